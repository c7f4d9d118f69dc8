"""Text functions on topics and reading payloads."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def decode_number(payload: str | Column) -> Column:
    """UTF-8 bytes (or text) of one number as double; null if it is not a number."""
    payload = F.col(payload) if isinstance(payload, str) else payload
    return F.trim(payload.cast("string")).try_cast("double")


def stream_id(topic: str | Column, prefix: str) -> Column:
    """Number after the last occurrence of ``prefix``; null if that is not an integer."""
    return F.element_at(F.split(topic, re.escape(prefix)), -1).try_cast("int")
