"""Column functions: topic text, vectors and losses."""

from onlinecast.functions.text import decode_number, stream_id
from onlinecast.functions.vectors import cosine_to_ones, dot, linear_output, squared_distance

__all__ = ["cosine_to_ones", "decode_number", "dot", "linear_output", "squared_distance", "stream_id"]
