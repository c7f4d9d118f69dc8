"""Tables in the shared folder: lineage cuts and state that is versioned by micro-batch."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEAVY = re.compile(r"\b(Join|Window|WindowGroupLimit|Aggregate|Generate|Sort|Repartition\w*|\w*InPandas|\w*InArrow)\b")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can read: ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a temporary folder.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if path is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="onlinecast-"))
        path = context.getCheckpointDir()
    return path


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/onlinecast/{name}-{uuid.uuid4().hex}"


_own = threading.local()


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """Delete at the end the tables that ``written`` made meanwhile in this thread."""
    outer, _own.paths = getattr(_own, "paths", None), []
    try:
        yield
    finally:
        for path in _own.paths:
            delete(spark, path)
        _own.paths = outer


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, which cuts its lineage."""
    path = new_path(df.sparkSession, name)
    if getattr(_own, "paths", None) is not None:
        _own.paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def input_bytes(df: DataFrame) -> int:
    """Bytes of the tables ``df`` reads, as the optimizer knows them; runs no job."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def is_scan(df: DataFrame) -> bool:
    """Whether ``df`` only reads, filters and projects, so that evaluating it again is cheap."""
    return not HEAVY.search(df._jdf.queryExecution().optimizedPlan().toString())


def settled(df: DataFrame, limit: int) -> DataFrame:
    """``df`` for repeated use: written once if it reads more than ``limit`` bytes and is not a plain scan."""
    return df if input_bytes(df) <= limit or is_scan(df) else written(df)


def empty(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def size_bound(df: DataFrame) -> int:
    """Upper bound of the in-memory bytes of ``df``: rows times its widest row."""
    width = 0
    widest = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.ArrayType):
            widest.append(F.max(F.size(field.name) * 8))
        elif isinstance(field.dataType, (T.StringType, T.BinaryType)):
            widest.append(F.max(F.octet_length(field.name)))
        width += 16
    row = df.agg(F.count(F.lit(1)), *widest).first()
    return row[0] * (width + sum(v or 0 for v in row[1:]))


class VersionedTable:
    """State of a streaming job, one folder per micro-batch.

    Batch ``b`` reads the rows of versions below ``b`` and overwrites only version ``b``, so a
    replayed batch sees the same state and leaves the same result. A version holds the rows of
    the keys it touched; every ``compact``-th version holds all rows, which bounds what is read, and
    versions before the last such one are deleted once the next is written.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], compact: int = 20):
        self.spark, self.path, self.keys, self.compact = spark, path, keys, compact
        self.schema = T.StructType.fromDDL(schema)

    def _versions(self) -> list[int]:
        """Versions that were written completely."""
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path
        root = hadoop_path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        folders = [entry.getPath() for entry in fs.listStatus(root)]
        return sorted(int(f.getName().split("=")[1]) for f in folders if fs.exists(hadoop_path(f, "_SUCCESS")))

    def read(self, before: int | None = None) -> DataFrame:
        """Rows valid just before batch ``before`` (all batches when None)."""
        versions = [v for v in self._versions() if before is None or v < before]
        full = [v for v in versions if v % self.compact == 0]
        versions = [v for v in versions if not full or v >= full[-1]]
        if not versions:
            return empty(self.spark, self.schema)
        dated = T.StructType([*self.schema.fields, T.StructField("version", T.LongType())])
        rows = self.spark.read.schema(dated).parquet(self.path).where(F.col("version").isin(versions))
        if len(versions) > 1:
            newest = rows.groupBy(*self.keys).agg(F.max("version").alias("version"))
            rows = rows.join(newest, [*self.keys, "version"], "left_semi")
        return rows.drop("version")

    def has(self, batch_id: int) -> bool:
        return batch_id in self._versions()

    def write(self, changed: DataFrame, batch_id: int, whole: bool = False, replay_from: int | None = None) -> None:
        """Store the rows of the touched keys, or the whole table, as version ``batch_id``.

        Where a micro-batch stores several versions, ``replay_from`` is its first: a repeated one reads what was before it.
        """
        changed = changed.select(*self.schema.fieldNames())
        if not whole and batch_id % self.compact == 0 and any(v < batch_id for v in self._versions()):
            changed = written(changed, "state")
            kept = self.read(batch_id).join(changed.select(*self.keys).distinct(), self.keys, "left_anti")
            changed = changed.unionByName(kept)
        changed.write.mode("overwrite").parquet(f"{self.path}/version={batch_id}")
        self._purge(batch_id, batch_id if replay_from is None else replay_from)

    def _purge(self, batch_id: int, replay_from: int) -> None:
        """Delete what neither this batch, if it is repeated, nor a later one reads."""
        if batch_id % self.compact:
            return
        earlier = [v for v in self._versions() if v < replay_from]
        whole = max((v for v in earlier if v % self.compact == 0), default=0)
        for version in earlier:
            if version < whole:
                delete(self.spark, f"{self.path}/version={version}")
