"""Sharded WARC archives, the same files for the same rows wherever and however often they are written.

Rows are dealt to shards by ranges of (key, digest) that hold about equal bytes, and each shard is sorted and written
by a task of its own, so a file depends on the rows alone. Records are gzip members; a file is closed when its compressed
size reaches a limit. Headers, record ids and digests are made anew from key, address and payload. A task
writes under a temporary name and reports what it wrote; only files in the reports of tasks that succeeded
are renamed, and the manifest, written last, lists them. Readers open what the manifest lists.

Of records with equal payloads one is a response, the others revisit it. The path may be of any file system
that Arrow opens by its address.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from onlinecast.llm.common import Scratch, small_side
from onlinecast.plans.tables import new_path

SHARD_BYTES = 64 << 20
FILE_BYTES = 64 << 20
LEAST_SHARD_BYTES = 4 << 20
SHARDS = 64
MAX_SHARDS = 65_536
STEP_BITS = 8
DIGITS = (0, 2, 4, 6, 40)
LEVEL = 6
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
REPORT = "shard int, part int, temporary string, name string, records long, bytes long, sha256 string"


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in path:
        path = re.sub(r"^(file:)?/*", "file:///", path)
    return pafs.FileSystem.from_uri(path)


def cell_levels(lo: int, hi: int) -> list[tuple[int, int]]:
    """Ever finer cells of (key, digest): how many low bits of the key do not count, and how many hex digits of the digest do."""
    varying = 64 if (lo < 0) != (hi < 0) else (lo ^ hi).bit_length()
    return [*((bits, 0) for bits in range(max(0, varying - STEP_BITS), 0, -STEP_BITS)), *((0, digits) for digits in DIGITS)]


def in_cell(df: DataFrame, levels: list[tuple[int, int]]) -> DataFrame:
    """``df`` with the cell of its ``level``: whether it has a key, the leading bits of the key and digits of the digest."""
    bits, digits = (F.element_at(F.array(*map(F.lit, values)), F.col("level") + 1) for values in zip(*levels, strict=True))
    df = df.withColumns({"bits": bits, "digits": digits})
    return df.withColumns({
        "keyed": F.col("key").isNotNull(),
        "least": F.coalesce(F.expr("shiftleft(shiftright(key, bits), bits)"), F.lit(0)),
        "lead": F.substring(F.hex("digest"), F.lit(1), F.col("digits")),
    }).drop("bits", "digits")


def shards_of(slim: DataFrame, scratch: Scratch, shard_bytes: int | None) -> tuple[Callable[[DataFrame], DataFrame], int]:
    """From ``slim`` (key, digest, n_bytes): what adds the ``shard`` to rows with key and digest, and the number of shards.

    Cells of the keys, and of the digests of one key, are cut into smaller ones until none has more than a shard's bytes;
    rows equal in both stay together. At most as many cells as there are shards are cut at each level, so what
    is broadcast is bounded by ``MAX_SHARDS`` rows, however keys are spread. Without ``shard_bytes`` its size follows from that of
    the table.
    """
    found = slim.agg(F.min("key").alias("lo"), F.max("key").alias("hi"), F.sum("n_bytes").alias("bytes")).first()
    total = found["bytes"] or 0
    if shard_bytes is None:
        shard_bytes = min(SHARD_BYTES, max(LEAST_SHARD_BYTES, total // SHARDS))
    shard_bytes = max(shard_bytes, total // MAX_SHARDS + 1)
    levels = cell_levels(found["lo"] or 0, found["hi"] or 0)
    cell = ["keyed", "least", "lead"]

    cut: list[DataFrame] = []
    rest = slim
    for level in range(len(levels) - 1):
        rest = in_cell(rest.withColumn("level", F.lit(level)), levels)
        full = rest.groupBy(*cell).agg(F.sum("n_bytes").alias("bytes")).where(F.col("bytes") > shard_bytes)
        full = scratch.write(full.select(*cell), f"cells{level}")
        if full.isEmpty():
            break
        cut.append(full)
        rest = rest.join(F.broadcast(full), cell, "left_semi").drop("level", *cell)  # at most MAX_SHARDS rows

    def celled(df: DataFrame) -> DataFrame:
        df = df.withColumn("finest", F.lit(0))
        for level, full in enumerate(cut):
            df = in_cell(df.withColumn("level", F.lit(level)), levels)
            df = df.join(F.broadcast(full.withColumn("full", F.lit(level + 1))), cell, "left")
            df = df.withColumn("finest", F.coalesce("full", "finest")).drop("full", "level", *cell)
        return in_cell(df.withColumnRenamed("finest", "level"), levels)

    filled = celled(slim).groupBy("level", *cell).agg(F.sum("n_bytes").alias("bytes"))
    # one row a cell: at most 2 ** STEP_BITS for each that was cut
    before = Window.orderBy(*cell).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("bytes").over(before), F.lit(0))
    placed = filled.select("level", *cell, F.floor(start / shard_bytes).cast("int").alias("shard"))
    placed = scratch.write(placed, "shards")
    last = placed.agg(F.max("shard")).first()[0]
    return lambda df: celled(df).join(small_side(placed), ["level", *cell]).drop("level", *cell), (last or 0) + 1


def record_id(key: int | None, digest: bytes, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMES, f'{key}|{digest.hex()}|{copy}')}>"


def sha1_name(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def record(head: list[tuple[str, str | None]], block: bytes) -> bytes:
    fields = [*head, ("WARC-Block-Digest", sha1_name(hashlib.sha1(block).digest())), ("Content-Length", str(len(block)))]
    lines = [f"{name}: {value}" for name, value in fields if value is not None]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def page_record(row: dict, refers_to: int | None, revisit: bool, copy: int, date: str) -> bytes:
    """Response with the payload, or revisit of the response to ``refers_to`` with the same payload."""
    payload = row["payload"] or b""
    digest = row["digest"]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    address = row["url"] and re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", row["url"])
    key = row["key"]
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(key, digest, copy)),
        ("WARC-Date", date),
        ("WARC-Target-URI", address),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", sha1_name(digest)),
        ("X-Payload-Length", str(len(payload))),
        ("X-Row-Key", None if key is None else str(key)),
    ]
    if revisit:
        head += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", record_id(refers_to, digest, 0)),
            ("X-Refers-To-Key", None if refers_to is None else str(refers_to)),
        ]
    return record(head, http if revisit else http + payload)


class ShardFile:
    """A file under a temporary name; counts records and compressed bytes."""

    def __init__(self, root: str, shard: int, part: int, date: str):
        self.shard, self.part = shard, part
        self.name = f"shard-{shard:07d}-{part:05d}.warc.gz"
        self.temporary = f"_temporary/{self.name}.{uuid.uuid4().hex}"
        files, base = opened(root)
        files.create_dir(f"{base}/_temporary", recursive=True)
        self.stream = files.open_output_stream(f"{base}/{self.temporary}")
        self.bytes = self.records = 0
        self.sha256 = hashlib.sha256()
        info = b"format: WARC File Format 1.1\r\n"
        name = f"<urn:uuid:{uuid.uuid5(NAMES, self.name)}>"
        self.add(record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", name), ("WARC-Date", date),
                         ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], info))

    def add(self, data: bytes) -> None:
        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        member = packer.compress(data) + packer.flush()
        self.stream.write(member)
        self.sha256.update(member)
        self.bytes += len(member)
        self.records += 1

    def report(self) -> tuple:
        self.stream.close()
        return self.shard, self.part, self.temporary, self.name, self.records, self.bytes, self.sha256.hexdigest()


def write_warc(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html",
    min_bytes: int = 0, shard_bytes: int | None = None, file_bytes: int = FILE_BYTES, date: str = DATE,
) -> DataFrame:
    """Write a record for every row to an empty or new folder; returns the manifest.

    Of payloads (UTF-8; null is empty) that are equal and have at least ``min_bytes`` bytes, the row with the largest
    key is the response and the others revisit it; of rows that repeat that key and payload the first is. Rows
    without key come first and revisit those with one. A null address leaves its header out. An empty table
    gives an empty manifest. Other columns are ignored.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    rows = pages.select(
        F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.unhex(F.sha1("payload")))
    slim = rows.select("key", "digest", F.octet_length("payload").cast("long").alias("n_bytes"))
    slim = scratch.write(slim, "slim")
    with_shard, n_shards = shards_of(slim, scratch, shard_bytes)
    largest = slim.where(F.col("n_bytes") >= min_bytes).groupBy("digest").agg(
        F.max("key").alias("refers_to"), F.count("*").alias("n")
    )
    revisits = slim.join(largest.where("n > 1").drop("n"), "digest").where(~F.col("key").eqNullSafe(F.col("refers_to")))
    info = revisits.select("key", "digest", "refers_to").distinct()
    none = F.lit(None)
    pages = rows.select("key", "digest", F.lit(1).alias("kind"), "url", "payload", none.cast("long").alias("refers_to"))
    info = info.select("key", "digest", F.lit(0), none.cast("string"), none.cast("binary"), "refers_to")
    columns = ["shard", "key", "digest", "kind", "url", "payload", "refers_to"]
    located = with_shard(pages.union(info)).select(*columns)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file: ShardFile | None = None
        reports, last, copies, told = [], None, 0, None
        for batch in batches:
            for at in range(len(batch)):
                row = {name: batch.column(i)[at].as_py() for i, name in enumerate(batch.schema.names)}
                same = (row["key"], row["digest"])
                if row["kind"] == 0:
                    told = (*same, row["refers_to"])
                    continue
                copies = copies + 1 if same == last else 0
                last = same
                if file is not None and (row["shard"] != file.shard or file.bytes >= file_bytes):
                    reports.append(file.report())
                    file = ShardFile(path, row["shard"], file.part + 1 if row["shard"] == file.shard else 0, date)
                elif file is None:
                    file = ShardFile(path, row["shard"], 0, date)
                revisit = told is not None and told[:2] == same
                again = copies > 0 and len(row["payload"]) >= min_bytes
                target = told[2] if revisit else row["key"]
                file.add(page_record(row, target, revisit or again, copies, date))
        if file is not None:
            reports.append(file.report())
        if reports:
            yield pa.RecordBatch.from_pydict(dict(zip([f.split()[0] for f in REPORT.split(", ")], map(list, zip(*reports)), strict=True)), schema=REPORT_SCHEMA)

    order = [F.col("shard"), F.col("key").asc_nulls_first(), F.col("digest"), F.col("kind"), F.col("url").asc_nulls_first()]
    sorted_rows = located.repartitionById(n_shards, F.col("shard")).sortWithinPartitions(*order)
    reports = scratch.write(sorted_rows.mapInArrow(write, REPORT), "reports")

    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = opened(path)
        for batch in batches:
            for row in batch.to_pylist():
                target = files.get_file_info(f"{base}/{row['name']}")
                if target.type == pafs.FileType.NotFound:
                    files.move(f"{base}/{row['temporary']}", f"{base}/{row['name']}")
                elif target.size != row["bytes"]:
                    raise ValueError(f"{row['name']} is there already, with {target.size} bytes")
            yield batch

    reports.mapInArrow(commit, REPORT).drop("temporary").write.parquet(f"{path}/_manifest")
    temporary = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_temporary")
    temporary.getFileSystem(spark._jsc.hadoopConfiguration()).delete(temporary, True)
    return spark.read.parquet(f"{path}/_manifest")


REPORT_SCHEMA = pa.schema(
    [("shard", pa.int32()), ("part", pa.int32()), ("temporary", pa.string()), ("name", pa.string()),
     ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())]
)
RECORD_SCHEMA = pa.schema(
    [("file", pa.string()), ("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()),
     ("refers_to_id", pa.string()), ("key", pa.int64()), ("refers_to", pa.int64()), ("payload_digest", pa.string()),
     ("payload_bytes", pa.int64()), ("payload", pa.binary())]
)
RECORD = (
    "file string, record_type string, record_id string, target_uri string, refers_to_id string, key long, "
    "refers_to long, payload_digest string, payload_bytes long, payload binary"
)


def members(stream) -> Iterator[bytes]:
    """Records of an archive: its gzip members, read piece by piece."""
    data = stream.read(1 << 20)
    while data:
        unpack, parts = zlib.decompressobj(31), []
        while not unpack.eof:
            if not data:
                data = stream.read(1 << 20)
                if not data:
                    raise ValueError("the archive ends within a record")
            parts.append(unpack.decompress(data))
            data = unpack.unused_data
        yield b"".join(parts)
        data = data or stream.read(1 << 20)


def parsed(file: str, raw: bytes, payloads: bool) -> dict | None:
    """Fields of a record; None for other types. Raises if a digest does not fit what it covers."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if sha1_name(hashlib.sha1(block).digest()) != fields["WARC-Block-Digest"]:
        raise ValueError(f"{file}: block of {fields['WARC-Record-ID']} does not fit its digest")
    kind = fields["WARC-Type"]
    if kind not in ("response", "revisit"):
        return None
    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
    digest = fields["WARC-Payload-Digest"]
    if payload is not None and sha1_name(hashlib.sha1(payload).digest()) != digest:
        raise ValueError(f"{file}: payload of {fields['WARC-Record-ID']} does not fit its digest")
    whole = lambda name: int(fields[name]) if name in fields else None
    return {
        "file": file, "record_type": kind, "record_id": fields["WARC-Record-ID"], "target_uri": fields.get("WARC-Target-URI"),
        "refers_to_id": fields.get("WARC-Refers-To"), "key": whole("X-Row-Key"), "refers_to": whole("X-Refers-To-Key"),
        "payload_digest": digest.removeprefix("sha1:"),
        "payload_bytes": len(payload) if payload is not None else whole("X-Payload-Length"),
        "payload": payload if payloads else None,
    }


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Responses and revisits of the archives in the manifest of ``path``; every digest is checked."""
    manifest = spark.read.parquet(f"{path}/_manifest")
    tasks = max(1, manifest.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = opened(path)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with files.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for raw in members(stream):
                        row = parsed(name, raw, payloads)
                        if row is not None:
                            rows.append(row)
                            held += len(row["payload"] or b"") + 512
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=RECORD_SCHEMA)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=RECORD_SCHEMA)

    return manifest.select("name").repartition(tasks, "name").mapInArrow(read, RECORD)


def archived(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write ``pages`` and read the archives back, without payloads."""
    path = path or new_path(pages.sparkSession, "archives")
    write_warc(pages, path, **options)
    return read_warc(pages.sparkSession, path, payloads=False)
