import base64
import gzip
import hashlib

import pytest
from pyarrow import fs as pafs
from pyspark.sql import functions as F

from onlinecast.llm import warc
from onlinecast.plans.tables import new_path
from tests.llm.frames import SMALL, clashing, none_of

PAGES = "page_id long, url string, html string"


def odd_pages(spark):
    rows = [
        (5, "http://a/1", "<p>same"), (9, "http://a/2", "<p>same"), (7, "http://b/ x\n", "<p>same"), (9, "http://a/2", "<p>same"),
        (1, None, None), (2, "http://c", ""), (3, "http://d", "Ünïcödé"), (-4, "http://e", "x" * 300_000),
        (None, "http://f", "<p>same"), (None, "http://g", "alone"), (2**62, "http://h", "far away"),
    ]
    return clashing(spark.createDataFrame(rows, PAGES), "key", "shard", "digest", "kind", "refers_to")


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def brute(rows, min_bytes=0):
    largest, out = {}, []
    for key, _, text in rows:
        d = digest(text)
        if len((text or "").encode()) >= min_bytes:
            have = largest.setdefault(d, key)
            largest[d] = key if have is None or (key is not None and key > have) else have
    written = set()
    for key, _, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        d, n = digest(text), len((text or "").encode())
        first = d not in largest or (key == largest[d] and (key, d) not in written)
        written.add((key, d))
        out.append((key, n, d, "response" if first else "revisit", None if first else largest[d]))
    return sorted(out, key=repr)


def records(frame):
    columns = ["key", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("min_bytes", [0, 1, 6])
def test_odd_rows(spark, min_bytes):
    pages = odd_pages(spark)
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    assert records(warc.archived(pages, min_bytes=min_bytes)) == brute(rows, min_bytes)


def test_payloads_come_back(spark):
    path = new_path(spark, "archives")
    pages = odd_pages(spark).where("page_id <> 9")
    warc.write_warc(pages, path)
    got = {r.key: r for r in warc.read_warc(spark, path).where("record_type = 'response'").collect()}
    assert bytes(got[3].payload).decode() == "Ünïcödé" and bytes(got[2].payload) == b"" and 1 not in got
    assert len(got[-4].payload) == 300_000
    assert got[7].target_uri == "http://b/%20x%0A"
    revisit = warc.read_warc(spark, path).where("record_type = 'revisit' and key = 5").first()
    assert revisit.refers_to == 7 and revisit.refers_to_id == got[7].record_id


def test_files_depend_on_the_rows_alone(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    found = []
    for frame in (pages, pages.repartition(7), pages.orderBy(F.rand(3))):
        path = new_path(spark, "archives")
        rows = warc.write_warc(frame, path, shard_bytes=40_000, file_bytes=8_000).orderBy("name").collect()
        found.append([(r.name, r.records, r.bytes, r.sha256) for r in rows])
        files, base = warc.opened(path)
        names = {f.base_name for f in files.get_file_info(pafs.FileSelector(base)) if f.base_name.endswith(".gz")}
        assert names == {r.name for r in rows}
        assert all(r.bytes < 8_000 + 40_000 for r in rows)
    assert found[0] == found[1] == found[2]
    assert len({r[0].split("-")[1] for r in found[0]}) > 2 and any("-00001." in r[0] for r in found[0])


@pytest.mark.parametrize("key", ["cast(null as bigint)", "7", "if(id < 2, -shiftleft(1, 40 + 20 * id), id)"])
def test_shards_hold_about_equal_bytes(spark, key):
    random = F.expr("array_join(transform(sequence(1, 40), k -> sha2(string(id * 41 + k), 512)), '')")
    pages = spark.range(400).select(F.expr(key).alias("page_id"), F.lit("u").alias("url"), random.alias("html"))
    manifest = warc.write_warc(pages, new_path(spark, "archives"), shard_bytes=100_000).collect()
    held = {}
    for row in manifest:
        held[row.shard] = held.get(row.shard, 0) + row.records - 1
    assert sum(held.values()) == 400 and max(held.values()) * 5120 <= 200_000 and len(held) >= 20


def test_cells_are_nested():
    assert warc.cell_levels(0, 0) == [(0, d) for d in warc.DIGITS]
    assert [bits for bits, _ in warc.cell_levels(3, 70_000)] == [9, 1, *[0] * len(warc.DIGITS)]
    assert [bits for bits, _ in warc.cell_levels(-1, 1)][:8] == [56, 48, 40, 32, 24, 16, 8, 0]


def test_members_are_records_in_order_of_the_key(spark):
    path = new_path(spark, "archives")
    manifest = warc.write_warc(spark.read.parquet(f"{SMALL}/pages.parquet"), path).collect()
    files, base = warc.opened(path)
    data = files.open_input_stream(f"{base}/{manifest[0].name}", compression=None).read()
    text = gzip.decompress(data)
    assert text.count(b"WARC/1.1\r\n") == manifest[0].records
    keys = [int(line.split(b": ")[1]) for line in text.split(b"\r\n") if line.startswith(b"X-Row-Key")]
    assert keys == sorted(keys) and text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")


def test_damage_is_noticed(spark):
    raw = warc.page_record({"payload": b"abc", "digest": hashlib.sha1(b"abc").digest(), "url": "u", "key": 1}, None, False, 0, warc.DATE)
    assert warc.parsed("f", raw, True)["payload"] == b"abc"
    with pytest.raises(ValueError):
        warc.parsed("f", raw.replace(b"abc\r\n", b"abd\r\n"), True)
    with pytest.raises(ValueError):
        list(warc.members(pafs.LocalFileSystem().open_input_stream(_cut(raw), compression=None)))


def _cut(raw):
    import tempfile

    with tempfile.NamedTemporaryFile(delete=False) as file:
        file.write(gzip.compress(raw)[:-9])
    return file.name


def test_a_second_write_is_refused(spark):
    path = new_path(spark, "archives")
    pages = odd_pages(spark)
    warc.write_warc(pages, path)
    with pytest.raises(Exception, match="already exists"):
        warc.write_warc(pages, path)


def test_empty_table(spark):
    assert warc.archived(none_of(odd_pages(spark))).count() == 0
