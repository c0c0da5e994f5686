import base64
import gzip
import hashlib

from pyspark.sql import functions as F

from tamis.llm import warc


def written(spark, rows, **options):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, path string")
    return warc.write_archives(pages, **options)


def test_round_trip_in_chunks(spark):
    texts = ["é" * 1000, "", "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n", "é" * 1000, None, "plain"]
    rows = [(i, f"http://h/{i}\n?q" if i else None, t, "clash") for i, t in enumerate(texts)]
    manifest = written(spark, rows, chunk_bytes=64, archive_bytes=300)
    assert sum(r.records for r in manifest.collect()) == 6
    chunks = warc.read_chunks(manifest, chunk_bytes=50).collect()
    got = {}
    for c in sorted(chunks, key=lambda c: (c.page_id, c.chunk_no)):
        assert len(c.data) <= 50
        got[c.page_id] = got.get(c.page_id, b"") + c.data
        assert c.bytes_so_far == len(got[c.page_id])
        assert c.digest_so_far == base64.b32encode(hashlib.sha1(got[c.page_id]).digest()).decode()
    last = {c.page_id: c for c in chunks if c.last}
    for i, text in enumerate(texts):
        raw = (text or "").encode()
        assert last[i].payload_bytes == len(raw)
        assert last[i].payload_digest == base64.b32encode(hashlib.sha1(raw).digest()).decode()
        twin = {0: 3, 1: 4}.get(i)
        assert (last[i].record_type, last[i].refers_to) == (("revisit", twin) if twin else ("response", None))
        if not twin:
            assert got[i] == raw
    assert last[0].url is None and last[1].url == "http://h/1%0A?q"


def test_every_archive_is_a_task(spark):
    manifest = written(spark, [(i, "u", f"{i} " * 400, "") for i in range(40)], archive_bytes=1)
    tasks = warc.read_chunks(manifest).select(F.spark_partition_id().alias("task")).distinct().count()
    assert manifest.count() == tasks == 40


def test_small_payloads_do_not_refer(spark):
    rows = [(1, "u", "same", ""), (2, "u", "same", ""), (3, "u", "much longer same", ""), (4, "u", "much longer same", "")]
    last = warc.read_chunks(written(spark, rows, min_bytes=5)).filter("last").collect()
    assert {r.page_id: r.refers_to for r in last} == {1: None, 2: None, 3: 4, 4: None}


def test_files_are_gzip_members(spark):
    path = written(spark, [(1, "http://a", "one", ""), (2, "http://b", "two", "")]).first().path
    text = gzip.open(path.removeprefix("file://")).read()
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and text.endswith(b"\r\n\r\n")


def test_odd_rows(spark):
    rows = [(None, "u", "a", ""), (None, "u", "a", ""), (5, "u", "a", ""), (6, "u", "b", ""), (6, "v", "b", ""), (7, None, None, "")]
    last = warc.read_chunks(written(spark, rows)).filter("last").collect()
    got = sorted((str(r.page_id), r.record_type, r.refers_to or 0) for r in last)
    assert got == [("5", "response", 0), ("6", "response", 0), ("6", "response", 0), ("7", "response", 0),
                   ("None", "revisit", 5), ("None", "revisit", 5)]
    manifest = written(spark, [])
    assert manifest.count() == 0 and warc.read_chunks(manifest).count() == 0
