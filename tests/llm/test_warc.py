import hashlib
import io
import random
import struct
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parcelog.llm import warc


def brute(rows):
    by = {}
    for i, _, h in rows:
        data = (h or "").encode()
        if len(data) >= 100 and i is not None:
            by[data] = min(i, by.get(data, i))
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        first = by.get(data)
        revisit = first is not None and i != first
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def test_pages_round_trip(spark):
    r = random.Random(1)
    bodies = [None, "", "short", "é" * 50, "é" * 49, "x" * 100000, "<p>\r\n\r\nWARC/1.1\r\n" * 9, *(f"<html>{i}" * 30 for i in range(20))]
    rows = [(i, r.choice([None, "http://a b/\nc", "http://x"]), r.choice(bodies)) for i in range(200)] + [(None, "u", bodies[5]), (None, None, "only here" * 20), (7, "u", "twice" * 30), (7, "u", "twice" * 30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    got = warc.archive_pages(spark, pages)
    assert sorted((tuple(x) for x in got.collect()), key=str) == brute(rows)
    assert warc.archive_pages(spark, pages.limit(0)).count() == 0


def test_single_records_without_extraction(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"body {i} " * 40) for i in range(30)]
    manifest = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), f"file://{tmp_path}/w", records=12)
    paths = [x.path for x in manifest.collect()]
    assert len(paths) == 3
    found = [warc.read_record(p, 17) for p in paths]
    (one,) = [x for x in found if x]
    assert one[2] == rows[17][2].encode() and one[0]["warc-target-uri"] == "http://h/17"
    with zipfile.ZipFile(paths[0].removeprefix("file://")) as z:
        assert z.testzip() is None and z.namelist() == [warc.RECORDS, warc.INDEX]


def test_reader_takes_plain_zip_and_zip64():
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("a.txt", "plain")
        with z.open("b.txt", "w", force_zip64=True) as f:
            f.write(b"wide")
        z.writestr("c.txt", "packed" * 99, zipfile.ZIP_DEFLATED)
        z.comment = b"a comment with PK\x05\x06 in it"
    reader = warc.ZipReader(pa.BufferReader(data.getvalue()))
    assert (reader.read("a.txt"), reader.read("b.txt", 1, 2)) == (b"plain", b"id")
    with pytest.raises(ValueError):
        reader.place("c.txt")
    with pytest.raises(ValueError):
        warc.ZipReader(pa.BufferReader(b"not a zip" * 9))


def test_offsets_beyond_four_gigabytes():
    """A directory entry whose sizes and place only stand in its ZIP64 field."""
    name, extra = b"x", struct.pack("<HHQQQ", 1, 24, 5 << 32, 5 << 32, 6 << 32)
    entry = struct.pack("<IHHHHHHIIIHHHHHII", warc.CENTRAL, 45, 45, 0, 0, 0, 0, 0, warc.MOST32, warc.MOST32, 1, len(extra), 0, 0, 0, 0, warc.MOST32) + name + extra
    ((_, member),) = warc.ZipReader._directory(None, entry, 1)
    assert member["size"] == 5 << 32 and member["start"] == 6 << 32


def test_urls_with_braces(spark, tmp_path):
    rows = [(i, u, f"body {i} " * 40) for i, u in enumerate(["http://h/item/{id}", "{", "http://h/{\"offset\": 1} x", "http://h/ "])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted((tuple(x) for x in warc.archive_pages(spark, pages).collect()), key=str) == brute(rows)
    (path,) = [x.path for x in warc.write_archives(pages.coalesce(1), f"file://{tmp_path}/w").collect()]
    assert [warc.read_record(path, i)[2].decode() for i in range(4)] == [h for _, _, h in rows]
