import gzip
import hashlib
import io
import pathlib
import random

from pyspark.sql import functions as F

from siltline.llm import warc


def test_round_trip(spark, path):
    long = "<p>zwölf 漢字 😀\r\n\r\nWARC/1.1\r\n" + "x" * 40_000 + "</p>" * 3000
    tie = "t" * 200
    rows = [
        (3, "http://a/\r\nb c", long), (1, "http://b", long), (9, None, long), (4, "u", None), (5, "u", ""), (6, "u", "short"),
        (7, "u", "short"), (2, "u", tie), (2, "v", tie), (8, "u", tie), (10, "u", "é" * 50), (11, "u", "é" * 50), (12, "u", "y" * 99),
        (13, "u", "y" * 99), (14, "u", "0\r\n\r\n" * 30), (1, "http://b", long), (None, "u", tie),
    ]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, record string").repartition(4)
    warc.write(pages, f"{path}/warc")
    found = warc.read_pages(spark, f"{path}/warc").collect()
    assert all(r.complete for r in found) and len(found) == len(rows)
    least = {}
    for k, _, html in rows:
        if html and len(html.encode()) >= 100 and k is not None:
            least[html] = min(k, least.get(html, k))
    want = []
    for k, _, html in rows:
        data = (html or "").encode()
        first = least.get(html)
        revisit = first is not None and k != first
        want.append((k, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    key = lambda r: tuple((x is not None, x or 0) if not isinstance(x, str) else x for x in r)
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert {r.uri for r in found if r.page_id == 3} == {"http://a/bc"}


def test_files_are_archives_other_readers_can_follow(spark, path):
    html = "<html>" + "abc é " * 9000
    pages = spark.createDataFrame([(1, "http://a", html), (2, "http://b", html)], "page_id long, url string, html string")
    warc.write(pages, path + "/w")
    files = spark.read.format("binaryFile").load(path + "/w").select("content").collect()
    data = b"".join(gzip.decompress(bytes(f.content)) for f in files)
    records = list(warc.parse(io.BytesIO(data)))
    kinds = [r[1] for r in records]
    assert kinds.count("response") == kinds.count("revisit") == 1 and kinds.count("continuation") >= 2
    for kind in (b"WARC-Type: revisit", b"WARC-Segment-Total-Length: ", b"WARC-Refers", b"WARC-Segment-Origin-ID: <urn:uuid:"):
        assert (kind in data) == (kind != b"WARC-Refers")
    segments = sorted((r[6], r[8]) for r in records if r[6])
    assert warc._body(b"".join(b for _, b in segments)).decode() == html


def test_broken_records(spark):
    rows = [
        ("a", "response", "1", None, None, None, 1, None, b"HTTP/1.1 200 OK\r\n\r\nab"), ("b", "continuation", None, None, None, "a", 2, 23, b"cd"),
        ("c", "response", "2", None, None, None, 1, None, b"HTTP/1.1 200 OK\r\n\r\nab"), ("d", "continuation", None, None, None, "c", 3, 23, b"cd"),
        ("e", "response", "3", None, None, None, 1, None, b"HTTP/1.1 200 OK\r\n\r\nab"), ("f", "continuation", None, None, None, "e", 2, 99, b"cd"),
        ("g", "response", "4", None, None, None, None, None, b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n5\r\nab"),
        ("h", "response", "5", None, None, None, None, None, b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n2;x=y\r\nab\r\n1\r\nc\r\n0\r\n\r\n"),
    ]
    found = warc.reassemble(spark.createDataFrame(rows, warc.RECORD)).collect()
    got = {r.page_id: (r.complete, r.payload and bytes(r.payload)) for r in found}
    assert got == {"1": (True, b"abcd"), "2": (False, None), "3": (False, None), "4": (False, None), "5": (True, b"abc")}


def record(page, body, length=None, **more):
    head = {"WARC-Type": "response", "WARC-Record-ID": f"<{page}>", "X-Page-Id": str(page), **more}
    block = b"HTTP/1.1 200 OK\r\n\r\n" + body
    if length is not False:
        head["Content-Length"] = str(len(block) if length is None else length)
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def test_archives_that_are_broken(spark, path):
    (tmp := pathlib.Path(path) / "w").mkdir()
    whole = b"".join(record(k, bytes([65 + k]) * 3000 + b"\r\n") for k in range(10, 14))
    packed = gzip.compress(bytes(random.Random(1).randbytes(20_000)).hex().encode())
    (tmp / "cut.warc").write_bytes(record(1, b"one") + record(2, b"two", length=5000))
    (tmp / "none.warc").write_bytes(record(3, b"no length", length=False) + b"junk\r\n" + record(4, b"four"))
    (tmp / "bad.warc").write_bytes(record(5, b"bad length", length="-7") + record(6, b"six"))
    (tmp / "junk.warc").write_bytes(b"no archive\r\n" + record(7, b"seven"))
    (tmp / "gz.warc.gz").write_bytes(gzip.compress(whole)[:-40])
    (tmp / "gz2.warc.gz").write_bytes(packed[: len(packed) // 2])
    (tmp / "empty.warc").write_bytes(b"")
    (tmp / "last.warc").write_bytes(record(8, b"a", **{"WARC-Segment-Number": 1}) + record(9, b"b")[:-10])
    found = {r.page_id or 0: r for r in warc.read_pages(spark, str(tmp)).collect()}  # 0: cut off in its head
    assert {k for k in found if 0 < k < 10} == set(range(1, 10)) and {10, 11} <= set(found)
    assert {k for k, r in found.items() if r.complete and k < 10} == {1, 4, 6, 7}
    assert all((r.payload_bytes is None) == (r.payload_digest is None) == (not r.complete) for r in found.values())
    assert found[4].payload_digest == hashlib.sha256(b"four").hexdigest()
    assert [r[8] for r in warc.parse(warc._Archive(record(1, b"x", length=50)))] == [None]
    records = {r.page_id: r.block for r in warc.read_records(spark, str(tmp)).collect()}
    assert records["2"] is None and bytes(records["1"]).endswith(b"one")


def test_empty_table(spark, path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write(pages, path + "/w")
    assert warc.read_pages(spark, path + "/w").count() == 0
    assert pages.select(warc.chunked(F.col("html"))).count() == 0
