import base64
import hashlib

from ledgerlake.llm import warc
from ledgerlake.session import scratch_dir


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


TRAP = "x WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\nWARC/1.1\r\nend"
PAGES = [
    (1, "http://a/", "one"), (2, "http://b/", None), (3, None, "dup é\n"), (4, "u\r\nv", "dup é\n"), (5, "c", TRAP), (6, "d", "WARC/1.1\r\n"),
    (7, "e", ""), (8, "f", "long " * 50_000), (9, "g", "dup é\n"), (9, "g", "dup é\n"), (None, "h", "lonely"), (10, "i", "\r\n\r\n"), (11, "j", TRAP),
]


def read(spark, pages, **kw):
    path = scratch_dir(spark, "warc-test")
    warc.write_archives(pages, path, **kw)
    return path, warc.read_archives(spark, path).collect()


def check(rows, min_revisit=0):
    found = {(r.id, r.payload_digest or r.declared) for r in rows}
    assert len(rows) == len(PAGES) and len(found) == len(PAGES) - 1
    first = {}
    for k, _, html in PAGES:
        if k is not None:
            first[html or ""] = min(k, first.get(html or "", k))
    for r in rows:
        k = r.id[len("<urn:page:") : -1]
        html = next(h or "" for i, _, h in PAGES if str(i if i is not None else "") == k)
        again = k and first[html] < int(k) and len(html.encode()) >= min_revisit
        assert r.kind == ("revisit" if again else "response") and r.declared == "sha1:" + digest(html)
        assert r.http_length == len(html.encode())
        assert (r.refers == f"<urn:page:{first[html]}>") if again else (r.payload_digest == digest(html) and r.payload_bytes == len(html.encode()))


def test_records_come_back(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "'z' as digest", "1 as bytes")
    _, rows = read(spark, pages.coalesce(1))
    check(rows)
    _, rows = read(spark, pages, min_revisit=7)
    check(rows, 7)


def test_split_files(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    path = scratch_dir(spark, "warc-test")
    warc.write_archives(pages.coalesce(1), path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "701")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        check(warc.read_archives(spark, path).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def test_no_pages(spark):
    _, rows = read(spark, spark.createDataFrame([], "page_id long, url string, html string"))
    assert rows == []
