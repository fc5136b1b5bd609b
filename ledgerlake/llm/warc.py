"""WARC archives: one record per page, written as text with Spark, and read back by boundary-chain verification.

A record ends where its Content-Length says, so the record starts of a file form a chain from its first byte. Every
occurrence of the magic is a candidate; tasks emit each candidate's place and its successor's, and pointer jumping
from the start of the file keeps those that the chain reaches. A magic inside a payload is never reached.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import discard, ship, written

MAGIC, CRLF = "WARC/1.1\r\n", "\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of a binary column's SHA-1: five hexadecimal digits are four of base 32."""
    digest = F.sha1(payload)
    digits = [
        F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)
    ]
    # fixed values: the digits of conv() and of RFC 4648
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write_archives(
    pages: DataFrame, path: str, min_revisit: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> None:
    """One record for each page, in uncompressed archives below `path`.

    Of pages with equal payloads of at least `min_revisit` bytes, that with the
    smallest id becomes a response and the others revisit it, with headers only;
    rows that share this id are all responses, as are smaller payloads and rows
    with a null id. A null html is an empty payload, a null url an empty target.
    """
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), payload.alias("payload")
    ).withColumns({
        "digest": base32_sha1(F.col("payload").cast("binary")), "bytes": F.octet_length("payload").cast("long")
    })
    long_enough = F.col("bytes") >= min_revisit
    # only payloads that occur again; a table, so that Spark knows its size when it joins
    first = written(
        rows.filter(long_enough).groupBy(F.col("digest").alias("of"))
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("of", "first"),
        "warc-copies",
    )
    revisit = F.coalesce(F.col("first") < F.col("page_id"), F.lit(False))
    joined = rows.join(first, long_enough & (F.col("digest") == F.col("of")), "left")
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    one_line = F.regexp_replace("url", r"[\x00-\x20]", "%20")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"),
        F.lit(CRLF + CRLF),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    head = F.concat(
        F.lit(f"{MAGIC}WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit(f"{CRLF}WARC-Record-ID: "), urn(F.col("page_id")),
        F.lit(f"{CRLF}WARC-Target-URI: "), one_line,
        F.lit(f"{CRLF}WARC-Date: {DATE}{CRLF}WARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit(f"{CRLF}WARC-Profile: {PROFILE}{CRLF}WARC-Refers-To: "), urn(F.col("first")))).otherwise(F.lit("")),
        F.lit(f"{CRLF}Content-Type: application/http; msgtype=response{CRLF}Content-Length: "),
        F.octet_length(block).cast("string"), F.lit(CRLF + CRLF),
    )
    joined.select(F.concat(head, block).alias("value")).write.option("lineSep", CRLF + CRLF).text(path)


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split(CRLF))
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


_SEGMENT = (
    "file string, block long, at long, size long, span long, kind string, id string, uri string, refers string, "
    "declared string, http_length long, payload_bytes long, payload_digest string"
)


def parse_payload(block: bytes) -> tuple[int | None, bytes]:
    """Content-Length that the HTTP head states, and the body."""
    head, _, body = block.partition(b"\r\n\r\n")
    length = _fields(head).get("content-length", "")
    return (int(length) if length.isdigit() else None), body


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What follows each magic, in the order of the file's block: place in the block, header fields, length to the next record."""
    place: dict[tuple[str, int], int] = {}
    for batch in batches:
        rows = []
        for file, block, value in zip(batch["file"], batch["block"], batch["value"]):
            at = place.get((file, block), 0)
            place[file, block] = at + len(value) + len(MAGIC)
            head, found, rest = bytes(value).partition(b"\r\n\r\n")
            fields = _fields(head) if found else {}
            length = fields.get("content-length", "")
            row = [file, block, at, len(value) + len(MAGIC), None, *[None] * 8]
            if length.isdigit():
                n = int(length)
                row[4] = len(MAGIC) + len(head) + 4 + n + 4
                row[5:10] = [fields.get(k) for k in ("warc-type", "warc-record-id", "warc-target-uri", "warc-refers-to", "warc-payload-digest")]
                if len(rest) >= n:  # else its payload goes on behind a magic
                    row[10], body = parse_payload(rest[:n])
                    row[11], row[12] = len(body), _digest(body)
            rows.append(row)
        yield pd.DataFrame(rows, columns=[f.split()[0] for f in _SEGMENT.split(", ")]).astype(
            {c: "Int64" for c in ("block", "at", "size", "span", "http_length", "payload_bytes")}
        )


def _segments(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.option("lineSep", MAGIC).text(path)
        .select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
            F.col("value").cast("binary").alias("value"),
        )
    )


def reach(links: DataFrame) -> DataFrame:
    """Rows (file, at) that the chain from place 0 of each file passes; links: (file, at, next), a written table.

    Pointer jumping: each round doubles the length of all jumps and adds what one
    jump from the reached places hits, so a chain of n records takes log2(n) rounds. A round's tables
    go when the next round's are written. Numbers pack so well that a table's size says little of its
    rows, so joins are by sort, whatever the size.
    """
    reached = written(links.filter("at = 0").select("file", "at"), "warc-reached")
    jumps, n, known = links, -1, links.select("file", "at")
    while True:
        hit = reached.join(jumps.hint("merge"), ["file", "at"]).select("file", F.col("next").alias("at"))
        more = written(reached.union(hit.join(known.hint("merge"), ["file", "at"], "left_semi")).distinct(), "warc-reached")
        discard(reached)
        reached, now = more, more.count()
        if now == n:
            break
        n = now
        ahead = jumps.select("file", F.col("at").alias("next"), F.col("next").alias("after"))
        doubled = written(
            jumps.join(ahead.hint("merge"), ["file", "next"]).select("file", "at", F.col("after").alias("next")), "warc-jumps"
        )
        if jumps is not links:
            discard(jumps)
        jumps = doubled
    if jumps is not links:
        discard(jumps)
    return reached


def _owners(placed: DataFrame, cut: DataFrame) -> DataFrame:
    """(file, block, local, record): the pieces that lie inside records of `cut`, by their places.

    A piece's record is the last that begins at it or before it: in its own block, or else
    the last of the blocks before.
    """
    begins = placed.select("file", "block", "at", "local").join(
        cut.select("file", F.col("record").alias("at"), F.struct("record", "next").alias("own")).hint("merge"), ["file", "at"], "left"
    )
    begins = written(begins, "warc-begins")
    in_block = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    blocks_before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = begins.groupBy("file", "block").agg(F.max("own").alias("own")).select(
        "file", "block", F.last("own", ignorenulls=True).over(blocks_before).alias("before")
    )
    found = begins.withColumn("own", F.last("own", ignorenulls=True).over(in_block)).join(carried, ["file", "block"])
    found = found.withColumn("own", F.coalesce("own", "before")).filter(F.col("at") < F.col("own.next"))
    owners = written(found.select("file", "block", "local", F.col("own.record").alias("record")), "warc-owners")
    discard(begins)
    return owners


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records below `path`: file, at, kind, id, uri, refers, declared digest, http_length, payload_bytes, payload_digest.

    Archives may be uncompressed, and then are read in splits, or gzip files as a
    whole. Bytes before the first record make a file unreachable, and it gives
    no rows; so do records behind a broken length. An empty folder gives no rows. A payload may be of
    any length: one that holds the magic is put together from its pieces in one task.
    """
    ship(spark)
    parsed = written(_segments(spark, path).mapInPandas(_candidates, _SEGMENT), "warc-candidates")
    numbers = written(parsed.select("file").distinct().withColumn("number", F.monotonically_increasing_id()), "warc-files")
    rows = parsed.withColumnRenamed("file", "name").join(numbers.select(F.col("file").alias("name"), F.col("number").alias("file")), "name").drop("name")
    # a block's first piece begins where those of the blocks before end; the piece ahead of the first magic is empty
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("file", "block").agg(F.sum("size").alias("n"))
        .select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    placed = rows.join(written(starts, "warc-starts"), ["file", "block"]).withColumns(
        {"local": F.col("at"), "at": F.col("at") + F.col("start") - len(MAGIC)}
    )
    placed = placed.drop("start").filter("at >= 0")
    links = written(placed.filter("span is not null").select("file", "at", (F.col("at") + F.col("span")).alias("next")), "warc-links")
    real = placed.join(reach(links).hint("merge"), ["file", "at"]).drop("size").withColumn("next", F.col("at") + F.col("span"))
    real = written(real, "warc-records")
    fields = ["file", "at", "kind", "id", "uri", "refers", "declared", "http_length", "payload_bytes", "payload_digest"]

    def named(records: DataFrame) -> DataFrame:
        names = numbers.select(F.col("file").alias("name"), F.col("number").alias("file"))
        return records.select(*fields).join(names, "file").drop("file").withColumnRenamed("name", "file").select(*fields)

    whole = real.filter("payload_digest is not null")
    cut = written(real.filter("payload_digest is null").select("file", F.col("at").alias("record"), "next"), "warc-cut")
    if cut.isEmpty():
        return named(whole)
    # payloads that hold the magic: their pieces, joined again
    owners = _owners(placed, cut).join(numbers.select(F.col("file").alias("name"), F.col("number").alias("file")), "file")
    pieces = _segments(spark, path).mapInPandas(_places, "file string, block long, at long, value binary").select(
        F.col("file").alias("name"), "block", F.col("at").alias("local"), "value"
    )
    joined = pieces.join(owners, ["name", "block", "local"]).groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("block", "local", "value"))).alias("parts")
    )
    magic = F.lit(MAGIC).cast("binary")
    raw = joined.select("file", F.col("record").alias("at"), F.aggregate(
        "parts", F.lit(b""), lambda a, x: F.concat(a, magic, x["value"])
    ).alias("raw"))
    mended = raw.mapInPandas(_mend, "file long, at long, http_length long, payload_bytes long, payload_digest string")
    late = real.filter("payload_digest is null").drop("http_length", "payload_bytes", "payload_digest").join(mended, ["file", "at"])
    return named(whole.select(*fields).unionByName(late.select(*fields)))


def _places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    place: dict[tuple[str, int], int] = {}
    for batch in batches:
        ats = []
        for file, block, value in zip(batch["file"], batch["block"], batch["value"]):
            at = place.get((file, block), 0)
            place[file, block] = at + len(value) + len(MAGIC)
            ats.append(at)
        yield batch.assign(at=ats)[["file", "block", "at", "value"]]


def _mend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for file, at, raw in zip(batch["file"], batch["at"], batch["raw"]):
            head, _, rest = bytes(raw).partition(b"\r\n\r\n")
            length, body = parse_payload(rest[: int(_fields(head[len(MAGIC) :])["content-length"])])
            rows.append((file, at, length, len(body), _digest(body)))
        yield pd.DataFrame(rows, columns=["file", "at", "http_length", "payload_bytes", "payload_digest"]).astype({"http_length": "Int64"})
