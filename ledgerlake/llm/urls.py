"""URL filter: a sorted array of 64-bit digests, memory-mapped by every task and probed with binary search.

A list entry is a host followed by the beginning of a path, such as `example.com/en/`. The array file holds the digests
of all entries in order, with each entry's text behind them; it is written once to the shared folder and handed to the
executors with SparkContext.addFile. A task maps its local copy, probes all digests of a batch of urls at
once, and compares the stored text wherever a digest is found, so that no collision decides.
"""

from __future__ import annotations

import functools
import mmap
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import put, ship

ALLOW, BLOCK = "allow", "block"
_HEAD = 4  # 64-bit words: entries, bytes of text, path lengths, most labels of a host
_PROBES = 200_000


def _digest(entry: str) -> int:
    return xxhash.xxh64_intdigest(entry.encode())


def pack_rules(rules: Iterable[tuple[str, str, str]]) -> bytes:
    """The array file of (verdict, host, path) rules: head, path lengths, digests, text places, verdicts, texts.

    Of equal entries the first one counts.
    """
    entries: dict[str, tuple[str, str, str]] = {}
    for verdict, host, path in rules:
        if verdict not in (ALLOW, BLOCK) or not host or "/" in host or not path.startswith("/"):
            raise ValueError(f"not a rule: {verdict} {host}{path}")
        entries.setdefault(host + path, (verdict, host, path))
    order = sorted(entries, key=lambda e: (_digest(e), e))
    texts = [e.encode() for e in order]
    lengths = sorted({len(path) for _, _, path in entries.values()})
    labels = max((host.count(".") + 1 for _, host, _ in entries.values()), default=0)
    parts = [
        np.array([len(order), sum(map(len, texts)), len(lengths), labels], dtype="<u8"),
        np.array(lengths, dtype="<u8"),
        np.array([_digest(e) for e in order], dtype="<u8"),
        np.cumsum([0, *map(len, texts)]).astype("<u8"),
        np.array([entries[e][0] == BLOCK for e in order], dtype=np.uint8),
    ]
    return b"".join(p.tobytes() for p in parts) + b"".join(texts)


class DigestArray:
    """A mapped array file."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            data = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        n, size, lengths, self.labels = (int(x) for x in np.frombuffer(data, "<u8", _HEAD))
        at = 8 * _HEAD
        self.path_lengths = np.frombuffer(data, "<u8", lengths, at).tolist()
        at += 8 * lengths
        self.digests = np.frombuffer(data, "<u8", n, at)
        at += 8 * n
        self.places = np.frombuffer(data, "<u8", n + 1, at)
        at += 8 * (n + 1)
        self.block = np.frombuffer(data, np.uint8, n, at)
        self.text = memoryview(data)[at + n : at + n + size]

    def find(self, probes: list[str]) -> np.ndarray:
        """Each probe's entry, or -1."""
        digests = np.array([_digest(p) for p in probes], dtype=np.uint64)
        at = np.searchsorted(self.digests, digests)
        end = np.searchsorted(self.digests, digests, side="right")
        found = np.full(len(probes), -1, dtype=np.int64)
        for k in np.flatnonzero(at < end):
            raw = probes[k].encode()
            for entry in range(int(at[k]), int(end[k])):  # all entries of this digest
                if self.text[int(self.places[entry]) : int(self.places[entry + 1])] == raw:
                    found[k] = entry
        return found

    def entry(self, k: int) -> str:
        return bytes(self.text[int(self.places[k]) : int(self.places[k + 1])]).decode()

    def judge(self, hosts: list[str], paths: list[str]) -> list[tuple[str | None, str | None]]:
        """The longest fitting rule and its verdict; of equally long ones that with the longer host."""
        out: list[tuple[str | None, str | None]] = [(None, None)] * len(hosts)
        probes, owners, ranks = [], [], []

        def settle():
            found = self.find(probes)
            best: dict[int, tuple] = {}
            for k in np.flatnonzero(found >= 0):
                candidate = (*ranks[k], found[k])
                if candidate > best.get(owners[k], (-1,)):
                    best[owners[k]] = candidate
            for owner, (*_, entry) in best.items():
                out[owner] = (self.entry(int(entry)), BLOCK if self.block[int(entry)] else ALLOW)
            probes.clear(), owners.clear(), ranks.clear()

        for owner, (host, path) in enumerate(zip(hosts, paths)):
            starts = [path[:n] for n in self.path_lengths if n <= len(path)]
            labels = host.split(".")
            for k in range(max(0, len(labels) - self.labels), len(labels)):
                suffix = ".".join(labels[k:])
                for start in starts:
                    probes.append(suffix + start)
                    owners.append(owner)
                    ranks.append((len(suffix) + len(start), len(suffix)))
            if len(probes) >= _PROBES:
                settle()
        settle()
        return out


@functools.cache
def _mapped(name: str) -> DigestArray:
    return DigestArray(SparkFiles.get(name))


def share_rules(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> str:
    """Writes the array file to the shared folder and hands it to the executors; returns its name there."""
    name = f"urls-{uuid.uuid4().hex}.bin"
    spark.sparkContext.addFile(put(spark, "url-rules", name, pack_rules(rules)))
    return name


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a url; both empty for a null url and one without ://."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def filter_urls(
    pages: DataFrame, rules: Iterable[tuple[str, str, str]], default: str = ALLOW, id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """page_id, host, path, rule and verdict of every url.

    A rule (verdict, host, path) fits its host and all subdomains where the url's
    path begins with its own; the longest decides. A url that no entry fits gets
    `default` and a null rule, so does an empty host. Repeated rows are judged
    alike; only the two named columns are read.
    """
    ship(pages.sparkSession)
    name = share_rules(pages.sparkSession, rules)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        array = _mapped(name)
        for batch in batches:
            judged = array.judge(batch["host"].tolist(), batch["path"].tolist())
            yield batch.assign(
                rule=pd.Series([r for r, _ in judged], dtype=object, index=batch.index),
                verdict=[v or default for _, v in judged],
            )

    host, path = host_and_path(F.col(url_col))
    kind = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    # the id goes through Python as text, so that a null one keeps its column whole
    judged = rows.withColumn("page_id", F.col("page_id").cast("string")).mapInPandas(
        judge, "page_id string, host string, path string, rule string, verdict string"
    )
    return judged.withColumn("page_id", F.col("page_id").cast(kind))
