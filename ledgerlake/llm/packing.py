"""Best-fit-decreasing packing of tokenised documents into sequences of a fixed capacity.

Pieces of one length are interchangeable, and lengths are whole numbers up to the capacity, so best-fit decreasing
needs only a histogram of at most `capacity` counts. The driver packs that, finding the tightest open bin with a segment
tree over remaining capacities and filling runs of equal bins at once; the pieces are numbered within their length
and looked up in the plan, in parallel. Result and order are those of placing one piece after another.
"""

from __future__ import annotations

import functools
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import Words, rank_in_group, ship, written

#: Words (as a power of two) and ids that a Python worker keeps, and bytes of text that it takes at once.
KEPT_BITS, KEPT_IDS, AT_ONCE = 20, 4_000_000, 2_000_000


class _Bins:
    """Open bins by remaining capacity; a segment tree finds the tightest that still fits."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.leaves)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # (first bin, bins)

    def add(self, left: int, first: int, n: int) -> None:
        if n and left:
            self.runs[left].append((first, n))
            self._mark(left, True)

    def take(self, left: int) -> tuple[int, int]:
        run = self.runs[left].pop()
        if not self.runs[left]:
            self._mark(left, False)
        return run

    def _mark(self, left: int, value: bool) -> None:
        at = left + self.leaves
        self.any[at] = value
        while at > 1:
            at >>= 1
            self.any[at] = self.any[2 * at] or self.any[2 * at + 1]

    def tightest(self, length: int) -> int | None:
        """The smallest remaining capacity of at least `length` that some bin has."""
        at = length + self.leaves
        if self.any[at]:
            return length
        while at > 1:
            if at % 2 == 0 and self.any[at + 1]:
                at += 1
                break
            at >>= 1
        else:
            return None
        while at < self.leaves:
            at = 2 * at if self.any[2 * at] else 2 * at + 1
        return at - self.leaves


def best_fit_plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first piece, first bin, pieces in each bin, offset in the bin) of the whole packing.

    Pieces `first piece` and on of that length go to bins `first bin` and on, so many
    to each, one behind the other. A bin's remaining capacity at least halves
    whenever it is filled further, so there are at most about
    3 * capacity * log2(capacity) rows, whatever the number of pieces.
    """
    bins, opened, plan = _Bins(capacity), 0, []
    for length in sorted(counts, reverse=True):
        count, piece = counts[length], 0
        while piece < count:
            left = bins.tightest(length)
            if left is None:
                left = capacity
                first, n = opened, -(-(count - piece) // (capacity // length))
                opened += n
            else:
                first, n = bins.take(left)
            each = left // length
            plan.append((length, piece, first, each, capacity - left))
            full, last = min(n, (count - piece) // each), 0
            bins.add(left - each * length, first, full)
            piece += full * each
            if full < n and piece < count:
                last = 1
                bins.add(left - (count - piece) * length, first + full, 1)
                piece = count
            bins.add(left, first + full + last, n - full - last)
    return np.array(plan, dtype=np.int64).reshape(-1, 5)


def best_fit(pieces: DataFrame, capacity: int, row: str = "row", length: str = "length") -> DataFrame:
    """pieces with sequence_id and offset; `pieces` is a written table, `row` tells its rows apart.

    Lengths must be whole numbers from 1 to `capacity`, else this raises. An empty
    table gives an empty result.
    """
    ship(pieces.sparkSession)
    counts = {r[0]: r[1] for r in pieces.groupBy(length).agg(F.count("*")).collect()}  # at most `capacity` rows
    if any(n is None or not 1 <= n <= capacity for n in counts):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    plan = best_fit_plan(counts, capacity)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    start = plan[:, 0] << 44 | plan[:, 1]
    first, each, offset = plan[:, 2], plan[:, 3], plan[:, 4]

    @F.pandas_udf("sequence_id long, offset long")
    def place(lengths, index):
        lengths, index = lengths.to_numpy(), index.to_numpy()
        at = np.searchsorted(start, lengths << 44 | index, side="right") - 1
        nth = index - plan[at, 1]
        return pa_frame(first[at] + nth // each[at], offset[at] + nth % each[at] * lengths)

    ranked = rank_in_group(pieces, [length], row, "_index")
    return ranked.withColumn("_at", place(length, "_index")).select(
        *pieces.columns, F.col("_at.sequence_id").alias("sequence_id"), F.col("_at.offset").alias("offset")
    )


def pa_frame(sequence: np.ndarray, offset: np.ndarray):
    import pandas as pd

    return pd.DataFrame({"sequence_id": sequence, "offset": offset})


@functools.cache
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class _WordIds:
    """Ids of texts, word by word.

    For tokenizers that never join over ASCII white space and drop it, as those
    with a word-end mark do, a text's ids are its words' ids in a row. The ids of
    words seen lately are kept in a table of 2 ** KEPT_BITS places, found by the
    word's 64-bit hash; a later word takes over an earlier one's place.
    """

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for token, k in vocabulary.items():
            self.ends[k] = token.endswith("</w>")
        self.keys = np.zeros(1 << KEPT_BITS, dtype=np.uint64)
        self.at = np.zeros(1 << KEPT_BITS, dtype=np.int32)
        self.size = np.zeros(1 << KEPT_BITS, dtype=np.int32)
        self.ids, self.used = np.zeros(1 << 16, dtype="<u4"), 0

    def _append(self, data: bytes) -> int:
        new, at = np.frombuffer(data, dtype="<u4"), self.used
        while at + len(new) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[at : at + len(new)] = new
        self.used += len(new)
        return at

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        if self.used > KEPT_IDS:
            self.keys[:], self.used = 0, 0
        parts = [Words(text) for text in texts]
        places = np.cumsum([0, *(len(text) for text in texts)])
        key = np.concatenate([p.hash for p in parts])
        slot = (key >> np.uint64(64 - KEPT_BITS)).astype(np.int64)
        at, size = self.at[slot].astype(np.int64), self.size[slot].astype(np.int64)
        miss = np.flatnonzero(self.keys[slot] != key)
        new, first, back = np.unique(key[miss], return_index=True, return_inverse=True)
        if len(new):
            blob = b"".join(texts)
            begin = np.concatenate([p.begin + n for p, n in zip(parts, places)])[miss[first]].tolist()
            end = np.concatenate([p.end + n for p, n in zip(parts, places)])[miss[first]].tolist()
            learnt = self._learn([blob[a:b] for a, b in zip(begin, end)])
            sizes = np.array([len(x) // 4 for x in learnt], dtype=np.int64)
            starts = self._append(b"".join(learnt)) + np.cumsum(sizes) - sizes
            at[miss], size[miss] = starts[back], sizes[back]
            place = slot[miss[first]]
            self.keys[place], self.at[place], self.size[place] = new, starts, sizes
        upto = np.cumsum(size)
        total = int(upto[-1]) if len(upto) else 0
        ids = self.ids[np.repeat(at - upto + size, size) + np.arange(total)].tobytes()
        cuts = np.concatenate([[0], upto])[np.cumsum([0, *(len(p) for p in parts)])] * 4
        return [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def _one_by_one(self, words: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in encoded]

    def _of_letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters only: each is one run, so many are encoded as one text and cut at their word ends."""
        out = []
        for k in range(0, len(words), 1000):
            block = words[k : k + 1000]
            encoded = self.tokenizer.encode_batch_fast([" ".join(block)], add_special_tokens=False)[0]
            ids = np.array(encoded.ids, dtype="<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(block):  # a letter that is more than a letter in lower case
                out += self._one_by_one(block)
                continue
            data, cuts = ids.tobytes(), [0, *(ends * 4).tolist()]
            out += [data[a:b] for a, b in zip(cuts, cuts[1:])]
        return out

    def _learn(self, new: list[bytes]) -> list[bytes]:
        words = [w.decode() for w in new]
        cores = [w.rstrip(_STOPS) for w in words]
        letters = [c for c in dict.fromkeys(cores) if c.isalpha()]
        ids = dict(zip(letters, self._of_letters(letters)))
        tails = {w[len(c) :] for w, c in zip(words, cores) if c in ids} - {""}
        tails = dict(zip(tails, self._one_by_one(list(tails)))) | {"": b""}
        other = [n for n, c in enumerate(cores) if c not in ids]
        rest = dict(zip(other, self._one_by_one([words[n] for n in other])))
        return [rest[n] if n in rest else ids[c] + tails[w[len(c) :]] for n, (w, c) in enumerate(zip(words, cores))]


#: Marks that end a run of letters and form one run themselves.
_STOPS = ".,;:!?|$&%#*"


@functools.cache
def _word_ids(path: str) -> _WordIds:
    return _WordIds(path)


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Begin and length of each run of equal values."""
    cuts = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
    return ((a, b - a) for a, b in zip(cuts, cuts[1:]) if b > a)


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, piece, start, length and ids of each document's pieces: its ids, then `end_id`, cut only if over `capacity`.

    `tokenizer` is a tokenizers file that drops white space and marks word ends.
    `ids` holds little-endian unsigned 32-bit integers. A null text is empty:
    one piece with `end_id` alone. Repeated rows give repeated pieces.
    """
    ship(docs.sparkSession)
    end = struct.pack("<I", end_id)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _word_ids(tokenizer)
        for batch in batches:
            sizes = np.array([0 if t is None else len(t) for t in batch.column(1).to_pylist()])
            part = np.cumsum(sizes) // AT_ONCE
            for k, n in _runs(part):
                ids, texts = batch.column(0).slice(k, n), batch.column(1).slice(k, n).to_pylist()
                rows, number, start, data = [], [], [], []
                for row, encoded in enumerate(encode([t or b"" for t in texts])):
                    encoded += end
                    for p, at in enumerate(range(0, len(encoded), 4 * capacity)):
                        rows.append(row)
                        number.append(p)
                        start.append(at // 4)
                        data.append(encoded[at : at + 4 * capacity])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(rows)), pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                        pa.array([len(x) // 4 for x in data], pa.int64()), pa.array(data, pa.binary()),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary")).mapInArrow(
        cut, f"doc_id {kind}, piece int, start long, length long, ids binary"
    )


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, keep_ids: bool = True, **columns) -> DataFrame:
    """token_pieces with row, ids_crc32, sequence_id and offset; without the ids themselves unless `keep_ids`."""
    pieces = token_pieces(docs, tokenizer, capacity, end_id, **columns).withColumn("ids_crc32", F.crc32("ids"))
    pieces = written(
        pieces.select(F.monotonically_increasing_id().alias("row"), *(c for c in pieces.columns if keep_ids or c != "ids")),
        "pack-pieces",
    )
    return best_fit(pieces, capacity)
