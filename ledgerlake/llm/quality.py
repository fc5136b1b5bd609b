"""Line-first quality rules: lines are judged one by one, failing ones go, and documents that lose too much text go too.

The counts that base rules use are exact and cover the whole text; words are runs of anything but space and 0x09 to
0x0D, compared by 64-bit hashes.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import SPACE, Words, ship


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules and of the text that a document may lose."""

    #: Punctuation: share of a line's words that may end in, or be, marks of emphasis or symbols.
    max_marked: float = 0.3
    #: Navigation: share of words that may be bare separators; a menu also has at least `least_separators` between its words
    #: (one more if all are dashes, as two enclose an aside), and items of at most `longest_item` words.
    max_separators: float = 0.15
    least_separators: int = 2
    longest_item: int = 4
    #: Boilerplate: share of a line's words that may be its single most frequent word, in lines of at least `long_line`.
    max_one_word: float = 0.3
    long_line: int = 10
    #: Share of the words that must remain.
    min_kept: float = 0.5
    #: Phrases of notices and menus; a line of at most `short_line` words that has one, as whole words, fails.
    phrases: tuple[str, ...] = (
        "javascript", "cookie policy", "cookies policy", "use of cookies", "privacy policy", "terms of use",
        "terms of service", "all rights reserved", "lorem ipsum", "sign in", "log in", "click here", "read more",
        "subscribe to our newsletter", "skip to content",
    )
    short_line: int = 30


_SEPARATORS = frozenset({"|", "»", "›", "·", "•", "/", ">", ">>", "::", "–", "—"})
_DASHES = frozenset({"–", "—"})
_MARKED = re.compile(r"(?:[!?]{2,}|[#*$%&|<>^~=_+\\]+)[.,;:]?$")
_ODD = re.compile(r"[|»›·•/>:–—#*$%&<^~=_+\\]|[!?]{2}")  # without one of these, no word is a separator or marked
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _is_menu(words: list[str], rules: LineRules) -> bool:
    """Short items with separators between them; a bullet or dash at either end separates nothing."""
    at = [k for k, w in enumerate(words) if w in _SEPARATORS and 0 < k < len(words) - 1]
    least = rules.least_separators + all(words[k] in _DASHES for k in at)
    if len(at) < least or len(at) <= rules.max_separators * len(words):
        return False
    return max(b - a - 1 for a, b in zip([-1, *at], [*at, len(words)])) <= rules.longest_item


def line_fails(line: str, rules: LineRules) -> str | None:
    """The first rule that a line fails: punctuation, navigation or boilerplate; lines without words pass."""
    words = _WORD.findall(line)
    n = len(words)
    if not n:
        return None
    if _ODD.search(line):
        if _is_menu(words, rules):
            return "navigation"
        if sum(_MARKED.search(w) is not None for w in words) > rules.max_marked * n:
            return "punctuation"
    # a word that fills such a share leaves few others
    if n >= rules.long_line and len(set(words)) <= (1 - rules.max_one_word) * n + 1:
        if Counter(words).most_common(1)[0][1] > rules.max_one_word * n:
            return "boilerplate"
    if n <= rules.short_line:
        low = line.lower()
        if any(p in low and re.search(rf"(?<!\w){re.escape(p)}(?!\w)", low) for p in rules.phrases):
            return "boilerplate"
    return None


def base_counts(text: bytes) -> dict[str, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a UTF-8 text."""
    words = Words(text)
    data, n = words.data, len(words)
    seen, repeated = set(), 0
    for line in text.split(b"\n"):
        if line in seen:
            repeated += 1
        elif line.strip(b" \t\n\r\x0b\x0c"):
            seen.add(line)
    windows = words.windows(3)
    covered = np.zeros(n + 3, dtype=np.int64)
    if len(windows):
        ordered = np.sort(windows)
        again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if len(again):
            at = np.minimum(np.searchsorted(again, windows), len(again) - 1)
            twice = np.flatnonzero(again[at] == windows)
            np.add.at(covered, twice, 1)
            np.add.at(covered, twice + 3, -1)
    return {
        "n_words": n,
        "word_chars": int((_FIRST[data] & ~SPACE[data]).sum()),
        "n_symbols": int(_SYMBOL[data].sum()),
        "n_dup_lines": repeated,
        "n_repeat_words": int((np.cumsum(covered)[:n] > 0).sum()),
    }


_FIRST = (np.arange(256) & 0xC0) != 0x80  # the first byte of a code point
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def cleaned(text: str, rules: LineRules) -> tuple[str, int | None]:
    """The text without failing lines, and how many words it still has; None: all."""
    lines = text.split("\n")
    kept = [line for line in lines if line_fails(line, rules) is None]
    if len(kept) == len(lines):
        return text, None
    return "\n".join(kept), sum(len(_WORD.findall(line)) for line in kept)


def judge_documents(
    docs: DataFrame,
    rules: LineRules = LineRules(),
    min_words: int = 50,
    max_repeated: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """docs with the counts, base_failed, kept, kept_words and clean_text.

    A document fails the base rules with fewer than `min_words` words or with more
    than `max_repeated` of its words in repeated windows. Else it is kept if at
    least `min_kept` of its words remain after line cleaning. A null text has no
    words, fails, and its clean text is null; an empty one stays empty. All other
    columns stay as they are; columns of docs that have the name of a result are
    replaced.
    """
    ship(docs.sparkSession)
    names = [*COUNTS, "base_failed", "kept", "kept_words", "clean_text"]
    rest = [c for c in docs.columns if c not in names]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 128):
                part = batch.slice(k, 128)
                out = {name: [] for name in names}
                for text in part.column(text_col).to_pylist():
                    counts = base_counts((text or "").encode())
                    for name, value in counts.items():
                        out[name].append(value)
                    n = counts["n_words"]
                    failed = n < min_words or counts["n_repeat_words"] > max_repeated * n
                    clean, left = cleaned(text, rules) if text else (text, 0)
                    left = n if left is None else left
                    out["base_failed"].append(failed)
                    out["kept"].append(not failed and left >= rules.min_kept * n)
                    out["kept_words"].append(left)
                    out["clean_text"].append(clean)
                kinds = [pa.int64()] * 5 + [pa.bool_(), pa.bool_(), pa.int64(), pa.string()]
                arrays = [part.column(c) for c in rest] + [pa.array(out[c], t) for c, t in zip(names, kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*rest, *names])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in rest]
    fields += [f"{c} long" for c in COUNTS] + ["base_failed boolean", "kept boolean", "kept_words long", "clean_text string"]
    return docs.select(*rest).mapInArrow(judge, ", ".join(fields))
