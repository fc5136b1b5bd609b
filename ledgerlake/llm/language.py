"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed n-grams of one to three characters of the lower-cased whole text, log-scaled counts times inverse
document frequency, of length one. Document frequencies cover all training documents. The weights are
fitted with follow-the-regularised-leader and elastic-net penalties on a bounded, seeded sample of labelled documents, and the
scores are calibrated with one temperature on a part of the sample that the fit has not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import chunked, gathered, ship, written

#: Places of the hashed features, as a power of two, and characters of an n-gram at most.
FEATURE_BITS, LONGEST = 14, 3
#: Labelled documents that the weights are fitted on, over all languages, and the share that calibrates.
SAMPLE, CALIBRATION = 4000, 0.2
#: Follow-the-regularised-leader: learning rate, its offset, both penalties, and passes over the sample.
ALPHA, BETA, L1, L2, PASSES = 0.5, 1.0, 0.05, 0.05, 3

UNKNOWN = "und"
_FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]  # odd
_LETTERS = str.isalpha


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(_LETTERS, text))


def term_counts(text: str) -> np.ndarray:
    """How often each hashed n-gram occurs."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.uint64)
    shift = np.uint64(64 - FEATURE_BITS)
    total = np.zeros(1 << FEATURE_BITS, dtype=np.int64)
    for n in range(1, LONGEST + 1):
        if len(codes) < n:
            break
        mixed = codes[: len(codes) - n + 1] * _FACTORS[0]
        for k in range(1, n):
            mixed = (mixed ^ (mixed >> np.uint64(29))) * _FACTORS[k] + codes[k : len(codes) - n + 1 + k] * _FACTORS[0]
        total += np.bincount(((mixed * _FACTORS[n - 1]) >> shift).astype(np.int64), minlength=len(total))
    return total


def features(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the non-zero features; their squares add up to one."""
    counts = term_counts(text)
    at = np.flatnonzero(counts)
    values = (1 + np.log(counts[at])) * idf[at]
    length = np.sqrt((values * values).sum())
    return at, values / length if length else values


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # features x languages
    bias: np.ndarray
    temperature: float

    def logits(self, at: np.ndarray, values: np.ndarray) -> np.ndarray:
        return values @ self.weights[at] + self.bias


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class _Leader:
    """Follow-the-regularised-leader for one table of weights."""

    def __init__(self, shape: tuple[int, ...], l1: float):
        self.z, self.n, self.l1 = np.zeros(shape), np.zeros(shape), l1

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        raw = (np.sign(z) * self.l1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) > self.l1, raw, 0.0)

    def update(self, at, gradient: np.ndarray, weights: np.ndarray) -> None:
        n = self.n[at]
        more = n + gradient * gradient
        self.z[at] += gradient - (np.sqrt(more) - np.sqrt(n)) / ALPHA * weights
        self.n[at] = more


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], languages: list[str], seed: int = 0) -> Model:
    """rows: (language, places, values). The last CALIBRATION of the shuffled rows set the temperature."""
    order = np.random.default_rng(seed).permutation(len(rows))
    held = order[: int(len(rows) * CALIBRATION)]
    seen = order[len(held) :]
    table, bias = _Leader((1 << FEATURE_BITS, len(languages)), L1), _Leader((len(languages),), 0.0)
    for _ in range(PASSES):
        for k in seen:
            label, at, values = rows[k]
            w, b = table.weights(at), bias.weights(slice(None))
            gap = _softmax(values @ w + b)
            gap[label] -= 1
            table.update(at, values[:, None] * gap, w)
            bias.update(slice(None), gap, b)
    model = Model(languages, table.weights(slice(None)).astype(np.float32), bias.weights(slice(None)), 1.0)
    if len(held):
        logits = np.array([model.logits(rows[k][1], rows[k][2]) for k in held])
        labels = np.array([rows[k][0] for k in held])
        loss = lambda t: -np.log(_softmax(logits / t)[np.arange(len(held)), labels] + 1e-12).mean()
        model.temperature = float(min(np.geomspace(0.05, 20, 121), key=loss))
    return model


def inverse_frequencies(texts: DataFrame) -> np.ndarray:
    """Smoothed inverse document frequency of every feature, over all rows of `texts`."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((1 << FEATURE_BITS) + 1, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen[:-1] += term_counts(text) > 0
                seen[-1] += 1
        yield chunked(seen)

    total = gathered(texts.mapInArrow(count, "chunk int, data binary"), "add")
    if not len(total):
        total = np.zeros((1 << FEATURE_BITS) + 1, dtype=np.int64)
    return np.log((1 + total[-1]) / (1 + total[:-1])) + 1


def train(labelled: DataFrame, seed: str = "language") -> tuple[Model | None, np.ndarray]:
    """Model and inverse frequencies from (doc_id, text, lang) rows with text and language.

    At most SAMPLE documents, equally many of each language as far as there are,
    are fitted on: those of the smallest seeded hashes of id and text. None if there are none.
    """
    ship(labelled.sparkSession)
    labelled = labelled.filter("text is not null and lang is not null")
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}  # one row a language
    idf = inverse_frequencies(labelled.select("text"))
    if not counts:
        return None, idf
    languages, most = sorted(counts), max(1, SAMPLE // len(counts))
    place = F.pmod(F.xxhash64("doc_id", "text", F.lit(seed)), F.lit(1 << 40))
    share = F.create_map(*(x for n in languages for x in (F.lit(n), F.lit(min(1.0, 1.3 * (most + 50) / counts[n])))))
    few = labelled.withColumn("place", place).filter(F.col("place") < share[F.col("lang")] * float(1 << 40))
    few = few.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("place", "doc_id"))).filter(F.col("nth") <= most)

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [features(text, idf) for text in batch["text"]]
            yield pd.DataFrame({
                "lang": batch["lang"], "place": batch["place"],
                "at": [a.astype(np.int32) for a, _ in found], "value": [v.astype(np.float32) for _, v in found],
            })

    sample = written(
        few.select("lang", "place", "text").mapInPandas(vectors, "lang string, place long, at array<int>, value array<float>"),
        "language-sample",
    )

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = list(batches)
        data = pd.concat(frames).sort_values("place") if frames else pd.DataFrame({"lang": []})
        rows = [
            (languages.index(lang), at.astype(np.int64), value.astype(np.float64))
            for lang, at, value in zip(data["lang"], data.get("at", []), data.get("value", []))
        ]
        model = fit(rows, languages)
        yield pd.DataFrame({
            "weights": [model.weights.tobytes()], "bias": [model.bias.tobytes()], "temperature": [model.temperature]
        })

    # the sample is bounded, so one task fits it
    row = sample.coalesce(1).mapInPandas(learn, "weights binary, bias binary, temperature double").first()
    weights = np.frombuffer(row["weights"], dtype=np.float32).reshape(-1, len(languages))
    return Model(languages, weights, np.frombuffer(row["bias"]), row["temperature"]), idf


def predict(docs: DataFrame, model: Model | None, idf: np.ndarray, text_col: str = "text") -> DataFrame:
    """docs with lang_pred and score, from the whole text alone.

    `und` with score 0 for a null text, one without a letter, and without a model.
    Columns named lang_pred or score are replaced, others stay.
    """
    ship(docs.sparkSession)
    rest = [c for c in docs.columns if c not in ("lang_pred", "score")]

    def label(text: str | None) -> tuple[str, float]:
        if model is None or not has_letter(text):
            return UNKNOWN, 0.0
        p = _softmax(model.logits(*features(text, idf)) / model.temperature)
        return model.languages[int(p.argmax())], float(p.max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [label(text) for text in batch.column(text_col).to_pylist()]
            arrays = [batch.column(c) for c in rest]
            arrays += [pa.array([n for n, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*rest, "lang_pred", "score"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in rest]
    return docs.select(*rest).mapInArrow(run, ", ".join([*fields, "lang_pred string", "score double"]))


def fold(doc_id: Column) -> Column:
    """The document's fold, 0 to 3: CRC-32 of its id as text, modulo 4. A null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4


def identify(docs: DataFrame, held_out_fold: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document; learnt from the other folds' text and non-null lang."""
    held_out = fold(F.col("doc_id")) == held_out_fold
    model, idf = train(docs.filter(~held_out).select("doc_id", "text", "lang"))
    return predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model, idf).drop("text")
