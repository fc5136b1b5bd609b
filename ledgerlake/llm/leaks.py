"""Benchmark decontamination: test passages are looked up in a positional inverted index of the training texts.

All of it is DataFrame functions. The index holds (term, text, position) for terms of the tests. A passage is found by
its rarest terms: their lists are moved by the terms' places in the passage, so that all of them name the passage's
start, and intersected by one aggregate. Only texts in which the rarest terms of a passage stand at the right distances
are compared word by word. The same lists give passages whose rarest terms stand near each other in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import written

#: Words of a passage, rarest places by which a passage is looked up, and rarest terms of a span.
WINDOW, RAREST, NEAR = 10, 2, 3
#: Rows of a table of short rows (a term, a probe or a key) up to which it is broadcast: counted first, and joined by a shuffle beyond.
BROADCAST_ROWS = 200_000

# fixed values: a word is a run of ASCII letters, digits and all beyond ASCII, in small letters
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The words of a text; null for a null text. Only A to Z are lower-cased."""
    ascii_only = F.length(text) == F.octet_length(text)
    small = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _CAPITALS, _SMALL))
    return F.regexp_extract_all(small, F.lit(_WORD), F.lit(0))


def text_key(text: Column) -> list[Column]:
    """128 bits that stand for a text; equal texts have one result."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("again"), text).alias("k2")]


def _sized(table: DataFrame) -> DataFrame:
    """A written table of short rows, to be broadcast if they are few."""
    return F.broadcast(table) if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else table


# ---- passages -------------------------------------------------------------------------------------------------------


def passages(tests: DataFrame, n: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Every different run of n words of a test, or all its words if they are fewer: words, and the ids of the tests that have it."""
    item = tests.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w"))
    item = item.filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - n + 1, F.lit(1)))
    runs = item.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, n))).alias("words"))
    # a passage that very many tests share is gathered once: an id stands there once
    return written(
        runs.groupBy("words").agg(F.collect_set("item").alias("items")).withColumn("passage", F.monotonically_increasing_id()), "leaks-passages"
    )


# ---- the index ------------------------------------------------------------------------------------------------------


def tokenized(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, k1, k2, n_words, w) of every row, stored: texts are cut into words once, and later steps read what they need."""
    rows = docs.select(F.col(id_col).alias("id"), *text_key(F.col(text_col)), words(F.col(text_col)).alias("w"))
    return written(rows.select("id", "k1", "k2", F.coalesce(F.size("w"), F.lit(0)).cast("long").alias("n_words"), "w"), "leaks-tokens")


def term_counts(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, times) for those of the different `terms` that tokenized texts have."""
    tokens = texts.select(F.explode("w").alias("term"))
    return written(tokens.join(_sized(terms), "term").groupBy("term").agg(F.count("*").alias("times")), "leaks-counts")


def postings(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """The index, as a stored table: (term, k1, k2, pos) wherever tokenized texts have one of the different `terms`."""
    tokens = texts.select("k1", "k2", F.posexplode("w").alias("pos", "term"))
    return written(tokens.join(_sized(terms), "term").select("term", "k1", "k2", "pos"), "leaks-index")


def rarest_places(found: DataFrame, counts: DataFrame, most: int) -> DataFrame:
    """(passage, length, places) of the passages all of whose terms occur; places are the rarest (offset, term, times), by offset."""
    terms = found.select("passage", F.size("words").alias("length"), F.posexplode("words").alias("offset", "term"))
    at = terms.join(counts, "term", "left").groupBy("passage", "length").agg(
        F.bool_or(F.col("times").isNull()).alias("absent"), F.sort_array(F.collect_list(F.struct("times", "offset", "term"))).alias("all")
    )
    places = F.array_sort(F.transform(F.slice("all", 1, most), lambda x: F.struct(x["offset"].alias("offset"), x["term"].alias("term"), x["times"].alias("times"))))
    return at.filter("not absent").select("passage", "length", places.alias("places"))


# ---- queries --------------------------------------------------------------------------------------------------------


def probes(found: DataFrame, counts: DataFrame, rarest: int) -> tuple[DataFrame, DataFrame]:
    """What is asked of the index: (probe, term, step, bit, mask), and which passages it finds: (probe, passage, lead).

    A probe is the rarest places of a passage, as steps from the first of them, which
    lies `lead` words into the passage. Passages that overlap mostly share their rarest places, and
    those are looked up once.
    """
    placed = rarest_places(found, counts, rarest)
    lead = F.col("places")[0]["offset"]
    steps = F.transform("places", lambda x: F.struct((x["offset"] - lead).alias("step"), x["term"].alias("term")))
    placed = written(placed.select("passage", lead.alias("lead"), steps.alias("steps")), "leaks-places")
    numbered = written(placed.select("steps").distinct().withColumn("probe", F.monotonically_increasing_id()), "leaks-probes")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("nth"))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.size("steps")) - 1
    asked = numbered.select("probe", mask.alias("mask"), F.posexplode("steps").alias("nth", "x"))
    asked = asked.select("probe", "x.term", "x.step", bit.alias("bit"), "mask")
    return written(asked, "leaks-asked"), written(placed.join(numbered, "steps").select("probe", "passage", "lead"), "leaks-leads")


def phrase_starts(index: DataFrame, asked: DataFrame, leads: DataFrame) -> DataFrame:
    """(k1, k2, passage, start): where a passage would have to start, as all places of its probe stand at their distances."""
    moved = index.join(_sized(asked), "term").select("k1", "k2", "probe", (F.col("pos") - F.col("step")).alias("at"), "bit", "mask")
    both = moved.groupBy("k1", "k2", "probe", "at").agg(F.bit_or("bit").alias("bits"), F.first("mask").alias("mask"))
    met = both.filter(F.col("bits") == F.col("mask")).join(_sized(leads), "probe")
    return met.select("k1", "k2", "passage", (F.col("at") - F.col("lead")).alias("start")).filter("start >= 0")


def proximity_spans(index: DataFrame, near: DataFrame, slack: int) -> DataFrame:
    """(k1, k2, passage, first, last): spans of at most the passage's length and `slack` words that hold all its rarest terms.

    `near` holds (passage, length, term, nth, most). Spans end at such a term and begin as
    late as they can; of those that end in one place there is one. Terms stand in any order.
    """
    rows = index.join(_sized(near), "term").dropDuplicates(["k1", "k2", "passage", "pos"])
    upto = Window.partitionBy("k1", "k2", "passage").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    latest = [F.max(F.when(F.col("nth") == k, F.col("pos"))).over(upto) for k in range(NEAR)]
    rows = rows.withColumns({f"_at{k}": c for k, c in enumerate(latest)})
    # places of terms that the passage does not have count as here
    places = [F.when(F.col("most") <= k, F.col("pos")).otherwise(F.col(f"_at{k}")) for k in range(NEAR)]
    complete = F.lit(True)
    for p in places:
        complete = complete & p.isNotNull()
    return (
        rows.withColumn("first", F.least(*places)).filter(complete & (F.col("pos") - F.col("first") < F.col("length") + slack))
        .select("k1", "k2", "passage", "first", F.col("pos").alias("last"))
    )


def _hits(texts: DataFrame, found: DataFrame, starts: DataFrame) -> DataFrame:
    """(k1, k2, n_hit, items) of the texts that do have the passages: compared word by word.

    Only texts with a likely passage are shuffled. A generator keeps an array from being made anew wherever it is used.
    """
    likely = starts.join(found, "passage").groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "words", "items")).alias("likely"))
    likely = written(likely, "leaks-likely")
    some = texts.select("k1", "k2", "w").join(_sized(likely.select("k1", "k2")), ["k1", "k2"], "left_semi")
    true = F.filter("likely", lambda c: F.slice("w", c["start"] + 1, F.size(c["words"])) == c["words"])
    judged = some.join(likely, ["k1", "k2"]).select("k1", "k2", F.explode(F.array(true)).alias("true")).filter(F.size("true") > 0)
    places = F.array_distinct(F.flatten(F.transform("true", lambda c: F.sequence(c["start"], c["start"] + F.size(c["words"]) - 1))))
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("true", lambda c: c["items"]))))
    hits = judged.select("k1", "k2", F.size(places).cast("long").alias("n_hit"), items.alias("items"))
    return written(hits.groupBy("k1", "k2").agg(F.first("n_hit").alias("n_hit"), F.first("items").alias("items")), "leaks-hits")


def decontaminate(
    docs: DataFrame, tests: DataFrame, n: int = WINDOW, rarest: int = RAREST, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id"
) -> DataFrame:
    """id_col, n_words, n_hit, items, n_items, items_sha256 and contaminated of every row of docs.

    A passage is a run of n words of a test, or all words of a shorter one. n_hit
    is the number of words inside any passage that the text holds; items are the ids, as
    text and sorted, of the tests that have such a passage; items_sha256 is the digest of
    those, joined by commas.

    A null or empty text, and one of white space and marks, has no words and is clean; so is
    a test without words, which has no passage. A test without an id is not looked
    up, as it could not be named; tests with one id are one item. Texts may be of any length; equal
    ones are judged each. An empty table on either side gives no rows, or clean ones. Columns but the
    named ones are not read.
    """
    texts = tokenized(docs, id_col, text_col)
    found = passages(tests, n, item_col, "text")
    terms = written(found.select(F.explode("words").alias("term")).distinct(), "leaks-terms")
    asked, leads = probes(found, term_counts(texts, terms), rarest)
    index = postings(texts, written(asked.select("term").distinct(), "leaks-terms"))
    hits = _hits(texts, found, written(phrase_starts(index, asked, leads), "leaks-starts"))
    none = F.array().cast("array<string>")
    return texts.select(F.col("id").alias(id_col), "k1", "k2", "n_words").join(hits, ["k1", "k2"], "left").withColumn("items", F.coalesce("items", none)).select(
        id_col, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), "items", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def near_passages(
    docs: DataFrame, tests: DataFrame, slack: int = 10, n: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id"
) -> DataFrame:
    """(id_col, item, first, last): spans of docs that hold the rarest terms of a test's passage in any order, at most `slack` words longer.

    Every span ends at such a term and is the shortest that does; equal spans of an
    item are one row. Null and empty texts have none.
    """
    texts = tokenized(docs, id_col, text_col)
    found = passages(tests, n, item_col, "text")
    terms = written(found.select(F.explode("words").alias("term")).distinct(), "leaks-terms")
    placed = rarest_places(found, term_counts(texts, terms), NEAR)
    different = F.array_distinct(F.transform("places", lambda x: x["term"]))
    near = placed.select("passage", "length", F.size(different).alias("most"), F.posexplode(different).alias("nth", "term"))
    near = written(near, "leaks-near")
    index = postings(texts, written(near.select("term").distinct(), "leaks-terms"))
    spans = proximity_spans(index, near, slack).join(found.select("passage", "items"), "passage")
    spans = written(spans.select("k1", "k2", F.explode("items").alias("item"), "first", "last").distinct(), "leaks-spans")
    return texts.select(F.col("id").alias(id_col), "k1", "k2").join(spans, ["k1", "k2"]).select(id_col, "item", "first", "last")
