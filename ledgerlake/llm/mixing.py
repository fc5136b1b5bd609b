"""Mixing sources to target weights by capped water-filling, then whole and fractional repetitions of documents.

A source's target is its weight's share of all words, but at most `epochs` times its own; what is cut off is shared
anew by weight until no target is above its limit. A document is repeated floor(target / size of the source) times; the
rest of the target is filled with one more copy of documents in seeded order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import word_count, written

#: Steps of the seeded order in which running totals are first added up, and rows of a step beyond which there are twice as many.
BUCKETS, BUCKET_ROWS = 1024, 1 << 16
#: Cells of the draw that tells equal rows apart.
CELLS = 1 << 12

#: Times that a source's draw is corrected by one document.
CORRECTIONS = 2


def water_fill(sources: DataFrame, epochs: float) -> DataFrame:
    """`target` for rows of (source_size, weight): capped shares that add up to the sum of all sizes.

    Sources are clamped in turn: those above their limit give their excess to
    the rest, in proportion to weight. Each round is one aggregate over the
    sources; it ends when no source is newly above, at most one round each.
    """
    limit = F.col("source_size") * F.lit(float(epochs))
    clamped = F.lit(False)
    known = -1
    while True:
        free = ~clamped
        row = sources.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(clamped, limit)).alias("fixed"),
            F.sum(F.when(free, F.col("weight"))).alias("weight"),
            F.count_if(clamped).alias("n"),
        ).first()
        level = ((row["all"] or 0) - (row["fixed"] or 0.0)) / row["weight"] if row["weight"] else float("inf")
        if row["n"] == known or not row["weight"]:
            return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), limit) if row["weight"] else limit)
        # the level only rises, so whoever was clamped stays so
        known, clamped = row["n"], F.col("weight") * F.lit(level) > limit


def code_point_rank(sources: DataFrame) -> DataFrame:
    """`rank` from 0 by code point of the source, null last; sorted in ranges, so not in one task."""
    ordered = written(
        sources.withColumn("_null", F.col("source").isNull())
        .repartitionByRange("_null", "source").sortWithinPartitions("_null", "source")
        .withColumn("_at", F.monotonically_increasing_id()),
        "mix-sources",
    )
    part = F.shiftright("_at", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = (
        ordered.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    return (
        ordered.withColumn("_part", part).join(starts, "_part")
        .withColumn("rank", F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1))
        .drop("_part", "_start", "_at", "_null")
    )


def _order(seed: str, doc_id: Column) -> Column:
    return F.md5(F.concat_ws("/", F.lit(seed), doc_id.cast("string")).cast("binary"))


def _bucket(order: Column, buckets: int) -> Column:
    return F.conv(F.substring(order, 1, 8), 16, 10).cast("long") % buckets


def _draw(row: Column) -> Column:
    """A seeded number from 0 for a row's place in its table, to choose among equal rows."""
    return F.shiftrightunsigned(F.xxhash64(row, F.lit("draw")), 1)


def mixing_plan(docs: DataFrame, weight: Column, epochs: int, seed: str) -> tuple[DataFrame, int]:
    """A row for each source of (doc_id, source, text, row) rows: source_size, target, whole copies, and who gets one more; and the number of buckets.

    Equal rows stand in one place of the seeded order. One more copy goes to the rows before `last`, of those
    that stand there to those whose draw is at most `limit` (null: all), and the single
    rows in `flips` change sides.
    """
    order = _order(seed, F.col("doc_id"))
    rows = docs.select("source", word_count(F.col("text")).alias("size"), order.alias("order"), F.xxhash64("text").alias("tie"))
    # rows of one place have one size
    rows = written(rows.groupBy("source", "order", "tie").agg(F.max("size").alias("size"), F.count("*").alias("rows")), "mix-rows")
    buckets = BUCKETS << max(0, (rows.count() // (BUCKETS * BUCKET_ROWS)).bit_length())
    rows = rows.withColumn("bucket", _bucket(F.col("order"), buckets))
    words = F.col("size") * F.col("rows")
    sources = code_point_rank(rows.groupBy("source").agg(F.sum(words).alias("source_size")))
    sources = written(
        water_fill(written(sources.withColumn("weight", weight.cast("double")), "mix-weights"), epochs)
        .withColumn("whole", F.coalesce(F.floor(F.col("target") / F.nullif("source_size", F.lit(0))), F.lit(0)))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
        .select("source", "source_size", "target", "whole", "rest"),
        "mix-targets",
    )
    # running totals: of whole buckets first, then inside each bucket
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("source", "bucket").agg(F.sum(words).alias("n"))
        .select("source", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")).alias("a")
        .join(sources.filter("rest > 0").alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")))
        .select("a.source", "bucket", "start", "rest")
    )
    inside = Window.partitionBy("source", "bucket").orderBy("order", "tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    a, b = rows.withColumn("upto", F.sum(words).over(inside)).alias("a"), starts.alias("b")
    left = F.col("rest") - F.col("start") - F.col("upto") + words  # what the place finds still to be filled
    # as many of its rows as bring the source nearest to it
    wanted = F.when(F.col("size") > 0, F.floor(left / F.col("size") + 0.5)).otherwise(F.when(left >= 0, F.col("rows")).otherwise(0))
    same = F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.bucket") == F.col("b.bucket"))
    drawn = a.join(b, same).select(
        F.col("a.source").alias("source"), "size", "rows", "rest", F.struct("a.bucket", "order", "tie").alias("at"),
        F.greatest(F.lit(0), F.least(wanted, F.col("rows"))).cast("long").alias("more"),
    )
    drawn = written(drawn, "mix-drawn")
    plan = drawn.groupBy("source").agg(F.max(F.when(F.col("more") > 0, F.struct("at", "more", "rows"))).alias("end")).select(
        "source", F.col("end.at").alias("last"), F.when(F.col("end.more") < F.col("end.rows"), F.col("end.more")).alias("some")
    )
    flips = drawn.select("source", "at").limit(0)
    for _ in range(CORRECTIONS):
        change = written(_correction(drawn), "mix-flips")
        flips = flips.union(change)
        drawn = written(
            drawn.join(change.select("at", F.lit(True).alias("flip")), "at", "left")
            .withColumn("more", F.when(F.coalesce("flip", F.lit(False)), 1 - F.col("more")).otherwise(F.col("more"))).drop("flip"), "mix-drawn",
        )
    flips = flips.groupBy("source", "at").agg(F.count("*").alias("n")).filter("n % 2 = 1")
    flips = flips.groupBy("source").agg(F.collect_list("at").alias("flips"))  # at most CORRECTIONS
    for extra in (plan, flips, _limits(docs, written(plan.filter("some is not null"), "mix-cuts"), order, buckets)):
        x, y = sources.alias("x"), extra.alias("y")
        names = [F.col(f"y.{c}") for c in extra.columns if c != "source"]
        sources = x.join(y, F.col("x.source").eqNullSafe(F.col("y.source")), "left").select("x.*", *names)
    sources = sources.withColumn("flips", F.coalesce("flips", F.array().cast(flips.schema["flips"].dataType)))
    return written(sources, "mix-plan"), buckets


def _limits(docs: DataFrame, cuts: DataFrame, order: Column, buckets: int) -> DataFrame:
    """(source, limit): the draw up to which `some` of the equal rows at `last` get one more copy.

    The draws are counted by cell first; only the cell that holds the limit is put in order.
    """
    at = F.struct(_bucket(order, buckets).alias("bucket"), order.alias("order"), F.xxhash64("text").alias("tie"))
    a, b = docs.select("source", at.alias("at"), _draw(F.col("row")).alias("draw")).alias("a"), cuts.alias("b")
    there = a.join(b, F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("at") == F.col("last"))).select("a.source", "draw", "some")
    there = there.withColumn("cell", F.floor(F.col("draw") / ((1 << 63) // CELLS)))
    upto = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = there.groupBy("source", "cell", "some").agg(F.count("*").alias("n")).withColumn("upto", F.sum("n").over(upto))
    cell = cells.filter((F.col("upto") >= F.col("some")) & (F.col("upto") - F.col("n") < F.col("some"))).select(
        "source", "cell", (F.col("some") - F.col("upto") + F.col("n")).alias("nth")
    )
    x, y = there.alias("x"), written(cell, "mix-cells").alias("y")
    inside = x.join(y, F.col("x.source").eqNullSafe(F.col("y.source")) & (F.col("x.cell") == F.col("y.cell"))).select("x.source", "draw", "nth")
    numbered = inside.withColumn("k", F.row_number().over(Window.partitionBy("source").orderBy("draw")))
    return numbered.filter("k = nth").select("source", F.col("draw").alias("limit"))


def _correction(drawn: DataFrame) -> DataFrame:
    """The single document of each source whose size is nearest to what the source lacks or has too much: (source, at)."""
    gaps = drawn.groupBy("source").agg((F.first("rest") - F.sum(F.col("more") * F.col("size"))).alias("gap"))
    off = F.abs(F.col("size") - F.abs("gap"))
    fits = (F.col("rows") == 1) & ((F.col("more") > 0) == (F.col("gap") < 0)) & (off < F.abs("gap"))
    return (
        drawn.alias("a").join(gaps.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source"))).filter(fits)
        .groupBy("a.source").agg(F.min(F.struct(off.alias("off"), "at")).alias("best"))
        .select("source", F.col("best.at").alias("at"))
    )


def mix_documents(
    docs: DataFrame,
    weight: Column | None = None,
    epochs: int = 3,
    seed: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """docs with size, source_size, target, copies and taken (= copies * size) of every row.

    `weight` is an expression over `rank`, the source's place by code point, null
    last; by default weights are 1, 2, 3, repeating. The order in which documents
    get one more copy hangs on the seed, id and text alone, so reruns agree. Rows
    with equal id and text stand in one place of it; where a source's target falls among them, as many of them
    as come nearest to it get one more, drawn by their places in the table. The document at which a target is reached
    is taken if that brings the source nearer to it; then, twice,
    the document whose size comes closest to the remaining gap changes sides.
    Null or empty texts have size 0 and are copied like others of the source, which
    adds nothing. A null source is a source of its own. Columns of docs with the name
    of a result are replaced, all others stay.
    """
    weight = (F.pmod("rank", F.lit(3)) + 1) if weight is None else weight
    docs = docs.withColumn("_row", F.monotonically_increasing_id())
    plan, buckets = mixing_plan(
        docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"), F.col("_row").alias("row")),
        weight, epochs, seed,
    )
    results = ["size", "source_size", "target", "copies", "taken", "_row"]
    a, b = docs.alias("a"), plan.alias("b")
    order, tie = _order(seed, F.col(f"a.{id_col}")), F.xxhash64(F.col(f"a.{text_col}"))
    at = F.struct(_bucket(order, buckets).alias("bucket"), order.alias("order"), tie.alias("tie"))
    among = (at == F.col("b.last")) & (F.col("b.limit").isNull() | (_draw(F.col("a._row")) <= F.col("b.limit")))
    more = F.coalesce((at < F.col("b.last")) | among, F.lit(False)) != F.array_contains(F.col("b.flips"), at)
    size = word_count(F.col(f"a.{text_col}"))
    copies = F.least(F.col("b.whole") + more.cast("int"), F.lit(epochs)).cast("int")
    return a.join(b, F.col(f"a.{source_col}").eqNullSafe(F.col("b.source"))).select(
        *(F.col(f"a.{c}") for c in docs.columns if c not in results),
        size.alias("size"), "b.source_size", "b.target", copies.alias("copies"), (copies * size).cast("long").alias("taken"),
    )
