"""Tab-separated extracts to typed rows."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.casts import lost, parse
from ledgerlake.schemas import SOURCES, Source

# The customer extract carries a close date that the load ignores.
FORCED_NULL = {"customer": {"close_date"}}


#: Holds the whole line where a line has too few or too many cells; null for all others.
BAD_LINE = "_bad_line"


def _headers(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """Files by their header line, found by the tasks that read the files' first blocks.

    The driver opens no file; it gets the names of the files, which it lists for the read anyway.
    """
    try:
        lines = spark.read.text(list(paths))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no staged files at {', '.join(paths)}") from error
        raise
    # rows of a block are numbered in their order, and the first block holds the header
    first = (
        lines.select("value", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("place"))
        .where("file_block_start = 0").groupBy("file_path").agg(F.min_by("value", "place").alias("header"))
    )
    found: dict[str, list[str]] = {}
    for row in first.groupBy("header").agg(F.sort_array(F.collect_list("file_path")).alias("files")).collect():
        found.setdefault(row.header.lstrip("\ufeff"), []).extend(unquote(file) for file in row.files)
    return dict(sorted(found.items()))


def read_text(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """All-string rows; columns go by each file's own header, in any order.

    One pass over the text finds the headers, one parses the rows.
    Files are read together with those of the same header, so that no file is
    read by another one's. ``_bad_line`` marks lines with too few or too many cells.
    """
    rows = None
    for header, files in _headers(spark, [path] if isinstance(path, str) else list(path)).items():
        names = [name.strip('"') for name in header.split("\t")]
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, BAD_LINE]])
        # without column pruning, as the reader then notices short and long lines
        reader = spark.read.option("columnPruning", False).option("columnNameOfCorruptRecord", BAD_LINE)
        part = reader.csv(files, schema=schema, sep="\t", header=True, enforceSchema=True, encoding="UTF-8", mode="PERMISSIVE")
        rows = part if rows is None else rows.unionByName(part)
    if rows is None:
        raise FileNotFoundError(f"no staged files at {path}")
    return rows


def batch_label(dt: str) -> str:
    return "batch_" + dt.replace("-", "")


def _audit(source: Source, dt: str) -> list[Column]:
    return [
        F.current_timestamp().alias("ingest_time"),
        F.lit(source.tag).alias("source_system"),
        F.lit(batch_label(dt)).alias("batch_id"),
    ]


def _typed(source: Source, field: T.StructField) -> Column:
    if field.name in FORCED_NULL.get(source.name, ()):
        return F.lit(None).cast(field.dataType).alias(field.name)
    return parse(F.col(field.name), field.dataType).alias(field.name)


def type_rows(raw: DataFrame, name: str, dt: str) -> DataFrame:
    """Project, cast and stamp all-string rows. A cell that does not fit its type is null.

    A line with too few or too many cells fails the load; set such lines aside
    first, with ``split_rejects``.
    """
    source = SOURCES[name]
    if BAD_LINE in raw.columns:
        bad = F.col(BAD_LINE)
        stop = F.raise_error(F.concat(F.lit(f"{name}: a line has too few or too many cells: "), bad))
        raw = raw.where(F.when(bad.isNull(), True).otherwise(stop.cast("boolean")))
    return raw.select(*[_typed(source, f) for f in source.schema], *_audit(source, dt))


def lost_cells(name: str) -> Column:
    """Names of the row's filled cells that the cast turns into null."""
    checked = [
        f for f in SOURCES[name].schema
        if not isinstance(f.dataType, T.StringType) and f.name not in FORCED_NULL.get(name, ())
    ]
    return F.array_compact(F.array(*[F.when(lost(F.col(f.name), f.dataType), F.lit(f.name)) for f in checked]))


def with_rejects(raw: DataFrame, name: str) -> DataFrame:
    """raw with ``rejected``: the names of the cells that the cast loses, or ``_bad_line`` for a malformed line."""
    cells = lost_cells(name)
    if BAD_LINE in raw.columns:
        cells = F.when(F.col(BAD_LINE).isNotNull(), F.array(F.lit(BAD_LINE))).otherwise(cells)
    return raw.withColumn("rejected", cells)


def rejected_cells(raw: DataFrame, name: str) -> DataFrame:
    """The raw rows in which a filled cell was lost or the line is malformed, with the names of those cells."""
    return with_rejects(raw, name).where(F.size("rejected") > 0)


def split_rejects(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows to load (well-formed lines) and rows to set aside, from a written result of ``with_rejects``."""
    load = marked.where(~F.array_contains("rejected", BAD_LINE)).drop("rejected", BAD_LINE)
    return load, marked.where(F.size("rejected") > 0)


def load_source(spark: SparkSession, name: str, path: str | Sequence[str], dt: str) -> DataFrame:
    """Read and type one staged extract."""
    return type_rows(read_text(spark, path), name, dt)


def write_text(df: DataFrame, path: str) -> str:
    """Write rows in the staged form, every cell as text so that times keep their fraction."""
    (
        df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
        .write.mode("overwrite").csv(path, sep="\t", header=True, encoding="UTF-8")
    )
    return path
