"""Text-to-type casts that give null on bad text instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse(column: Column, data_type: T.DataType) -> Column:
    """Typed value of a text cell, null when the text does not fit the type."""
    if isinstance(data_type, T.StringType):
        return column
    if isinstance(data_type, T.IntegralType):
        # '12.0' is a whole number in the extracts; a strict integer cast would lose it.
        column = F.regexp_replace(F.trim(column), r"^([+-]?\d+)\.\d*$", "$1")
    return column.try_cast(data_type)


def lost(column: Column, data_type: T.DataType) -> Column:
    """True where a filled cell turned null in the cast."""
    if isinstance(data_type, T.StringType):
        return F.lit(False)
    return column.isNotNull() & (F.trim(column) != "") & parse(column, data_type).isNull()
