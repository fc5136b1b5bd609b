"""Text and scaled forms of amounts and names for dashboards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

YI = 1e8
WAN = 1e4


def masked_name(name: Column, keep: int = 3) -> Column:
    """First characters and two stars; three stars for a missing name."""
    blank = name.isNull() | (name == "")
    return F.when(blank, F.lit("***")).otherwise(F.concat(F.substring(name, 1, keep), F.lit("**")))


def card_text(value: Column, unit: str = "number") -> Column:
    """Grouped text: '39.22亿' for yi, '4.99万' for wan, '1,000' otherwise."""
    number = value.cast("double")
    if unit == "yi":
        return F.concat(F.format_number(number / YI, 2), F.lit("亿"))
    if unit == "wan":
        return F.concat(F.format_number(number / WAN, 2), F.lit("万"))
    return F.format_number(number, 0)


def _fixed(number: Column, pattern: str) -> Column:
    return F.call_function("format_number", number, F.lit(pattern))


def auto_text(value: Column, unit: str | None = None) -> Column:
    """Text in the unit asked for, or in the largest unit that fits; '-' for null."""
    number = value.cast("double")
    # exact halves go up here, unlike the half-even number format
    hundredths = number / YI
    halves_up = F.when(hundredths * 8 == F.floor(hundredths * 8), F.round(hundredths, 2)).otherwise(hundredths)
    yi = F.concat(_fixed(halves_up, "0.00"), F.lit(" 亿"))
    wan = F.concat(F.floor(number / WAN + 0.5).cast("string"), F.lit(" 万"))
    if unit == "yi":
        text = yi
    elif unit == "wan":
        text = wan
    elif unit == "pct":
        text = F.concat(_fixed(number, "0.00"), F.lit("%"))
    else:
        whole = F.format_number(F.floor(number + 0.5), 0)
        text = F.when(number >= YI, yi).when(number >= WAN, wan).otherwise(whole)
    return F.when(value.isNull(), F.lit("-")).otherwise(text)


def in_wan(value: Column) -> Column:
    """Chart value in ten-thousands, rounded half to even."""
    return F.bround(value.cast("double") / WAN, 0)
