"""Text normalisation, number and date parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stayglass import fixed_values as fv


def null_if_na(c: Column, tokens: list[str] = fv.NA_TOKENS) -> Column:
    """Null when the trimmed text is one of the "no value" tokens."""
    return F.when(~F.trim(c).isin(tokens), c)


def parse_price_strict(c: Column) -> Column:
    """``$1,200`` -> 1200.0; null unless the whole remaining text is a plain number.

    Texts such as ``Free airport taxi`` match nothing, and an empty match casts to null.
    """
    bare = F.translate(c, "$,", "")
    return F.regexp_extract(bare, r"^(\d+\.?\d*)$", 1).try_cast("double")


def parse_first_number(c: Column) -> Column:
    """First run of digits and dots in the text, as a number."""
    return F.regexp_extract(c, r"([\d.]+)", 1).try_cast("double")


def parse_date(c: Column) -> Column:
    """ISO date; anything else becomes null."""
    return F.try_to_date(c, "yyyy-MM-dd")


def parse_whole(c: Column) -> Column:
    """Whole number, also when written with a decimal point."""
    return c.try_cast("double").try_cast("bigint")


def convert_currency(c: Column, rate: float = fv.USD_TO_CAD) -> Column:
    return F.round(c * F.lit(rate), 2)


def python_bool(c: Column) -> Column:
    """``True`` / ``False`` spelling of a boolean, as category labels use it."""
    return F.when(c, F.lit("True")).when(~c, F.lit("False"))


def interaction(*cols: Column) -> Column:
    """``a_b`` category; null when a part is null."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit("_"))
        parts.append(c)
    return F.concat(*parts)
