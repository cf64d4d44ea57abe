"""Places of publication."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliant.nulls import col, trim

#: Texts removed from a city, wherever they stand and in this order; the lookup tables are keyed that way.
REMOVED = ("In ", "A ", "À ", "Tot ", "Te ", "T' ", "t ", "t' ")


def split_place(c: Column | str) -> tuple[Column, Column]:
    """City and country: what stands before the last opening parenthesis, and after it without parentheses."""
    c = col(c)
    has = c.contains("(")
    city = F.when(has, trim(F.regexp_extract(c, r"(?s)^(.*)\(", 1))).otherwise(trim(c))
    country = F.when(has, trim(F.regexp_replace(F.regexp_extract(c, r"(?s)^.*\((.*)\z", 1), "[()]", "")))
    return city, F.nullif(country, F.lit(""))


def city_key(city: Column | str) -> Column:
    """Lookup key of a city."""
    c = F.regexp_replace(col(city), r"[\[\]()?,]", "")
    for text in REMOVED:
        c = F.replace(c, F.lit(text), F.lit(""))
    return F.nullif(trim(c), F.lit(""))


def uncertainty(city: Column | str) -> dict[str, Column]:
    c = col(city)
    return {"brackets": c.rlike(r"[\[\]]"), "parentheses": c.rlike("[()]"), "question_marks": c.contains("?")}
