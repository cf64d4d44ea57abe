"""The year readings in use. They differ on purpose; each operator names the one it needs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliant.nulls import col


def _first(c: Column, pattern: str, group: int = 0) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def year_of_role(first: Column | str, span: Column | str) -> Column:
    """Four digits before a slash, from the first year, else from the range."""

    def one(c):
        c = F.substring_index(col(c), "/", 1)
        return F.when(c.rlike(r"^\s*\d{4}\s*\z"), F.trim(c).cast("int"))

    return F.coalesce(one(first), one(span))


def year_of_edition(c: Column | str) -> Column:
    """First number of three digits, or of four that begin with 1."""
    return _first(col(c), r"\b(1[0-9]{3}|[0-9]{3})\b", 1).try_cast("int")


def year_of_actor(c: Column | str) -> Column:
    """First four digits anywhere."""
    return _first(col(c), r"\d{4}").try_cast("int")


def year_text_bounded(c: Column | str) -> Column:
    """First four digits that stand alone, as text."""
    return _first(col(c), r"\b(\d{4})\b", 1)


def year_text(c: Column | str) -> Column:
    """First four digits as text, empty text without any."""
    return F.coalesce(_first(col(c), r"\d{4}"), F.lit(""))


def years_of_path(c: Column | str) -> Column:
    """Distinct years 1000-2099 of a file path, in order."""
    return F.array_distinct(F.regexp_extract_all(col(c), F.lit(r"(?<!\d)(1\d{3}|20\d{2})(?!\d)"), F.lit(1)))


def year_of_edtf(c: Column | str) -> Column:
    """A plain four-digit year, else NULL."""
    return F.when(col(c).rlike(r"^[0-9]{4}\z"), col(c).try_cast("int"))


def in_years(year: Column | str, low: int | None, high: int | None) -> Column:
    """Inside the bounds given; with any bound an unknown year is outside, with none every row is inside."""
    y, out = col(year), F.lit(True)
    if low is not None:
        out = out & (y >= low)
    if high is not None:
        out = out & (y <= high)
    return F.coalesce(out, F.lit(False))
