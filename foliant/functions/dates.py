"""Dates of persons and organisations: classes of source forms and their EDTF rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliant.nulls import col

SIGN = r"(-\s?)?"
DAY = rf"^{SIGN}(\d{{1,4}})-(\d{{2}})-(\d{{2}})\z"
MONTH = rf"^{SIGN}(\d{{1,4}})-(\d{{2}})\z"
YEAR = rf"^{SIGN}(\d{{1,4}})\z"
MASKED = rf"^{SIGN}(?=[\d.X]{{4}}\z)(\d{{1,3}})([.X]{{1,3}})\z"
FIELDS = ("birth", "death", "start", "end")


def date_form(c: Column | str) -> Column:
    """missing, exact_date, year_month, exact_year, masked_precision or non_parseable, tried in that order."""
    c = col(c)
    return (
        F.when(c.isNull(), "missing")
        .when(c.rlike(DAY), "exact_date")
        .when(c.rlike(MONTH), "year_month")
        .when(c.rlike(YEAR), "exact_year")
        .when(c.rlike(MASKED), "masked_precision")
        .otherwise("non_parseable")
    )


def edtf(c: Column | str) -> Column:
    """EDTF text: year padded to four digits, sign kept without the astronomical shift, unknown digits as X; else NULL."""
    c = col(c)

    def part(pattern: str, i: int) -> Column:
        return F.regexp_extract(c, pattern, i)

    def signed(pattern: str, *rest: Column) -> Column:
        return F.concat(F.when(part(pattern, 1) != "", "-").otherwise(""), *rest)

    form = date_form(c)
    return (
        F.when(form == "exact_date", signed(DAY, F.lpad(part(DAY, 2), 4, "0"), F.lit("-"), part(DAY, 3), F.lit("-"), part(DAY, 4)))
        .when(form == "year_month", signed(MONTH, F.lpad(part(MONTH, 2), 4, "0"), F.lit("-"), part(MONTH, 3)))
        .when(form == "exact_year", signed(YEAR, F.lpad(part(YEAR, 2), 4, "0")))
        .when(form == "masked_precision", signed(MASKED, part(MASKED, 2), F.translate(part(MASKED, 3), ".", "X")))
    )


def date_confidence(form: Column | str) -> Column:
    form = col(form)
    return F.when(form.isin("missing", "non_parseable"), "low").when(form == "truncated_decade", "medium").otherwise("high")


def with_truncated_decades(df, raw: dict[str, str], out: dict[str, str], form: dict[str, str]):
    """A bare three-digit year is a decade (`170X`) where another date of the row begins in the second millennium.

    The maps name the raw, rendered and form column of each field; fields are settled in the maps' order, and what is
    settled counts as context for the fields after it.
    """
    for f in raw:
        others = [F.coalesce(F.col(out[g]), F.lit("")).rlike("^[12][0-9X]{3}") for g in raw if g != f]
        near = others[0]
        for o in others[1:]:
            near = near | o
        cut = (F.col(form[f]) == "exact_year") & F.col(raw[f]).rlike(r"^\d{3}\z") & near
        df = df.withColumns(
            {
                out[f]: F.when(cut, F.concat(F.col(raw[f]), F.lit("X"))).otherwise(F.col(out[f])),
                form[f]: F.when(cut, "truncated_decade").otherwise(F.col(form[f])),
            }
        )
    return df
