"""Empty-value conventions. Inside the engine a missing value is NULL; sinks write it as an empty string."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Markers that stand for a missing value, per source convention, and how case is treated.
MARKERS = {
    "base": ("upper", ("NA", "N/A", "NULL", "NONE", "")),
    "name": ("upper", ("NA", "N/A", "NULL", "NONE", "NAN", "***", "")),
    "analysis": ("exact", ("NA", "N/A", "None", "none", "null", "NULL", "")),
    "graph": ("lower", ("", "nan", "none", "null", "<na>", "na", "n/a")),
    "strip": ("exact", ("",)),
}


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(c: Column, f) -> Column:
    """f of a value that is computed once, however often f uses it."""
    return F.transform(F.array(c), f)[0]


#: Unicode white space, and the separators that Python strips as well.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def trim(c: Column | str) -> Column:
    """Strip every kind of Unicode white space from both ends (SQL trim strips blanks only)."""
    return F.btrim(col(c), F.lit(SPACES))


def fold(c: Column | str, profile: str = "base") -> Column:
    """Trimmed text, NULL where it is a marker of the profile. Not for control columns, where "none" is a value."""
    case, markers = MARKERS[profile]
    t = trim(c)
    cased = {"upper": F.upper(t), "lower": F.lower(t), "exact": t}[case]
    return F.when(~cased.isin(*markers), t)


def fold_exact(c: Column | str, empty_too: bool = False) -> Column:
    """NULL for the exact text None, and for the empty text if asked; nothing is trimmed."""
    c = col(c)
    return F.when((c != "None") & (F.lit(not empty_too) | (c != "")), c)


def with_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """df with the named columns; those it lacks are added as NULL text. Column order follows names, then the rest."""
    have = {c.lower(): c for c in df.columns}
    out = df.select(*[F.col(have[n.lower()]).alias(n) if n.lower() in have else F.lit(None).cast("string").alias(n) for n in names],
                    *[F.col(c) for c in df.columns if c.lower() not in {n.lower() for n in names}])
    return out


def at_sink(df: DataFrame) -> DataFrame:
    """NULL text written as empty text."""
    return df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])
