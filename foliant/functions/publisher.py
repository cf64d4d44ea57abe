"""Publisher statements."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from foliant.nulls import col, let, trim

#: Abbreviations and what they stand for.
ABBREVIATIONS = {
    "impr.": "Imprimerie",
    "imp.": "Imprimerie",
    "impr": "Imprimerie",
    "imp": "Imprimerie",
    "éd.": "Éditeur",
    "ed.": "Éditeur",
    "lib.": "Libraire",
    "libr.": "Libraire",
    "vve": "Veuve",
    "vve.": "Veuve",
    "vf": "Veuve",
    "frères": "Frères",
    "fres": "Frères",
    "cie": "Compagnie",
    "cie.": "Compagnie",
    "cº": "Compagnie",
    "st": "Saint",
    "ste": "Sainte",
}
NO_NAME = r"(?iU)^(s\.?\s?n\.?|sine\s+nomine|sans\s+nom)\z"
AUTHOR = r"(?iU)^(chez\s+l['’]\s?auteur|l['’]\s?auteur|auteur)\z"
SEVERAL = r"(?iU);|\s-\s|\bet\.?\b"
CLUSTERED = ("passthrough", "abbreviation_expanded", "bracketed_uncertain", "location_stripped")


#: Any abbreviation as a whole word, the longest first.
ABBREVIATION = rf"(?<!\w)({'|'.join(re.escape(k) for k in sorted(ABBREVIATIONS, key=len, reverse=True))})(?!\w)"


def expanded_text(s: str | None) -> str | None:
    """Abbreviations written out, white space collapsed."""
    return None if s is None else " ".join(re.sub(ABBREVIATION, lambda m: ABBREVIATIONS[m[0].lower()], s, flags=re.I).split())


@F.pandas_udf(StringType())
def expanded(s: pd.Series) -> pd.Series:
    """Each match has its own replacement, which no built-in replace can do in one pass."""
    return s.map(expanded_text)


def statement(c: Column | str) -> Column:
    """A struct of a folded statement: unwrapped, named (location removed), correction_type and confidence.

    The kind is settled in this order: missing, sine_nomine, self_published, multi_value, then location_stripped,
    abbreviation_expanded, bracketed_uncertain, passthrough. Each step's value is computed once.
    """
    inside = lambda x: F.struct(x.alias("c"), F.regexp_extract(x, r"(?s)^\[(.+)\]\z", 1).alias("inner"))
    opened = lambda x: F.struct(x["c"].alias("c"), (x["inner"] != "").alias("bracketed"), F.when(x["inner"] != "", trim(x["inner"])).otherwise(x["c"]).alias("plain"))
    part = lambda x, i: trim(F.regexp_extract(x["plain"], r"(?U)^(.+?)\s*\(([^()]+)\)\s*\z", i))
    parted = lambda x: F.struct(x.alias("x"), part(x, 1).alias("name"), part(x, 2).alias("where"))
    located = lambda y: (y["name"] != "") & (y["where"] != "") & ~y["where"].rlike(r"^\d{3,4}\.?(-\d{3,4}\.?)?\z")
    settled = lambda y: F.struct(y["x"].alias("x"), located(y).alias("located"), F.when(located(y), y["name"]).otherwise(y["x"]["plain"]).alias("named"))

    def judged(z: Column) -> Column:
        plain = z["x"]["plain"]
        kind = F.when(z["x"]["c"].isNull(), "missing")
        for when, name in (
            (plain.rlike(NO_NAME), "sine_nomine"), (plain.rlike(AUTHOR), "self_published"), (plain.rlike(SEVERAL), "multi_value"), (z["located"], "location_stripped"),
            (z["named"].rlike("(?iuU)" + ABBREVIATION), "abbreviation_expanded"), (z["x"]["bracketed"], "bracketed_uncertain"),
        ):
            kind = kind.when(when, name)
        return F.struct(plain.alias("unwrapped"), z["named"].alias("named"), kind.otherwise("passthrough").alias("correction_type"))

    def trusted(w: Column) -> Column:
        kind = w["correction_type"]
        return w.withField("confidence", F.when(kind.isin("missing", "multi_value"), "low").when(kind == "bracketed_uncertain", "medium").otherwise("high"))

    out = col(c)
    for step in (inside, opened, parted, settled, judged, trusted):
        out = let(out, step)
    return out


def harmonised(c: Column | str, kind: Column, named_expanded: Column) -> Column:
    """Final text by kind: nothing, the author's own, the statement as it stands, or the written-out name."""
    return (
        F.when(kind.isin("missing", "sine_nomine"), F.lit(None))
        .when(kind == "self_published", "L'auteur")
        .when(kind == "multi_value", col(c))
        .otherwise(named_expanded)
    )
