"""Language codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliant.nulls import col

ISO = r"^<http://id\.loc\.gov/vocabulary/iso639-2/([a-z]{3})>\z"


def language_form(c: Column | str) -> Column:
    c = col(c)
    return F.when(c.isNull(), "missing").when(c.rlike(ISO), "iso_code_uri").otherwise("non_parseable")


def language_code(c: Column | str) -> Column:
    """ISO 639-2 code of the vocabulary IRI, else NULL."""
    return F.nullif(F.regexp_extract(col(c), ISO, 1), F.lit(""))


#: English names of languages that catalogues write out.
NAMES = {"french": "fre", "english": "eng", "latin": "lat", "german": "ger", "italian": "ita", "spanish": "spa", "dutch": "dut", "greek": "gre"}


def language_any(c: Column | str) -> Column:
    """Code from an IRI's last part, an English name, or a code; lower case."""
    tail = F.lower(F.regexp_replace(F.element_at(F.split(col(c), "/"), -1), "[<>]", ""))
    names = F.create_map(*[F.lit(x) for kv in NAMES.items() for x in kv])
    return F.coalesce(names[tail], tail)
