"""Identifiers and IRIs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliant.functions.links import unwrap
from foliant.nulls import col, trim


def _id(c: Column | str, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(col(c), pattern, group), F.lit(""))


def viaf_id(c: Column | str) -> Column:
    return _id(c, r"viaf\.org/viaf/(\d+)")


def bnf_number(c: Column | str) -> Column:
    """Eight digits of a cb identifier."""
    return _id(c, r"cb(\d{8})")


def bnf_ark(c: Column | str) -> Column:
    return _id(c, r"(ark:/12148/cb\d{8}[0-9a-z])")


def wikidata_id(c: Column | str) -> Column:
    return _id(c, r"\b(Q\d+)\b")


def viaf_of_key(c: Column | str) -> Column:
    return _id(c, r"^viaf_(\d+)\z")


def valid_iri(c: Column | str) -> Column:
    """http(s), a host, no white space. NULL counts as not valid."""
    return F.coalesce(col(c).rlike(r"(?i)^https?://[^/?#\s]+\S*\z") & ~col(c).rlike(r"(?U)\s"), F.lit(False))


def clean_iri(c: Column | str) -> Column:
    """Trimmed, without angle brackets; NULL where not valid."""
    t = unwrap(trim(c))
    return F.when(valid_iri(t), t)


def valid_iris(c: Column | str, separator: str = ";") -> Column:
    """All valid IRIs of a multi-valued cell, in order."""
    return F.filter(F.transform(F.split(col(c), separator), clean_iri), lambda x: x.isNotNull())


def base_iri(c: Column | str) -> Column:
    return F.substring_index(col(c), "#", 1)


def fragment(base: Column | str, name: str | Column) -> Column:
    """base#name; NULL where the base is."""
    return F.concat(col(base), F.lit("#"), name if isinstance(name, Column) else F.lit(name))


def fragment_n(base: Column | str, name: str, n: Column | str) -> Column:
    return F.concat(col(base), F.lit(f"#{name}_"), col(n).cast("string"))


def edition_iri(c: Column | str, stem: str = "http://data.bnf.fr/") -> Column:
    """A full IRI as it is, an ark appended to the stem, digits as a cb ark."""
    c = trim(c)
    return (
        F.when(c.rlike("^https?://"), c)
        .when(c.startswith("ark:/"), F.concat(F.lit(stem), c))
        .when(c.rlike(r"^\d+\z"), F.concat(F.lit(f"{stem}ark:/12148/cb"), c))
    )


def authority_iri(kind: str, c: Column | str) -> Column:
    """IRI of an identifier at an authority; values that are IRIs stay."""
    c = trim(c)
    made = {
        "viaf": F.concat(F.lit("http://viaf.org/viaf/"), c),
        "wikidata": F.concat(F.lit("http://www.wikidata.org/entity/"), F.when(c.startswith("Q"), c).otherwise(F.concat(F.lit("Q"), c))),
        "isni": F.concat(F.lit("http://isni.org/isni/"), F.regexp_replace(c, r"\s", "")),
        "lc": F.concat(F.lit("http://id.loc.gov/authorities/names/"), c),
    }[kind]
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit(None)).when(c.rlike("^https?://"), c).otherwise(made)


def url_encoded(c: Column | str) -> Column:
    """Percent-encoding of everything but letters, digits and -._~"""
    return F.replace(F.replace(F.replace(F.url_encode(col(c)), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def wkt_point(longitude: Column | str, latitude: Column | str) -> Column:
    """POINT(lon lat), NULL unless both are numbers."""
    x, y = trim(longitude), trim(latitude)
    ok = x.try_cast("double").isNotNull() & y.try_cast("double").isNotNull()
    return F.when(ok, F.concat(F.lit("POINT("), x.try_cast("double").cast("string"), F.lit(" "), y.try_cast("double").cast("string"), F.lit(")")))


def xsd_date_time(edtf: Column | str) -> Column:
    """First moment of a full year or day, else NULL."""
    c = col(edtf)
    return F.when(c.rlike(r"^\d{4}\z"), F.concat(c, F.lit("-01-01T00:00:00"))).when(c.rlike(r"^\d{4}-\d{2}-\d{2}\z"), F.concat(c, F.lit("T00:00:00")))
