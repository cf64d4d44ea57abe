"""Rule sets: each gives every value an array of cases (label, kind) as a column, evaluated in one pass."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions.links import AUTHORITIES, SECURE, URI
from foliant.functions.names import ALIASES, CONJUNCTIONS, TITLE_PHRASES, TITLES, has_brackets, initials_only, rdf_text
from foliant.nulls import col, let, trim

#: ISO 639-2 codes in use, and those of older stages of a language.
CODES = """
    afr alb alg ang ara arc arm art baq ben bos bre car cat cel chi chu cop cos cze
    dan dum dut eng enm epo est fin fre frm fro fry gem geo ger gez gla gle gmh goh
    got grc gre grn gsw heb hin hrv hsb hun ice iku iro ita jav jpn kon lad lat lav
    lit mal map may mis mlg mnc mul mus nds nog non nor oci ota peo per pol por pro
    roa roh rum rus sai sam sga sin sla slv smi spa srp swe syc syr tam tat tel tgl
    tur urd wel wen yid zxx
""".split()
OLD = ("fro", "frm", "pro", "oci")


def _case(when: Column, label: str | Column, kind: str) -> Column:
    return F.when(when, F.struct((F.lit(label) if isinstance(label, str) else label).alias("label"), F.lit(kind).alias("kind")))


def _only(*cases: Column) -> Column:
    return F.array_compact(F.array(*cases))


def _text(value: str) -> Column:
    return F.coalesce(trim(value), F.lit(""))


def dates(value: str, form: str) -> Column:
    return let(F.struct(_text(value).alias("v"), F.coalesce(col(form), F.lit("")).alias("f")), lambda x: _dates(x["v"], x["f"]))


def _dates(v: Column, f: Column) -> Column:
    empty = v == ""
    masked = v.rlike(r"^-?\d{1,3}X{1,3}\z") & (F.length(F.regexp_replace(v, "^-", "")) == 4)
    unknown = F.length(F.regexp_extract(v, "(X*)$", 1))
    level = F.when(unknown == 1, "decade_level").when(unknown == 2, "century_level").otherwise("millennium_level")
    shaped = v.rlike(r"^-?\d{4}\z|^-?\d{4}-\d{2}\z|^-?\d{4}-\d{2}-\d{2}\z")
    return _only(
        _case(empty & (f == "non_parseable"), "unresolved_residual", "warning"),
        _case(empty & ~f.isin("missing", "non_parseable"), "missing_value", "error"),
        _case(v.contains("~"), "approximate_date", "warning"),
        _case(v.contains("?"), "uncertain_date", "warning"),
        _case(v.contains("/"), "date_range", "warning"),
        _case(masked, level, "warning"),
        _case(~empty & ~masked & ~shaped, "non_edtf_format", "error"),
    )


def links(value: str) -> Column:
    return let(_text(value), _links)


def _links(v: Column) -> Column:
    empty, several = v == "", v.rlike("[;|]")
    uri = v.rlike(r"^https?://\S+\z")
    host, scheme = F.lower(F.regexp_extract(v, URI, 2)), F.regexp_extract(v, URI, 1)
    good = ~empty & ~several & uri
    return _only(
        _case(empty, "missing_value", "error"),
        _case(~empty & several, "multi_value_not_split", "error"),
        _case(~empty & ~several & ~uri, "not_a_uri", "error"),
        _case(good & ~host.isin(*AUTHORITIES), "unknown_authority_domain", "warning"),
        _case(good & host.isin(*SECURE) & (scheme == "http"), "insecure_http_for_known_authority", "warning"),
        _case(good & host.startswith("www.") & F.substring(host, 5, 1000).isin(*AUTHORITIES), "www_prefix_variant", "warning"),
    )


def language(value: str) -> Column:
    return let(F.lower(_text(value)), _language)


def _language(v: Column) -> Column:
    empty, several = v == "", v.rlike("[;,]")
    shaped = v.rlike(r"^[a-z]{3}\z")
    return _only(
        _case(empty, "missing_value", "error"),
        _case(several, "multi_language_value", "warning"),
        _case(~empty & ~several & ~shaped, "not_iso_639_2_format", "error"),
        _case(shaped & ~v.isin(*CODES), "low_confidence_mapping", "warning"),
        _case(v.isin(*OLD), "archaic_or_dialectal_language", "warning"),
    )


def place(value: str, original: str, tgn_id: str, country: str, longitude: str, latitude: str) -> Column:
    names = (value, original, tgn_id, country, longitude, latitude)
    return let(F.struct(*[_text(n).alias(f"f{i}") for i, n in enumerate(names)]), lambda r: _place(*[r[f"f{i}"] for i in range(len(names))]))


def _place(p: Column, o: Column, t: Column, c: Column, x: Column, y: Column) -> Column:
    none = (p == "") & (c == "")
    placed, known = (p != "") & ~none, (t != "") & ~none
    inside = F.coalesce(x.try_cast("double").between(-180, 180) & y.try_cast("double").between(-90, 90), F.lit(False))
    blank = (x == "") | (y == "")
    return _only(
        _case(none & (o != ""), "unmatched_place", "warning"),
        _case(none & (o == ""), "missing_value", "error"),
        _case(placed & (t == ""), "missing_tgn_id", "error"),
        _case(placed & (c == ""), "missing_publication_country", "error"),
        _case(placed & p.rlike(r"[\[\]]"), "residual_bracket_in_harmonised", "error"),
        _case(placed & p.rlike(r"[()]"), "residual_parenthesis_in_harmonised", "error"),
        _case(placed & p.contains("?"), "residual_question_mark_in_harmonised", "error"),
        _case(known & blank, "missing_coordinates", "warning"),
        _case(known & ~blank & ~inside, "invalid_coordinates", "error"),
    )


def publisher(value: str) -> Column:
    return let(_text(value), _publisher)


def _publisher(v: Column) -> Column:
    full = v != ""
    return _only(
        _case(~full, "missing_value", "error"),
        _case(v.rlike(r"(?iuU)\b(s\.?\s?n\.?|sine\s+nomine|sans\s+nom|ohne\s+verlag|senza\s+nome|without\s+publisher)\b"), "sine_nomine", "warning"),
        _case(v.rlike(r"(?U)\b(Impr\.|Lib\.|Éd\.|Ed\.)\b"), "residual_abbreviation", "warning"),
        _case(v.rlike(r"\([A-Z][a-z]+\)"), "residual_location_in_name", "warning"),
        _case(v.contains(";"), "multi_value_not_split", "error"),
        _case(full & v.rlike(r"(?U)[^\w\s.,\-'()&]"), "non_alphanumeric_noise", "error"),
    )


def person_name(value: str) -> Column:
    """Names that still look damaged: empty, tagged, bracketed, aliased, titled, joined, abbreviated, digits, one letter, case."""
    return let(_text(value), _person_name)


def _person_name(v: Column) -> Column:
    full = v != ""
    titles = "|".join([*TITLE_PHRASES, *TITLES])
    joins = "|".join(CONJUNCTIONS)
    return _only(
        _case(~full, "missing_value", "error"),
        _case(rdf_text(v).isNotNull(), "rdf_literal", "error"),
        _case(has_brackets(v), "brackets_or_separators", "error"),
        _case(v.rlike(r"[;|]"), "multi_value_not_split", "error"),
        _case(v.rlike(r"(?U)\s{2,}"), "repeated_white_space", "error"),
        _case(v.rlike(rf"(?iuU)\b({ALIASES})\b"), "alias_marker", "warning"),
        _case(v.rlike(rf"(?iuU)\b({titles})\b"), "title_or_role", "warning"),
        _case(v.rlike(rf"(?U)\s({joins})\s"), "conjunction", "warning"),
        _case(initials_only(v), "initials_or_abbreviation", "warning"),
        _case(v.rlike(r"\d"), "digits", "warning"),
        _case(full & ~v.rlike(r"(?U)\s"), "single_word", "warning"),
        _case(F.length(v) == 1, "single_letter", "warning"),
        _case(full & (v == F.upper(v)) & v.rlike(r"\p{Lu}{2}"), "all_capitals", "warning"),
        _case(full & (v == F.lower(v)) & v.rlike(r"\p{Ll}"), "no_capital", "warning"),
        _case(v.rlike(r"[^\p{L}\p{N}\s.,'’\-]"), "unusual_character", "warning"),
    )


#: Which rule set reads which column.
REGISTRY: dict[str, Callable[..., Column]] = {
    "date_harmonised": dates,
    "link_harmonised": links,
    "language_harmonised": language,
    "publication_place": place,
    "publisher_harmonised": publisher,
    "actor_name_harmonised": person_name,
}


def summary(df: DataFrame, cases: Column) -> DataFrame:
    """case, case_type, total_occurrences, percentage over all rows; the number of rows reaches the driver."""
    total = df.count()
    counts = df.select(F.inline(cases)).groupBy("label", "kind").agg(F.count("*").alias("n"))
    share = F.round(F.col("n") / F.lit(max(total, 1)) * 100, 4)
    return counts.select(F.col("label").alias("case"), F.col("kind").alias("case_type"), F.col("n").alias("total_occurrences"), share.alias("percentage"))


def by_value(df: DataFrame, value: str, cases: Column, kind: str) -> DataFrame:
    """value, cases (sorted, joined by ;), occurrences: the sum of all cases of the kind."""
    rows = df.select(F.coalesce(F.col(value), F.lit("")).alias("value"), F.inline(cases)).where(F.col("kind") == kind)
    return rows.groupBy("value").agg(F.array_join(F.array_sort(F.collect_set("label")), ";").alias("cases"), F.count("*").alias("occurrences"))
