"""Names of persons: one cascade of rules, the first that applies settles the result."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliant.nulls import col

#: Words that join names or belong inside them, marks of aliases, titles and roles.
PARTICLES = ("de", "da", "di", "del", "van", "von", "y", "e", "et", "und")
CONJUNCTIONS = ("e", "and", "et", "y", "und")
PREPOSITIONS = ("de", "del", "di", "da", "of")
ALIASES = (
    r"alias|dit\s+le|dit\s+la|dit\s+il|detto\s+il|detto\s+lo|detto\s+la|detta\s+la|called|also\s+known\s+as|known\s+as|"
    r"surnomm[ée]e?|llamad[oa]|conocid[oa]\s+como|apodad[oa]|genannt|bekannt\s+als"
)
TITLES = (
    "veuve", "vve", "seigneur", "sieur", "prince", "chevalier", "comte",
    "comtesse", "duque", "duc", "cardinal", "officier", "officer", "colonel",
    "dame", "madame", "mme", "abbé", "abbe", "abate", "abbot", "herr",
    "frau", "rey", "reina", "king", "queen",
)
TITLE_PHRASES = (
    "vve de", "veuve de", "widow of", "vedova di", "viuda de", "witwe von",
    "sieur de", "le fils du", "fils de", "son of", "hijo de", "figlio di",
    "homme de lettres",
)

_PAIRS = (("[", "]"), ("(", ")"), ("{", "}"), ("«", "»"), ("<", ">"), ('"', '"'), ("'", "'"))
_W = "(?U)"


def rdf_text(c: Column | str) -> Column:
    """Text of a literal with a language tag, else NULL."""
    return F.nullif(F.trim(F.regexp_extract(F.trim(col(c)), r'^"(.*)"@[a-z]{2,3}\z', 1)), F.lit(""))


def has_brackets(c: Column | str) -> Column:
    return col(c).rlike(r'[\[\](){}"<>]|//')


def without_wrapping(c: Column | str) -> Column:
    """A matched outer pair removed, then everything but letters and digits at both ends."""
    c = F.trim(col(c))
    inner = c
    for a, b in _PAIRS:
        inner = F.when(c.startswith(a) & c.endswith(b) & (F.length(c) > 1), F.substring(c, F.lit(2), F.length(c) - 2)).otherwise(inner)
    return F.regexp_replace(inner, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+\z", "")


def before_alias(c: Column | str) -> Column:
    """What stands before the first alias mark, without outer blanks and signs; NULL without one or with nothing before."""
    head = F.regexp_extract(col(c), rf"(?isuU)^(.*?)\b(?:{ALIASES})\b", 1)
    return F.nullif(F.btrim(head, F.lit(" ,;.")), F.lit(""))


def without_title(c: Column | str) -> Column:
    """The name without its first title or role, longest phrases first; NULL without one or with nothing left."""
    words = "|".join(re.escape(t).replace(r"\ ", " ") for t in [*sorted(TITLE_PHRASES, key=len, reverse=True), *sorted(TITLES, key=len, reverse=True)])
    pattern = rf"(?isuU)^(.*?)\b(?:{words})\b(.*)\z"
    c = col(c)
    both = F.concat(F.regexp_extract(c, pattern, 1), F.lit(" "), F.regexp_extract(c, pattern, 2))
    rest = F.btrim(F.regexp_replace(both, rf"{_W}\s+", " "), F.lit(" ,;"))
    return F.when(c.rlike(pattern), F.nullif(rest, F.lit("")))


def _words(c: Column) -> Column:
    return F.filter(F.split(c, rf"{_W}\s+"), lambda x: x != "")


def several_names(c: Column | str) -> Column:
    """A conjunction inside the name joins two names: not in compound surnames, not before the last word, not by initials."""
    w = F.transform(_words(col(c)), lambda x: F.btrim(x, F.lit(".,;")))
    low = F.transform(w, lambda x: F.lower(x))
    n = F.size(w)
    joins = F.transform(low, lambda x, i: F.when(x.isin(*CONJUNCTIONS), i).otherwise(F.lit(-1)))
    last_join = F.array_max(F.filter(joins, lambda i: i < n - 1))
    compound = F.exists(F.transform(low, lambda x, i: x.isin(*PREPOSITIONS) & (i < n - 2) & (i < last_join)), lambda x: x)
    second_last = (n >= 4) & F.try_element_at(low, F.greatest(n - 1, F.lit(1))).isin(*CONJUNCTIONS)
    initial = lambda x: x.rlike(r"^[A-Za-z]\.?\z")

    def joined(x, i):
        before, after = F.try_element_at(w, F.greatest(i, F.lit(1))), F.try_element_at(w, i + 2)
        own = (F.length(x) == 1) & (x != F.lower(x))
        return F.lower(x).isin(*CONJUNCTIONS) & (i > 0) & (i < n - 1) & ~own & ~initial(before) & ~F.coalesce(initial(after), F.lit(False))

    return (n >= 3) & ~F.coalesce(compound, F.lit(False)) & ~F.coalesce(second_last, F.lit(False)) & F.exists(F.transform(w, joined), lambda x: x)


def initials_only(c: Column | str) -> Column:
    """One dotted abbreviation, dotted initials, or only words of at most two letters."""
    w = _words(col(c))
    kept = F.filter(w, lambda x: ~F.lower(F.btrim(x, F.lit("."))).isin(*PARTICLES))
    one = (F.size(w) == 1) & F.try_element_at(w, F.lit(1)).rlike(r"^[A-Za-z]{1,3}\.\z")
    dotted = (F.size(w) > 0) & F.forall(w, lambda x: x.rlike(r"^[A-Za-z]\.\z"))
    short = (F.size(w) >= 2) & (F.size(kept) > 0) & F.forall(kept, lambda x: F.length(F.btrim(x, F.lit("."))) <= 2)
    return one | dotted | short


def name_cascade(name: Column | str, first: Column | str, last: Column | str) -> dict[str, Column]:
    """harmonised, correction_type, confidence of a folded display name, given folded first and last names."""
    c = col(name)
    given = F.nullif(F.concat_ws(" ", col(first), col(last)), F.lit(""))
    literal, alias, untitled, bare = rdf_text(c), before_alias(c), without_title(c), without_wrapping(c)
    marked = has_brackets(c)
    cleaned = (bare != "") & (bare != c) & ~has_brackets(bare)
    kind = (
        F.when(c.isNull() & given.isNotNull(), "derived_from_first_last")
        .when(c.isNull(), "unresolved_missing")
        .when(literal.isNotNull(), "stripped_rdf_literal_tag")
        .when(marked & cleaned, "stripped_brackets_or_separators")
        .when(marked, "unresolved_brackets_or_separators")
        .when(alias.isNotNull(), "alias_split")
        .when(untitled.isNotNull(), "stripped_title_role")
        .when(several_names(c), "unresolved_multiple_values")
        .when(initials_only(c) & given.isNotNull() & (F.lower(given) != F.lower(c)), "preferred_first_last_over_initials")
        .when(initials_only(c), "initials_or_abbreviation_unresolved")
        .otherwise("none")
    )
    text = (
        F.when(kind.isin("derived_from_first_last", "preferred_first_last_over_initials"), given)
        .when(kind == "stripped_rdf_literal_tag", literal)
        .when(kind == "stripped_brackets_or_separators", bare)
        .when(kind == "alias_split", alias)
        .when(kind == "stripped_title_role", untitled)
        .otherwise(c)
    )
    confidence = F.when(kind.isin("alias_split", "stripped_title_role"), "medium").when(kind.rlike("unresolved"), "low").otherwise("high")
    return {"harmonised": text, "correction_type": kind, "confidence": confidence}


#: Words that catalogues put where a name belongs.
NO_NAMES = ("anonyme", "anonymous", "anonymus", "inconnu", "unknown", "collectif", "auteur", "editeur", "societe", "academie", "eglise", "ville", "france")


def plausible_name(c: Column | str) -> Column:
    """Whether a text can be a person's name: letters, no digits, 2 to 60 characters, not a stand-in. A coarse reading
    without a name parser: order and parts aren't judged."""
    c = F.trim(col(c))
    return F.coalesce(c.rlike(r"\p{L}") & ~c.rlike(r"\d") & F.length(c).between(2, 60) & ~F.lower(c).isin(*NO_NAMES), F.lit(False))


def name_category(column: str) -> str | None:
    """What a column's title says it holds: first, last or name; None for other columns."""
    low = column.lower()
    if "first" in low or "prenom" in low or "given" in low:
        return "first"
    if "last" in low or "family" in low or "surname" in low:
        return "last"
    return "name" if "name" in low or "nom" in low else None
