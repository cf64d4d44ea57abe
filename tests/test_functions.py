from __future__ import annotations

from pyspark.sql import functions as F

from foliant.functions import dates, iri, language, links, names, place, publisher, text, years
from foliant.functions.html import title_of
from foliant.nulls import fold, with_columns


def test_null_folding_differs_by_profile(values):
    raw = [" na ", "None", "***", "", "nan", "none", "x ", " y\n", None]
    assert values(raw, lambda c: fold(c)) == [None, None, "***", None, "nan", None, "x", "y", None]
    assert values(raw, lambda c: fold(c, "name"))[2:5] == [None, None, None]
    assert values(["NULL", "Null", "none"], lambda c: fold(c, "analysis")) == [None, "Null", None]
    assert values(["<NA>", "n/a", "0"], lambda c: fold(c, "graph")) == [None, None, "0"]


def test_dates(values):
    raw = ["1750", "43", "- 43", "-43", "1594-06-14", "1564-04", "17..", "1...", "17XX", "150.-02-20", "14??", "1..", "1750\n", None]
    want = ["1750", "0043", "-0043", "-0043", "1594-06-14", "1564-04", "17XX", "1XXX", "17XX", None, None, None, None, None]
    assert values(raw, dates.edtf) == want
    assert values(["17..", "1..", None, "882-05-01"], dates.date_form) == ["masked_precision", "non_parseable", "missing", "exact_date"]
    assert values(["882-05-01"], dates.edtf) == ["0882-05-01"]


def test_truncated_decade_needs_another_date(spark):
    d = spark.createDataFrame([(1, "1628", "170"), (2, "265", "340"), (3, None, "170"), (4, "170", "171X")], "i int, birth_raw string, death_raw string")
    d = d.withColumns({"birth": dates.edtf("birth_raw"), "death": dates.edtf("death_raw"), "bf": dates.date_form("birth_raw"), "df": dates.date_form("death_raw")})
    d = dates.with_truncated_decades(d, {"b": "birth_raw", "d": "death_raw"}, {"b": "birth", "d": "death"}, {"b": "bf", "d": "df"})
    got = {r["i"]: (r["birth"], r["death"], r["df"]) for r in d.collect()}
    assert got[1] == ("1628", "170X", "truncated_decade") and got[2][:2] == ("0265", "0340") and got[3][1] == "0170" and got[4][0] == "170X"


def test_language(values):
    raw = ["<http://id.loc.gov/vocabulary/iso639-2/fre>", "fre", None, "<http://id.loc.gov/vocabulary/iso639-2/FRE>"]
    assert values(raw, language.language_code) == ["fre", None, None, None]
    assert values(raw, language.language_form) == ["iso_code_uri", "non_parseable", "missing", "non_parseable"]
    assert values(["English", "<http://x/y/eng>", "lat"], language.language_any) == ["eng", "eng", "lat"]


def test_links(values):
    raw = ["<http://fr.wikipedia.org/wiki/X>", "<://43102>", "HTTP://VIAF.org/viaf/1?q#f", "https://unknown.example/a", None, "mailto:x"]
    got = values(raw, lambda c: F.struct(*[v.alias(k) for k, v in links.link_parts(c).items()]))
    assert [(g["harmonised"], g["correction_type"]) for g in got] == [
        ("https://fr.wikipedia.org/wiki/X", "scheme_upgraded_https"), (None, "malformed"), ("http://viaf.org/viaf/1?q#f", "passthrough"),
        ("https://unknown.example/a", "unknown_authority"), (None, "missing"), (None, "malformed"),
    ]
    assert got[2]["authority"] == "VIAF"


def test_place(values):
    raw = ["In Paris (France)", "A (b) (c)", "Lyon", "[Rouen?]"]
    assert values(raw, lambda c: place.split_place(c)[0]) == ["In Paris", "A (b)", "Lyon", "[Rouen?]"]
    assert values(raw, lambda c: place.split_place(c)[1]) == ["France", "c", None, None]
    assert values(["In Paris", "Saint Omer", "[Rouen?]", "À Lyon,"], place.city_key) == ["Paris", "SainOmer", "Rouen", "Lyon"]


def test_publisher(values):
    raw = ["[s.n.]", "chez l'auteur", "Impr. royale", "imp. royale", "Vve F. Muguet et H. Muguet", "X (Paris)", "X (1750-1780)", "[Didot]", "Didot", None, "Cº Y"]
    kinds = ["sine_nomine", "self_published", "abbreviation_expanded", "abbreviation_expanded", "multi_value", "location_stripped", "passthrough", "bracketed_uncertain", "passthrough", "missing", "abbreviation_expanded"]
    assert values(raw, lambda c: publisher.statement(c)["correction_type"]) == kinds
    assert values(raw[2:4], lambda c: publisher.expanded(publisher.statement(c)["named"])) == ["Imprimerie royale", "Imprimerie royale"]
    assert publisher.expanded_text("Impr. St  Jean, imprimeur") == "Imprimerie Saint Jean, imprimeur"


def test_names(spark):
    rows = [
        ('"William Blake trust"@fr', "William Blake trust", "stripped_rdf_literal_tag"), ("Jean Petit, dit le Grand", "Jean Petit", "alias_split"),
        ("Sieur de Malherbe", "Malherbe", "stripped_title_role"), ("Juan Melo y Girón", "Juan Melo y Girón", "none"), ("[Anon]", "Anon", "stripped_brackets_or_separators"),
        ("Un [livre", "Un [livre", "unresolved_brackets_or_separators"), ("Ann and Bob Stone", "Ann and Bob Stone", "unresolved_multiple_values"), ("A E Crous", "A E Crous", "none"),
        ("Fernando de Toledo y Pimentel Sanz", "Fernando de Toledo y Pimentel Sanz", "none"), ("M. B. L.", "First Last", "preferred_first_last_over_initials"), ("Th.", "First Last", "preferred_first_last_over_initials"),
        (None, "First Last", "derived_from_first_last"), ("Eric E Edner", "Eric E Edner", "none"),
    ]
    d = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "i int, n string").withColumns({"f": F.lit("First"), "l": F.lit("Last")})
    got = d.select("i", *[c.alias(k) for k, c in names.name_cascade("n", "f", "l").items()]).orderBy("i").collect()
    assert [(g["harmonised"], g["correction_type"]) for g in got] == [r[1:] for r in rows]


def test_text_keys_and_scores(spark, values):
    assert text.canonical_text("Éditions  du-Cœur!") == "editions du cœur"
    assert values(["Œuvres de Straße", None, "L'an_2, ½ ÆÞ!"], text.folded) == ["oeuvres de strasse", "", "l an_2 ½ aeþ"]
    assert abs(text.ratio("abcd", "bcde") - 0.75) < 1e-9 and text.ratio("", "") == 0 == text.ratio(None, "a")
    assert values(["Stone, Ann", "Ann Stone"], text.author_key) == ["ann stone"] * 2
    pairs = [
        ("Poems", "Poems on several occasions"), ("The history of England", "The history of England, from the invasion of Caesar, in six volumes"),
        ("Medea a tragedy", "Phaedra a tragedy"), ("", ""), (None, "A play"), ("The end", "the END!"), ("1790", "1791"),
    ]
    d = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    d = d.select("i", text.folded_words("a").alias("a"), text.folded_words("b").alias("b"))
    got = [r["s"] for r in d.select("i", text.title_similarity("a", "b").alias("s")).orderBy("i").collect()]
    assert got[0] < 0.75 and got[1] > 0.8 and got[2:6] == [0.0, 0.0, 0.0, 1.0] and got[6] == 0.75
    assert text.ratio_at_most("ab", "abcdef") >= text.ratio("ab", "abcdef")


def test_years(values):
    assert values(["b. 1628?", "x17", "-0384"], years.year_of_actor) == [1628, None, 384]
    assert values(["in 882 or 1750", "2001", "x"], years.year_of_edition) == [882, None, None]
    assert values(["a/1750/b1999.csv", "31750"], years.years_of_path) == [["1750", "1999"], []]
    assert values(["1750", None], lambda c: years.in_years(c.cast("int"), 1700, None)) == [True, False]
    assert values([None], lambda c: years.in_years(c.cast("int"), None, None)) == [True]


def test_iris(values):
    assert values(["http://a.b/c", "http:///x", "ftp://a", "http://a b", None], iri.valid_iri) == [True, False, False, False, False]
    assert values(["<http://a/b>; bad; https://c/d#e"], iri.valid_iris) == [["http://a/b", "https://c/d#e"]]
    assert values(["a*b~c d/é"], iri.url_encoded) == ["a%2Ab~c%20d%2F%C3%A9"]
    assert values(["8.2711", "x"], lambda c: iri.wkt_point(c, F.lit("49.9929"))) == ["POINT(8.2711 49.9929)", None]
    assert values(["1750", "1750-01-02", "17XX"], iri.xsd_date_time) == ["1750-01-01T00:00:00", "1750-01-02T00:00:00", None]
    assert values(["0000 0001 2345"], lambda c: iri.authority_iri("isni", c)) == ["http://isni.org/isni/000000012345"]


def test_html_title():
    assert title_of('<meta property="og:title" content="A &amp; B"><h1>x</h1>') == "A & B"
    assert title_of("<title>t</title><h1> <b>H</b>\n1 </h1>") == "H 1"
    assert title_of("<title>t</title><h1> </h1>") == "t" and title_of(None) is None and title_of("") is None


def test_with_columns(spark):
    d = spark.createDataFrame([(1, "x")], "b int, C string")
    assert with_columns(d, ["a", "c"]).columns == ["a", "c", "b"]
