from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from foliant.functions import text as link_text
from foliant.link import actors as link_actors
from foliant.link import editions as link_editions
from foliant.link import gazetteer
from foliant.operators import cluster, components, dedup, distinct, firsts, integrity, overlay, records, roles, sampling, subset


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_firsts(spark):
    d = spark.createDataFrame([("a", 2, "x"), ("a", 1, None), ("b", 3, "y"), (None, 0, "z")], "k string, _row_id long, v string")
    assert rows(firsts.first_row_by(d, ["k"]), "k") == [("a", 1, None), ("b", 3, "y")]
    assert rows(firsts.last_row_by(d, ["k"]), "k") == [("a", 2, "x"), ("b", 3, "y")]
    assert rows(firsts.first_filled_by(d, ["k"], ["v"]), "k") == [("a", "x"), ("b", "y")]


def test_components_against_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(5, 5), (None, 3)]
    parent: dict[int, int] = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = dict(rows(components.connected(spark.createDataFrame(edges, "a long, b long")), "node"))
    assert got == {x: find(x) for x in parent}
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_on_distinct_keeps_nulls_and_repeats(spark):
    d = spark.createDataFrame([("a",), ("a",), (None,)], "v string")
    assert rows(distinct.on_distinct(d, ["v"], {"u": F.upper}), "v") == [(None, None), ("a", "A"), ("a", "A")]


def test_overlays(spark):
    d = spark.createDataFrame([(1, None, "p"), (2, "old", "q"), (3, "kept", "q")], "k int, n string, l string")
    o = spark.createDataFrame([(1, None, "new", "derived_from_first_last"), (2, "old", "new", "stripped_rdf_literal_tag"), (3, "other", "new", "stripped_rdf_literal_tag")], "k int, original string, harmonised string, correction_type string")
    assert rows(overlay.fill_or_replace(d, "k", "n", o), "k") == [(1, "new", "p"), (2, "new", "q"), (3, "kept", "q")]
    v = spark.createDataFrame([(2, "l", "q", "Q"), (3, "l", "zzz", "Q")], "k int, field string, original string, harmonised string")
    assert [r[2] for r in rows(overlay.replace_by_value(d, "k", ["l"], v), "k")] == ["p", "Q", "q"]


def test_roles(spark):
    e = spark.createDataFrame([("e1", "a", "b"), ("e2", "a", None), ("e1", "a", "NA")], "edition string, author string, editor string")
    known = spark.createDataFrame([("a",)], "actor string")
    m = roles.role_map(roles.role_edges(e, {"author": "author", "editor": "editor"}, actors=known))
    assert rows(m.select("actor", roles.encode_role_map("role_edition_map")), "actor") == [("a", "author:e1,e2")]
    cell = spark.createDataFrame([("x", "author:31015462;editor:999;bad")], "actor string, m string")
    parsed = roles.parse_role_map(cell, "actor", "m")
    found, lost = roles.resolve_editions(parsed, spark.createDataFrame([("31015462", "iri")], "edition_id string, edition_iri string"))
    assert found.count() == 1 and rows(lost, "role") == [("999", "x", "editor")]


def test_subset(spark):
    d = spark.createDataFrame([("A1", "l1", 1), ("A1", "l2", 2), ("A2", None, 3), ("A1", "l1", 4)], "k string, v string, _row_id long")
    assert rows(subset.set_aggregate(d, "k", ["v"]), "k") == [("A1", "l1; l2"), ("A2", None)]
    assert rows(subset.variations(d, "k", ["v"]), "k") == [("A1", 1, "v")]
    e = spark.createDataFrame([(None, "x"), (None, "y"), ("k", "z")], "f string, v string")
    assert rows(subset.dedup_by_field(e, "f"), "f") == [(None, "x, y"), ("k", "z")]


def test_sampling(spark):
    d = spark.createDataFrame([(i, None if i % 2 else "x", None if i % 3 else "y") for i in range(20)], "i int, a string, b string")
    assert [r[0] for r in rows(sampling.fewest_gaps(d, ["a", "b"], 4, "i"), "i")] == [0, 6, 12, 18]
    assert sampling.fewest_gaps(d, ["a", "b"], 5, "i").where("gaps > 1").count() == 0
    got = [r["value"] for r in sampling.spaced_values(spark.createDataFrame([(c,) for c in "ABCDefghij"], "v string"), "v", 4).collect()]
    assert got == ["A", "C", "f", "h"]
    assert sampling.seeded(d, "i", 5).count() == 5 and rows(sampling.seeded(d, "i", 5), "i") == rows(sampling.seeded(d, "i", 5), "i")


def test_integrity(values):
    raw = ["ok", "a�b", "Ã©", "â€™", "x\x07", '"France"@fr', '"1"^^<http://t>', None, ""]
    want = [[], ["replacement_char"], ["double_encoded"], ["double_encoded"], ["control_char"], ["serialised_rdf_literal"], ["serialised_rdf_literal"], [], []]
    assert values(raw, lambda c: integrity.issues(c)) == want
    assert values(["a�b"], lambda c: integrity.issues(c, F.lit(False))) == [["invalid_utf8"]]
    assert values(['"France"@fr', "x"], integrity.unwrap_literal) == ["France", "x"]


def test_records(spark):
    d = spark.createDataFrame([("e1", ["Text", "Map"], 1), ("e2", ["Text"], 2), ("e2", ["Map"], 3), ("e3", [], 4)], "k string, t array<string>, _row_id long")
    assert [r[0] for r in rows(records.only_types(d, "k", "t", ["Text"]), "_row_id")] == ["e2", "e2"]
    assert rows(records.co_occurring(d, "t"), "a") == [("Map", "Text", 1)]


def test_clusters(spark):
    v = spark.createDataFrame([("b", "Didot", "didot", 2), ("c", "DIDOT", "didot", 2), ("d", "Other", "other", 1), ("e", "x", None, 1)], "raw string, harmonised string, key string, n long")
    assert {r["raw"]: r["canonical"] for r in cluster.by_key(v).collect()} == {"b": "DIDOT", "c": "DIDOT", "d": "Other", "e": "x"}
    k = spark.createDataFrame([("imprimerie royale", 5), ("imprimerie royalle", 1), ("imprimerie roiale", 5), ("zzz", 1)], "key string, n long")
    got = dict(rows(cluster.by_similarity(k), "key"))
    assert got == {"imprimerie royale": "imprimerie royale", "imprimerie royalle": "imprimerie royale", "imprimerie roiale": "imprimerie royale", "zzz": "zzz"}
    assert dict(rows(cluster.by_similarity(k, largest=2), "key"))["imprimerie royalle"] == "imprimerie royalle"


def test_actor_dedup(spark):
    d = spark.createDataFrame(
        [("a", "N", ["l1"], "1700", "1750", None), ("b", "N", ["l1"], None, None, "x"), ("c", "N", [], "1700", "1750", None), ("d", "N", [], None, None, None), ("e", "M", ["l1"], None, None, None)],
        "actor string, name string, links array<string>, birth string, death string, extra string",
    )
    got = {r["actor"]: (r["canonical_actor"], r["match_type"], r["confidence"]) for r in dedup.same_persons(d, ["birth", "death", "extra"]).collect()}
    both = "matching_dates+shared_external_link"
    assert got == {"a": ("a", both, "high"), "b": ("a", both, "high"), "c": ("a", both, "high"), "d": ("d", "ambiguous_name_only", "low")}
    assert all(r["confidence"] == "low" for r in dedup.same_persons(d, ["birth"], largest=3).collect())


def test_dates_compatible_is_three_valued(spark):
    d = spark.createDataFrame([(1700, None, 1701, None), (1700, 1750, 1700, 1760), (None, None, 1700, 1750), (1700, None, None, 1750)], "a int, b int, c int, d int")
    ok = link_actors.dates_compatible(F.col("a"), F.col("b"), F.col("c"), F.col("d"), 2)
    assert [r[0] for r in d.select(ok).collect()] == [True, False, None, None]


def test_resolve_near_ties(spark):
    d = spark.createDataFrame(
        [(1, 1750, "x", 1751, 0.90, "k"), (1, 1750, "y", 1750, 0.89, "k"), (2, 1750, "x", 1750, 0.9, "k"), (2, 1750, "y", 1750, 0.9, "k"), (3, None, "z", 1700, 0.8, "k")],
        "edition int, year int, other_id string, other_year int, score double, kind string",
    )
    got = rows(link_editions.resolve(d).select("edition", "other_id", "match_type"), "edition")
    assert got == [(1, "y", "k"), (2, "x", "ambiguous_k"), (3, "z", "k")]


def test_match_against_all_pairs(spark, monkeypatch):
    """Copies, titles without a telling word, empty ones, several names and authors; copies are never paired one by one."""
    rng = random.Random(5)
    titles = ["Voyage autour du monde", "Voyages autour du monde", "Le monde entier", "Of an 12", "of an 13", "", None, "Histoire de la terre et du ciel en neuf livres nouveaux", "Histoire de la terre"]
    people = ["Jean Dupont", "Dupont, Jean", "Jeanne Dupond", "Ann Smith", "Li"]
    mine = [(i, rng.choice(titles), rng.choice([None, *range(1700, 1706)]), rng.random() < 0.8) for i in range(60)] + [(i, titles[0], 1700, True) for i in range(100, 160)]
    theirs = [(i, rng.choice(titles), rng.choice([None, *range(1700, 1706)])) for i in range(60)] + [(i, titles[0], 1700) for i in range(100, 160)]
    named = {i: [people[0]] if i >= 100 else rng.sample(people, rng.randrange(3)) for i, *_ in mine}
    other_named = {i: [people[1]] if i >= 100 else rng.sample(people, rng.randrange(3)) for i, *_ in theirs}
    acts = [(i, a) for i, *_ in mine if i < 100 for a in rng.sample(range(4), rng.randrange(3))]
    other_acts = [(i, a) for i, *_ in theirs if i < 100 for a in rng.sample(range(4), rng.randrange(3))]
    flat = lambda d: [(i, n) for i, ns in d.items() for n in ns]
    e = spark.createDataFrame(mine, "edition long, title string, year int, scope boolean")
    o = spark.createDataFrame(theirs, "other_id long, other_title string, other_year int")
    au, oau = spark.createDataFrame(acts, "edition long, actor long"), spark.createDataFrame(other_acts, "other_id long, other_actor long")
    known = spark.createDataFrame([(i, i) for i in range(4)], "actor long, other_actor long")
    names = spark.createDataFrame(flat(named), "edition long, raw string").select("edition", link_text.folded("raw").alias("name"))
    others = spark.createDataFrame(flat(other_named), "other_id long, raw string").select("other_id", link_text.folded("raw").alias("other_name"))
    names, others = names.withColumn("tokens", link_editions.name_tokens("name")), others.withColumn("other_tokens", link_editions.name_tokens("other_name"))

    near = e.join(o, F.abs(e["year"] - o["other_year"]) <= 2)
    near = near.withColumn("ts", link_text.title_similarity(link_text.folded_words("title"), link_text.folded_words("other_title"))).where("ts >= 0.75")
    linked = au.withColumnRenamed("actor", "other_actor").join(oau, "other_actor").select("edition", "other_id").distinct()
    bridge = near.join(linked, ["edition", "other_id"]).select("edition", "year", "other_id", "other_year", ((1 + F.col("ts")) / 2).alias("score"), F.lit("actor_bridge").alias("kind"))
    pairs = names.join(others, F.lit(True)).withColumn("au", link_text.similarity(link_text.author_key("name"), link_text.author_key("other_name")))
    pairs = pairs.groupBy("edition", "other_id").agg(F.max("au").alias("au"), F.max(F.arrays_overlap("tokens", "other_tokens")).alias("word")).where("au >= 0.8 AND word")
    second = near.join(pairs, ["edition", "other_id"]).select("edition", "year", "other_id", "other_year", ((F.col("au") + F.col("ts")) / 2).alias("score"), F.lit("heuristic").alias("kind"))
    want = rows(link_editions.cascade(e, "scope", bridge, second), "edition")

    staged = []
    monkeypatch.setattr(link_editions, "stage", lambda df, made=link_editions.stage: staged.append(out := made(df)) or out)
    assert rows(link_editions.match(e, "scope", au, known, names, o, oau, others), "edition") == want
    assert len({r[3] for r in want}) >= 5 and max(s.count() for s in staged) < 60 * 60


def test_gazetteer_flags(spark):
    t = spark.createDataFrame([("1", "Paris", "France", "2.3", "48.8"), ("9", "X", "Y", "0", "0")], "tgn_id string, publication_place string, publication_country string, longitude string, latitude string")
    g = spark.createDataFrame([("1", "Paris", "France", 2.3, 48.8), ("2", "paris", "United States", -95.5, 33.6)], "tgn_id string, label string, country string, longitude double, latitude double")
    got = {r["tgn_id"]: r for r in gazetteer.verify(t, g).collect()}
    assert not got["1"]["far_off"] and got["1"]["homonyms"] == 1 and got["9"]["id_unknown"]


@pytest.mark.parametrize("margin", [0.0, 0.02])
def test_resolve_empty(spark, margin):
    d = spark.createDataFrame([], "edition int, year int, other_id string, other_year int, score double, kind string")
    assert link_editions.resolve(d, margin).count() == 0
