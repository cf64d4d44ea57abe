from __future__ import annotations

from foliant.functions import names
from foliant.link import tables
from foliant.sources import writers


def test_authors_of_foreign_records(spark):
    core = spark.createDataFrame([("t1", "A"), ("t2", "B")], "estc_id string, title string")
    links = spark.createDataFrame([("t1", "p2", "TRUE", 1), ("t1", "p1", "true", 2), ("t1", "p2", "TRUE", 3), ("t2", "p1", "FALSE", 4)], "estc_id string, actor_id string, is_author string, _row_id long")
    people = spark.createDataFrame([("p1", "old", 1), ("p1", "One", 2), ("p2", "Two", 3)], "actor_id string, name string, _row_id long")
    got = {r["estc_id"]: (r["author_ids"], r["authors"]) for r in tables.with_authors(core, links, people).collect()}
    assert got == {"t1": (["p2", "p1"], ["Two", "One"]), "t2": ([], [])}


def test_single_table(spark):
    d = spark.createDataFrame([("1", "T", "NA", None, "c. 1750")], "estc_id string, short_title string, author string, pub_year string, pub_date string")
    assert tables.guess_columns(d.columns)["title"] == "short_title"
    r = tables.single_table(d).first()
    assert (r["id"], r["title"], r["author"], r["year"], r["place"]) == ("1", "T", None, 1750, None)


def test_edition_authors(spark):
    actors = spark.createDataFrame([("<http://a/1>", None, "Ann", "Lee", 1), ("<http://a/1>", "Ann L.", None, None, 2), ("<http://a/1>", "NA", None, None, 3)], "actor string, actor_name string, actor_first_name string, actor_last_name string, _row_id long")
    n = tables.display_names(actors)
    e = spark.createDataFrame([("e1", "<http://a/1>; <http://a/2>", "Bare"), ("e2", "none", "NA")], "edition string, author string, author_name string")
    assert sorted((r["edition"], r["iri"], r["name"] or "") for r in tables.edition_authors(e, n).collect()) == [("e1", "", "Bare"), ("e1", "http://a/1", "Ann L."), ("e1", "http://a/2", "")]


def test_canonical_and_inherited(spark):
    m = spark.createDataFrame([("b", "a"), ("c", "a")], "actor string, canonical_actor string")
    d = spark.createDataFrame([("b",), ("z",)], "x string")
    assert sorted(r["x"] for r in tables.canonical(d, "x", m).collect()) == ["a", "z"]
    known = spark.createDataFrame([("a", "o1"), ("c", "o2")], "actor string, other_actor string")
    assert sorted(map(tuple, tables.inherit(known, m).collect())) == [("a", "o1"), ("b", "o1"), ("c", "o2")]


def test_names_and_writers(spark, values, tmp_path):
    assert values(["Ann Lee", "Anonyme", "x1", "A", None], names.plausible_name) == [True, False, False, False, False]
    assert [names.name_category(c) for c in ("actor_first_name", "Surname", "nom", "year")] == ["first", "last", "name", None]
    assert writers.stamped("a b", ".csv", "20250101", year="17/50") == "a_b_year-17_50_20250101.csv"
    path = str(tmp_path / "t")
    for n in (3, 5):
        writers.replace_table(spark.range(n).toDF("i"), path)
    assert spark.read.parquet(path).count() == 5
