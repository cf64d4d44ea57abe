from __future__ import annotations

import io
import zipfile

from pyspark.sql import functions as F

from foliant.graph import mapping, ntriples, prepare, shapes
from foliant.sources import increments, readers, writers
from foliant.streaming import resume


def test_csv_round_trip(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,v\n1,"x ""y"" z"\n2,"two\nlines"\n', encoding="utf-8")
    d = readers.read_csv(spark, str(tmp_path / "a.csv"), ["k", "v", "w"])
    assert [(r["k"], r["v"], r["w"]) for r in d.orderBy("_row_id").collect()] == [("1", 'x "y" z', None), ("2", "two\nlines", None)]
    writers.write_csv(d, str(tmp_path / "out"), ["v", "k"], quote_all=True)
    again = readers.read_csv(spark, str(tmp_path / "out"))
    assert sorted(r["v"] for r in again.collect()) == ["two\nlines", 'x "y" z']


def test_sniff(spark, tmp_path):
    (tmp_path / "b.csv").write_bytes("a;é;c\n1;2;3\n".encode("latin-1"))
    assert readers.sniff(spark, str(tmp_path / "b.csv")) == (";", "ISO-8859-1")


def test_archives(spark, tmp_path):
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("deep/1750.csv", "edition,place\ne3,Lyon\n")
    with zipfile.ZipFile(tmp_path / "x.zip", "w") as z:
        z.writestr("1749/a.csv", 'edition,title\ne1,"T ""1"""\ne2,\n')
        z.writestr("readme.txt", "x")
        z.writestr("nested.zip", inner.getvalue())
        z.writestr("empty.csv", "")
    a = readers.read_archives(spark, str(tmp_path / "x.zip"))
    t = readers.archive_table(a, ["edition", "title", "place"])
    assert sorted((r["edition"], r["title"], r["place"]) for r in t.fillna("").collect()) == [("e1", 'T "1"', ""), ("e2", "", ""), ("e3", "", "Lyon")]
    assert {r["extension"]: r["files"] for r in readers.archive_tree(a).collect()} == {"csv": 3, "txt": 1}
    assert readers.in_years(t, "__internal_csv_path", [1750]).count() == 1


def test_damaged_lines(spark, tmp_path):
    (tmp_path / "c.txt").write_bytes(b"good\nb\xffd\n")
    assert [r["valid_utf8"] for r in readers.text_lines(spark, str(tmp_path / "c.txt")).orderBy(F.desc("value")).collect()].count(False) == 1


def test_increments(spark):
    have = spark.createDataFrame([(1700,), (1702,)], "y int")
    assert [r["year"] for r in increments.missing_years(spark, have, "y", 1700, 1703).orderBy("year").collect()] == [1701, 1703]
    assert increments.start_year(have, "y", 1600) == 1702
    log = spark.createDataFrame([("failed: a1",), ("ok",), ("failed: a2",)], "value string")
    assert [r["key"] for r in increments.failed_in_log(log, r"failed: (\S+)", spark.createDataFrame([("a1",)], "key string")).collect()] == ["a2"]


def test_resumable_append(spark, tmp_path):
    todo = spark.createDataFrame([(1,), (2,)], "k int")
    first = resume.append_new(spark, todo, "k", str(tmp_path / "t"), lambda d: d.withColumn("v", F.lit(1)))
    assert first.count() == 2
    more = spark.createDataFrame([(2,), (3,)], "k int")
    assert resume.append_new(spark, more, "k", str(tmp_path / "t"), lambda d: d.withColumn("v", F.lit(2))).orderBy("k").collect()[-1]["v"] == 2
    todo.write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        resume.follow(spark, str(tmp_path / "in"), "k int", "k", str(tmp_path / "s"), str(tmp_path / "cp"), lambda d: d).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "s")).count() == 2


def test_rule_counts_and_roles(spark):
    assert sum(len(r.predicates) for r in mapping.actor_rules()) == 68
    assert sum(len(r.predicates) for r in mapping.edition_rules()) == 77
    assert sum(len(r.predicates) for r in mapping.role_rules()) == 6
    e = spark.createDataFrame([("http://a/1", "http://e/1#x", "author"), ("http://a/2", "http://e/1#x", "author")], "actor_iri string, edition_iri string, role string")
    r = prepare.roles(e)
    assert r.count() == 2 and r.select("role_activity_iri").distinct().count() == 1
    assert mapping.as_graph(mapping.triples({"roles": r}, mapping.role_rules())).count() == 7


def test_only_organisations_have_start_events(spark):
    d = spark.createDataFrame([("<http://a/1>", "http://xmlns.com/foaf/0.1/Person", "1800"), ("<http://a/2>", "http://xmlns.com/foaf/0.1/Organization", "1800"), ("bad", None, None)], "actor string, entity_type string, actor_start string")
    got = {r["actor"]: r["actor_start_obj"] for r in prepare.actors(d).collect()}
    assert got == {"http://a/1": None, "http://a/2": "1800-01-01T00:00:00"}


def test_ntriples(spark):
    t = spark.createDataFrame([("http://s", "http://p", 'a "b"\n\\c', "literal", None), ("http://s", "http://p", "1750", "literal", "http://id.loc.gov/datatypes/edtf/EDTF"), ("http://s", "http://p", "http://o", "iri", None)], "s string, p string, o string, kind string, datatype string")
    lines = ntriples.lines(t)
    assert lines.where(~ntriples.valid("value")).count() == 0
    assert sorted(r["o"] for r in ntriples.parse(lines).collect()) == sorted(r["o"] for r in t.collect())
    bad = spark.createDataFrame([("<a b> <p> <o> .",), ("<s> <p> o .",), ("# note",), ("",)], "value string")
    assert ntriples.bad_lines(bad).count() == 2


def test_shapes(spark):
    found = shapes.from_prose("obj:X", "has exactly one crm:P1 and at most two alias:p.", {"alias:p": "crm:P2"})
    assert [(s.path, s.least, s.most) for s in found] == [("crm:P1", 1, 1), ("crm:P2", 0, 2)]
