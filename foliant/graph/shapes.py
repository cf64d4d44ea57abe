"""Shape constraints checked as aggregates over triples."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.graph.mapping import PREFIXES, TYPE, expand


@dataclass(frozen=True)
class Shape:
    """Of nodes of a class: how often a property may stand, and what its values are (iri, literal, a datatype, a class)."""

    target: str
    path: str
    least: int = 0
    most: int | None = None
    kind: str | None = None
    datatype: str | None = None
    node: str | None = None


COUNTS = re.compile(r"(exactly|at least|at most)\s+(one|two|three|\d+)\s+(\S+)", re.I)
NUMBERS = {"one": 1, "two": 2, "three": 3}


def from_prose(target: str, text: str, aliases: dict[str, str] | None = None) -> list[Shape]:
    """Shapes from sentences such as "has exactly one crm:P102_has_title" (exactly, at least, at most); aliases rename properties."""
    out = []
    for how, n, path in COUNTS.findall(text):
        n = NUMBERS.get(n.lower()) or int(n)
        path = path.rstrip(".,;")
        path = (aliases or {}).get(path, path)
        low, high = {"exactly": (n, n), "at least": (n, None), "at most": (0, n)}[how.lower()]
        out.append(Shape(target, path, low, high))
    return out


def violations(t: DataFrame, shapes: list[Shape], prefixes: dict[str, str] | None = None) -> DataFrame:
    """target, path, constraint, node, found: one row per node that breaks a constraint.

    The shapes are one small table; nodes and their values meet it in two equi-joins, however many shapes there are.
    """
    names = PREFIXES | (prefixes or {})
    spark = t.sparkSession
    rows = [(i, expand(s.target, names), expand(s.path, names), s.least, s.most, s.kind, expand(s.datatype, names) if s.datatype else None, expand(s.node, names) if s.node else None) for i, s in enumerate(shapes)]
    table = spark.createDataFrame(rows, "shape int, target string, path string, least long, most long, want_kind string, want_type string, want_node string")
    typed = t.where(F.col("p") == expand(TYPE, names)).select(F.col("s").alias("node"), F.col("o").alias("target")).distinct()
    nodes = typed.join(F.broadcast(table), "target")
    values = t.select(F.col("s").alias("node"), F.col("p").alias("path"), "o", "kind", "datatype")
    classes = typed.select(F.col("node").alias("value"), F.col("target").alias("o_class"))
    j = nodes.join(values, ["node", "path"], "left").join(classes, (F.col("want_node") == F.col("o_class")) & (F.col("o") == F.col("value")), "left")
    bad = lambda c: F.count_if(F.col("o").isNotNull() & F.coalesce(c, F.lit(False)))
    per = j.groupBy("shape", "target", "path", "least", "most", "node").agg(
        F.count("o").alias("n"), bad(F.col("want_kind") != F.col("kind")).alias("bad_kind"),
        bad(F.col("want_type").isNotNull() & ~F.col("datatype").eqNullSafe(F.col("want_type"))).alias("bad_type"),
        bad(F.col("want_node").isNotNull() & F.col("o_class").isNull()).alias("bad_node"),
    )
    cases = F.array_compact(
        F.array(
            F.when(F.col("n") < F.col("least"), F.struct(F.lit("minCount").alias("constraint"), F.col("n").alias("found"))),
            F.when(F.col("n") > F.col("most"), F.struct(F.lit("maxCount").alias("constraint"), F.col("n").alias("found"))),
            F.when(F.col("bad_kind") > 0, F.struct(F.lit("nodeKind").alias("constraint"), F.col("bad_kind").alias("found"))),
            F.when(F.col("bad_type") > 0, F.struct(F.lit("datatype").alias("constraint"), F.col("bad_type").alias("found"))),
            F.when(F.col("bad_node") > 0, F.struct(F.lit("node").alias("constraint"), F.col("bad_node").alias("found"))),
        )
    )
    return per.select("target", "path", "node", F.inline(cases)).select("target", "path", "constraint", "node", "found")


def families(v: DataFrame) -> DataFrame:
    """family (16 digits of a SHA-256), target, path, constraint, n, example: violations of one kind together."""
    per = v.groupBy("target", "path", "constraint").agg(F.count("*").alias("n"), F.min("node").alias("example"))
    return per.withColumn("family", F.substring(F.sha2(F.concat_ws("|", "target", "path", "constraint"), 256), 1, 16))


def coverage(t: DataFrame, shapes: list[Shape], prefixes: dict[str, str] | None = None) -> DataFrame:
    """class, n, covered: instances per class, and whether a shape targets it."""
    names = PREFIXES | (prefixes or {})
    targets = sorted({expand(s.target, names) for s in shapes})
    per = t.where(F.col("p") == expand(TYPE, names)).groupBy(F.col("o").alias("class")).agg(F.count_distinct("s").alias("n"))
    return per.withColumn("covered", F.col("class").isin(*targets) if targets else F.lit(False))
