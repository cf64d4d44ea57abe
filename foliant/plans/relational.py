"""Firsts, overlays, roles and records of one entity."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliant.nulls import fold
from foliant.operators import firsts, overlay, roles, subset
from foliant.plans import query, table
from foliant.sources import increments


@query("SELECT o_custkey, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus, arg_min(o_orderpriority, o_orderkey) AS o_orderpriority, min(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey")
def q_first_row(spark, sf_dir):
    return firsts.first_row_by(table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority", "o_orderkey"), ["o_custkey"], "o_orderkey")


@query("SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus, max(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey")
def q_last_row(spark, sf_dir):
    return firsts.last_row_by(table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderkey"), ["o_custkey"], "o_orderkey")


@query("SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) FILTER (o_orderkey % 3 <> 0) AS priority, arg_min(o_orderstatus, o_orderkey) FILTER (o_orderkey % 2 = 0) AS status FROM orders GROUP BY o_custkey")
def q_first_filled(spark, sf_dir):
    k = F.col("o_orderkey")
    d = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.when(k % 3 != 0, F.col("o_orderpriority")).alias("priority"), F.when(k % 2 == 0, F.col("o_orderstatus")).alias("status"))
    return firsts.first_filled_by(d, ["o_custkey"], ["priority", "status"], "o_orderkey")


@query("""
SELECT c_nationkey, c_custkey, c_mktsegment, bal FROM (
  SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY (c_mktsegment IS NOT NULL)::INT + (bal IS NOT NULL)::INT DESC, c_custkey) AS r
  FROM (SELECT c_nationkey, c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS c_mktsegment, CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal END AS bal FROM customer)) WHERE r = 1
""")
def q_canonical_pick(spark, sf_dir):
    k = F.col("c_custkey")
    d = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", F.when(k % 3 != 0, F.col("c_mktsegment")).alias("c_mktsegment"), F.when(k % 4 != 0, F.col("c_acctbal")).alias("bal"))
    return firsts.richest_by(d, ["c_nationkey"], ["c_mktsegment", "bal"], "c_custkey")


@query("SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IN (SELECT c_nationkey FROM customer GROUP BY 1 HAVING count(*) > 1)")
def q_repeated_keys(spark, sf_dir):
    return firsts.repeated_keys(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), ["c_nationkey"])


@query("SELECT l_orderkey, string_agg(DISTINCT l_returnflag, '; ' ORDER BY l_returnflag) AS l_returnflag, string_agg(DISTINCT l_linestatus, '; ' ORDER BY l_linestatus) AS l_linestatus FROM lineitem GROUP BY l_orderkey")
def q_set_aggregate(spark, sf_dir):
    return subset.set_aggregate(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus"), "l_orderkey", ["l_returnflag", "l_linestatus"])


@query("SELECT l_orderkey, sum(n)::BIGINT AS rows, (sum(n) - count(*))::BIGINT AS duplicates FROM (SELECT l_orderkey, l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY l_orderkey")
def q_dup_rows(spark, sf_dir):
    return subset.exact_duplicates(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus"), "l_orderkey", ["l_returnflag", "l_linestatus"])


@query("""
WITH l AS (SELECT o_custkey, o_orderkey, unnest(['o_orderstatus','o_orderpriority']) AS field, unnest([o_orderstatus, o_orderpriority]) AS value FROM orders),
s AS (SELECT o_custkey, field, value, min(o_orderkey) AS seen_at FROM l GROUP BY ALL), f AS (SELECT o_custkey, field, min(seen_at) AS start FROM s GROUP BY ALL)
SELECT o_custkey, count(DISTINCT seen_at) AS merge_count, string_agg(DISTINCT field, '; ' ORDER BY field) AS varying FROM s JOIN f USING (o_custkey, field) WHERE seen_at > start GROUP BY o_custkey
""")
def q_variations(spark, sf_dir):
    return subset.variations(table(spark, sf_dir, "orders"), "o_custkey", ["o_orderstatus", "o_orderpriority"], "o_orderkey")


@query("""
SELECT seg, string_agg(DISTINCT c_nationkey::VARCHAR, ', ' ORDER BY c_nationkey::VARCHAR) AS nations FROM (SELECT CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS seg, c_nationkey FROM customer) GROUP BY seg
""")
def q_dedup_by_field(spark, sf_dir):
    d = table(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")).alias("seg"), F.col("c_nationkey").cast("string").alias("nations"))
    return subset.dedup_by_field(d, "seg")


@query("""
WITH d AS (SELECT CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment || '; ' || c_name END AS a FROM customer)
SELECT 'a' AS field, count(a) AS filled, round(count(a) / count(*) * 100, 4) AS fill_percent, round(count(a) * 2 / count(*), 4) AS items_per_record FROM d
""")
def q_field_statistics(spark, sf_dir):
    d = table(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 4 != 0, F.concat("c_mktsegment", F.lit("; "), "c_name")).alias("a"))
    return subset.field_statistics(d, ["a"])


def edges(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("edition"), F.col("l_suppkey").alias("author"), F.when(F.col("l_linenumber") > 3, F.col("l_partkey") % 100).alias("editor"))  # noqa: E741
    known = table(spark, sf_dir, "supplier").where("s_suppkey % 7 != 0").select(F.col("s_suppkey").alias("actor"))
    return roles.role_edges(l, {"author": "author", "editor": "editor"}, actors=known)


EDGES = """
WITH e AS (SELECT l_suppkey::VARCHAR AS actor, 'author' AS role, l_orderkey::VARCHAR AS edition FROM lineitem UNION ALL
           SELECT (l_partkey % 100)::VARCHAR, 'editor', l_orderkey::VARCHAR FROM lineitem WHERE l_linenumber > 3),
k AS (SELECT e.* FROM e WHERE actor IN (SELECT s_suppkey::VARCHAR FROM supplier WHERE s_suppkey % 7 <> 0)),
g AS (SELECT actor, role, string_agg(DISTINCT edition, ',' ORDER BY edition) AS ids FROM k GROUP BY ALL)
"""


@query(EDGES + "SELECT actor, string_agg(role || ':' || ids, ';' ORDER BY role) AS role_edition_map, string_agg(role, '; ' ORDER BY role) AS roles FROM g GROUP BY actor")
def q_role_map(spark, sf_dir):
    m = roles.role_map(edges(spark, sf_dir))
    return m.select("actor", roles.encode_role_map("role_edition_map").alias("role_edition_map"), F.array_join("roles", "; ").alias("roles"))


@query(EDGES + ", i AS (SELECT DISTINCT actor, role, edition FROM k) SELECT actor, role, count(*) AS editions, count(*) FILTER (edition::BIGINT % 2 = 0) AS resolved FROM i GROUP BY ALL")
def q_role_parse(spark, sf_dir):
    parsed = roles.parse_role_map(q_role_map(spark, sf_dir), "actor", "role_edition_map")
    known = table(spark, sf_dir, "orders").where("o_orderkey % 2 = 0").select(F.col("o_orderkey").cast("string").alias("edition_id"), F.lit(1).alias("edition_iri"))
    found, lost = roles.resolve_editions(parsed, known)
    every = found.select("actor", "role", F.lit(1).alias("ok")).unionByName(lost.select("actor", "role", F.lit(0).alias("ok")))
    return every.groupBy("actor", "role").agg(F.count("*").alias("editions"), F.sum("ok").alias("resolved"))


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'filled' WHEN c_custkey % 3 = 1 AND c_custkey % 2 = 0 THEN 'changed' ELSE c_mktsegment END AS seg FROM customer
""")
def q_overlay_fill(spark, sf_dir):
    k = F.col("c_custkey")
    d = table(spark, sf_dir, "customer").select("c_custkey", F.when(k % 3 != 0, F.col("c_mktsegment")).alias("seg"))
    o = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when((k % 3 == 1) & (k % 2 == 0), F.col("c_mktsegment")).otherwise("other").alias("original"),
        F.when(k % 3 == 0, "filled").otherwise("changed").alias("harmonised"), F.when(k % 3 == 2, "alias_split").otherwise("derived_from_first_last").alias("correction_type"),
    )
    return overlay.fill_or_replace(d, "c_custkey", "seg", o)


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'n' || c_custkey::VARCHAR ELSE c_name END AS c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN 'B' ELSE c_mktsegment END AS c_mktsegment FROM customer
""")
def q_overlay_replace(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    by_field = c.where("c_custkey % 2 = 0").select("c_custkey", F.lit("c_name").alias("field"), F.concat(F.lit("n"), F.col("c_custkey").cast("string")).alias("harmonised"))
    by_value = c.select("c_custkey", F.lit("c_mktsegment").alias("field"), F.lit("BUILDING").alias("original"), F.lit("B").alias("harmonised"))
    return overlay.replace_by_value(overlay.replace_by_field(c, "c_custkey", ["c_name"], by_field), "c_custkey", ["c_mktsegment"], by_value)


@query("""
SELECT n_nationkey, CASE WHEN n_nationkey % 5 = 0 THEN 'over' WHEN n_nationkey % 2 = 0 AND n_nationkey < 20 THEN 'plan' ELSE n_name END AS n_name,
       n_nationkey % 5 = 0 OR (n_nationkey % 2 = 0 AND n_nationkey < 20) AS changed FROM nation
""")
def q_patch_table(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    plan = n.where("n_nationkey % 2 = 0").select("n_nationkey", F.when(F.col("n_nationkey") < 20, F.col("n_regionkey")).otherwise(-1).alias("old_n_regionkey"), F.lit("plan").alias("new_n_name"))
    over = n.where("n_nationkey % 5 = 0").select("n_nationkey", F.lit("over").alias("new_n_name"))
    return overlay.patch_table(n, ["n_nationkey"], plan, over, ["n_name"], ["n_regionkey"]).drop("n_regionkey")


@query("SELECT y::INTEGER AS year FROM range(1985, 2006) t(y) WHERE y NOT IN (SELECT DISTINCT year(o_orderdate) FROM orders)")
def q_gap_detection(spark, sf_dir):
    return increments.missing_years(spark, table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("y")), "y", 1985, 2005)


@query("""
WITH dim AS (SELECT s_suppkey AS k, s_suppkey AS idx FROM supplier WHERE s_suppkey < 20),
new AS (SELECT l_suppkey AS k, min(l_orderkey) AS f FROM lineitem WHERE l_suppkey NOT IN (SELECT k FROM dim) GROUP BY 1)
SELECT k, ((SELECT max(idx) FROM dim) + row_number() OVER (ORDER BY f, k))::BIGINT AS idx FROM new
""")
def q_dimension_sync(spark, sf_dir):
    dim = table(spark, sf_dir, "supplier").where("s_suppkey < 20").select(F.col("s_suppkey").alias("k"), F.col("s_suppkey").alias("idx"))
    return increments.appended(dim, table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("k"), "l_orderkey"), "k", "l_orderkey")


@query("SELECT DISTINCT trim(a) AS actor FROM (SELECT c_mktsegment AS a FROM customer UNION ALL SELECT c_nationkey::VARCHAR || ' ' FROM customer)")
def q_distinct_actors(spark, sf_dir):
    d = table(spark, sf_dir, "customer").select("c_mktsegment", F.concat(F.col("c_nationkey").cast("string"), F.lit(" ")).alias("n"))
    return increments.distinct_actors(d, ["c_mktsegment", "n"]).select(fold("actor", "strip").alias("actor"))
