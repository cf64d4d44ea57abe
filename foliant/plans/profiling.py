"""Profiles, samples and damage."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliant.operators import integrity, profile, records, sampling
from foliant.plans import query, table


@query("SELECT o_orderpriority AS value, count(*) AS n FROM orders GROUP BY ALL")
def q_value_counts(spark, sf_dir):
    return profile.value_counts(table(spark, sf_dir, "orders"), "o_orderpriority")


@query("""
WITH l AS (SELECT unnest(['c_mktsegment','c_nationkey']) AS field, unnest([c_mktsegment, c_nationkey::VARCHAR]) AS value FROM customer),
c AS (SELECT field, value, count(*) AS n FROM l GROUP BY ALL),
t AS (SELECT field, sum(n)::BIGINT AS total, sum(n) FILTER (value IS NOT NULL)::BIGINT AS filled, count(value) AS distinct_values FROM c GROUP BY field),
r AS (SELECT *, row_number() OVER (PARTITION BY field ORDER BY n DESC, value) AS rank FROM c)
SELECT t.field, total, filled, distinct_values, round(filled / total, 4) AS fill_rate, rank, value, n FROM t JOIN r ON t.field = r.field WHERE rank <= 10
""")
def q_profile(spark, sf_dir):
    return profile.profile(table(spark, sf_dir, "customer"), ["c_mktsegment", "c_nationkey"])


@query("""
WITH l AS (SELECT o_custkey, unnest(['o_orderstatus','o_orderpriority']) AS field, unnest([o_orderstatus, o_orderpriority]) AS value FROM orders),
p AS (SELECT field, o_custkey, count(DISTINCT value) AS c FROM l GROUP BY ALL)
SELECT field, count(*) AS keys, round(avg(c), 4) AS mean_values FROM p GROUP BY field
""")
def q_field_cardinality(spark, sf_dir):
    return profile.field_cardinality(table(spark, sf_dir, "orders"), "o_custkey", ["o_orderstatus", "o_orderpriority"])


@query("SELECT c_mktsegment AS first, c_nationkey::VARCHAR AS second, count(*) AS n FROM customer GROUP BY ALL")
def q_grouped_counts(spark, sf_dir):
    return profile.grouped_counts(table(spark, sf_dir, "customer"), "c_mktsegment", "c_nationkey")


@query("""
WITH c AS (SELECT o_custkey, o_orderpriority AS value, count(*) AS n FROM orders GROUP BY o_custkey, o_orderpriority)
SELECT o_custkey, 'o_orderpriority' AS field, string_agg(value || '=' || n::VARCHAR, '; ' ORDER BY n DESC, value) AS "values" FROM c GROUP BY o_custkey HAVING sum(n) > 1
""")
def q_key_profiles(spark, sf_dir):
    return profile.key_profiles(table(spark, sf_dir, "orders"), "o_custkey", ["o_orderpriority"])


@query("SELECT count(*) AS files, round(avg(m), 6) AS mean FROM (SELECT source, avg(n_chars) AS m FROM documents GROUP BY source)")
def q_mean_of_means(spark, sf_dir):
    return profile.mean_of_means(table(spark, sf_dir, "documents"), "source", "n_chars")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus IS NOT NULL")
def q_subset_by_value(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").where((F.col("l_returnflag") == "R") & F.col("l_linestatus").isNotNull()).select("l_orderkey", "l_linenumber")


@query("""
WITH d AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS a, CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_orderpriority END AS b FROM orders),
g AS (SELECT *, (a IS NULL)::INT + (b IS NULL)::INT AS gaps FROM d),
h AS (SELECT gaps, sum(count(*)) OVER (ORDER BY gaps) AS have FROM g GROUP BY gaps),
m AS (SELECT coalesce(min(gaps) FILTER (have >= 6000), 2) AS most FROM h)
SELECT o_orderkey, a, b, gaps FROM g, m WHERE gaps <= most ORDER BY o_orderkey LIMIT 6000
""")
def q_best_rows(spark, sf_dir):
    k = F.col("o_orderkey")
    d = table(spark, sf_dir, "orders").select("o_orderkey", F.when(k % 3 != 0, F.col("o_orderstatus")).alias("a"), F.when(k % 2 != 0, F.col("o_orderpriority")).alias("b"))
    return sampling.fewest_gaps(d, ["a", "b"], 6000, "o_orderkey")


@query("""
WITH v AS (SELECT DISTINCT p_name AS value FROM part), r AS (SELECT value, row_number() OVER (ORDER BY lower(value), value) - 1 AS i, count(*) OVER () AS n FROM v)
SELECT value FROM r WHERE n <= 25 OR i IN (SELECT (k * n) // 25 FROM range(25) t(k))
""")
def q_sample_spaced(spark, sf_dir):
    return sampling.spaced_values(table(spark, sf_dir, "part"), "p_name", 25)


@query("SELECT o_custkey, o_orderkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IS NOT NULL) ORDER BY md5(o_custkey::VARCHAR || '|42'), o_custkey LIMIT 20)")
def q_sample_seeded(spark, sf_dir):
    return sampling.seeded_entities(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), "o_custkey", 20)


@query("""
WITH t AS (SELECT doc_id::VARCHAR AS k, CASE doc_id % 7 WHEN 0 THEN text || chr(65533) WHEN 1 THEN 'Ã©' || text WHEN 2 THEN '"x"@fr' WHEN 3 THEN text || chr(7) ELSE text END AS text FROM documents),
i AS (SELECT k, unnest(list_filter([CASE WHEN contains(text, chr(65533)) THEN 'replacement_char' END, CASE WHEN regexp_matches(text, '[ÃÂ][\\x{80}-¿€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]|â€[\\x{80}-¿€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]') THEN 'double_encoded' END,
   CASE WHEN regexp_matches(text, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f-\\x{9f}]') THEN 'control_char' END, CASE WHEN regexp_matches(text, '(?s)^\\s*"(.*)"(@[A-Za-z]{2,3}(-[A-Za-z0-9]+)*|\\^\\^<[^>]+>)\\s*$') THEN 'serialised_rdf_literal' END], lambda x: x IS NOT NULL)) AS issue FROM t)
SELECT 'text' AS column_name, issue, count(*) AS n, array_to_string(list_slice(list_sort(list(DISTINCT k)), 1, 3), '; ') AS examples FROM i GROUP BY issue
""")
def q_text_integrity(spark, sf_dir):
    k = F.col("doc_id") % 7
    t = F.when(k == 0, F.concat("text", F.lit("�"))).when(k == 1, F.concat(F.lit("Ã©"), "text")).when(k == 2, '"x"@fr').when(k == 3, F.concat("text", F.lit("\x07"))).otherwise(F.col("text"))
    return integrity.issue_counts(table(spark, sf_dir, "documents").select("doc_id", t.alias("text")), ["text"], "doc_id")


@query("SELECT event_type AS type, count(DISTINCT user_id) AS n FROM events GROUP BY ALL")
def q_record_types(spark, sf_dir):
    return records.type_counts(_types(spark, sf_dir), "types")


@query("SELECT n_types, count(*) AS rows FROM (SELECT user_id, count(DISTINCT event_type) AS n_types FROM events GROUP BY user_id) GROUP BY n_types")
def q_type_cardinality(spark, sf_dir):
    return records.type_cardinality(_types(spark, sf_dir), "types")


def _types(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("types"))


@query("""
SELECT count(DISTINCT w) AS works, count(DISTINCT l_orderkey) AS editions, count(DISTINCT CASE WHEN w IS NOT NULL THEN l_orderkey END) AS editions_linked,
       count(DISTINCT CASE WHEN w IS NOT NULL THEN l_suppkey END) AS expressions_linked
FROM (SELECT *, CASE WHEN l_partkey % 3 = 0 THEN l_partkey END AS w FROM lineitem)
""")
def q_link_summary(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").withColumn("w", F.when(F.col("l_partkey") % 3 == 0, F.col("l_partkey")))
    return records.link_summary(d, "w", "l_orderkey", "l_suppkey")


@query("SELECT n, count(*) AS keys FROM (SELECT l_orderkey, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1) GROUP BY n")
def q_one_to_many(spark, sf_dir):
    return records.one_to_many(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_suppkey")


@query("""
WITH t AS (SELECT DISTINCT l_orderkey, l_shipdate IS NOT NULL AS x, l_returnflag || l_linestatus AS v FROM lineitem)
SELECT a.v AS a, b.v AS b, count(*) AS n FROM t a JOIN t b ON a.l_orderkey = b.l_orderkey AND a.v < b.v GROUP BY ALL
""")
def q_cooccurrence(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set(F.concat("l_returnflag", "l_linestatus")).alias("v"))
    return records.co_occurring(d, "v")


@query("SELECT DISTINCT o_orderkey AS entity FROM orders WHERE o_orderkey % 4 = 0")
def q_without_type(spark, sf_dir):
    d = table(spark, sf_dir, "orders").select(F.array(F.col("o_orderkey")).alias("e"), F.when(F.col("o_orderkey") % 4 != 0, F.array("o_orderstatus")).alias("t"))
    return records.without_type(d, "t", "e")
