"""Overlays, enrichment, scopes, catalogues of columns, and the property blocks of the portal."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliant.graph import mapping, portal, prepare, shapes
from foliant.link import editions, tables
from foliant.operators import overlay, profile, records, subset
from foliant.plans import query, table
from foliant.plans.graph import STEM, people

SCHEMA = "https://example.org/schema/"


@query("""
SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 THEN 'place ' || c_nationkey::VARCHAR END AS place, CASE WHEN c_custkey % 4 = 1 THEN lower(c_mktsegment) END AS publisher FROM customer
""")
def q_overlay_columns(spark, sf_dir):
    k, c = F.col("c_custkey"), table(spark, sf_dir, "customer")
    place = c.where(k % 3 == 0).select("c_custkey", F.concat(F.lit("place "), F.col("c_nationkey").cast("string")).alias("place"))
    publisher = c.where(k % 4 == 1).select("c_custkey", F.lower("c_mktsegment").alias("publisher"))
    return overlay.overlay_columns(c.select("c_custkey", "c_name"), "c_custkey", place, publisher)


@query("""
WITH s AS (SELECT o_custkey, min('Q' || o_orderkey::VARCHAR) AS v FROM orders GROUP BY 1)
SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'Q' || c_custkey::VARCHAR ELSE v END AS qid FROM customer LEFT JOIN s ON c_custkey = o_custkey
""")
def q_id_fallback(spark, sf_dir):
    k = F.col("c_custkey")
    mine = table(spark, sf_dir, "customer").select("c_custkey", F.when(k % 5 == 0, F.concat(F.lit("Q"), k.cast("string"))).alias("qid"))
    other = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.concat(F.lit("Q"), F.col("o_orderkey").cast("string")).alias("id"))
    return overlay.coalesce_ids(mine, "c_custkey", "qid", other, "id")


@query("""
WITH s AS (SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS o_orderpriority, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY 1)
SELECT c_custkey, 'own' AS o_orderstatus, o_orderpriority FROM customer LEFT JOIN s ON c_custkey = o_custkey
""")
def q_join_if_absent(spark, sf_dir):
    """The status stays the table's own; the priority comes from the first order."""
    mine = table(spark, sf_dir, "customer").select("c_custkey", F.lit("own").alias("o_orderstatus"))
    source = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return overlay.join_if_absent(mine, "c_custkey", source, ["o_orderstatus", "o_orderpriority"], "o_orderkey")


SEEDS = "WITH e AS (SELECT DISTINCT l_suppkey AS actor, l_orderkey AS edition FROM lineitem), s AS (SELECT actor FROM (SELECT DISTINCT actor FROM e) ORDER BY md5(actor::VARCHAR || '|42'), actor LIMIT 2), c AS (SELECT DISTINCT edition FROM e JOIN s USING (actor))"


@query(SEEDS + " SELECT 'edition' AS kind, o_orderkey AS id FROM orders WHERE o_orderkey IN (SELECT edition FROM c) UNION ALL SELECT DISTINCT 'actor', actor FROM e JOIN c USING (edition)")
def q_linked_sample(spark, sf_dir):
    edges = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("actor"), F.col("l_orderkey").alias("edition"))
    chosen, who = prepare.linked_sample(table(spark, sf_dir, "orders"), edges, "o_orderkey", 2)
    return chosen.select(F.lit("edition").alias("kind"), F.col("o_orderkey").alias("id")).unionByName(who.select(F.lit("actor").alias("kind"), F.col("actor").alias("id")))


@query("SELECT DISTINCT f AS field, v AS value FROM (SELECT unnest(['o_orderpriority', 'o_orderstatus']) AS f, unnest([o_orderpriority, o_orderstatus]) AS v FROM orders) WHERE v IS NOT NULL")
def q_distinct_values(spark, sf_dir):
    return profile.distinct_values(table(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderstatus"])


@query("""
WITH l AS (SELECT l_returnflag || '/' || (l_partkey % 50)::VARCHAR AS name, l_suppkey % 40 AS actor, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT name, count(DISTINCT actor) AS members, sum(n)::BIGINT AS total FROM l GROUP BY name HAVING count(DISTINCT actor) > 1
""")
def q_merged_counts(spark, sf_dir):
    name = F.concat("l_returnflag", F.lit("/"), (F.col("l_partkey") % 50).cast("string"))
    lists = table(spark, sf_dir, "lineitem").groupBy(name.alias("name"), (F.col("l_suppkey") % 40).alias("actor")).agg(F.count("*").alias("n"))
    return profile.merged_counts(lists, "name", "actor", "n", "actor")


def headers(spark, sf_dir):
    names = ("region", "nation", "customer", "orders")
    rows = [(n, table(spark, sf_dir, n).columns) for n in (*names, "orders")]
    return spark.createDataFrame([(f"{n}-{i}", c) for i, (n, c) in enumerate(rows)], "file string, columns array<string>")


HEADERS = """
WITH h AS (SELECT t || '-' || i::VARCHAR AS file, column_name FROM (SELECT unnest(['region', 'nation', 'customer', 'orders', 'orders']) AS t, unnest([0, 1, 2, 3, 4]) AS i)
           JOIN (SELECT DISTINCT table_name, column_name FROM duckdb_columns()) ON t = table_name)
"""


@query(HEADERS + "SELECT column_name, string_agg(DISTINCT file, '; ' ORDER BY file) AS files FROM h GROUP BY column_name")
def q_column_catalogue(spark, sf_dir):
    return profile.column_catalogue(headers(spark, sf_dir))


@query(HEADERS + ", g AS (SELECT file, string_agg(column_name, '; ' ORDER BY column_name) AS names, count(*) AS n_columns FROM h GROUP BY file) SELECT names, n_columns, string_agg(file, '; ' ORDER BY file) AS files, count(*) AS n_files FROM g GROUP BY ALL")
def q_schema_groups(spark, sf_dir):
    return profile.schema_groups(headers(spark, sf_dir))


@query("SELECT '" + SCHEMA + "' || CASE WHEN c_custkey % 3 = 0 THEN 'Organization' ELSE 'Person' END AS class, count(*) AS n, c_custkey % 3 <> 0 AS covered FROM customer GROUP BY ALL")
def q_class_coverage(spark, sf_dir):
    t = mapping.triples({"actors": prepare.actors(people(spark, sf_dir))}, mapping.actor_rules())
    return shapes.coverage(t, shapes.from_prose("obj:Person", "at least one obj:isIdentifiedBy")).where(F.col("class").rlike("(Person|Organization)$"))


@query("SELECT o_orderkey, (o_orderkey % 3 = 0 OR o_orderkey % 4 = 1) AS scope FROM orders")
def q_in_scope(spark, sf_dir):
    k = F.col("o_orderkey")
    d = table(spark, sf_dir, "orders").select("o_orderkey", F.when(k % 3 == 0, "ENG").when(k % 5 != 0, "fre").alias("language_harmonised"), F.when(k % 4 == 1, "Ireland").when(k % 4 == 2, "France").alias("publication_country"))
    return d.select("o_orderkey", editions.in_scope(d).alias("scope"))


@query("""
WITH f AS (SELECT o_custkey, arg_min(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY 1)
SELECT o_custkey, o_orderkey FROM orders JOIN f USING (o_custkey) WHERE status IN ('F', 'P')
""")
def q_only_types(spark, sf_dir):
    d = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.array("o_orderstatus").alias("types"))
    return records.only_types(d, "o_custkey", "types", ["F", "P"], "o_orderkey").select("o_custkey", "o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'")
def q_of_type(spark, sf_dir):
    d = table(spark, sf_dir, "orders").select("o_orderkey", F.array(F.lower("o_orderstatus"), F.lit("x")).alias("types"))
    return records.of_type(d, "types", "F").select("o_orderkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0")
def q_any_link(spark, sf_dir):
    k = F.col("c_custkey")
    d = table(spark, sf_dir, "customer").select("c_custkey", F.when(k % 2 == 0, "http://a/1").when(k % 5 == 0, " n/a ").alias("exact"), F.when(k % 3 == 0, "http://b/1").when(k % 7 == 0, "None").alias("close"))
    return subset.with_any(d, ["exact", "close"]).select("c_custkey")


@query("SELECT s_suppkey FROM supplier WHERE s_suppkey % 4 <> 0 AND s_suppkey % 5 <> 0")
def q_persons_only(spark, sf_dir):
    k = F.col("s_suppkey")
    d = table(spark, sf_dir, "supplier").select("s_suppkey", F.when(k % 5 != 0, k.cast("string")).otherwise(" ").alias("actor_id"), F.when(k % 4 == 0, "true").when(k % 4 == 1, "FALSE").alias("is_organization"))
    return tables.persons(d).select("s_suppkey")


@query("""
WITH v AS (SELECT 'http://example.org/n' || c_nationkey::VARCHAR AS actor, c_custkey, 'http://l/' || (c_custkey % 3)::VARCHAR AS link FROM customer),
f AS (SELECT actor, link, min(c_custkey) AS seen_at FROM v GROUP BY ALL) SELECT actor, (row_number() OVER (PARTITION BY actor ORDER BY seen_at))::INT AS n, link FROM f
""")
def q_link_numbers(spark, sf_dir):
    actor = F.concat(F.lit(f"<{STEM}n"), F.col("c_nationkey").cast("string"), F.lit(">"))
    cell = F.concat(F.lit("none; <http://l/"), (F.col("c_custkey") % 3).cast("string"), F.lit(">"))
    return prepare.actor_links(table(spark, sf_dir, "customer").select(actor.alias("actor"), cell.alias("link"), "c_custkey"), "link", "c_custkey")


ENRICHED = """
WITH m AS (SELECT o_custkey::VARCHAR AS k, arg_max(o_orderkey, o_orderkey) AS id, arg_max(CASE o_orderkey % 3 WHEN 0 THEN 'heuristic' WHEN 1 THEN 'ambiguous_heuristic' ELSE 'actor_bridge' END, o_orderkey) AS t FROM orders GROUP BY 1),
r AS (SELECT c_custkey, CASE WHEN t <> 'ambiguous_heuristic' THEN id END AS other_id, CASE WHEN t = 'ambiguous_heuristic' THEN id END AS other_candidate_id, t AS other_match_type FROM customer LEFT JOIN m ON k = c_custkey::VARCHAR)
"""


def enriched(spark, sf_dir):
    """Customers as editions, met by a number of their own or else by their IRI."""
    k, o = F.col("c_custkey").cast("string"), F.col("o_orderkey")
    mine = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, k).otherwise("").alias("bnf_id"), k.alias("edition"))
    kind = F.when(o % 3 == 0, "heuristic").when(o % 3 == 1, "ambiguous_heuristic").otherwise("actor_bridge")
    found = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("edition"), o.alias("other_id"), kind.alias("match_type"), F.lit(0.9).alias("confidence"), o.alias("_row_id"))
    return editions.enrich(mine, found)


@query(ENRICHED + "SELECT * FROM r")
def q_edition_enrichment(spark, sf_dir):
    return enriched(spark, sf_dir).select("c_custkey", "other_id", "other_candidate_id", "other_match_type")


@query(ENRICHED + "SELECT count(*) AS total, count(other_id) AS matched, count(other_candidate_id) AS ambiguous FROM r")
def q_enrichment_coverage(spark, sf_dir):
    return editions.enrichment_counts(enriched(spark, sf_dir))


@query("SELECT unnest(['place', 'note']) AS field, unnest([count(DISTINCT CASE WHEN l_linenumber % 3 = 0 THEN l_orderkey END), count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_orderkey END)]) AS n FROM lineitem")
def q_filled_editions(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").select("l_orderkey", F.when(F.col("l_linenumber") % 3 == 0, "Paris").otherwise("").alias("place"), F.when(F.col("l_returnflag") == "R", "x").alias("note"))
    return profile.filled_entities(d, "l_orderkey", ["place", "note"])


@query("WITH x AS (SELECT c_custkey AS k, 'http://example.org/cb' || c_custkey::VARCHAR || '#about' AS actor FROM customer) SELECT actor, 'type' AS facet, '" + SCHEMA + """' || CASE WHEN k % 3 = 0 THEN 'Organization' ELSE 'Person' END AS value FROM x
UNION ALL SELECT actor, 'birth_year', (1700 + k % 90)::VARCHAR FROM x WHERE k % 2 = 0 UNION ALL SELECT actor, 'foundation_year', '1800' FROM x WHERE k % 12 = 0
UNION ALL SELECT actor, 'gender', '""" + SCHEMA + "male' FROM x WHERE k % 7 = 0")
def q_actor_facets(spark, sf_dir):
    return portal.actor_facets(mapping.triples({"actors": prepare.actors(people(spark, sf_dir))}, mapping.actor_rules()))


@query("SELECT 'http://example.org/cb' || c_custkey::VARCHAR || '#about' AS s, (1700 + c_custkey % 90)::VARCHAR || '-01-01T00:00:00' AS o FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT 'http://example.org/cb' || c_custkey::VARCHAR || '#about', '1800-01-02T00:00:00' FROM customer WHERE c_custkey % 12 = 0")
def q_property_path(spark, sf_dir):
    t = mapping.triples({"actors": prepare.actors(people(spark, sf_dir))}, mapping.actor_rules())
    return portal.follow(t, *[SCHEMA + p for p in ("wasPresentAt", "hasTimeSpan", "hasStartTime")])


VOCABULARY = [("en", "English"), ("fr", "French"), ("de", "German")]


@query("SELECT doc_id, CASE lang WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' WHEN 'de' THEN 'German' ELSE lang END AS label FROM (SELECT doc_id, lang FROM documents) WHERE lang IS NOT NULL")
def q_vocabulary_labels(spark, sf_dir):
    d = table(spark, sf_dir, "documents").where("lang IS NOT NULL").select("doc_id", F.concat(F.lit(f"{STEM}lang/"), "lang").alias("iri"))
    return portal.with_labels(d, "iri", portal.values(spark, [(f"{STEM}lang/{c}", n) for c, n in VOCABULARY], "iri", "label")).select("doc_id", "label")


@query("""
WITH p AS (SELECT o_orderkey AS edition, o_custkey, o_orderpriority FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20)
SELECT edition, 'title' AS property, o_orderpriority AS value FROM p UNION ALL SELECT edition, 'author', c_name FROM p JOIN customer ON o_custkey = c_custkey
UNION ALL SELECT DISTINCT edition, 'form', l_returnflag FROM p JOIN lineitem ON l_orderkey = edition
""")
def q_property_blocks(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "edition")
    names = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("value"))
    blocks = {
        "title": o.select("edition", F.col("o_orderpriority").alias("value")), "author": o.join(names, "o_custkey").select("edition", "value"),
        "form": table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("edition"), F.col("l_returnflag").alias("value")),
    }
    return portal.property_blocks(portal.page(o, "o_totalprice", descending=True), "edition", blocks)


@query("SELECT l_suppkey, l_orderkey FROM lineitem WHERE l_linenumber = 1 EXCEPT SELECT l_suppkey, l_orderkey FROM lineitem WHERE l_returnflag = 'R'")
def q_link_difference(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem")
    return records.missing_links(d.where("l_linenumber = 1"), d.where("l_returnflag = 'R'"), ["l_suppkey", "l_orderkey"])
