"""Duplicates, matches and quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliant.evaluate import rules
from foliant.functions.html import page_title
from foliant.functions.names import plausible_name
from foliant.functions.text import folded, group_name, token_set
from foliant.link import actors, authorities, editions, tables
from foliant.operators.dedup import same_persons
from foliant.plans import ORACLES, query, table
from foliant.plans.scalar import q_dates_edtf, q_link_norm, q_place_lookup, q_publisher_classify


def people(spark, sf_dir):
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.alias("actor"), group_name(F.concat(F.lit("Name, "), (k % 120).cast("string"))).alias("name"),
        F.when(k % 4 == 0, F.array(F.concat(F.lit("L"), (k % 60).cast("string")))).otherwise(F.array().cast("array<string>")).alias("links"),
        F.when(k % 5 == 0, (1700 + k % 3).cast("string")).alias("birth"), F.when(k % 10 == 0, (1750 + k % 7).cast("string")).alias("death"), F.when(k % 3 == 0, "x").alias("extra"),
    )


@query("""
WITH RECURSIVE p AS (SELECT c_custkey AS actor, 'NAME ' || (c_custkey % 120)::VARCHAR AS name, CASE WHEN c_custkey % 4 = 0 THEN 'L' || (c_custkey % 60)::VARCHAR END AS link,
    CASE WHEN c_custkey % 5 = 0 THEN (1700 + c_custkey % 3)::VARCHAR END AS birth, CASE WHEN c_custkey % 10 = 0 THEN (1750 + c_custkey % 7)::VARCHAR END AS death, CASE WHEN c_custkey % 3 = 0 THEN 'x' END AS extra FROM customer),
g AS (SELECT * FROM p WHERE name IN (SELECT name FROM p GROUP BY name HAVING count(*) > 1)),
e AS (SELECT a.actor AS a, b.actor AS b, (a.link = b.link) IS TRUE AS by_link, (a.birth = b.birth AND a.death = b.death) IS TRUE AS by_date FROM g a JOIN g b ON a.name = b.name AND a.actor <> b.actor
      AND ((a.link = b.link) OR (a.birth = b.birth AND a.death = b.death))),
reach(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a),
lab AS (SELECT a AS actor, least(a, min(b)) AS label FROM reach GROUP BY a),
why AS (SELECT label, array_to_string(list_filter([CASE WHEN bool_or(by_date) THEN 'matching_dates' END, CASE WHEN bool_or(by_link) THEN 'shared_external_link' END], lambda x: x IS NOT NULL), '+') AS reasons FROM e JOIN lab ON e.a = lab.actor GROUP BY label),
r AS (SELECT g.*, label, reasons, (birth IS NOT NULL)::INT + (death IS NOT NULL)::INT + (extra IS NOT NULL)::INT AS filled FROM g LEFT JOIN lab USING (actor) LEFT JOIN why USING (label)),
c AS (SELECT *, CASE WHEN label IS NULL THEN actor ELSE first_value(actor) OVER (PARTITION BY name, label ORDER BY filled DESC, actor) END AS canonical_actor FROM r)
SELECT actor, CASE WHEN label IS NOT NULL THEN name || '::' || label::VARCHAR END AS cluster_id, canonical_actor, actor = canonical_actor AS is_canonical,
       coalesce(reasons, 'ambiguous_name_only') AS match_type, CASE WHEN label IS NOT NULL THEN 'high' ELSE 'low' END AS confidence, name FROM c
""")
def q_actor_dedup(spark, sf_dir):
    return same_persons(people(spark, sf_dir), ["birth", "death", "extra"])


def both_sides(spark, sf_dir):
    k, s = F.col("c_custkey"), F.col("s_suppkey")
    mine = table(spark, sf_dir, "customer").select(
        k.alias("actor"), F.when(k % 10 == 0, F.array((k % 200).cast("string"), ((k + 7) % 200).cast("string"))).otherwise(F.array().cast("array<string>")).alias("viaf_ids"),
        token_set(F.concat(F.lit("Family"), (k % 300).cast("string"), F.lit(", Given"))).alias("name_key"),
        F.when(k % 3 != 0, (1700 + k % 50).cast("int")).alias("birth"), F.when(k % 2 == 0, (1750 + k % 50).cast("int")).alias("death"),
    )
    other = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("o"), s.cast("string")).alias("other_id"), s.alias("row_no"), F.when(s % 3 == 0, s.cast("string")).alias("viaf"),
        token_set(F.concat(F.lit("given. family"), (s % 90).cast("string"))).alias("name_key"),
        F.when(s % 4 != 0, (1700 + s % 50).cast("int")).alias("birth"), F.when(s % 5 != 0, (1750 + s % 50).cast("int")).alias("death"),
    )
    return mine, other


MATCH = """
WITH a AS (SELECT c_custkey AS actor, CASE WHEN c_custkey % 10 = 0 THEN [(c_custkey % 200)::VARCHAR, ((c_custkey + 7) % 200)::VARCHAR] ELSE [] END AS ids, 'FAMILY' || (c_custkey % 300)::VARCHAR AS nk,
    CASE WHEN c_custkey % 3 <> 0 THEN 1700 + c_custkey % 50 END AS b, CASE WHEN c_custkey % 2 = 0 THEN 1750 + c_custkey % 50 END AS d FROM customer),
o AS (SELECT 'o' || s_suppkey::VARCHAR AS other_id, s_suppkey AS row_no, CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey::VARCHAR END AS viaf, 'FAMILY' || (s_suppkey % 90)::VARCHAR AS nk,
    CASE WHEN s_suppkey % 4 <> 0 THEN 1700 + s_suppkey % 50 END AS ob, CASE WHEN s_suppkey % 5 <> 0 THEN 1750 + s_suppkey % 50 END AS od FROM supplier),
v AS (SELECT actor, arg_min(other_id, viaf) AS vid FROM (SELECT actor, unnest(ids) AS viaf FROM a) JOIN (SELECT viaf, arg_min(other_id, row_no) AS other_id FROM o WHERE viaf IS NOT NULL GROUP BY viaf) USING (viaf) GROUP BY actor),
p AS (SELECT actor, other_id, row_no, CASE WHEN abs(b - ob) IS NULL AND abs(d - od) IS NULL THEN NULL ELSE coalesce(abs(b - ob) <= 2, true) AND coalesce(abs(d - od) <= 2, true) END AS ok FROM a JOIN o USING (nk) WHERE actor NOT IN (SELECT actor FROM v)),
s AS (SELECT actor, count(*) FILTER (ok) AS accepted, count(*) FILTER (ok IS NULL) AS open, arg_min(other_id, row_no) FILTER (ok) AS first_id FROM p GROUP BY actor),
m AS (SELECT a.actor, CASE WHEN vid IS NOT NULL THEN 'viaf_id' WHEN accepted = 1 THEN 'name_and_dates' WHEN accepted > 1 THEN 'ambiguous_name_and_dates' WHEN open > 0 THEN 'ambiguous_name_only' ELSE 'unmatched' END AS match_type,
    CASE WHEN vid IS NOT NULL THEN vid WHEN accepted > 0 THEN first_id END AS other_id FROM a LEFT JOIN v USING (actor) LEFT JOIN s USING (actor)),
r AS (SELECT *, CASE match_type WHEN 'viaf_id' THEN 1.0 WHEN 'name_and_dates' THEN 0.9 WHEN 'ambiguous_name_and_dates' THEN 0.5 WHEN 'ambiguous_name_only' THEN 0.3 ELSE 0.0 END::DOUBLE AS confidence FROM m)
"""


@query(MATCH + "SELECT actor, match_type, other_id, confidence FROM r")
def q_actor_match(spark, sf_dir):
    return actors.match(*both_sides(spark, sf_dir)).select("actor", "match_type", "other_id", "confidence")


@query(MATCH + """, c AS (SELECT r.*, actor % 400 AS canon, CASE match_type WHEN 'viaf_id' THEN 0 WHEN 'name_and_dates' THEN 1 WHEN 'ambiguous_name_and_dates' THEN 2 WHEN 'ambiguous_name_only' THEN 3 ELSE 4 END AS pr FROM r),
k AS (SELECT *, row_number() OVER (PARTITION BY canon ORDER BY pr, -confidence, actor) AS n FROM c)
SELECT canon AS actor, match_type, other_id, confidence, CASE WHEN actor <> canon THEN actor END AS taken_from FROM k WHERE n = 1""")
def q_collapse_canonical(spark, sf_dir):
    m = actors.match(*both_sides(spark, sf_dir)).drop("candidates")
    return actors.collapse(m, m.select("actor", (F.col("actor") % 400).alias("canonical_actor"))).select("actor", "match_type", "other_id", "confidence", "taken_from")


@query(MATCH + "SELECT CASE WHEN match_type IN ('viaf_id','name_and_dates') THEN 'confident' ELSE 'review' END AS part, count(*) AS n FROM r WHERE match_type <> 'unmatched' GROUP BY 1")
def q_confident_split(spark, sf_dir):
    sure, check = actors.split(actors.match(*both_sides(spark, sf_dir)))
    return sure.select(F.lit("confident").alias("part")).unionByName(check.select(F.lit("review").alias("part"))).groupBy("part").agg(F.count("*").alias("n"))


@query(MATCH + """SELECT actor, CASE WHEN match_type IN ('viaf_id','name_and_dates') THEN other_id END AS other_id, CASE WHEN match_type NOT IN ('viaf_id','name_and_dates') THEN other_id END AS other_candidate_id,
    match_type AS other_match_type, confidence AS other_confidence FROM r""")
def q_merge(spark, sf_dir):
    mine, other = both_sides(spark, sf_dir)
    return actors.enrich(mine.select("actor"), actors.match(mine, other))


@query()
def q_edition_match(spark, sf_dir):
    """Page titles against the same titles in capitals, by invented authors and years; no SQL has the ratios."""
    k, d = F.col("page_id"), table(spark, sf_dir, "pages", spread=True).select("page_id", page_title("html").alias("title"))
    mine = d.select(k.alias("edition"), "title", (1700 + k % 90).cast("int").alias("year"), (k % 4 != 0).alias("scope"))
    other = d.select(k.alias("other_id"), F.upper("title").alias("other_title"), (1700 + k % 90 + k % 2).cast("int").alias("other_year"))
    names = d.select(k.alias("edition"), folded(F.concat(F.lit("Author Élie"), (k % 7).cast("string"))).alias("name"))
    names = names.withColumn("tokens", editions.name_tokens("name"))
    theirs = d.select(k.alias("other_id"), folded(F.concat(F.lit("Elie"), (k % 7).cast("string"), F.lit(" author"))).alias("other_name"))
    theirs = theirs.withColumn("other_tokens", editions.name_tokens("other_name"))
    authors = d.select(k.alias("edition"), F.when(k % 2 == 0, k % 5).alias("actor"))
    known = spark.range(5).select(F.col("id").alias("actor"), F.col("id").alias("other_actor"))
    return editions.match(mine, "scope", authors, known, names, other, d.select(k.alias("other_id"), (k % 5).alias("other_actor")), theirs)


@query("""
WITH c AS (SELECT doc_id AS edition, doc_id % 90 + 1700 AS year, doc_id % 10 AS other_id, 1700 + (doc_id * 7) % 90 AS other_year, ((doc_id % 13) / 13.0)::DOUBLE AS score FROM documents UNION ALL
           SELECT doc_id, doc_id % 90 + 1700, doc_id % 10 + 10, doc_id % 90 + 1700 + doc_id % 2, ((doc_id % 13) / 13.0 - (doc_id % 3) / 100.0)::DOUBLE FROM documents),
t AS (SELECT *, max(score) OVER (PARTITION BY edition) AS top FROM c), k AS (SELECT * FROM t WHERE score >= top - 0.02),
n AS (SELECT *, count(*) OVER (PARTITION BY edition) AS n, count(*) FILTER (year = other_year) OVER (PARTITION BY edition) AS same FROM k),
s AS (SELECT * FROM n WHERE NOT (n > 1 AND same = 1) OR year = other_year),
b AS (SELECT edition, count(*) AS rivals, first(other_id ORDER BY score DESC, other_id) AS other_id FROM s GROUP BY edition)
SELECT edition, other_id, CASE WHEN rivals > 1 THEN 'ambiguous_heuristic' ELSE 'heuristic' END AS match_type FROM b
""")
def q_resolve_ties(spark, sf_dir):
    k = F.col("doc_id")
    d = table(spark, sf_dir, "documents")
    one = d.select(k.alias("edition"), (k % 90 + 1700).alias("year"), (k % 10).alias("other_id"), (1700 + (k * 7) % 90).alias("other_year"), ((k % 13) / 13.0).alias("score"))
    two = d.select(k.alias("edition"), (k % 90 + 1700).alias("year"), (k % 10 + 10).alias("other_id"), (k % 90 + 1700 + k % 2).alias("other_year"), ((k % 13) / 13.0 - (k % 3) / 100.0).alias("score"))
    return editions.resolve(one.unionByName(two).withColumn("kind", F.lit("heuristic"))).select("edition", "other_id", "match_type")


@query()
def q_authority_match(spark, sf_dir):
    """Suppliers against customers as an authority file: by source id, by link, by name."""
    s, c = F.col("s_suppkey"), F.col("c_custkey")
    mine = table(spark, sf_dir, "supplier").select(
        s.alias("actor"), F.when(s % 4 == 0, s.cast("string")).alias("source_id"), F.when(s % 4 == 1, F.concat(F.lit("v"), s.cast("string"))).alias("linked_id"),
        F.concat(F.lit("Given Family"), s.cast("string")).alias("name"), (s % 50).cast("string").alias("name_token"),
    )
    by_source = table(spark, sf_dir, "customer").select(F.when(c % 8 == 0, c.cast("string")).alias("source_id"), F.concat(F.lit("v"), c.cast("string")).alias("authority_id"))
    names = table(spark, sf_dir, "customer").select((c % 50).cast("string").alias("name_token"), F.concat(F.lit("v"), c.cast("string")).alias("authority_id"), F.concat(F.lit("Family"), c.cast("string"), F.lit(", Given (1700)")).alias("heading"))
    return authorities.by_authority(mine, by_source, names)


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 AND p_size % 2 = 0 THEN 'fixed ' || p_size::VARCHAR ELSE p_brand END AS harmonised, CASE WHEN p_partkey % 3 = 0 AND p_size % 2 = 0 THEN 'llm_resolved' WHEN p_partkey % 3 = 0 THEN 'non_parseable' ELSE 'none' END AS correction_type
FROM part
""")
def q_residual_merge(spark, sf_dir):
    d = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("string").alias("original"), F.col("p_brand").alias("harmonised"), F.when(F.col("p_partkey") % 3 == 0, "non_parseable").otherwise("none").alias("correction_type"), F.lit("low").alias("confidence"))
    open_ = authorities.residual(d, ("non_parseable",))
    answers = open_.where(F.col("original").cast("int") % 2 == 0).select("original", F.concat(F.lit("fixed "), "original").alias("resolved"))
    return authorities.merge_resolved(d, answers, ("non_parseable",)).select("p_partkey", "harmonised", "correction_type")


@query("""
WITH RECURSIVE base AS (SELECT 1), """ + __import__("foliant.plans.scalar", fromlist=["DATES_SQL"]).DATES_SQL.strip()[5:].replace("SELECT o_orderkey, form, CASE WHEN form IN", ", done AS (SELECT o_orderkey, form, CASE WHEN form IN", 1).replace("FROM forms", "FROM forms)") + """
, cases AS (SELECT CASE WHEN edtf IS NULL AND form = 'non_parseable' THEN 'unresolved_residual' WHEN regexp_full_match(edtf, '-?\\d{3}X') THEN 'decade_level' WHEN regexp_full_match(edtf, '-?\\d{2}XX') THEN 'century_level'
  WHEN regexp_full_match(edtf, '-?\\dXXX') THEN 'millennium_level' END AS "case" FROM done)
SELECT "case", 'warning' AS case_type, count(*) AS total_occurrences, round(count(*) / (SELECT count(*) FROM orders) * 100, 4) AS percentage FROM cases WHERE "case" IS NOT NULL GROUP BY "case"
""")
def q_evaluate_dates(spark, sf_dir):
    return rules.summary(q_dates_edtf(spark, sf_dir), rules.dates("edtf", "form"))


@query("WITH h AS (SELECT harmonised AS v FROM (" + ORACLES["q_link_norm"] + """)),
c AS (SELECT CASE WHEN v IS NULL THEN 'missing_value' WHEN regexp_matches(v, '[;|]') THEN 'multi_value_not_split' WHEN NOT regexp_full_match(v, 'https?://\\S+') THEN 'not_a_uri'
      WHEN regexp_extract(v, '://([^/?#]+)', 1) NOT IN ('viaf.org', 'fr.wikipedia.org') THEN 'unknown_authority_domain' END AS "case" FROM h)
SELECT "case", CASE "case" WHEN 'unknown_authority_domain' THEN 'warning' ELSE 'error' END AS case_type, count(*) AS total_occurrences, round(count(*) / (SELECT count(*) FROM h) * 100, 4) AS percentage
FROM c WHERE "case" IS NOT NULL GROUP BY "case"
""")
def q_evaluate_links(spark, sf_dir):
    return rules.summary(q_link_norm(spark, sf_dir), rules.links("harmonised"))


@query("""
SELECT "case", 'error' AS case_type, count(*) AS total_occurrences, round(count(*) / (SELECT count(*) FROM documents) * 100, 4) AS percentage
FROM (SELECT CASE WHEN doc_id % 4 = 0 THEN 'missing_value' WHEN doc_id % 4 <> 1 THEN 'not_iso_639_2_format' END AS "case" FROM documents) WHERE "case" IS NOT NULL GROUP BY 1
UNION ALL SELECT "case", 'warning', count(*), round(count(*) / (SELECT count(*) FROM documents) * 100, 4)
FROM (SELECT unnest(CASE WHEN doc_id % 4 = 1 THEN CASE WHEN doc_id % 8 = 1 THEN ['archaic_or_dialectal_language'] ELSE ['low_confidence_mapping'] END ELSE [] END) AS "case" FROM documents) GROUP BY 1
""")
def q_evaluate_language(spark, sf_dir):
    k = F.col("doc_id")
    d = table(spark, sf_dir, "documents").select(F.when(k % 4 == 0, F.lit(None)).when(k % 8 == 1, "FRO").when(k % 4 == 1, "xyz").otherwise(F.col("lang")).alias("l"))
    return rules.summary(d, rules.language("l"))


@query("WITH h AS (SELECT * FROM (" + ORACLES["q_place_lookup"] + """)),
c AS (SELECT unnest([CASE WHEN publication_place IS NULL AND publication_country IS NULL THEN 'unmatched_place' END, CASE WHEN publication_place IS NOT NULL AND publication_country IS NULL THEN 'missing_publication_country' END,
      CASE WHEN tgn_id IS NOT NULL AND s_suppkey % 3 = 0 THEN 'invalid_coordinates' END]) AS "case" FROM h)
SELECT "case", CASE "case" WHEN 'unmatched_place' THEN 'warning' ELSE 'error' END AS case_type, count(*) AS total_occurrences, round(count(*) / (SELECT count(*) FROM h) * 100, 4) AS percentage
FROM c WHERE "case" IS NOT NULL GROUP BY "case"
""")
def q_evaluate_place(spark, sf_dir):
    d = q_place_lookup(spark, sf_dir).withColumns({"o": F.lit("x"), "x": F.when(F.col("s_suppkey") % 3 == 0, "200").otherwise("1.5"), "y": F.lit("2")})
    return rules.summary(d, rules.place("publication_place", "o", "tgn_id", "publication_country", "x", "y"))


@query("WITH h AS (SELECT coalesce(harmonised, '') AS v FROM (" + ORACLES["q_publisher_classify"] + """)),
c AS (SELECT v, unnest([CASE WHEN v = '' THEN 'missing_value' END, CASE WHEN contains(v, ';') THEN 'multi_value_not_split' END, CASE WHEN regexp_matches(v, '[^\\w\\s.,\\-''()&]') THEN 'non_alphanumeric_noise' END]) AS label FROM h)
SELECT v AS "value", string_agg(DISTINCT label, ';' ORDER BY label) AS cases, count(*) AS occurrences FROM c WHERE label IS NOT NULL GROUP BY v
""")
def q_evaluate_publisher(spark, sf_dir):
    return rules.by_value(q_publisher_classify(spark, sf_dir), "harmonised", rules.publisher("harmonised"), "error")


@query("""
SELECT "case", case_type, count(*) AS total_occurrences, round(count(*) / (SELECT count(*) FROM customer) * 100, 4) AS percentage
FROM (SELECT unnest(CASE c_custkey % 4 WHEN 0 THEN ['missing_value'] WHEN 1 THEN ['alias_marker', 'conjunction'] WHEN 2 THEN ['digits', 'single_word', 'unusual_character'] ELSE ['title_or_role'] END) AS "case",
             CASE WHEN c_custkey % 4 = 0 THEN 'error' ELSE 'warning' END AS case_type FROM customer) GROUP BY ALL
""")
def q_evaluate_names(spark, sf_dir):
    k = F.col("c_custkey") % 4
    d = table(spark, sf_dir, "customer").select(F.when(k == 0, F.lit("")).when(k == 1, "Ann alias Bob and Co").when(k == 2, F.col("c_name")).otherwise("Veuve Martin").alias("n"))
    return rules.summary(d, rules.person_name("n"))


@query("""
WITH a AS (SELECT l_orderkey, l_suppkey, min(l_linenumber) AS at_line FROM lineitem WHERE l_linenumber % 2 = 0 GROUP BY ALL),
g AS (SELECT l_orderkey, string_agg(l_suppkey::VARCHAR, ',' ORDER BY at_line, l_suppkey::VARCHAR) AS ids, count(DISTINCT s_name) AS n FROM a JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_orderkey)
SELECT o_orderkey AS estc_id, coalesce(ids, '') AS ids, coalesce(n, 0) AS n FROM orders LEFT JOIN g ON o_orderkey = l_orderkey
""")
def q_foreign_authors(spark, sf_dir):
    core = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("estc_id"))
    links = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("estc_id"), F.col("l_suppkey").cast("string").alias("actor_id"), F.when(F.col("l_linenumber") % 2 == 0, "TRUE").otherwise("FALSE").alias("is_author"), F.col("l_linenumber").alias("_row_id"))
    people = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("actor_id"), F.col("s_name").alias("name"))
    d = tables.with_authors(core, links, people)
    return d.select("estc_id", F.array_join("author_ids", ",").alias("ids"), F.size("authors").cast("long").alias("n"))


@query("""
SELECT o_orderkey AS edition, 'http://a/' || o_custkey::VARCHAR AS iri, CASE WHEN o_custkey % 3 = 0 THEN c_name WHEN o_custkey % 3 = 1 THEN 'Ann Lee' END AS name FROM orders JOIN customer ON o_custkey = c_custkey
UNION ALL SELECT o_orderkey, '', o_orderpriority FROM orders WHERE o_orderkey % 5 = 0
""")
def q_edition_authors(spark, sf_dir):
    k, iri = F.col("c_custkey"), lambda c: F.concat(F.lit("<http://a/"), F.col(c).cast("string"), F.lit(">"))
    people = table(spark, sf_dir, "customer").select(iri("c_custkey").alias("actor"), F.when(k % 3 == 0, F.col("c_name")).alias("actor_name"), F.when(k % 3 == 1, "Ann").alias("actor_first_name"), F.when(k % 3 == 1, "Lee").alias("actor_last_name"), k.alias("_row_id"))
    books = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("edition"), iri("o_custkey").alias("author"), F.when(F.col("o_orderkey") % 5 == 0, F.col("o_orderpriority")).alias("author_name"))
    return tables.edition_authors(books, tables.display_names(people))


@query("SELECT o_orderkey, CASE WHEN o_custkey % 10 = 0 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey FROM orders")
def q_canonical_remap(spark, sf_dir):
    k = F.col("c_custkey")
    m = table(spark, sf_dir, "customer").select(k.alias("actor"), F.when(k % 10 == 0, k + 1).otherwise(k).alias("canonical_actor"))
    return tables.canonical(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey", m)


@query("SELECT c_custkey, c_custkey % 3 = 1 AS plausible FROM customer")
def q_plausible_names(spark, sf_dir):
    k = F.col("c_custkey") % 3
    return table(spark, sf_dir, "customer").select("c_custkey", plausible_name(F.when(k == 0, F.col("c_name")).when(k == 1, "Ann Lee").otherwise("Anonymous")).alias("plausible"))
