"""Triples and the browsing queries over customers, orders and nations as actors, editions and places."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliant.graph import mapping, ntriples, portal, prepare, shapes
from foliant.operators.components import connected
from foliant.plans import query, table

STEM = "http://example.org/"


def people(spark, sf_dir):
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer", spread=True).select(
        F.concat(F.lit(f"<{STEM}cb"), k.cast("string"), F.lit("#about>")).alias("actor"), F.when(k % 3 == 0, "http://xmlns.com/foaf/0.1/Organization").otherwise("http://xmlns.com/foaf/0.1/Person").alias("entity_type"),
        F.when(k % 5 != 0, F.col("c_name")).alias("actor_name"), F.when(k % 2 == 0, (1700 + k % 90).cast("string")).alias("actor_birth"), F.when(k % 4 == 0, "1800-01-02").alias("actor_start"),
        F.when(k % 7 == 0, "male").alias("actor_gender"), F.when(k % 11 == 0, k.cast("string")).alias("viaf_id"),
    )


ACTOR_TRIPLES = """
WITH p AS (SELECT c_custkey AS k, 'http://example.org/cb' || c_custkey::VARCHAR AS base, c_name FROM customer), x AS (SELECT *, base || '#about' AS a FROM p),
t AS (
 SELECT a AS s, 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type' AS p, 'https://example.org/schema/' || CASE WHEN k % 3 = 0 THEN 'Organization' ELSE 'Person' END AS o FROM x
 UNION ALL SELECT base || '#app_fullname', unnest(['http://www.w3.org/1999/02/22-rdf-syntax-ns#type','https://example.org/schema/hasType','https://example.org/schema/hasSymbolicContent']), unnest(['https://example.org/schema/Appellation','https://example.org/schema/full-name', c_name]) FROM x WHERE k % 5 <> 0
 UNION ALL SELECT a, 'https://example.org/schema/isIdentifiedBy', base || '#app_fullname' FROM x WHERE k % 5 <> 0
 UNION ALL SELECT base || '#gender_aa', unnest(['http://www.w3.org/1999/02/22-rdf-syntax-ns#type','https://example.org/schema/assignsAttributeTo','https://example.org/schema/assignsPropertyOfType','https://example.org/schema/assigns']), unnest(['https://example.org/schema/AttributeAssignment', a, 'https://example.org/schema/gender','https://example.org/schema/male']) FROM x WHERE k % 7 = 0
 UNION ALL SELECT base || '#birth', unnest(['http://www.w3.org/1999/02/22-rdf-syntax-ns#type','https://example.org/schema/hasType','https://example.org/schema/hasTimeSpan']), unnest(['https://example.org/schema/Event','https://example.org/schema/birth', base || '#birth_ts']) FROM x WHERE k % 2 = 0
 UNION ALL SELECT base || '#birth_ts', unnest(['http://www.w3.org/1999/02/22-rdf-syntax-ns#type','https://example.org/schema/hasStartTime','https://example.org/schema/hasEndTime']), unnest(['https://example.org/schema/Time-Span', (1700 + k % 90)::VARCHAR || '-01-01T00:00:00', (1700 + k % 90)::VARCHAR || '-01-01T00:00:00']) FROM x WHERE k % 2 = 0
 UNION ALL SELECT a, 'https://example.org/schema/wasPresentAt', base || '#birth' FROM x WHERE k % 2 = 0
 UNION ALL SELECT base || '#start', unnest(['http://www.w3.org/1999/02/22-rdf-syntax-ns#type','https://example.org/schema/hasType','https://example.org/schema/hasTimeSpan']), unnest(['https://example.org/schema/Event','https://example.org/schema/foundation', base || '#start_ts']) FROM x WHERE k % 12 = 0
 UNION ALL SELECT base || '#start_ts', unnest(['http://www.w3.org/1999/02/22-rdf-syntax-ns#type','https://example.org/schema/hasStartTime','https://example.org/schema/hasEndTime']), unnest(['https://example.org/schema/Time-Span','1800-01-02T00:00:00','1800-01-02T00:00:00']) FROM x WHERE k % 12 = 0
 UNION ALL SELECT a, 'https://example.org/schema/wasPresentAt', base || '#start' FROM x WHERE k % 12 = 0
 UNION ALL SELECT a, 'http://www.w3.org/2002/07/owl#sameAs', 'http://viaf.org/viaf/' || k::VARCHAR FROM x WHERE k % 11 = 0)
"""


@query(ACTOR_TRIPLES + "SELECT s, p, o FROM t")
def q_triples_actors(spark, sf_dir):
    t = mapping.triples({"actors": prepare.actors(people(spark, sf_dir))}, mapping.actor_rules())
    return t.select("s", "p", "o")


@query(ACTOR_TRIPLES + "SELECT p, count(*) AS n FROM (SELECT DISTINCT s, p, o FROM t) GROUP BY p")
def q_nt_lines(spark, sf_dir):
    """Triples to N-Triples text, checked, read back and counted as a set."""
    t = mapping.triples({"actors": prepare.actors(people(spark, sf_dir))}, mapping.actor_rules())
    text = ntriples.lines(mapping.as_graph(t))
    return ntriples.parse(text.where(ntriples.valid("value"))).groupBy("p").agg(F.count("*").alias("n"))


@query(ACTOR_TRIPLES + """SELECT 'https://example.org/schema/Person' AS target, 'https://example.org/schema/isIdentifiedBy' AS path, 'minCount' AS "constraint", count(*) AS n FROM x WHERE k % 3 <> 0 AND k % 5 = 0
 UNION ALL SELECT 'https://example.org/schema/Organization', 'https://example.org/schema/wasPresentAt', 'maxCount', count(*) FROM x WHERE k % 12 = 0""")
def q_shape_counts(spark, sf_dir):
    t = mapping.triples({"actors": prepare.actors(people(spark, sf_dir))}, mapping.actor_rules())
    some = [
        *shapes.from_prose("obj:Person", "A person has at least one obj:isIdentifiedBy."), *shapes.from_prose("obj:Organization", "has at most one obj:wasPresentAt"),
        shapes.Shape("obj:Appellation", "obj:hasSymbolicContent", kind="literal", datatype="xsd:string"),
    ]
    return shapes.families(shapes.violations(t, some)).select("target", "path", "constraint", "n")


@query("""
WITH e AS (SELECT DISTINCT 'http://example.org/a' || l_suppkey::VARCHAR AS a, 'http://example.org/e' || l_orderkey::VARCHAR AS b, CASE l_returnflag WHEN 'A' THEN 'author' WHEN 'N' THEN 'editor' ELSE 'translator' END AS r FROM lineitem),
x AS (SELECT *, CASE r WHEN 'author' THEN '300025492' WHEN 'editor' THEN '300312355' ELSE '300069831' END AS aat FROM e),
t AS (SELECT b || '#expr_creation' AS s, 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type' AS p, 'http://iflastandards.info/ns/lrm/lrmoo/F28_Expression_Creation' AS o FROM x
 UNION SELECT b || '#ed', 'http://www.cidoc-crm.org/cidoc-crm/P16i_was_used_for', b || '#expr_creation' FROM x
 UNION SELECT b || '#expr_creation_' || r, unnest(['http://www.w3.org/1999/02/22-rdf-syntax-ns#type','https://example.org/schema/hasType','http://www.cidoc-crm.org/cidoc-crm/P14_carried_out_by']), unnest(['http://www.cidoc-crm.org/cidoc-crm/E7_Activity','http://vocab.getty.edu/aat/' || aat, a]) FROM x
 UNION SELECT b || '#expr_creation', 'http://www.cidoc-crm.org/cidoc-crm/P9_consists_of', b || '#expr_creation_' || r FROM x)
SELECT p, count(*) AS n, min(s) AS low, max(o) AS high FROM t GROUP BY p
""")
def q_triples_roles(spark, sf_dir):
    role = F.when(F.col("l_returnflag") == "A", "author").when(F.col("l_returnflag") == "N", "editor").otherwise("translator")
    e = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit(f"{STEM}a"), F.col("l_suppkey").cast("string")).alias("actor_iri"), F.concat(F.lit(f"{STEM}e"), F.col("l_orderkey").cast("string"), F.lit("#ed")).alias("edition_iri"), role.alias("role")
    )
    t = mapping.as_graph(mapping.triples({"roles": prepare.roles(e)}, mapping.role_rules()))
    return t.groupBy("p").agg(F.count("*").alias("n"), F.min("s").alias("low"), F.max("o").alias("high"))


def volumes(spark, sf_dir):
    """Orders as editions with every field that the edition rules read."""
    k = F.col("o_orderkey")
    t, iri = k.cast("string"), lambda x: F.concat(F.lit(f"<{STEM}{x}"), k.cast("string"), F.lit(">"))
    return table(spark, sf_dir, "orders", spread=True).select(
        F.concat(F.lit(f"<{STEM}cb"), t, F.lit("#about>")).alias("edition"), F.when(k % 3 == 0, t).alias("bnf_id"), F.when(k % 6 != 0, F.col("o_orderpriority")).alias("title"),
        F.when(k % 9 != 0, F.date_format("o_orderdate", "yyyy")).alias("year_first"), F.when(k % 4 == 0, "1992/1998").alias("year_range"), F.when(k % 5 == 1, F.col("o_orderstatus")).alias("description"),
        F.when(k % 4 != 1, "A Paris").alias("place"), F.when(k % 8 == 2, "Paris").alias("publication_place"), F.when(k % 5 == 0, "2.5").alias("longitude"), F.when(k % 10 == 0, "48.75").alias("latitude"),
        F.col("o_orderstatus").alias("publisher"), F.when(k % 3 == 0, F.col("o_orderpriority")).alias("publisher_harmonised"), F.when(k % 13 == 0, iri("pub")).alias("publisher_2"),
        F.when(k % 2 == 0, iri("w")).alias("work"), F.when(k % 10 != 3, iri("x")).alias("expression"), F.lit("<http://id.loc.gov/vocabulary/iso639-2/fre>").alias("language"),
        F.when(k % 7 != 0, "http://example.org/Text").alias("record_type"), F.when(k % 7 == 0, F.concat(F.lit("none; "), iri("d"), F.lit(";http://example.org/other"))).alias("digital_copy_link"),
        F.when(k % 10 == 0, iri("s")).alias("subject_topic"), F.when(k % 2 == 1, F.concat(F.lit(f"{STEM}a"), F.col("o_custkey").cast("string"))).alias("author"),
        F.when(k % 17 == 0, iri("e")).alias("editor"), F.when(k % 19 == 0, "nobody").alias("translator"), F.when(k % 11 == 0, t).alias("estc_id"),
    )


#: One line per triple pattern: condition, subject, predicate, object.
_EDITION = [line.split(" | ") for line in """
true | e | rdf:type | 'lrmoo:F3_Manifestation'
k % 7 <> 0 | e | obj:hasType | 'http://example.org/Text'
k % 3 = 0 | b || '#bnf_id' | rdf:type | 'obj:Identifier'
k % 3 = 0 | b || '#bnf_id' | obj:hasType | 'aat:300404621'
k % 3 = 0 | b || '#bnf_id' | obj:hasSymbolicContent | k::VARCHAR
k % 3 = 0 | e | obj:isIdentifiedBy | b || '#bnf_id'
k % 6 <> 0 | b || '#title' | rdf:type | 'crm:E35_Title'
k % 6 <> 0 | b || '#title' | obj:hasType | 'aat:300417204'
k % 6 <> 0 | b || '#title' | obj:hasSymbolicContent | o_orderpriority
k % 6 <> 0 AND k % 2 = 0 | w | crm:P102_has_title | b || '#title'
k % 6 <> 0 | e | crm:P102_has_title | b || '#title'
k % 9 <> 0 | b || '#ts_year_first' | rdf:type | 'obj:Time-Span'
k % 9 <> 0 | b || '#ts_year_first' | crm:P82a_begin_of_the_begin | y
k % 9 <> 0 | b || '#ts_year_first' | crm:P82b_end_of_the_end | y
k % 9 <> 0 | e | obj:hasTimeSpan | b || '#ts_year_first'
k % 4 = 0 OR k % 9 <> 0 | b || '#ts_year_range' | rdf:type | 'obj:Time-Span'
k % 4 = 0 OR k % 9 <> 0 | b || '#ts_year_range' | crm:P82_at_some_time_within | CASE WHEN k % 4 = 0 THEN '1992/1998' ELSE y END
k % 4 = 0 OR k % 9 <> 0 | e | obj:hasTimeSpan | b || '#ts_year_range'
k % 5 = 1 | e | crm:P3_has_note | o_orderstatus
k % 4 <> 1 | b || '#pub_place' | rdf:type | 'obj:Place'
k % 4 <> 1 | b || '#pub_place' | obj:isIdentifiedBy | b || '#pub_place_app'
k % 4 <> 1 | b || '#pub_place_app' | rdf:type | 'obj:Appellation'
k % 4 <> 1 | b || '#pub_place_app' | obj:hasSymbolicContent | 'A Paris'
k % 4 <> 1 | e | crm:P7_took_place_at | b || '#pub_place'
k % 8 = 2 | b || '#pub_place' | rdf:type | 'obj:Place'
k % 8 = 2 | b || '#pub_place' | obj:isIdentifiedBy | b || '#pub_place_norm_app'
k % 8 = 2 | b || '#pub_place_norm_app' | rdf:type | 'obj:Appellation'
k % 8 = 2 | b || '#pub_place_norm_app' | obj:hasType | 'aat:300404670'
k % 8 = 2 | b || '#pub_place_norm_app' | obj:hasSymbolicContent | 'Paris'
k % 8 = 2 | e | crm:P7_took_place_at | b || '#pub_place'
true | b || '#pub_actor' | rdf:type | 'obj:Actor'
true | b || '#pub_actor' | obj:isIdentifiedBy | b || '#pub_actor_app'
true | b || '#pub_actor_app' | rdf:type | 'obj:Appellation'
true | b || '#pub_actor_app' | obj:hasSymbolicContent | o_orderstatus
true | e | crm:P14_carried_out_by | b || '#pub_actor'
k % 3 = 0 | b || '#pub_actor' | rdf:type | 'obj:Actor'
k % 3 = 0 | b || '#pub_actor' | obj:isIdentifiedBy | b || '#pub_actor_norm_app'
k % 3 = 0 | b || '#pub_actor_norm_app' | rdf:type | 'obj:Appellation'
k % 3 = 0 | b || '#pub_actor_norm_app' | obj:hasType | 'aat:300404670'
k % 3 = 0 | b || '#pub_actor_norm_app' | obj:hasSymbolicContent | o_orderpriority
k % 3 = 0 | e | crm:P14_carried_out_by | b || '#pub_actor'
k % 10 = 0 | b || '#pub_place' | crm:P168_place_is_defined_by | 'POINT(2.5 48.75)'
k % 13 = 0 | e | crm:P14_carried_out_by | 'http://example.org/pub' || k::VARCHAR
k % 10 <> 3 | x | rdf:type | 'lrmoo:F2_Expression'
k % 10 <> 3 | e | lrmoo:R4_embodies | x
k % 10 <> 3 | x | crm:P72_has_language | 'http://id.loc.gov/vocabulary/iso639-2/fre'
k % 2 = 0 | w | rdf:type | 'lrmoo:F1_Work'
k % 2 = 0 AND k % 10 <> 3 | x | lrmoo:R3i_realises | w
k % 7 = 0 | b || '#digital_obj' | rdf:type | 'crmdig:D9_Data_Object'
k % 7 = 0 | b || '#digital_obj' | obj:isIdentifiedBy | b || '#digital_id'
k % 7 = 0 | b || '#digital_id' | rdf:type | 'obj:Identifier'
k % 7 = 0 | b || '#digital_id' | obj:hasType | 'aat:300404630'
k % 7 = 0 | b || '#digital_id' | obj:hasSymbolicContent | 'http://example.org/d' || k::VARCHAR
k % 7 = 0 | e | crm:P130i_features_are_also_found_on | b || '#digital_obj'
k % 10 = 0 | 'http://example.org/s' || k::VARCHAR | rdf:type | 'crm:E73_Information_Object'
k % 10 = 0 | 'http://example.org/s' || k::VARCHAR | obj:hasType | 'aat:300404126'
k % 10 = 0 | x | crm:P129_is_about | 'http://example.org/s' || k::VARCHAR
true | b || '#expr_creation' | rdf:type | 'lrmoo:F28_Expression_Creation'
k % 10 <> 3 | b || '#expr_creation' | lrmoo:R17_created | x
true | e | crm:P16i_was_used_for | b || '#expr_creation'
k % 2 = 1 | b || '#expr_creation_author' | rdf:type | 'crm:E7_Activity'
k % 2 = 1 | b || '#expr_creation_author' | obj:hasType | 'aat:300025492'
k % 2 = 1 | b || '#expr_creation_author' | crm:P14_carried_out_by | 'http://example.org/a' || o_custkey::VARCHAR
k % 2 = 1 | b || '#expr_creation' | crm:P9_consists_of | b || '#expr_creation_author'
k % 17 = 0 | b || '#expr_creation_editor' | rdf:type | 'crm:E7_Activity'
k % 17 = 0 | b || '#expr_creation_editor' | obj:hasType | 'aat:300312355'
k % 17 = 0 | b || '#expr_creation_editor' | crm:P14_carried_out_by | 'http://example.org/e' || k::VARCHAR
k % 17 = 0 | b || '#expr_creation' | crm:P9_consists_of | b || '#expr_creation_editor'
k % 11 = 0 | e | rdfs:seeAlso | 'https://estc.bl.uk/' || k::VARCHAR
""".strip().splitlines()]  # fmt: skip


def _named(term: str) -> str:
    """A quoted constant of a known prefix in full."""
    return f"'{mapping.expand(term[1:-1], mapping.PREFIXES)}'" if term.startswith("'") and not term.startswith("'http") and ":" in term and "||" not in term else term


EDITION_TRIPLES = (
    "WITH v AS (SELECT *, o_orderkey AS k, 'http://example.org/cb' || o_orderkey::VARCHAR AS b, 'http://example.org/w' || o_orderkey::VARCHAR AS w, 'http://example.org/x' || o_orderkey::VARCHAR AS x, strftime(o_orderdate, '%Y') AS y FROM orders),\n"
    "u AS (SELECT *, b || '#about' AS e FROM v),\nt AS ("
    + "\nUNION ALL ".join(f"SELECT {s} AS s, '{mapping.expand(p, mapping.PREFIXES)}' AS p, {_named(o)} AS o FROM u WHERE {when}" for when, s, p, o in _EDITION)
    + ")\n"
)


@query(EDITION_TRIPLES + "SELECT p, count(*) AS n, min(s) AS low, max(s) AS high, min(o) AS o_low, max(o) AS o_high FROM (SELECT DISTINCT s, p, o FROM t) GROUP BY p")
def q_triples_editions(spark, sf_dir):
    """All edition rules over all orders, as a set, summed up by predicate."""
    t = mapping.as_graph(mapping.triples({"editions": prepare.editions(volumes(spark, sf_dir))}, mapping.edition_rules()))
    ends = [f(c).alias(n) for f, c, n in ((F.min, "s", "low"), (F.max, "s", "high"), (F.min, "o", "o_low"), (F.max, "o", "o_high"))]
    return t.groupBy("p").agg(F.count("*").alias("n"), *ends)


@query(EDITION_TRIPLES + "SELECT s, p, o FROM t WHERE p LIKE '%hasTimeSpan' OR p LIKE '%P14_carried_out_by' OR p LIKE '%P102_has_title' OR p LIKE '%R3i_realises'")
def q_edition_links(spark, sf_dir):
    """The triples of four predicates, one by one."""
    t = mapping.triples({"editions": prepare.editions(volumes(spark, sf_dir))}, mapping.edition_rules())
    return t.where(F.col("p").rlike("(hasTimeSpan|P14_carried_out_by|P102_has_title|R3i_realises)$")).select("s", "p", "o")


def books(spark, sf_dir):
    k, y = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy")
    return table(spark, sf_dir, "orders").select(
        k.alias("edition"), F.repeat(F.col("o_orderpriority"), (k % 20).cast("int") + 1).alias("title"), F.when(k % 9 != 0, y).otherwise(F.concat(F.substring(y, 1, 3), F.lit("X"))).alias("year_first"),
        F.when(k % 4 != 0, F.concat(F.lit("Place "), (k % 30).cast("string"))).alias("publication_place"), F.when(k % 3 == 0, F.col("o_orderpriority")).alias("publisher_harmonised"), F.col("o_orderstatus").alias("publisher"),
        F.lit("fre").alias("language_harmonised"), F.when(k % 5 == 0, ((k % 30) / 2.0).cast("string")).alias("longitude"), F.when(k % 5 == 0, ((k % 30) / 4.0).cast("string")).alias("latitude"),
    )


BOOKS = """
WITH b AS (SELECT o_orderkey AS edition, repeat(o_orderpriority, (o_orderkey % 20)::INT + 1) AS title, CASE WHEN o_orderkey % 9 <> 0 THEN year(o_orderdate)::INT END AS y,
    CASE WHEN o_orderkey % 4 <> 0 THEN 'Place ' || (o_orderkey % 30)::VARCHAR END AS place, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END, o_orderstatus) AS pub, o_orderkey % 30 AS m, o_orderkey % 5 = 0 AS located FROM orders)
"""


@query(BOOKS + "SELECT edition, CASE WHEN length(title) > 160 THEN substr(title, 1, 157) || '...' ELSE title END AS label, y AS year, (y // 10 * 10)::INT AS decade, 'https://example.org/portal/place/' || replace(lower(place), ' ', '%20') AS place, pub AS publisher_label FROM b")
def q_edition_facets(spark, sf_dir):
    return portal.edition_facets(books(spark, sf_dir)).select("edition", "label", "year", "decade", "place", "publisher_label")


@query(BOOKS + "SELECT 'https://example.org/portal/place/' || replace(lower(place), ' ', '%20') AS place, min(place) AS label, min(CASE WHEN located THEN m / 2.0 END)::DOUBLE AS long, min(CASE WHEN located THEN m / 4.0 END)::DOUBLE AS lat FROM b WHERE place IS NOT NULL GROUP BY 1")
def q_shared_place(spark, sf_dir):
    d = portal.shared_places(books(spark, sf_dir))
    return d.withColumns({"long": F.col("long").cast("double"), "lat": F.col("lat").cast("double")})


@query(BOOKS + "SELECT (y // 10 * 10)::INT AS decade, count(*) AS n FROM b WHERE y IS NOT NULL GROUP BY 1")
def q_by_decade(spark, sf_dir):
    return portal.per_decade(portal.edition_facets(books(spark, sf_dir)), "year", "edition")


@query(BOOKS + "SELECT place, (m / 2.0)::DOUBLE AS long, (m / 4.0)::DOUBLE AS lat, count(*) AS n FROM b WHERE place IS NOT NULL AND located GROUP BY ALL")
def q_map(spark, sf_dir):
    d = portal.on_map(books(spark, sf_dir), "publication_place", "longitude", "latitude", "edition")
    return d.withColumns({"long": F.col("long").cast("double"), "lat": F.col("lat").cast("double")})


@query(BOOKS + "SELECT pub AS value, count(*) AS n FROM b WHERE y BETWEEN 1993 AND 1996 AND title ILIKE '%urgent%' AND place IN ('Place 1', 'Place 2', 'Place 3', 'Place 5') GROUP BY 1")
def q_facet_counts(spark, sf_dir):
    d = books(spark, sf_dir).withColumn("y", F.col("year_first").try_cast("int"))
    d = portal.filtered(d, {"title": "urgent"}, {"publication_place": ["Place 1", "Place 2", "Place 3", "Place 5"]}, {"y": (1993, 1996)})
    return portal.facet_counts(d.withColumn("pub", F.coalesce("publisher_harmonised", "publisher")), "pub")


@query("SELECT p.o_orderkey AS edition, c_name FROM (SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 40) p LEFT JOIN customer ON o_custkey = c_custkey")
def q_page(spark, sf_dir):
    rows = portal.page(table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "edition"), "o_totalprice", 2, descending=True)
    names = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return portal.with_properties(rows.select("edition", "o_custkey"), "o_custkey", names).select("edition", "c_name")


@query("SELECT o_orderkey AS edition, o_custkey AS actor, 'author' AS role FROM orders UNION SELECT o_orderkey, o_custkey % 10, 'editor' FROM orders WHERE o_orderkey % 3 = 0")
def q_contributors(spark, sf_dir):
    d = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("edition"), F.col("o_custkey").alias("author"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey") % 10).alias("editor"))
    return portal.contributors(d, {"author": "author", "editor": "editor"})


@query("SELECT 'http://example.org/cb' || c_custkey::VARCHAR || '#about' AS actor, CASE WHEN c_custkey % 3 = 0 THEN c_name WHEN c_custkey % 3 = 1 THEN 'Last' ELSE 'cb' || c_custkey::VARCHAR END AS label FROM customer")
def q_actor_labels(spark, sf_dir):
    k = F.col("c_custkey")
    d = table(spark, sf_dir, "customer").select(F.concat(F.lit(f"{STEM}cb"), k.cast("string"), F.lit("#about")).alias("actor"), F.when(k % 3 == 0, F.concat(F.lit('"'), "c_name", F.lit('"@fr'))).alias("actor_name"), F.when(k % 3 == 1, "Last").alias("actor_last_name"))
    return portal.actor_labels(d)


@query("""
WITH RECURSIVE e AS (SELECT DISTINCT l_suppkey AS a, l_suppkey + 7 AS b FROM lineitem), s AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(a, b) AS (SELECT a, b FROM s UNION SELECT r.a, s.b FROM r JOIN s ON r.b = s.a)
SELECT a AS node, least(a, min(b)) AS label FROM r GROUP BY a
""")
def q_components(spark, sf_dir):
    e = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("a"), (F.col("l_suppkey") + 7).alias("b"))
    return connected(e)
