"""Scalar normalisers. Raw values are composed from table columns by key, the same way in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliant.functions import dates, language, links, names, place, publisher, text
from foliant.functions.html import page_title
from foliant.functions.years import in_years, year_of_actor, year_of_edition, year_of_role
from foliant.link.gazetteer import locate
from foliant.nulls import fold
from foliant.operators.cluster import by_key, by_similarity
from foliant.operators.distinct import on_distinct
from foliant.operators.firsts import first_row_by
from foliant.plans import query, table


@query("""
SELECT c_custkey,
       CASE WHEN upper(trim(raw)) IN ('NA','N/A','NULL','NONE','') THEN NULL ELSE trim(raw) END AS base,
       CASE WHEN upper(trim(raw)) IN ('NA','N/A','NULL','NONE','NAN','***','') THEN NULL ELSE trim(raw) END AS name,
       CASE WHEN trim(raw) IN ('NA','N/A','None','none','null','NULL','') THEN NULL ELSE trim(raw) END AS analysis
FROM (SELECT c_custkey, CASE c_custkey % 9 WHEN 0 THEN ' na ' WHEN 1 THEN 'None' WHEN 2 THEN '***' WHEN 3 THEN '' WHEN 4 THEN 'nan'
             WHEN 5 THEN 'NULL' ELSE c_name || ' ' END AS raw FROM customer)
""")
def q_null_fold(spark, sf_dir):
    k = F.col("c_custkey") % 9
    raw = F.when(k == 0, " na ").when(k == 1, "None").when(k == 2, "***").when(k == 3, "").when(k == 4, "nan").when(k == 5, "NULL").otherwise(F.concat("c_name", F.lit(" ")))
    d = table(spark, sf_dir, "customer").select("c_custkey", raw.alias("raw"))
    return d.select("c_custkey", *[fold("raw", p).alias(p) for p in ("base", "name", "analysis")])


@query("""
WITH raw AS (SELECT source, CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN lang ELSE '<http://id.loc.gov/vocabulary/iso639-2/' || lang || 'x>' END AS l, doc_id FROM documents),
firsts AS (SELECT source, arg_min(struct_pack(l := l), doc_id).l AS l FROM raw GROUP BY source),
kinds AS (SELECT CASE WHEN l IS NULL THEN 'missing' WHEN regexp_matches(l, '^<http://id\\.loc\\.gov/vocabulary/iso639-2/[a-z]{3}>$') THEN 'iso_code_uri' ELSE 'non_parseable' END AS correction_type,
          nullif(regexp_extract(l, '^<http://id\\.loc\\.gov/vocabulary/iso639-2/([a-z]{3})>$', 1), '') AS code FROM firsts)
SELECT correction_type, code, count(*) AS n FROM kinds GROUP BY ALL
""")
def q_language_norm(spark, sf_dir):
    k = F.col("doc_id") % 5
    raw = F.when(k == 0, F.lit(None)).when(k == 1, F.col("lang")).otherwise(F.concat(F.lit("<http://id.loc.gov/vocabulary/iso639-2/"), "lang", F.lit("x>")))
    d = table(spark, sf_dir, "documents").select("source", "doc_id", raw.alias("l"))
    first = first_row_by(d, ["source"], "doc_id").withColumn("l", fold("l"))
    return first.groupBy(language.language_form("l").alias("correction_type"), language.language_code("l").alias("code")).agg(F.count("*").alias("n"))


DATES_SQL = """
WITH raw AS (
  SELECT o_orderkey, CASE o_orderkey % 11
    WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m') WHEN 2 THEN strftime(o_orderdate, '%Y')
    WHEN 3 THEN '- ' || (o_orderkey % 997)::VARCHAR WHEN 4 THEN (o_orderkey % 999)::VARCHAR WHEN 5 THEN substr(strftime(o_orderdate, '%Y'), 1, 2) || '..'
    WHEN 6 THEN substr(strftime(o_orderdate, '%Y'), 1, 3) || 'X' WHEN 7 THEN NULL WHEN 8 THEN '19.-02-20' WHEN 9 THEN '1...' ELSE '12..5' END AS d FROM orders),
forms AS (
  SELECT o_orderkey, d, CASE WHEN d IS NULL THEN 'missing'
    WHEN regexp_full_match(d, '(-\\s?)?\\d{1,4}-\\d{2}-\\d{2}') THEN 'exact_date' WHEN regexp_full_match(d, '(-\\s?)?\\d{1,4}-\\d{2}') THEN 'year_month'
    WHEN regexp_full_match(d, '(-\\s?)?\\d{1,4}') THEN 'exact_year'
    WHEN regexp_full_match(d, '(-\\s?)?(\\d[.X]{3}|\\d{2}[.X]{2}|\\d{3}[.X])') THEN 'masked_precision' ELSE 'non_parseable' END AS form FROM raw)
SELECT o_orderkey, form, CASE WHEN form IN ('missing','non_parseable') THEN NULL ELSE
    CASE WHEN d LIKE '-%' THEN '-' ELSE '' END ||
    CASE form WHEN 'masked_precision' THEN translate(regexp_replace(d, '^-\\s?', ''), '.', 'X')
      ELSE lpad(regexp_extract(regexp_replace(d, '^-\\s?', ''), '^\\d+'), 4, '0') || regexp_replace(regexp_replace(d, '^-\\s?', ''), '^\\d+', '') END END AS edtf,
  CASE WHEN form IN ('missing','non_parseable') THEN 'low' ELSE 'high' END AS confidence
FROM forms
"""


def raw_dates(spark, sf_dir):
    k, d, key = F.col("o_orderkey") % 11, F.col("o_orderdate"), F.col("o_orderkey")
    y = F.date_format(d, "yyyy")
    raw = (
        F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "yyyy-MM")).when(k == 2, y)
        .when(k == 3, F.concat(F.lit("- "), (key % 997).cast("string"))).when(k == 4, (key % 999).cast("string"))
        .when(k == 5, F.concat(F.substring(y, 1, 2), F.lit(".."))).when(k == 6, F.concat(F.substring(y, 1, 3), F.lit("X")))
        .when(k == 7, F.lit(None)).when(k == 8, "19.-02-20").when(k == 9, "1...").otherwise("12..5")
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", fold(raw).alias("d"))


@query(DATES_SQL)
def q_dates_edtf(spark, sf_dir):
    form = dates.date_form("d")
    return raw_dates(spark, sf_dir).select("o_orderkey", form.alias("form"), dates.edtf("d").alias("edtf"), dates.date_confidence(form).alias("confidence"))


@query("""
WITH raw AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN '1628' WHEN 1 THEN '265' ELSE NULL END AS birth,
                    CASE c_custkey % 4 WHEN 0 THEN '170' WHEN 1 THEN '340' WHEN 2 THEN '17..' ELSE '169' END AS death FROM customer),
out AS (SELECT c_custkey, birth AS birth_raw, death AS death_raw, lpad(birth, 4, '0') AS birth, CASE WHEN death = '17..' THEN '17XX' ELSE lpad(death, 4, '0') END AS death FROM raw),
one AS (SELECT *, CASE WHEN birth_raw = '265' AND regexp_matches(death, '^[12][0-9X]{3}') THEN '265X' ELSE birth END AS birth2 FROM out),
two AS (SELECT *, CASE WHEN regexp_full_match(death_raw, '\\d{3}') AND regexp_matches(coalesce(birth2, ''), '^[12][0-9X]{3}') THEN death_raw || 'X' ELSE death END AS death2 FROM one)
SELECT c_custkey, f AS field, v AS edtf FROM (SELECT c_custkey, unnest(['birth','death']) AS f, unnest([birth2, death2]) AS v FROM two)
""")
def q_truncated_decade(spark, sf_dir):
    a, b = F.col("c_custkey") % 3, F.col("c_custkey") % 4
    birth = F.when(a == 0, "1628").when(a == 1, "265")
    death = F.when(b == 0, "170").when(b == 1, "340").when(b == 2, "17..").otherwise("169")
    d = table(spark, sf_dir, "customer").select("c_custkey", birth.alias("birth_raw"), death.alias("death_raw"))
    d = d.withColumns({"birth": dates.edtf("birth_raw"), "death": dates.edtf("death_raw"), "bf": dates.date_form("birth_raw"), "df": dates.date_form("death_raw")})
    d = dates.with_truncated_decades(d, {"birth": "birth_raw", "death": "death_raw"}, {"birth": "birth", "death": "death"}, {"birth": "bf", "death": "df"})
    return d.select("c_custkey", F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("edtf")) for f in ("birth", "death")])))


@query("""
WITH raw AS (SELECT page_id, CASE page_id % 6 WHEN 0 THEN '<://' || page_id::VARCHAR || '>' WHEN 1 THEN NULL WHEN 2 THEN '<http://FR.wikipedia.org/wiki/' || page_id::VARCHAR || '>'
                    WHEN 3 THEN 'https://viaf.org/viaf/' || page_id::VARCHAR ELSE '<' || url || '>' END AS l FROM pages),
parts AS (SELECT page_id, l, regexp_replace(l, '^<(.*)>$', '\\1') AS inner_ FROM raw),
split AS (SELECT page_id, l, lower(regexp_extract(inner_, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]+)(.*)$', 1)) AS s, lower(regexp_extract(inner_, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]+)(.*)$', 2)) AS h,
          regexp_extract(inner_, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]+)(.*)$', 3) AS r FROM parts),
kinds AS (SELECT *, CASE WHEN l IS NULL THEN 'missing' WHEN s = '' OR h = '' THEN 'malformed' WHEN h IN ('fr.wikipedia.org','imslp.org') AND s = 'http' THEN 'scheme_upgraded_https'
          WHEN h IN ('viaf.org','fr.wikipedia.org') THEN 'passthrough' ELSE 'unknown_authority' END AS correction_type FROM split)
SELECT page_id, correction_type, CASE WHEN correction_type IN ('missing','malformed') THEN NULL ELSE CASE WHEN correction_type = 'scheme_upgraded_https' THEN 'https' ELSE s END || '://' || h || r END AS harmonised,
       CASE h WHEN 'viaf.org' THEN 'VIAF' WHEN 'fr.wikipedia.org' THEN 'Wikipedia (fr)' END AS authority,
       CASE WHEN correction_type IN ('missing','malformed') THEN 'low' WHEN correction_type = 'unknown_authority' THEN 'medium' ELSE 'high' END AS confidence
FROM kinds
""")
def q_link_norm(spark, sf_dir):
    k, i = F.col("page_id") % 6, F.col("page_id").cast("string")
    raw = (
        F.when(k == 0, F.concat(F.lit("<://"), i, F.lit(">"))).when(k == 1, F.lit(None)).when(k == 2, F.concat(F.lit("<http://FR.wikipedia.org/wiki/"), i, F.lit(">")))
        .when(k == 3, F.concat(F.lit("https://viaf.org/viaf/"), i)).otherwise(F.concat(F.lit("<"), "url", F.lit(">")))
    )
    d = table(spark, sf_dir, "pages").select("page_id", fold(raw).alias("l"))
    return d.select("page_id", *[c.alias(n) for n, c in links.link_parts("l").items()])


@query("""
WITH raw AS (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN '[In ' || n_name || '?] (' || r_name || ')' WHEN 1 THEN 'A ' || n_name WHEN 2 THEN n_name || ' (x) (' || r_name || ')' ELSE 'Nowhere (' || r_name || ')' END AS p
             FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
split AS (SELECT s_suppkey, CASE WHEN p LIKE '%(%' THEN trim(regexp_extract(p, '^(.*)\\(', 1)) ELSE trim(p) END AS city,
          CASE WHEN p LIKE '%(%' THEN trim(regexp_replace(regexp_extract(p, '^.*\\((.*)$', 1), '[()]', '', 'g')) END AS country FROM raw),
keyed AS (SELECT *, trim(replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(city, '[][()?,]', '', 'g'), 'In ', ''), 'A ', ''), 'À ', ''), 'Tot ', ''), 'Te ', ''), 'T'' ', ''), 't ', ''), 't'' ', '')) AS k FROM split)
SELECT s_suppkey, regexp_matches(city, '[][]') AS brackets, contains(city, '?') AS question_marks, n_nationkey::VARCHAR AS tgn_id, n_name AS publication_place,
       coalesce(CASE WHEN n_nationkey % 2 = 0 THEN 'land ' || n_nationkey::VARCHAR END, 'region ' || r_regionkey::VARCHAR) AS publication_country
FROM keyed LEFT JOIN nation ON k = n_name LEFT JOIN region ON country = r_name
""")
def q_place_lookup(spark, sf_dir):
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    s = table(spark, sf_dir, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    k = F.col("s_suppkey") % 4
    p = (
        F.when(k == 0, F.concat(F.lit("[In "), "n_name", F.lit("?] ("), "r_name", F.lit(")"))).when(k == 1, F.concat(F.lit("A "), "n_name"))
        .when(k == 2, F.concat("n_name", F.lit(" (x) ("), "r_name", F.lit(")"))).otherwise(F.concat(F.lit("Nowhere ("), "r_name", F.lit(")")))
    )
    places = n.select(
        F.col("n_name").alias("city_harmonised"), F.col("n_nationkey").cast("string").alias("tgn_id"), F.col("n_name").alias("publication_place"),
        F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("land "), F.col("n_nationkey").cast("string"))).alias("publication_country"),
        F.lit(None).cast("string").alias("longitude"), F.lit(None).cast("string").alias("latitude"),
    )
    countries = r.select(F.col("r_name").alias("country"), F.concat(F.lit("region "), F.col("r_regionkey").cast("string")).alias("country_harmonised"))
    d = locate(s.select("s_suppkey", p.alias("p")), "p", places, countries)
    return d.select("s_suppkey", F.col("place_uncertainty_brackets").alias("brackets"), F.col("place_uncertainty_question_marks").alias("question_marks"), "tgn_id", "publication_place", "publication_country")


def raw_publishers(spark, sf_dir):
    k, n = F.col("p_partkey") % 8, F.col("p_brand")
    raw = (
        F.when(k == 0, "[s.n.]").when(k == 1, "Chez l'auteur").when(k == 2, F.concat(n, F.lit(" et fils"))).when(k == 3, F.concat(n, F.lit(" (Paris)")))
        .when(k == 4, F.concat(F.lit("Impr. "), n)).when(k == 5, F.concat(F.lit("["), n, F.lit("]"))).when(k == 6, F.concat(F.lower(n), F.lit("."))).otherwise(n)
    )
    return table(spark, sf_dir, "part").select("p_partkey", fold(raw).alias("raw"))


PUBLISHER_SQL = """
WITH raw AS (SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN '[s.n.]' WHEN 1 THEN 'Chez l''auteur' WHEN 2 THEN p_brand || ' et fils' WHEN 3 THEN p_brand || ' (Paris)'
             WHEN 4 THEN 'Impr. ' || p_brand WHEN 5 THEN '[' || p_brand || ']' WHEN 6 THEN lower(p_brand) || '.' ELSE p_brand END AS raw FROM part),
made AS (SELECT p_partkey, raw, CASE p_partkey % 8 WHEN 0 THEN 'sine_nomine' WHEN 1 THEN 'self_published' WHEN 2 THEN 'multi_value' WHEN 3 THEN 'location_stripped' WHEN 4 THEN 'abbreviation_expanded'
                WHEN 5 THEN 'bracketed_uncertain' ELSE 'passthrough' END AS correction_type,
         CASE p_partkey % 8 WHEN 0 THEN NULL WHEN 1 THEN 'L''auteur' WHEN 2 THEN raw WHEN 3 THEN regexp_replace(raw, ' \\(Paris\\)$', '') WHEN 4 THEN replace(raw, 'Impr.', 'Imprimerie')
                WHEN 5 THEN regexp_replace(raw, '[][]', '', 'g') ELSE raw END AS harmonised FROM raw)
"""


@query(PUBLISHER_SQL + "SELECT p_partkey, raw, correction_type, harmonised, CASE WHEN correction_type = 'multi_value' THEN 'low' WHEN correction_type = 'bracketed_uncertain' THEN 'medium' ELSE 'high' END AS confidence FROM made")
def q_publisher_classify(spark, sf_dir):
    d = raw_publishers(spark, sf_dir).withColumn("s", publisher.statement("raw")).select("p_partkey", "raw", "s.named", "s.correction_type", "s.confidence")
    d = on_distinct(d, ["named"], {"full": publisher.expanded})
    return d.select("p_partkey", "raw", "correction_type", publisher.harmonised("raw", F.col("correction_type"), F.col("full")).alias("harmonised"), "confidence")


def publisher_values(spark, sf_dir):
    d = q_publisher_classify(spark, sf_dir).where(F.col("correction_type").isin(*publisher.CLUSTERED))
    v = d.groupBy("raw", "harmonised").agg(F.count("*").alias("n"))
    return v.withColumn("key", text.canonical_key("harmonised"))


@query(PUBLISHER_SQL + """, vals AS (SELECT raw, harmonised, count(*) AS n FROM made WHERE correction_type NOT IN ('sine_nomine','self_published','multi_value') GROUP BY ALL),
keyed AS (SELECT *, trim(regexp_replace(regexp_replace(lower(strip_accents(harmonised)), '[^\\w\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS key FROM vals),
forms AS (SELECT key, harmonised, sum(n) AS n FROM keyed GROUP BY ALL),
best AS (SELECT key, harmonised AS canonical FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY n DESC, harmonised) AS r FROM forms) WHERE r = 1)
SELECT raw, harmonised, key, n, canonical FROM keyed JOIN best USING (key)""")
def q_publisher_key_cluster(spark, sf_dir):
    return by_key(publisher_values(spark, sf_dir)).select("raw", "harmonised", "key", "n", "canonical")


@query()
def q_fuzzy_cluster(spark, sf_dir):
    """Part names as keys, the same name in two spellings; no SQL has this ratio."""
    p = table(spark, sf_dir, "part").select(F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).otherwise(F.regexp_replace("p_name", "o", "oo")).alias("name"))
    keys = p.groupBy(text.canonical_key("name").alias("key")).agg(F.count("*").alias("n"))
    return by_similarity(keys)


@query("""
SELECT c_custkey, CASE c_custkey % 10 WHEN 0 THEN 'William ' || c_mktsegment WHEN 1 THEN 'Jean ' || c_mktsegment WHEN 2 THEN c_mktsegment WHEN 3 THEN 'First Last' WHEN 4 THEN 'First Last' WHEN 5 THEN c_mktsegment
         WHEN 6 THEN 'Ann and Bob ' || c_mktsegment WHEN 7 THEN 'Juan Melo y ' || c_mktsegment WHEN 8 THEN 'a [b ' || c_mktsegment ELSE c_name END AS harmonised,
       CASE c_custkey % 10 WHEN 0 THEN 'stripped_rdf_literal_tag' WHEN 1 THEN 'alias_split' WHEN 2 THEN 'stripped_title_role' WHEN 3 THEN 'derived_from_first_last' WHEN 4 THEN 'preferred_first_last_over_initials'
         WHEN 5 THEN 'stripped_brackets_or_separators' WHEN 6 THEN 'unresolved_multiple_values' WHEN 7 THEN 'none' WHEN 8 THEN 'unresolved_brackets_or_separators' ELSE 'none' END AS correction_type,
       CASE c_custkey % 10 WHEN 1 THEN 'medium' WHEN 2 THEN 'medium' WHEN 6 THEN 'low' WHEN 8 THEN 'low' ELSE 'high' END AS confidence
FROM customer
""")
def q_name_cascade(spark, sf_dir):
    k, s = F.col("c_custkey") % 10, F.col("c_mktsegment")
    raw = (
        F.when(k == 0, F.concat(F.lit('"William '), s, F.lit('"@fr'))).when(k == 1, F.concat(F.lit("Jean "), s, F.lit(", dit le Grand"))).when(k == 2, F.concat(F.lit("Sieur de "), s))
        .when(k == 3, "NA").when(k == 4, "M. B.").when(k == 5, F.concat(F.lit("["), s, F.lit("]"))).when(k == 6, F.concat(F.lit("Ann and Bob "), s))
        .when(k == 7, F.concat(F.lit("Juan Melo y "), s)).when(k == 8, F.concat(F.lit("a [b "), s)).otherwise(F.col("c_name"))
    )
    d = table(spark, sf_dir, "customer").select("c_custkey", fold(raw, "name").alias("raw"), F.lit("First").alias("first"), F.lit("Last").alias("last"))
    return d.select("c_custkey", *[c.alias(n) for n, c in names.name_cascade("raw", "first", "last").items()])


@query("""
SELECT o_orderkey, year(o_orderdate)::INTEGER AS role_year, CASE WHEN o_orderkey % 2 = 0 THEN year(o_orderdate)::INTEGER END AS actor_year,
       CASE WHEN year(o_orderdate) < 2000 THEN year(o_orderdate)::INTEGER END AS edition_year
FROM orders WHERE year(o_orderdate) BETWEEN 1994 AND 1996
""")
def q_year_filter(spark, sf_dir):
    y = F.date_format("o_orderdate", "yyyy")
    d = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(y, F.lit("/1999")).alias("first"), F.lit("2000").alias("span"), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("b. "), y)).otherwise("b. 17").alias("text"), y.alias("y"))
    year = year_of_role("first", "span")
    return d.where(in_years(year, 1994, 1996)).select("o_orderkey", year.alias("role_year"), year_of_actor("text").alias("actor_year"), year_of_edition("y").alias("edition_year"))


@query()
def q_html_title(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", page_title("html").alias("title"))
