"""The derived layer and the browsing queries, on the wide tables that the triples come from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions.iri import url_encoded
from foliant.functions.years import year_of_edtf
from foliant.graph.mapping import PREFIXES, TYPE, expand
from foliant.nulls import col


def label(title: Column | str) -> Column:
    """Titles over 160 characters are cut to 157 and dots."""
    c = col(title)
    return F.when(F.length(c) > 160, F.concat(F.substring(c, 1, 157), F.lit("..."))).otherwise(c)


def decade(year: Column | str) -> Column:
    return (F.floor(col(year) / 10) * 10).cast("int")


def shared_iri(kind: str, name: Column | str, stem: str = "https://example.org/portal/") -> Column:
    """One IRI for all spellings that differ in case only."""
    return F.concat(F.lit(f"{stem}{kind}/"), url_encoded(F.lower(col(name))))


def edition_facets(df: DataFrame) -> DataFrame:
    """edition with label, year, decade, place and publisher IRIs; the raw publisher stands in where no harmonised one is."""
    publisher = F.coalesce("publisher_harmonised", "publisher")
    y = year_of_edtf("year_first")
    return df.select(
        "edition", label("title").alias("label"), y.alias("year"), decade(y).alias("decade"), shared_iri("place", "publication_place").alias("place"),
        shared_iri("publisher", publisher).alias("publisher"), publisher.alias("publisher_label"), F.col("language_harmonised").alias("language"),
    )


def shared_places(df: DataFrame) -> DataFrame:
    """place, label, long, lat: one label and one coordinate per shared place, the smallest, so that runs agree."""
    rows = df.where("publication_place IS NOT NULL").select(shared_iri("place", "publication_place").alias("place"), "publication_place", "longitude", "latitude")
    at = F.min(F.when(F.col("longitude").isNotNull() & F.col("latitude").isNotNull(), F.struct("longitude", "latitude")))
    return rows.groupBy("place").agg(F.min("publication_place").alias("label"), at.alias("c")).select("place", "label", F.col("c.longitude").alias("long"), F.col("c.latitude").alias("lat"))


def contributors(editions: DataFrame, roles: dict[str, str]) -> DataFrame:
    """edition, actor, role."""
    pairs = F.array(*[F.struct(F.col(c).alias("actor"), F.lit(r).alias("role")) for c, r in roles.items()])
    return editions.select("edition", F.inline(pairs)).where("actor IS NOT NULL").distinct()


def actor_labels(df: DataFrame) -> DataFrame:
    """actor, label: the name without a literal's quotes and tag, else the last name, else the identifier in the IRI."""
    full = F.regexp_replace("actor_name", r'^"(.*)"@[A-Za-z-]+\z', "$1")
    return df.select("actor", F.coalesce(full, "actor_last_name", F.regexp_replace("actor", r"^.*/(cb[^#]+).*\z", "$1")).alias("label"))


def filtered(df: DataFrame, text: dict[str, str] | None = None, values: dict[str, list] | None = None, ranges: dict[str, tuple] | None = None) -> DataFrame:
    """Facet selections: text anywhere regardless of case, one of given values, a range; all must hold."""
    for c, pattern in (text or {}).items():
        df = df.where(F.col(c).rlike(f"(?iu){pattern}"))
    for c, some in (values or {}).items():
        df = df.where(F.col(c).isin(*some))
    for c, (low, high) in (ranges or {}).items():
        df = df.where(F.col(c).between(low, high))
    return df


def facet_counts(df: DataFrame, facet: str, entity: str = "edition") -> DataFrame:
    """value, n: distinct entities per value of the facet."""
    return df.where(F.col(facet).isNotNull()).groupBy(F.col(facet).alias("value")).agg(F.count_distinct(entity).alias("n"))


def page(df: DataFrame, sort: str, number: int = 0, size: int = 20, descending: bool = False, tie: str = "edition") -> DataFrame:
    """One page in order; properties are best joined to the page, not before it."""
    order = F.desc(sort) if descending else F.asc(sort)
    return df.orderBy(order, tie).offset(number * size).limit(size)


def with_properties(rows: DataFrame, key: str, properties: DataFrame) -> DataFrame:
    """Properties of a page's rows only."""
    return rows.join(properties, key, "left")


def property_blocks(rows: DataFrame, key: str, blocks: dict[str, DataFrame]) -> DataFrame:
    """key, property, value: the distinct values of every block (key, value) for a page's rows."""
    chosen = rows.select(key)
    made = [b.join(chosen, key, "left_semi").where("value IS NOT NULL").select(key, F.lit(n).alias("property"), F.col("value").cast("string").alias("value")) for n, b in blocks.items()]
    out = made[0]
    for m in made[1:]:
        out = out.unionByName(m)
    return out.distinct()


def values(spark: SparkSession, rows: list[tuple], *names: str) -> DataFrame:
    """An inline table of texts."""
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))


def with_labels(df: DataFrame, column: str, vocabulary: DataFrame) -> DataFrame:
    """df with label: the vocabulary's (iri, label; the smallest of several) for the IRI, else the last part of the IRI."""
    v = vocabulary.groupBy(F.col("iri").alias("_iri")).agg(F.min("label").alias("_label"))
    j = df.join(v, df[column] == F.col("_iri"), "left")
    return j.withColumn("label", F.coalesce("_label", F.regexp_extract(column, r"([^/#]*)\z", 1))).drop("_iri", "_label")


def follow(t: DataFrame, *path: str) -> DataFrame:
    """s, o: what a path of predicates connects, once each; every step is an equi-join on the node between."""
    first, *rest = [t.where(F.col("p") == p).select("s", "o") for p in path]
    for step in rest:
        first = first.withColumnRenamed("o", "_via").join(step.select(F.col("s").alias("_via"), "o"), "_via").select("s", "o")
    return first.distinct()


#: Kinds of events and the years that they give.
EVENT_YEARS = {"obj:birth": "birth_year", "obj:death": "death_year", "obj:foundation": "foundation_year", "obj:dissolution": "dissolution_year"}


def actor_facets(t: DataFrame, prefixes: dict[str, str] | None = None) -> DataFrame:
    """actor, facet, value: type, years of events, gender and country, from an actor's triples; only organisations have
    years of foundation and dissolution."""
    names = PREFIXES | (prefixes or {})
    iri = lambda x: expand(x, names)
    facet = lambda d, name: d.select("actor", F.lit(name).alias("facet"), "value")
    kinds = follow(t, iri(TYPE)).toDF("actor", "value").where(F.col("value").isin(iri("obj:Person"), iri("obj:Organization")))
    groups = kinds.where(F.col("value") == iri("obj:Organization")).select("actor").distinct()
    year_of = F.create_map(*[F.lit(x) for k, v in EVENT_YEARS.items() for x in (iri(k), v)])
    events = follow(t, iri("obj:wasPresentAt")).toDF("actor", "event")
    typed = follow(t, iri("obj:hasType")).toDF("event", "kind").where(F.col("kind").isin(*[iri(k) for k in EVENT_YEARS]))
    start = follow(t, iri("obj:hasTimeSpan"), iri("obj:hasStartTime")).toDF("event", "at").where(F.col("at").rlike("^[0-9]{4}-"))
    years = events.join(typed, "event").join(start, "event").select("actor", year_of[F.col("kind")].alias("facet"), F.substring("at", 1, 4).cast("int").cast("string").alias("value"))
    life = F.col("facet").isin("birth_year", "death_year")
    years = years.where(life).unionByName(years.where(~life).join(groups, "actor", "left_semi"))
    given = follow(t, iri("obj:assigns")).toDF("a", "value")
    gender = follow(t.where(F.col("o") == iri("obj:gender")), iri("obj:assignsPropertyOfType")).select(F.col("s").alias("a"))
    gender = follow(t, iri("obj:assignsAttributeTo")).toDF("a", "actor").join(gender, "a", "left_semi").join(given, "a")
    country = follow(t, iri("obj:hasResidenceIn")).toDF("actor", "value")
    return facet(kinds, "type").unionByName(years).unionByName(facet(gender, "gender")).unionByName(facet(country, "country")).distinct()


def on_map(df: DataFrame, place: str, longitude: str, latitude: str, entity: str) -> DataFrame:
    """place, long, lat, n: distinct entities per place with coordinates."""
    d = df.dropna(subset=[place, longitude, latitude])
    return d.groupBy(F.col(place).alias("place"), F.col(longitude).alias("long"), F.col(latitude).alias("lat")).agg(F.count_distinct(entity).alias("n"))


def per_decade(df: DataFrame, year: str, entity: str) -> DataFrame:
    """decade, n"""
    return df.where(F.col(year).isNotNull()).groupBy(decade(year).alias("decade")).agg(F.count_distinct(entity).alias("n"))
