"""Harmonised tables made ready for the mapping rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions.iri import authority_iri, base_iri, clean_iri, fragment, valid_iris, wkt_point, xsd_date_time
from foliant.graph.mapping import PREFIXES, ROLE_TERMS, expand
from foliant.nulls import fold, with_columns

#: Names of the nodes and of the fields that the mapping rules read.
ACTOR_NODES = {
    "actor_app_fullname": "app_fullname", "actor_app_firstname": "app_firstname", "actor_app_lastname": "app_lastname",
    "actor_gender_aa": "gender_aa", "actor_language_aa": "language_aa", "actor_profession_lo": "profession_lo",
    "actor_birth_event": "birth", "actor_birth_ts": "birth_ts", "actor_death_event": "death", "actor_death_ts": "death_ts",
    "actor_start_event": "start", "actor_start_ts": "start_ts", "actor_end_event": "end", "actor_end_ts": "end_ts",
}
EDITION_NODES = {
    "edition_bnf_id": "bnf_id", "edition_title": "title", "edition_ts_year_first": "ts_year_first", "edition_ts_year_range": "ts_year_range",
    "edition_pub_place": "pub_place", "edition_pub_place_app": "pub_place_app", "edition_pub_place_norm_app": "pub_place_norm_app",
    "edition_pub_actor": "pub_actor", "edition_pub_actor_app": "pub_actor_app", "edition_pub_actor_norm_app": "pub_actor_norm_app",
    "edition_digital_obj": "digital_obj", "edition_digital_id": "digital_id", "edition_expr_creation": "expr_creation",
    **{f"edition_expr_creation_{r}": f"expr_creation_{r}" for r in ROLE_TERMS},
}
ACTOR_FIELDS = [
    "actor", "entity_type", "actor_name", "actor_first_name", "actor_last_name", "actor_birth", "actor_death", "actor_start", "actor_end",
    "actor_gender", "actor_language", "actor_country", "actor_profession", "actor_link_exact", "actor_link_close", "viaf_id", "qid", "isni", "lc_id",
]
EDITION_FIELDS = [
    "edition", "bnf_id", "title", "year_first", "year_range", "description", "place", "publication_place", "longitude", "latitude", "publisher",
    "publisher_harmonised", "publisher_2", "work", "expression", "language", "record_type", "digital_copy_link", "subject_topic",
    "author", "editor", "translator", "illustrator", "estc_id",
]


def actors(df: DataFrame, prefixes: dict[str, str] | None = None) -> DataFrame:
    """Columns that the actor rules read; rows without a valid actor IRI are left out. Organisations alone have start and end."""
    names = PREFIXES | (prefixes or {})
    d = with_columns(df, ACTOR_FIELDS).select(*[fold(F.col(c).cast("string"), "graph").alias(c) for c in ACTOR_FIELDS])
    d = d.withColumn("actor", clean_iri("actor")).where("actor IS NOT NULL").withColumn("_base", base_iri("actor"))
    kind = F.element_at(F.split(F.regexp_replace("entity_type", "[<>]", ""), "[/#]"), -1)
    d = d.withColumn("entity_type", F.when(kind == "Person", expand("obj:Person", names)).when(kind == "Organization", expand("obj:Organization", names)).otherwise(F.col("entity_type")))
    group = F.coalesce(F.col("entity_type") == expand("obj:Organization", names), F.lit(False))
    person = F.coalesce(F.col("entity_type") == expand("obj:Person", names), F.lit(False))
    gender = F.lower("actor_gender")
    made = {n: fragment("_base", f) for n, f in ACTOR_NODES.items()} | {
        "actor_if_person": F.when(person, F.col("actor")), "actor_if_organization": F.when(group, F.col("actor")),
        "actor_gender_obj": F.when(gender == "male", expand("obj:male", names)).when(gender == "female", expand("obj:female", names)),
        "actor_birth_obj": xsd_date_time("actor_birth"), "actor_death_obj": xsd_date_time("actor_death"),
        "actor_start_obj": F.when(group, xsd_date_time("actor_start")), "actor_end_obj": F.when(group, xsd_date_time("actor_end")),
        "actor_country": clean_iri("actor_country"), "actor_language": clean_iri("actor_language"),
        "viaf_uri": authority_iri("viaf", "viaf_id"), "wikidata_uri": authority_iri("wikidata", "qid"),
        "isni_uri": authority_iri("isni", "isni"), "lc_uri": authority_iri("lc", "lc_id"),
    }
    return d.withColumns(made).drop("_base")


def actor_links(df: DataFrame, column: str, order: str | None = None) -> DataFrame:
    """actor, n, column: every valid link of a multi-valued cell, numbered per actor by the rows' order, without one by the cells' values."""
    d = df.select(clean_iri("actor").alias("actor"), (F.col(order) if order else F.lit(0)).alias("at"), valid_iris(column).alias("v")).where("actor IS NOT NULL")
    cells = F.array_sort(F.collect_list(F.struct("at", "v")))
    links = d.groupBy("actor").agg(F.array_distinct(F.flatten(F.transform(cells, lambda x: x["v"]))).alias("v"))
    return links.select("actor", F.posexplode("v").alias("n", column)).withColumn("n", F.col("n") + 1)


def editions(df: DataFrame) -> DataFrame:
    """Columns that the edition rules read; of multi-valued IRI cells the first valid one counts."""
    d = with_columns(df, EDITION_FIELDS).select(*[fold(F.col(c).cast("string"), "graph").alias(c) for c in EDITION_FIELDS])
    d = d.withColumn("edition", clean_iri("edition")).where("edition IS NOT NULL").withColumn("_base", base_iri("edition"))
    iris = ["work", "expression", "language", "record_type", "digital_copy_link", "subject_topic", "publisher_2", *ROLE_TERMS]
    made = {n: fragment("_base", f) for n, f in EDITION_NODES.items()} | {c: F.try_element_at(valid_iris(c), F.lit(1)) for c in iris} | {
        "year_range": F.coalesce("year_range", "year_first"), "place_wkt": wkt_point("longitude", "latitude"),
        "estc_uri": F.concat(F.lit("https://estc.bl.uk/"), F.col("estc_id")),
    }
    return d.withColumns(made).drop("_base")


def roles(edges: DataFrame, prefixes: dict[str, str] | None = None) -> DataFrame:
    """Role edges (actor_iri, edition_iri, role) with the nodes of the role rules; equal rows once.

    One activity stands for a role on an edition, whoever holds it.
    """
    names = PREFIXES | (prefixes or {})
    base = base_iri("edition_iri")
    term = F.create_map(*[F.lit(x) for r, t in ROLE_TERMS.items() for x in (r, expand(t, names))])[F.col("role")]
    d = edges.select("actor_iri", "edition_iri", "role").where("actor_iri IS NOT NULL AND edition_iri IS NOT NULL").distinct()
    return d.withColumns({"edition_base": base, "edition_expr_creation": fragment(base, "expr_creation"), "role_activity_iri": F.concat(base, F.lit("#expr_creation_"), F.col("role")), "role_aat": term})


def linked_sample(editions_: DataFrame, edges: DataFrame, key: str, n: int, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """n seed actors by hash, the editions they had a part in, and all actors of those editions."""
    from foliant.operators.sampling import seeded

    seeds = seeded(edges.select("actor").distinct(), "actor", n, seed)
    chosen = edges.join(seeds, "actor", "left_semi").select("edition").distinct()
    people = edges.join(chosen, "edition", "left_semi").select("actor").distinct()
    return editions_.join(chosen, editions_[key] == chosen["edition"], "left_semi"), people
