"""Actors that are one person."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.operators.components import connected

LARGEST_GROUP = 200


def same_persons(actors: DataFrame, fields: list[str], largest: int = LARGEST_GROUP) -> DataFrame:
    """actors: actor, name (for grouping), links (array), birth, death and the fields that make a record rich; one row per actor.

    Actors of one name are linked by a shared link or by equal birth and death. Evidence is joined, not paired: a
    link or a pair of dates is linked to the first actor of the name that has it. Returns, for names on several rows,
    actor, cluster_id, canonical_actor, is_canonical, match_type, confidence, name. Names on more than `largest` rows
    are ambiguous as a whole (a rule of the operator); actors without evidence are ambiguous_name_only.
    """
    named = actors.where("name IS NOT NULL AND actor IS NOT NULL")
    sizes = named.groupBy("name").agg(F.count("*").alias("size")).where("size > 1")
    grouped = named.join(sizes, "name")
    small = grouped.where(F.col("size") <= largest)
    by_link = small.select("name", "actor", F.explode(F.array_distinct("links")).alias("value")).withColumn("reason", F.lit("shared_external_link"))
    by_date = small.where("birth IS NOT NULL AND death IS NOT NULL").select("name", "actor", F.concat_ws("|", "birth", "death").alias("value"), F.lit("matching_dates").alias("reason"))
    evidence = by_link.unionByName(by_date)
    first = evidence.groupBy("name", "reason", "value").agg(F.min("actor").alias("head"), F.count_distinct("actor").alias("c")).where("c > 1").drop("c")
    edges = evidence.join(first, ["name", "reason", "value"])
    labels = connected(edges.select(F.col("actor").alias("a"), F.col("head").alias("b")))
    reasons = edges.join(labels, F.col("actor") == F.col("node")).groupBy("label").agg(F.array_join(F.array_sort(F.collect_set("reason")), "+").alias("reasons"))
    filled = sum((F.col(f).isNotNull().cast("int") for f in fields), F.lit(0))
    rows = grouped.select("name", "actor", filled.alias("filled")).join(labels, F.col("actor") == F.col("node"), "left").join(reasons, "label", "left")
    best = Window.partitionBy("name", "label").orderBy(F.desc("filled"), "actor")
    rows = rows.withColumn("canonical_actor", F.when(F.col("label").isNull(), F.col("actor")).otherwise(F.first("actor").over(best)))
    return rows.select(
        "actor",
        F.when(F.col("label").isNotNull(), F.concat(F.col("name"), F.lit("::"), F.col("label").cast("string"))).alias("cluster_id"),
        "canonical_actor",
        (F.col("actor") == F.col("canonical_actor")).alias("is_canonical"),
        F.coalesce("reasons", F.lit("ambiguous_name_only")).alias("match_type"),
        F.when(F.col("label").isNotNull(), "high").otherwise("low").alias("confidence"),
        "name",
    )
