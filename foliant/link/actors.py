"""Persons of one catalogue matched to those of another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.nulls import col

#: What a match type is worth, best first, and which may be published.
PRIORITY = {"viaf_id": 0, "name_and_dates": 1, "ambiguous_name_and_dates": 2, "ambiguous_name_only": 3, "unmatched": 4}
CONFIDENT = ("viaf_id", "name_and_dates")
REVIEW = ("ambiguous_name_and_dates", "ambiguous_name_only")


def dates_compatible(birth: Column, death: Column, other_birth: Column, other_death: Column, window: int) -> Column:
    """TRUE: all comparable years lie within the window; FALSE: one doesn't; NULL: nothing to compare."""
    near_birth, near_death = F.abs(birth - other_birth) <= window, F.abs(death - other_death) <= window
    return F.when(near_birth.isNull() & near_death.isNull(), F.lit(None).cast("boolean")).otherwise(F.coalesce(near_birth, F.lit(True)) & F.coalesce(near_death, F.lit(True)))


def match(actors: DataFrame, others: DataFrame, window: int = 2) -> DataFrame:
    """actors: actor, viaf_ids (array), name_key (sorted words), birth, death. others: other_id, row_no, viaf, name_key, birth, death.

    1. The smallest of an actor's VIAF ids that the other side has; there the first row. 2. Equal name keys with
    compatible dates: one is a match, several are ambiguous. 3. Equal name keys without any date: ambiguous.
    Both are equi-joins, folded into one row per actor. Returns actor, other_id, match_type, confidence, candidates.
    """
    by_id = others.where("viaf IS NOT NULL").groupBy("viaf").agg(F.min_by("other_id", "row_no").alias("other_id"), F.count("*").alias("c"))
    ids = actors.select("actor", F.explode("viaf_ids").alias("viaf")).join(by_id, "viaf")
    first = ids.groupBy("actor").agg(F.min_by(F.struct("other_id", "c"), "viaf").alias("v"))
    rest = actors.join(first.select("actor"), "actor", "left_anti").where(F.size("name_key") > 0)
    o = others.where(F.size("name_key") > 0).select("name_key", "other_id", "row_no", F.col("birth").alias("ob"), F.col("death").alias("od"))
    pairs = rest.join(o, "name_key").withColumn("ok", dates_compatible(F.col("birth"), F.col("death"), F.col("ob"), F.col("od"), window))
    seen = pairs.groupBy("actor").agg(
        F.count_if("ok").alias("accepted"), F.count_if(F.col("ok").isNull()).alias("open"), F.min_by("other_id", F.when(F.col("ok"), F.col("row_no"))).alias("first_id")
    )
    out = actors.select("actor").join(first, "actor", "left").join(seen, "actor", "left")
    kind = (
        F.when(F.col("v").isNotNull(), "viaf_id")
        .when(F.col("accepted") == 1, "name_and_dates")
        .when(F.col("accepted") > 1, "ambiguous_name_and_dates")
        .when(F.col("open") > 0, "ambiguous_name_only")
        .otherwise("unmatched")
    )
    worth = F.create_map(*[F.lit(x) for kv in {"viaf_id": 1.0, "name_and_dates": 0.9, "ambiguous_name_and_dates": 0.5, "ambiguous_name_only": 0.3, "unmatched": 0.0}.items() for x in kv])
    return out.select(
        "actor",
        F.when(F.col("v").isNotNull(), F.col("v.other_id")).when(F.col("accepted") > 0, F.col("first_id")).alias("other_id"),
        kind.alias("match_type"),
        worth[kind].alias("confidence"),
        F.when(F.col("v").isNotNull(), F.col("v.c")).otherwise(F.coalesce("accepted", F.lit(0))).cast("long").alias("candidates"),
    )


def collapse(results: DataFrame, canonical: DataFrame, order: str = "actor") -> DataFrame:
    """One result per canonical actor: the best match type, then the highest confidence, then the first row.

    canonical: actor, canonical_actor; actors that it lacks stand for themselves.
    """
    rank = F.create_map(*[F.lit(x) for kv in PRIORITY.items() for x in kv])[F.col("match_type")]
    j = results.join(canonical.select(F.col("actor").alias("_a"), F.col("canonical_actor").alias("_c")), F.col("actor") == F.col("_a"), "left")
    j = j.withColumn("_c", F.coalesce("_c", "actor")).withColumn("_o", F.col(order))
    rest = [c for c in results.columns if c != "actor"]
    best = j.groupBy("_c").agg(F.min_by(F.struct(*rest, F.col("actor").alias("_from")), F.struct(F.coalesce(rank, F.lit(99)).alias("a"), (-F.col("confidence")).alias("b"), F.col("_o").alias("c"))).alias("r"))
    return best.select(F.col("_c").alias("actor"), *[F.col(f"r.{c}").alias(c) for c in rest], F.when(F.col("r._from") != F.col("_c"), F.col("r._from")).alias("taken_from"))


def split(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Results to publish, and results to review; unmatched rows are in neither."""
    return results.where(col("match_type").isin(*CONFIDENT)), results.where(col("match_type").isin(*REVIEW))


def enrich(actors: DataFrame, matches: DataFrame, prefix: str = "other") -> DataFrame:
    """Actors with <prefix>_id of confident matches, <prefix>_candidate_id of the others, match type and confidence."""
    sure = F.col("match_type").isin(*CONFIDENT)
    m = matches.select(
        F.col("actor").alias("_k"), F.when(sure, F.col("other_id")).alias(f"{prefix}_id"), F.when(~sure, F.col("other_id")).alias(f"{prefix}_candidate_id"),
        F.col("match_type").alias(f"{prefix}_match_type"), F.col("confidence").alias(f"{prefix}_confidence"),
    )
    return actors.join(m, actors["actor"] == F.col("_k"), "left").drop("_k")
