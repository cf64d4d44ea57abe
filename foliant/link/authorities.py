"""Authority files given as tables: source id first, then links, then the best name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions.text import name_similarity


def by_authority(actors: DataFrame, by_source: DataFrame, names: DataFrame, threshold: float = 0.85) -> DataFrame:
    """actors: actor, source_id, linked_id, name, name_token. by_source: source_id, authority_id. names: name_token, authority_id, heading.

    Returns actor, authority_id, match_type (source_id, link, name_search, unmatched), confidence; each later step only
    for what the earlier ones leave. Of equal scores the smaller authority_id wins.
    """
    a = actors.join(by_source.groupBy("source_id").agg(F.min("authority_id").alias("by_source")), "source_id", "left")
    rest = a.where("by_source IS NULL AND linked_id IS NULL AND name IS NOT NULL").select("actor", "name", "name_token")
    scored = rest.join(names, "name_token").withColumn("s", name_similarity("name", "heading")).where(F.col("s") >= threshold)
    best = scored.groupBy("actor").agg(F.min_by(F.struct("authority_id", "s"), F.struct((-F.col("s")).alias("x"), "authority_id")).alias("b"))
    j = a.join(best, "actor", "left")
    kind = F.when(F.col("by_source").isNotNull(), "source_id").when(F.col("linked_id").isNotNull(), "link").when(F.col("b").isNotNull(), "name_search").otherwise("unmatched")
    return j.select(
        "actor", F.coalesce("by_source", "linked_id", "b.authority_id").alias("authority_id"), kind.alias("match_type"),
        F.when(kind.isin("source_id", "link"), 1.0).otherwise(F.coalesce("b.s", F.lit(0.0))).alias("confidence"),
    )


def merge_resolved(audit: DataFrame, resolved: DataFrame, unresolved: tuple[str, ...]) -> DataFrame:
    """Values that rules left open, replaced from a table of resolutions (original, resolved) as `llm_resolved`, confidence medium.

    audit: original, harmonised, correction_type, confidence. Whoever fills the table is outside the engine.
    """
    r = resolved.where("resolved IS NOT NULL").groupBy(F.col("original").alias("_o")).agg(F.min("resolved").alias("_r"))
    open_ = F.col("correction_type").isin(*unresolved) & F.col("_r").isNotNull()
    return audit.join(r, audit["original"] == F.col("_o"), "left").withColumns(
        {"harmonised": F.when(open_, F.col("_r")).otherwise(F.col("harmonised")), "confidence": F.when(open_, "medium").otherwise(F.col("confidence")), "correction_type": F.when(open_, "llm_resolved").otherwise(F.col("correction_type"))}
    ).select(*audit.columns)


def residual(audit: DataFrame, unresolved: tuple[str, ...], known: DataFrame | None = None) -> DataFrame:
    """Distinct originals still open, without those that a cache of answers holds."""
    out = audit.where(F.col("correction_type").isin(*unresolved)).select("original").where("original IS NOT NULL").distinct()
    return out if known is None else out.join(known.select("original"), "original", "left_anti")
