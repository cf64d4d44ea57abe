"""Variants of one name brought to one form."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions.text import ratio, ratio_at_most
from foliant.operators.components import connected

THRESHOLD = 0.87
LARGEST_BLOCK = 500
TILE = 64


def by_key(values: DataFrame) -> DataFrame:
    """values: raw, harmonised, key, n (distinct raw values). Adds canonical: the form that most rows of the key have.

    Equal counts go to the smallest form. A NULL or empty key is no key: such rows keep their form.
    """
    forms = values.where("key IS NOT NULL AND key != ''").groupBy("key", "harmonised").agg(F.sum("n").alias("n"))
    best = forms.groupBy(F.col("key").alias("_key")).agg(F.min_by("harmonised", F.struct((-F.col("n")).alias("a"), F.col("harmonised").alias("b"))).alias("_form"))
    joined = values.join(best, F.col("key") == F.col("_key"), "left")
    return joined.withColumn("canonical", F.coalesce("_form", "harmonised")).drop("_key", "_form")


def _similar(pairs: DataFrame, threshold: float) -> DataFrame:
    """a, b of two tiles of keys whose ratio reaches the threshold; lengths rule out most pairs first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for same, xs, ys in zip(pdf["same"], pdf["xs"], pdf["ys"], strict=True):
                for i, a in enumerate(xs):
                    for b in ys[i + 1 :] if same else ys:
                        p, q = (a, b) if a < b else (b, a)
                        if ratio_at_most(p, q) >= threshold and ratio(p, q) >= threshold:
                            out.append((p, q))
            yield pd.DataFrame(out, columns=["a", "b"])

    return pairs.mapInPandas(run, "a string, b string")


def by_similarity(keys: DataFrame, threshold: float = THRESHOLD, largest: int = LARGEST_BLOCK) -> DataFrame:
    """keys: key, n (one row per key). Returns key, canonical: the most frequent key of the cluster, of equals the largest.

    Keys with the same first four letters form a block; clusters are the components of pairs at or above the
    threshold. Blocks of more than `largest` keys are left as they are: a rule of the operator, not a safeguard. A block is cut into
    tiles of TILE keys and tiles meet tiles, so a task holds two tiles at a time.
    """
    k = keys.where("key IS NOT NULL AND key != ''").withColumn("block", F.substring("key", 1, 4))
    sizes = k.groupBy("block").agg(F.count("*").alias("size")).where((F.col("size") > 1) & (F.col("size") <= largest))
    tiled = k.join(sizes, "block").withColumn("tile", F.pmod(F.xxhash64("key"), F.ceil(F.col("size") / TILE)))
    tiles = tiled.groupBy("block", "tile").agg(F.array_sort(F.collect_list("key")).alias("xs"))
    other = tiles.select("block", F.col("tile").alias("tile2"), F.col("xs").alias("ys"))
    pairs = tiles.join(other, "block").where("tile <= tile2").select((F.col("tile") == F.col("tile2")).alias("same"), "xs", "ys")
    labels = connected(_similar(pairs, threshold))
    members = labels.join(keys.select(F.col("key").alias("node"), "n"), "node")
    best = members.groupBy("label").agg(F.max_by("node", F.struct("n", "node")).alias("canonical"))
    return keys.select("key").join(labels, F.col("key") == F.col("node"), "left").join(best, "label", "left").select("key", F.coalesce("canonical", "key").alias("canonical"))


def oversized_blocks(keys: DataFrame, largest: int = LARGEST_BLOCK) -> DataFrame:
    """Blocks that by_similarity leaves as they are."""
    return keys.groupBy(F.substring("key", 1, 4).alias("block")).agg(F.count("*").alias("size")).where(F.col("size") > largest)
