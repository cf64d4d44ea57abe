"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

Words are turned into a template: numbers become <num>, a unit after a number becomes <unit>, a capitalised word inside
a sentence becomes <name>; other words are lower-cased and freed of outer punctuation. Windows of five template words of
the documents meet those of the benchmark in a hash join. A question that was given other numbers or names still has
its template windows; the slot check then asks whether each of the item's slot values stands for one value in the
document and the other way round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.llm.common import meet, only, stage, without

WINDOW = 5
CONTAINMENT = 0.5
#: Units of measure and money that may follow a number.
UNITS = (
    "mm cm m km inch inches ft foot feet yard yards mile miles mg g kg t ton tons lb lbs oz ml l litre litres liter liters "
    "s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
    "percent % usd eur gbp dollar dollars euro euros pound pounds cent cents degree degrees c f k w kw mw v a hz khz mhz ghz "
    "b kb mb gb tb mph kmh"
).split()
#: Placeholders that stand for a value.
SLOTS = ("<num>", "<unit>", "<name>")
TRIM = " \t.,;:!?\"'()[]{}<>*#$%&+=_~`|/\\-"


def _tokens(text):
    return F.filter(F.split(text, "[\\x20\\x09-\\x0D]+", -1), lambda x: x != "")


def template(raw):
    """Template words of an array of raw words. Each word is trimmed once: lambdas are interpreted and share no results."""
    units = F.array(*[F.lit(u) for u in UNITS])

    def one(bare, i):
        before = F.try_element_at(raw, F.greatest(i, F.lit(1)))
        end = F.substring(before, -1, 1)
        number = (bare >= "0") & (bare < ":")
        # The last sign rules most words out before the pattern is tried.
        after_number = (i > 0) & end.isin(*"0123456789.,") & before.rlike("[0-9][0-9.,]*$")
        lower = F.lower(bare)
        first, rest = F.substring(bare, 1, 1), F.substring(bare, 2, 1_000_000_000)
        small = (bare >= "a") & (bare < "{")  # most words begin with a small letter and are no names
        name = ~small & (first != F.lower(first)) & (F.length(bare) > 1) & (i > 0) & ~end.isin(".", "!", "?", ":") & (rest == F.lower(rest))
        return (
            F.when(number, F.lit("<num>"))
            .when(after_number & F.array_contains(units, lower), F.lit("<unit>"))
            .when(name, F.lit("<name>"))
            .otherwise(lower)
        )

    return F.transform(F.transform(raw, lambda w: F.btrim(w, F.lit(TRIM))), one)


def _windows(df: DataFrame, words: str, window: int, at: str) -> DataFrame:
    """df with a row for each window of its words: the place (from 0) and the key, a hash of the window's words.

    A shorter text is one window of all its words, a text without words has none. Only places are exploded, so that
    the keys are made in compiled code.
    """
    n, w = F.size(words), F.col(words)
    places = F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - window, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    rows = df.withColumn(at, F.explode(places))
    wide = F.xxhash64(*[F.get(w, F.col(at) + j) for j in range(window)])
    return rows.withColumn("key", F.when(n >= window, wide).otherwise(F.xxhash64(F.array_join(w, " "))))


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, item_id, matched, windows, consistent: the documents that hold a benchmark item, once per pair.

    matched of the item's `windows` distinct template windows stand in the document with consistent slots; a pair is
    reported when matched >= containment * windows. Null ids and null, empty or wordless texts match nothing; an item
    of fewer than `window` words is one window, which only a document of exactly these words holds. Rows repeating an
    id are read as one more passage of it. Other columns are ignored. Empty tables give no rows.
    The benchmark side is staged and grows with the benchmark only, so its size is known when the join is planned.
    """
    d = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long"), _tokens(F.col("text").cast("string")).alias("raw"))
    items = items.where(F.size("raw") > 0).withColumn("words", template(F.col("raw")))
    seeds = _windows(items, "words", window, "ipos")
    seeds = stage(seeds.select("item_id", "ipos", "key", _cut("words", "ipos", window).alias("kinds"), _cut("raw", "ipos", window).alias("asked")))
    keys = stage(seeds.select("key").distinct())
    sizes = seeds.groupBy("item_id").agg(F.count_distinct("key").alias("windows"))

    d = d.select("doc_id", F.xxhash64("text").alias("version"), "text")  # rows of one doc_id can have several texts
    made = d.select("doc_id", "version", _tokens(F.col("text")).alias("raw")).select("doc_id", "version", template(F.col("raw")).alias("words"))
    hits = stage(_windows(made, "words", window, "dpos").select("doc_id", "version", "dpos", "key").join(keys, "key", "left_semi"))
    # Each window counts once for a document and once for an item, so a common window isn't multiplied by its places; a
    # window that many documents hold is dealt over several tasks.
    held = stage(hits.select("doc_id", "key").distinct())
    of = stage(seeds.groupBy("key").agg(F.collect_set("item_id").alias("items")))  # bounded by the benchmark
    pairs = meet(held, of, ["key"]).select("doc_id", F.explode("items").alias("item_id"))
    enough = pairs.groupBy("doc_id", "item_id").agg(F.count("*").alias("n")).join(sizes, "item_id")
    enough = stage(enough.where(F.col("n") >= containment * F.col("windows")).select("doc_id", "item_id", "windows"))

    # Slot check, on candidates only. The words of a window are cut out where they meet it; no text goes on with them.
    some = only(d, stage(enough.select("doc_id").distinct()), "doc_id")
    raws = some.dropDuplicates(["doc_id", "version"]).select("doc_id", "version", _tokens(F.col("text")).alias("draw"))
    near = hits.join(enough, "doc_id").join(seeds, ["item_id", "key"])
    near = stage(near.withColumn("shift", F.col("dpos") - F.col("ipos")))
    slotted = near.where(F.exists("kinds", lambda x: x.isin(*SLOTS))).join(raws, ["doc_id", "version"])
    at = ["doc_id", "version", "item_id", "shift"]
    slot = slotted.select(*at, F.explode(F.arrays_zip("kinds", "asked", _cut("draw", "dpos", window).alias("found"))).alias("w"))
    bare = lambda c: F.btrim(F.lower(c), F.lit(TRIM))
    slot = slot.select(*at, F.col("w.kinds").alias("kind"), bare(F.col("w.asked")).alias("asked"), bare(F.col("w.found")).alias("found"))
    slot = slot.where(F.col("kind").isin(*SLOTS)).distinct()
    to = slot.groupBy(*at, "kind", "asked").agg(F.count("*").alias("c"))
    fro = slot.groupBy(*at, "kind", "found").agg(F.count("*").alias("c"))
    broken = to.where("c > 1").select(*at).unionByName(fro.where("c > 1").select(*at)).distinct()
    good = near.join(broken.withColumn("bad", F.lit(True)), at, "left")
    out = good.groupBy("doc_id", "item_id", "windows").agg(
        F.count_distinct(F.when(F.col("bad").isNull(), F.col("key"))).alias("matched"),
        F.max(F.col("bad").isNull()).alias("consistent"),
    )
    return out.where(F.col("matched") >= containment * F.col("windows")).select("doc_id", "item_id", "matched", "windows", "consistent")


def _cut(words: str, at: str, window: int):
    """The words of the window that begins at this place, counted from 0."""
    return F.slice(words, F.col(at) + 1, F.lit(window))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, containment: float = CONTAINMENT) -> DataFrame:
    """docs without the rows that hold a benchmark item; all columns are kept as they are."""
    return without(docs, leaks(docs, benchmark, window, containment), "doc_id")


def best_leak(found: DataFrame) -> DataFrame:
    """Of each document the item that it holds most of."""
    order = Window.partitionBy("doc_id").orderBy(F.desc(F.col("matched") / F.col("windows")), "item_id")
    return found.withColumn("r", F.row_number().over(order)).where("r = 1").drop("r")
