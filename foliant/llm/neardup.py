"""Near-duplicate groups by MinHash bands, sequential Bayesian pruning and exact verification.

1. Every text becomes its set of distinct word shingles (64-bit hashes). Equal sets form classes first, so thousands
   of exact copies cost one signature.
2. A class representative has BANDS x ROWS minimum hashes. Two sets of similarity 0.8 share no band with probability
   (1 - 0.8^7)^52 = 5e-6, more similar ones far less; unrelated texts (0.07 here) share one with probability 4e-7.
3. Candidates of a bucket are compared with a hub of that bucket, not with each other. Where a bucket still spans
   several components after HUB_ROUNDS hubs, the documents of the buckets that hang together form a family; every
   member outside the family's main component meets all members in blocks inside numpy, so no link is lost and no
   bucket is expanded into pairs of rows.
4. Two signatures are compared batch after batch; a pair is dropped as soon as the posterior probability that its
   similarity reaches the threshold falls below MISS (uniform prior).
5. Survivors are verified on their full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import BROADCAST_ROWS, components, forget, meet, only, stage, tidy, without

BANDS, ROWS = 52, 7
MISS = 1e-6
STEP = 52
HUB_ROUNDS = 2
BLOCK = 128
BLOCK_SHINGLES = 200_000
TRACE = "doc_id long, version long, n_shingles long, h1 long, h2 long, sig binary, bands array<long>"


def shingler(k: int):
    """A function from text to its sorted distinct shingle hashes (uint64).

    A-Z are lower-cased, words are runs of anything but ASCII white space; fewer than k words make one shingle.
    """
    import xxhash

    class Ids(dict):
        def __missing__(self, word: bytes) -> int:
            if len(self) >= 500_000:
                self.clear()
            value = self[word] = xxhash.xxh64_intdigest(word)
            return value

    ids = Ids()
    mix1, mix2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
    shift = np.uint64(32)

    def sets(text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.empty(0, dtype=np.uint64)
        get = ids.__getitem__
        w = np.fromiter((get(x) for x in words), dtype=np.uint64, count=len(words))
        width = min(k, len(w))
        h = np.full(len(w) - width + 1, width, dtype=np.uint64)
        for i in range(width):
            h = (h ^ w[i : len(w) - width + 1 + i]) * mix1
            h ^= h >> shift
            h *= mix2
            h ^= h >> shift
        return np.unique(h)

    return sets


def multipliers(n: int) -> np.ndarray:
    return (np.random.default_rng(20240607).integers(1, 2**32, n, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)


def signature(shingles: np.ndarray, mult: np.ndarray) -> np.ndarray:
    """Minimum of the multiplied 32-bit hashes, per multiplier."""
    low = (shingles >> np.uint64(16)).astype(np.uint32)[:, None]
    best = np.full(len(mult), 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(low), 128):
        np.minimum(best, (low[at : at + 128] * mult).min(axis=0), out=best)
    return best


def least_matches(threshold: float, n_hashes: int, step: int, miss: float) -> list[tuple[int, int]]:
    """For each prefix of the signature: the matches under which P(similarity >= threshold) < miss.

    Signatures keep one byte per hash, so two hashes agree with probability p = s + (1 - s) / 256. The prior of s is
    uniform; the posterior is integrated numerically.
    """
    s = (np.arange(20_000) + 0.5) / 20_000
    p = s + (1 - s) / 256
    out = []
    for n in range(step, n_hashes + 1, step):
        need = 0
        for m in range(n + 1):
            log = m * np.log(p) + (n - m) * np.log1p(-p)
            w = np.exp(log - log.max())
            if w[s >= threshold].sum() / w.sum() >= miss:
                need = m
                break
        out.append((n, need))
    return out


def traces(docs: DataFrame, k: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, a hash of the text, set size, a 128-bit digest of the set, one-byte signature, band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        forget()
        sets, mult = shingler(k), multipliers(bands * rows)
        salt = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        step = np.uint64(0xD6E8FEB86659FD93)
        for batch in batches:
            n, h1, h2, sig, keys = [], [], [], [], []
            for text in batch.column(1):
                s = sets(text.as_py())
                both = xxhash.xxh128_intdigest(s.tobytes())
                n.append(len(s))
                h1.append((both >> 64) - 2**63)
                h2.append((both & (2**64 - 1)) - 2**63)
                m = signature(s, mult) if len(s) else np.zeros(bands * rows, dtype=np.uint32)
                sig.append(m.astype(np.uint8).tobytes())
                key = salt.copy()
                for c in m.reshape(bands, rows).T.astype(np.uint64):
                    key = (key ^ c) * step
                    key ^= key >> np.uint64(29)
                keys.append(key.view(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()),
                 pa.array(sig, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "version", "n_shingles", "h1", "h2", "sig", "bands"],
            )
        tidy()

    return _versions(docs).mapInArrow(run, TRACE)


def _versions(docs: DataFrame) -> DataFrame:
    """doc_id, text and the text's hash, which tells the rows of one doc_id apart."""
    d = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return d.withColumn("version", F.xxhash64("text"))


def _rows_of(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """One row per node of marks (node, doc_id, version; staged): that of its representative."""
    side = F.broadcast(marks) if marks.count() <= BROADCAST_ROWS // 2 else marks
    return rows.join(side, ["doc_id", "version"]).drop("doc_id", "version").dropDuplicates(["node"])


def _marks(marks: DataFrame, nodes: DataFrame) -> DataFrame:
    return stage(marks.select("node", "doc_id", "version").join(nodes, "node", "left_semi"))


def _both_ends(pairs: DataFrame) -> DataFrame:
    return pairs.select("node").unionByName(pairs.select(F.col("hub").alias("node"))).distinct()


def _pruned(pairs: DataFrame, reps: DataFrame, marks: DataFrame, threshold: float, bands: int, rows: int) -> DataFrame:
    """Sequential comparison of both signatures; pairs node, hub that may reach the threshold stay."""
    tests = least_matches(threshold, bands * rows, STEP, MISS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("sig", "hub_sig"))
            alive, agreed, done = np.arange(batch.num_rows), np.zeros(batch.num_rows, dtype=np.int64), 0
            for n, need in tests:
                agreed[alive] += (x[alive, done:n] == y[alive, done:n]).sum(axis=1)
                alive, done = alive[agreed[alive] >= need], n
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(alive)) for c in ("node", "hub")], ["node", "hub"])

    mine = _rows_of(reps, _marks(marks, _both_ends(pairs)))
    hubs = mine.select(F.col("node").alias("hub"), F.col("sig").alias("hub_sig"), F.col("n_shingles").alias("hub_n"))
    both = meet(pairs, hubs, ["hub"]).join(mine, "node")
    fits = F.least("n_shingles", "hub_n") >= threshold * F.greatest("n_shingles", "hub_n") - 1e-9
    return both.where(fits).select("node", "hub", "sig", "hub_sig").mapInArrow(run, "node long, hub long")


def _verified(pairs: DataFrame, texts: DataFrame, marks: DataFrame, k: int, percent: int) -> DataFrame:
    """a, b: the pairs whose full sets have 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = shingler(k)
        kept: dict[int, np.ndarray] = {}

        def of(node: int, text: str) -> np.ndarray:
            if node not in kept:
                if len(kept) >= 64:
                    kept.pop(next(iter(kept)))
                kept[node] = sets(text)
            return kept[node]

        for batch in batches:
            ok = []
            for a, b, ta, tb in zip(*(batch.column(c).to_pylist() for c in ("node", "hub", "text", "hub_text")), strict=True):
                x, y = of(a, ta), of(b, tb)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            take = pa.array(np.flatnonzero(ok), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(c).take(take) for c in ("node", "hub")], ["a", "b"])
        kept.clear()
        tidy()

    mine = _rows_of(texts, _marks(marks, _both_ends(pairs)))
    hubs = mine.select(F.col("node").alias("hub"), F.col("text").alias("hub_text"))
    both = meet(pairs, hubs, ["hub"]).join(mine, "node")
    return both.select("node", "hub", "text", "hub_text").mapInArrow(run, "a long, b long")


def _families(active: DataFrame, reps: DataFrame, texts: DataFrame, marks: DataFrame, k: int, percent: int, bands: int, rows: int) -> DataFrame:
    """Verified links a, b between nodes of different labels, each outside member of a family against all members.

    Members come in blocks; every pair of an outside block and a block of the same family is a row of its own key.
    """
    tests = least_matches(percent / 100, bands * rows, STEP, MISS)
    threshold = percent / 100
    firsts = active.groupBy("key").agg(F.min("node").alias("b"))
    together = components(meet(active.select("key", F.col("node").alias("a")), firsts, ["key"]).select("a", "b"))
    alone = active.select(F.col("node").alias("n")).distinct().join(together, F.col("n") == F.col("node"), "left")
    family = alone.select(F.col("n").alias("node"), F.coalesce("label", "n").alias("family"))
    members = stage(active.select("node", "label").distinct().join(family, "node"))
    per = members.groupBy("family", "label").agg(F.count("*").alias("c"))
    main = per.groupBy("family").agg(F.max(F.struct("c", "label"))["label"].alias("main"), F.count("*").alias("labels")).where("labels > 1")
    members = stage(meet(members, stage(main.select("family", "main")), ["family"]))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made_of = shingler(k)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                made = [made_of(t.as_py()).view(np.int64) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(made, pa.list_(pa.int64()))], ["node", "shingles"])

    own = _marks(marks, members.select("node").distinct())
    sets = _rows_of(texts, own).select("node", "text").mapInArrow(read, "node long, shingles array<long>")
    full = stage(members.join(_rows_of(reps, own).select("node", "sig", "n_shingles"), "node").join(sets, "node"))
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int")
    full = meet(full, stage(full.groupBy("family").agg(blocks.alias("blocks"))), ["family"])
    full = stage(full.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")))
    item = F.struct("node", "label", "sig", "n_shingles", "shingles")
    walls = stage(full.groupBy("family", "block").agg(F.collect_list(item).alias("members")))
    asked = full.where("label != main").groupBy("family", "blocks", F.col("block").alias("from_block")).agg(F.collect_list(item).alias("asked"))
    asked = stage(asked).select("family", "asked", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for mine, wall in zip(batch.column(0), batch.column(1), strict=True):
                xs, ys = mine.values, wall.values
                sig = np.frombuffer(b"".join(ys.field("sig").to_pylist()), np.uint8).reshape(len(ys), -1)
                size, label = ys.field("n_shingles").to_numpy(), ys.field("label").to_numpy()
                ids, held = ys.field("node").to_numpy(), ys.field("shingles")
                for i in range(len(xs)):
                    x = xs[i]
                    n, own = x["n_shingles"].as_py(), np.frombuffer(x["sig"].as_py(), np.uint8)
                    fits = (label != x["label"].as_py()) & (np.minimum(size, n) >= threshold * np.maximum(size, n) - 1e-9)
                    alive, done = np.flatnonzero(fits), 0
                    agreed = np.zeros(len(ys), dtype=np.int64)
                    for upto, need in tests:
                        if not alive.size:
                            break
                        agreed[alive] += (own[done:upto] == sig[alive, done:upto]).sum(axis=1)
                        alive, done = alive[agreed[alive] >= need], upto
                    if not alive.size:
                        continue
                    mine_set = np.sort(x["shingles"].values.to_numpy())
                    theirs = held.take(pa.array(alive))
                    flat, counts = theirs.values.to_numpy(), size[alive]
                    at = np.minimum(np.searchsorted(mine_set, flat), len(mine_set) - 1)
                    both = np.add.reduceat((mine_set[at] == flat).astype(np.int64), np.cumsum(counts) - counts)
                    for j in alive[100 * both >= percent * (n + counts - both)]:
                        a.append(x["node"].as_py())
                        b.append(int(ids[j]))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return asked.join(walls, ["family", "block"]).select("asked", "members").mapInArrow(compare, "a long, b long")


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """rows with the label of their node; a node without links is its own label."""
    return rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _merged(labels: DataFrame, found: DataFrame) -> DataFrame:
    """Labels after further links: the components of the graph of labels carry over to the nodes."""
    a = _labelled(found.select(F.col("a").alias("node"), "b"), labels).select(F.col("label").alias("a"), F.col("b").alias("node"))
    joined = components(_labelled(a, labels).select("a", F.col("label").alias("b")))
    ends = found.select(F.col("a").alias("node")).unionByName(found.select(F.col("b").alias("node"))).distinct()
    alone = ends.join(labels, "node", "left_anti").withColumn("label", F.col("node"))
    moved = joined.select(F.col("node").alias("label"), F.col("label").alias("to"))
    every = stage(labels.unionByName(alone.select("node", "label")))
    stay = every.join(moved, "label", "left_anti").select("node", "label")
    return stage(meet(every, moved, ["label"]).select("node", F.col("to").alias("label")).unionByName(stay))


def _of_one_id(named: DataFrame, classes: DataFrame) -> DataFrame | None:
    """Links a, b between the classes in which one doc_id stands with differing texts; None where no id does."""
    span = named.groupBy("doc_id").agg(*[f(c).alias(f"{f.__name__}_{c}") for c in ("h1", "h2") for f in (F.min, F.max)])
    several = stage(span.where("min_h1 < max_h1 OR min_h2 < max_h2").select("doc_id"))
    if several.isEmpty():
        return None
    stands = only(named.select("doc_id", "h1", "h2"), several, "doc_id").join(classes.select("h1", "h2", "node"), ["h1", "h2"])
    stands = stage(stands.select("doc_id", F.col("node").alias("b")).distinct())
    firsts = stage(stands.groupBy("doc_id").agg(F.min("b").alias("a")))
    return meet(stands, firsts, ["doc_id"]).where("a < b").select("a", "b")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept.

    docs needs doc_id and text; other columns are ignored. Documents are linked when 100 * |intersection| is at least
    percent * |union| of their shingle sets; component_id is the smallest doc_id reachable, kept marks that document.
    A text without words (null, empty, white space) is linked with nothing. A row with a null doc_id can't be named
    as anyone's duplicate: it is returned with its own size, a null component and kept true. Rows with words that repeat
    a doc_id are one document: they share its component, which every one of their texts can extend. An empty table
    gives no rows.
    """
    threshold = percent / 100
    all_rows = stage(traces(docs, k, bands, rows))
    named = all_rows.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = named.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "version")).alias("r"), F.count("*").alias("n"))
    # Numbers of classes are fixed by writing them.
    classes = stage(classes.select("h1", "h2", "n", "r.doc_id", "r.version", F.monotonically_increasing_id().alias("node")))
    marks = classes.select("node", "doc_id", "version")
    reps = named.select("doc_id", "version", "n_shingles", "sig")
    texts = _versions(docs)
    same_id = _of_one_id(named, classes)

    side = F.broadcast(marks) if marks.count() <= BROADCAST_ROWS // 2 else marks
    active = named.select("doc_id", "version", "bands").join(side, ["doc_id", "version"])
    active = active.select(F.explode("bands").alias("key"), "node", F.col("node").alias("label"))
    labels = None
    for turn in range(HUB_ROUNDS + 1):
        if turn < HUB_ROUNDS:
            if turn == 0:  # counts are combined before the shuffle; keys of one node go with it
                hubs = active.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last"), F.count("*").alias("n")).where("hub < last")
                hubs = stage(hubs.select("key", "hub", F.col("hub").alias("hub_label"), "n"))
                keys = hubs.select("key")
                active = stage(active.join(F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys, "key", "left_semi"))
            else:
                order = F.struct(F.xxhash64("node", F.lit(turn)).alias("o"), "node", "label")
                hubs = active.groupBy("key").agg(F.min(order).alias("hub"), F.count("*").alias("n"))
                hubs = stage(hubs.select("key", F.col("hub.node").alias("hub"), F.col("hub.label").alias("hub_label"), "n"))
            active = stage(meet(active, hubs, ["key"], "n").where("node != hub"))
            pairs = stage(active.where("label != hub_label").select("node", "hub").distinct())
            maybe = stage(_pruned(pairs, reps, marks, threshold, bands, rows))
            found = _verified(maybe, texts, marks, k, percent)
            found = stage(found if labels is not None or same_id is None else found.unionByName(same_id))
        else:
            found = stage(_families(active, reps, texts, marks, k, percent, bands, rows))
        if labels is None:
            labels = components(found)
        elif not found.isEmpty():
            labels = _merged(labels, found)
        if turn == HUB_ROUNDS:
            break
        active = stage(_labelled(active.select("key", "node"), labels))
        open_ = stage(active.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("n")).where("lo < hi").select("key", "n"))
        if open_.isEmpty():
            break
        active = stage(meet(active, open_, ["key"], "n"))

    linked = stage(labels.join(marks, "node").select("node", "label", "doc_id"))
    least = stage(linked.groupBy("label").agg(F.min("doc_id").alias("reached")))
    reach = meet(linked, least, ["label"]).select("node", "reached")
    reach = stage(classes.join(reach, "node", "left").select("h1", "h2", "n", F.coalesce("reached", "doc_id").alias("reached")))
    own = all_rows.select("doc_id", "n_shingles", "h1", "h2")
    joins = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    out = meet(own.where(joins), reach, ["h1", "h2"], "n").select("doc_id", "n_shingles", F.col("reached").alias("component_id"))
    out = out.unionByName(own.where(~joins).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """docs without the rows that a near duplicate of smaller doc_id stands for; all columns are kept as they are."""
    return without(docs, near_duplicates(docs, k, percent).where("NOT kept"), "doc_id")
