"""Log-bilinear language model trained with noise-contrastive estimation, and corpus-count scores.

Tokens are words (A-Z lower-cased, cut at ASCII white space) and one end per text. Counts are taken over every training
text. The model's classes are the most frequent words, the end, and for all other words the hashed bucket of their last
letters and sign; inside a bucket a word has its share of the bucket's counts, an unseen word half a count.
A context of two classes gives the vector R1[c1] + R2[c2]; class w has the score vector . Q[w] + b[w].

Training reads every training text once, in two rounds: the texts whose hash falls on one of FIRST, then all others.
In a round the texts are dealt by hash to shards of about SHARD_TOKENS tokens, as many as the corpus asks for; each shard
trains by minibatches in hash order from the round's common start, and the parameters are averaged, weighted by tokens.
Texts, shards and their order follow from the rows alone, so scores don't depend on how the table is partitioned.
Scoring normalises exactly: one matrix product gives the sum over all classes for every context.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import process_memory, stage

HEAD = 1024
BUCKETS = 256
KNOWN = 262_144
WIDTH = 24
NOISE = 32
MINIBATCH = 4096
RATE = 0.08
#: One text in FIRST trains the start of the others.
FIRST = 8
SHARD_TOKENS = 4_000_000
CHUNK = 16 * MINIBATCH
#: Averaged parameters are rounded, so that the order of their sum can't show.
DIGITS = 6
SIGNS = b".,;:!?\"'()*&%$#"


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def bucket_of(word: bytes) -> int:
    """Bucket of a word outside the head: its last three letters and whether a sign follows."""
    bare = word.rstrip(SIGNS)
    return zlib.crc32(bare.decode("utf-8", "replace")[-3:].encode() + word[len(bare) : len(bare) + 1]) % BUCKETS


def word_counts(texts: DataFrame) -> DataFrame:
    """h, bucket, n: occurrences of each distinct word, by its 64-bit hash; combined per task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        def flush(count: Counter) -> pa.RecordBatch:
            h = np.fromiter((xxhash.xxh64_intdigest(w) for w in count), np.uint64, len(count)).view(np.int64)
            b = np.fromiter((bucket_of(w) for w in count), np.int32, len(count))
            return pa.RecordBatch.from_arrays([pa.array(h), pa.array(b), pa.array(np.fromiter(count.values(), np.int64, len(count)))], ["h", "bucket", "n"])

        count: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                count.update(tokens(text.as_py()))
                if len(count) > 500_000:
                    yield flush(count)
                    count = Counter()
        yield flush(count)

    made = texts.select("text").mapInArrow(run, "h long, bucket int, n long")
    return made.groupBy("h").agg(F.min("bucket").alias("bucket"), F.sum("n").alias("n"))


class Vocabulary:
    """Head classes, bucket totals and the counts of the KNOWN most frequent words, all of bounded size."""

    def __init__(self, h: np.ndarray, n: np.ndarray, n_tokens: int, n_types: int, n_texts: int, buckets: np.ndarray, head: int = HEAD):
        self.h, self.n, self.head = h, n, head  # sorted by h
        self.n_tokens, self.n_types, self.n_texts = n_tokens, n_types, n_texts
        top = np.argsort(-n, kind="stable")[:head]
        self.head_of = np.full(len(h), -1, dtype=np.int32)
        self.head_of[np.sort(top)] = np.arange(len(top))
        self.size = head + BUCKETS + 1
        self.end = self.size - 1
        mass = np.zeros(self.size)
        mass[self.head_of[self.head_of >= 0]] = n[self.head_of >= 0] + 0.5
        mass[head : head + BUCKETS] = buckets + 0.5
        mass[self.end] = n_texts + 0.5
        mass[: head][mass[:head] == 0] = 1e-3
        self.log_total = np.log10(buckets + 0.5)
        self.share = (mass / mass.sum()).astype(np.float64)

    @classmethod
    def of(cls, state: dict) -> Vocabulary:
        """From vars(vocabulary), the form in which it is broadcast."""
        made = cls.__new__(cls)
        vars(made).update(state)
        return made

    def classes(self, h: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class of each word, and its count or -1 where it isn't among the KNOWN."""
        if not len(self.h):
            return (self.head + bucket).astype(np.int32), np.full(len(h), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        hit = self.h[at] == h
        head = np.where(hit, self.head_of[at], -1)
        return np.where(head >= 0, head, self.head + bucket).astype(np.int32), np.where(hit, self.n[at], -1)


class Reader:
    """Texts to class numbers; words are looked up once and remembered."""

    def __init__(self, vocabulary: Vocabulary):
        self.v, self.place = vocabulary, {}
        self._clear()

    def _clear(self) -> None:
        self.place.clear()
        self.h = np.empty(0, dtype=np.int64)
        self.cls, self.n = np.empty(0, dtype=np.int32), np.empty(0, dtype=np.int64)

    def read(self, texts: list[str | None]) -> list[np.ndarray]:
        """Places of each text's words in h, cls, n."""
        import xxhash

        cut = [tokens(t) for t in texts]
        if len(self.place) > 600_000:
            self._clear()
        fresh = [w for w in set().union(*cut) if w not in self.place]
        if fresh:
            h = np.fromiter((xxhash.xxh64_intdigest(w) for w in fresh), np.uint64, len(fresh)).view(np.int64)
            cls, n = self.v.classes(h, np.fromiter((bucket_of(w) for w in fresh), np.int32, len(fresh)))
            self.place.update(zip(fresh, range(len(self.h), len(self.h) + len(fresh)), strict=True))
            self.h, self.cls, self.n = np.concatenate([self.h, h]), np.concatenate([self.cls, cls]), np.concatenate([self.n, n])
        get = self.place.__getitem__
        return [np.fromiter(map(get, words), np.int64, len(words)) for words in cut]


def start(vocabulary: Vocabulary, seed: int = 5) -> np.ndarray:
    """All parameters in one float32 matrix, a row per class: R1, R2, Q, b. b begins at the class shares."""
    rng = np.random.default_rng(seed)
    p = np.zeros((vocabulary.size, 3 * WIDTH + 1), dtype=np.float32)
    p[:, : 2 * WIDTH] = rng.normal(0, 0.1, (vocabulary.size, 2 * WIDTH))
    p[:, 2 * WIDTH : 3 * WIDTH] = rng.normal(0, 0.1, (vocabulary.size, WIDTH))
    p[:, -1] = np.log(vocabulary.share)
    return p


def _add(target: np.ndarray, scale: np.ndarray, ids: np.ndarray, g: np.ndarray, rate: float) -> None:
    """Adagrad step on the rows ids, equal ids summed."""
    order = np.argsort(ids, kind="stable")
    s = ids[order]
    first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
    total = np.add.reduceat(g[order], first, axis=0)
    rows = s[first]
    scale[rows] += np.mean(total * total, axis=1) if total.ndim > 1 else total * total
    step = rate / np.sqrt(scale[rows])
    target[rows] -= (step[:, None] * total) if total.ndim > 1 else step * total


class Trainer:
    """Noise-contrastive estimation by minibatches over class sequences."""

    def __init__(self, p: np.ndarray, share: np.ndarray, seed: int):
        self.r1, self.r2, self.q, self.b = p[:, :WIDTH].copy(), p[:, WIDTH : 2 * WIDTH].copy(), p[:, 2 * WIDTH : 3 * WIDTH].copy(), p[:, -1].copy()
        n = len(p)
        self.s1, self.s2, self.sq, self.sb = (np.full(n, 1.0, dtype=np.float32) for _ in range(4))
        self.rng, self.cum = np.random.default_rng(seed), np.cumsum(share)
        self.log_noise = (np.log(share) + np.log(NOISE)).astype(np.float32)
        self.seen = 0

    def batch(self, c1: np.ndarray, c2: np.ndarray, w: np.ndarray) -> None:
        rate = RATE / (1 + self.seen / 20_000_000)
        k = np.minimum(np.searchsorted(self.cum, self.rng.random(NOISE) * self.cum[-1]), len(self.cum) - 1)
        v, qw, qk = self.r1[c1] + self.r2[c2], self.q[w], self.q[k]
        pos = np.einsum("ij,ij->i", v, qw) + self.b[w] - self.log_noise[w]
        neg = v @ qk.T + (self.b[k] - self.log_noise[k])
        gp = -1 / (1 + np.exp(np.clip(pos, -30, 30)))
        gn = 1 / (1 + np.exp(-np.clip(neg, -30, 30)))
        dv = gp[:, None] * qw + gn @ qk
        _add(self.q, self.sq, np.concatenate([w, k]), np.concatenate([gp[:, None] * v, gn.T @ v]), rate)
        _add(self.b, self.sb, np.concatenate([w, k]), np.concatenate([gp, gn.sum(axis=0)]), rate * 0.5)
        _add(self.r1, self.s1, c1, dv, rate)
        _add(self.r2, self.s2, c2, dv, rate)
        self.seen += len(w)

    def texts(self, sequences: list[np.ndarray], end: int) -> None:
        if not sequences:
            return
        c1, c2, w = contexts(sequences, end)
        for at in range(0, len(w), MINIBATCH):
            self.batch(c1[at : at + MINIBATCH], c2[at : at + MINIBATCH], w[at : at + MINIBATCH])

    def parameters(self) -> np.ndarray:
        return np.concatenate([self.r1, self.r2, self.q, self.b[:, None]], axis=1).astype(np.float32)


def contexts(sequences: list[np.ndarray], end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class before, class before that, class, over all texts with their ends; before a text stand ends."""
    w = np.concatenate([np.append(s, np.int32(end)) for s in sequences])
    c1, c2 = np.empty_like(w), np.empty_like(w)
    c1[0], c1[1:] = end, w[:-1]
    c2[:2], c2[2:] = end, w[:-2]
    first = np.cumsum([0, *(len(s) + 1 for s in sequences[:-1])])
    c1[first] = end
    c2[first] = end
    second = first[np.asarray([len(s) > 0 for s in sequences])] + 1
    c2[second] = end
    return c1, c2, w


def fit(texts: DataFrame, vocabulary: Vocabulary, shard_tokens: int = SHARD_TOKENS) -> np.ndarray:
    """Parameters trained on every text. texts: text, and o, a hash of its row."""
    p = start(vocabulary)
    first = F.pmod("o", F.lit(FIRST)) == 0
    for rows, share in ((texts.where(first), 1 / FIRST), (texts.where(~first), 1 - 1 / FIRST)):
        p = _trained(rows, vocabulary, p, max(1, round(vocabulary.n_tokens * share / shard_tokens)))
    return p


def _trained(texts: DataFrame, vocabulary: Vocabulary, p: np.ndarray, shards: int) -> np.ndarray:
    """One round: the mean of the parameters of all shards, each begun at p; p itself without texts."""
    begin = texts.sparkSession.sparkContext.broadcast((p, vars(vocabulary)))  # bounded by the number of classes and KNOWN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, state = begin.value
        v = Vocabulary.of(state)
        r = Reader(v)
        total, seen, waiting, trainer, now = np.zeros(p.shape), 0, 0, None, None
        held: list[np.ndarray] = []

        def flush() -> None:
            nonlocal waiting
            trainer.texts(held, v.end)
            held.clear()
            waiting = 0

        def close() -> None:
            nonlocal seen
            if trainer is not None:
                flush()
                total[:] += trainer.parameters().astype(np.float64) * trainer.seen
                seen += trainer.seen

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                for places, shard in zip(r.read(part.column(1).to_pylist()), part.column(0).to_pylist(), strict=True):
                    if shard != now:
                        close()
                        trainer, now = Trainer(p, v.share, 2), shard
                    held.append(r.cls[places])
                    waiting += len(places)
                    if waiting >= CHUNK:
                        flush()
        close()
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64())), pa.array(np.full(len(total), seen, dtype=np.int64))],
                ["class", "row", "seen"],
            )

    dealt = texts.select(F.pmod(F.shiftrightunsigned("o", 3), F.lit(shards)).cast("int").alias("shard"), "o", "text")
    dealt = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "o").select("shard", "text")
    sums = [F.sum(F.col("row")[i]).alias(f"s{i}") for i in range(3 * WIDTH + 1)]
    made = dealt.mapInArrow(run, "class int, row array<double>, seen long")
    total = made.groupBy("class").agg(F.sum("seen").alias("seen"), *sums).toPandas()  # a row per class
    begin.destroy()
    if not len(total):
        return p
    total = total.sort_values("class")
    mean = total[[f"s{i}" for i in range(3 * WIDTH + 1)]].to_numpy() / total["seen"].to_numpy()[:, None]
    return np.round(mean, DIGITS).astype(np.float32)


class Scorer:
    """Normalised log10 probabilities of classes.

    The sum over all classes of exp(x + y), x of the nearer and y of the farther context class, is a product of two
    matrices of exponentials, so one matrix product normalises every context. Rows are shifted by their maxima and kept
    in double precision: scores of one context would have to lie some 700 apart to be lost.
    """

    def __init__(self, p: np.ndarray, memory: dict):
        if memory.get("for") != (key := hash(p.tobytes())):
            memory.clear()
            q = p[:, 2 * WIDTH : 3 * WIDTH].T
            a1, a2 = p[:, :WIDTH] @ q + p[:, -1], p[:, WIDTH : 2 * WIDTH] @ q
            top1, top2 = (a.max(axis=1, keepdims=True).astype(np.float64) for a in (a1, a2))
            z = np.log(np.exp(a1 - top1) @ np.exp(a2 - top2).T) + top1 + top2.T
            memory |= {"for": key, "a1": a1, "a2": a2, "z": z}
        self.a1, self.a2, self.z = memory["a1"], memory["a2"], memory["z"]

    def log10(self, c1: np.ndarray, c2: np.ndarray, w: np.ndarray) -> np.ndarray:
        return (self.a1[c1, w].astype(np.float64) + self.a2[c2, w] - self.z[c1, c2]) / np.log(10)


def _most_frequent(counts: DataFrame, most: int):
    """The most frequent words, at most `most` rows, by n and hash: all words from a count level on.

    Levels are sixteenths of powers of two, a thousand at most, so neither the histogram nor the words outgrow the driver.
    """
    level = F.floor(F.log2("n") * 16).cast("int")
    sizes = sorted(((r["level"], r["c"]) for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("c")).collect()), reverse=True)
    least, have = None, 0
    for at, c in sizes:
        if have + c > most:
            break
        least, have = at, have + c
    rows = counts.where(F.lit(False) if least is None else level >= least).select("h", "bucket", "n").toPandas()
    return rows.sort_values(["n", "h"], ascending=[False, True])


def scores(docs: DataFrame, held_out, head: int = HEAD) -> DataFrame:
    """Score every text of docs, learning from the rows where held_out is not true.

    docs needs doc_id and text; other columns are ignored. Null texts count as empty: their one token is the end. A null
    doc_id is scored and learned from like any other; repeated rows count each time. Without training rows every count
    is 0 and the classes keep their starting shares. An empty table gives no rows. head: how many words are classes of
    their own; all others meet the model as their bucket.
    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    train = rows.where("NOT held_out").select("text", F.xxhash64("doc_id", "text").alias("o"))
    counts = stage(word_counts(train))
    total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    n_texts = train.count()
    n_tokens, n_types = int(total["n"] or 0) + n_texts, int(total["v"]) + (1 if n_texts else 0)
    top = _most_frequent(counts, KNOWN)
    by_bucket = counts.groupBy("bucket").agg(F.sum(F.col("n") + 0.5).alias("mass")).toPandas()
    buckets = np.zeros(BUCKETS)
    buckets[by_bucket["bucket"].to_numpy(dtype=np.int64)] = by_bucket["mass"].to_numpy(dtype=np.float64)
    lead = top.head(head)
    np.subtract.at(buckets, lead["bucket"].to_numpy(dtype=np.int64), lead["n"].to_numpy(dtype=np.float64) + 0.5)
    top = top.sort_values("h")
    vocabulary = Vocabulary(top["h"].to_numpy(dtype=np.int64), top["n"].to_numpy(dtype=np.int64), n_tokens, n_types, n_texts, np.maximum(buckets, 0), head)
    p = fit(train, vocabulary)
    given = spark.sparkContext.broadcast((p, vars(vocabulary)))
    log_all = float(np.log10(n_tokens + 0.5 * (n_types + 1)))
    names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "rare", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        p, state = given.value
        v = Vocabulary.of(state)
        reader, scorer = Reader(v), Scorer(p, process_memory("log-bilinear scores"))
        row = TaskContext.get().partitionId() << 36
        end_base = float(np.log10(v.n_texts + 0.5)) - log_all
        for batch in batches:
            for at in range(0, batch.num_rows, 400):
                part = batch.slice(at, 400)
                places = reader.read(part.column(1).to_pylist())
                sequences = [reader.cls[i] for i in places]
                got = scorer.log10(*contexts(sequences, v.end))
                sizes = np.asarray([len(s) + 1 for s in sequences])
                summed = np.add.reduceat(got, np.cumsum(sizes) - sizes)
                known, base, score, rare, times = [], [], [], [], []
                for i, s, total in zip(places, sequences, summed, strict=True):
                    n = reader.n[i]
                    have = n >= 0
                    log_n = np.log10(n[have] + 0.5)
                    tail = s >= v.head
                    base.append(float(log_n.sum()) - log_all * len(i) + end_base)
                    score.append(float(total + log_n[tail[have]].sum() - v.log_total[s[tail] - v.head].sum()))
                    known.append(int((n > 0).sum()) + (v.n_texts > 0))
                    h, c = np.unique(reader.h[i[~have]], return_counts=True)
                    rare.append(h)
                    times.append(c)
                numbers = pa.array(np.arange(row, row + part.num_rows))
                row += part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [numbers, part.column(0), part.column(2), pa.array(sizes.astype(np.int64)), pa.array(known, pa.int64()), pa.array(base), pa.array(score),
                     pa.array(rare, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int64()))],
                    names,
                )

    schema = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, rare array<long>, times array<long>"
    made = stage(rows.mapInArrow(run, schema))
    # Words outside the KNOWN meet their counts in a join; they are rare, so no key is hot.
    rare = made.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("h"), F.col("x.times").alias("t"))
    found = rare.join(counts.select("h", "n"), "h", "left").groupBy("row").agg(
        F.sum(F.col("t") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("more"),
        F.sum(F.when(F.col("n") > 0, F.col("t")).otherwise(0)).alias("known"),
    )
    out = made.drop("rare", "times").join(found, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )
