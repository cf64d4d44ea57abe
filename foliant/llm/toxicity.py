"""Toxicity scores from a gap-weighted subsequence kernel, Nyström landmarks and a linear support vector machine.

Kernel. A word is the set of its three-letter subsequences within SPAN letters; a subsequence spread over s letters
weighs DECAY^s, so `idiot`, `idxiot` and `i.d.i.o.t` share most of their weight. Punctuation inside words is removed,
word edges count as letters, digits that stand for letters are read as those, and runs of single letters are read as one word as well.
k(word, landmark) is the inner product over the landmark's own, at most 1.
A document's value for a landmark is the largest over its words, whatever its length; the vector over all landmarks,
whitened with the landmarks' own kernel matrix (Nyström), goes to the machine.

Training takes a bounded sample: at most `per_class` labelled documents of each class (TRAIN_PER_CLASS) of at most
TRAIN_CHARS characters, chosen by hash: the first of twice as many ids whose text isn't longer. Scoring reads every whole
text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import forget, stage, tidy

TRAIN_PER_CLASS = 800
TRAIN_CHARS = 12_000
LANDMARKS = 64
SPAN = 5
DECAY = 0.85
LEAST = 0.35
#: A landmark's toxic rows times the logarithm of how much likelier it is in toxic than in clean rows.
SIGNAL = 14
CODES = 64
PATTERNS = [(d1, d2) for d1 in range(1, SPAN) for d2 in range(1, SPAN) if d1 + d2 < SPAN]
#: Digits and signs commonly written for letters.
LOOKALIKE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"})
WINDOW, OVERLAP = 28, 12
#: Bounds of memory: texts and words taken at a time, words remembered.
TEXTS, WORDS, KNOWN = 100, 4096, 100_000


def words_of(text: str | None) -> set[str]:
    """Distinct normal forms of the text's words; runs of three or more single letters add their joined form."""
    raw = (text or "").lower().split()
    out = set(raw)
    if sum(len(w) == 1 for w in raw) >= 3:
        run: list[str] = []
        for w in [*raw, "  "]:
            if len(w) == 1 and w.isalnum():
                run.append(w)
            else:
                if len(run) >= 3:
                    out.add("".join(run))
                run = []
    return out


_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_INNER = re.compile(r"[\W_]+")


def plain(word: str) -> str:
    """Letters of a word between edge marks: outer signs dropped, look-alikes read as letters, inner signs dropped."""
    if not word.isalpha():
        word = _INNER.sub("", _EDGE.sub("", word).translate(LOOKALIKE))
    return f"^{word}$" if word else ""


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letter codes (0: none) of words cut into overlapping windows, and the word that each row belongs to."""
    rows, owner = [], []
    for i, w in enumerate(words):
        for at in range(0, max(1, len(w) - OVERLAP), WINDOW - OVERLAP):
            rows.append(w[at : at + WINDOW])
            owner.append(i)
    width = max((len(r) for r in rows), default=0) + SPAN
    flat = np.frombuffer("".join(r.ljust(width, "\0") for r in rows).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    cp = flat.reshape(len(rows), width)
    code = np.where((cp >= 97) & (cp <= 122), cp - 96, np.where(cp == 0, 0, 27 + cp % (CODES - 27)))
    return code.astype(np.int32), np.asarray(owner)


def _features(code: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """Feature numbers of all subsequences of one shape (0 where there is none), with the shape's weight."""
    n = code.shape[1] - SPAN
    if n <= 0:
        return
    a = code[:, :n]
    for d1, d2 in PATTERNS:
        b, c = code[:, d1 : n + d1], code[:, d1 + d2 : n + d1 + d2]
        yield np.where(c > 0, (a * CODES + b) * CODES + c, 0), DECAY ** (d1 + d2 + 1)


@dataclass
class Kernel:
    """Kernel values of words against landmarks."""

    landmarks: list[str]

    def __post_init__(self) -> None:
        m = len(self.landmarks)
        code, owner = _codes(self.landmarks)
        shapes = list(_features(code))
        used = np.unique(np.concatenate([f.ravel() for f, _ in shapes])) if shapes else np.zeros(1, dtype=np.int64)
        used = used[used > 0]
        # Rows for the landmarks' features only; number 0 stands for all others.
        self.row = np.zeros(CODES**3, dtype=np.int32)
        self.row[used] = np.arange(1, len(used) + 1)
        self.own = np.zeros((len(used) + 1, m), dtype=np.float32)
        for feature, weight in shapes:
            np.add.at(self.own, (self.row[feature], np.broadcast_to(owner[:, None], feature.shape)), weight)
        self.own[0] = 0
        self.gram = self.own.T @ self.own
        self.own /= np.maximum(np.diag(self.gram), 1e-9)
        self.top = self.own.max(axis=1)[self.row]

    def values(self, words: list[str]) -> dict[str, np.ndarray]:
        """Vectors of those words that reach LEAST for some landmark."""
        out: dict[str, np.ndarray] = {}
        by_size: dict[int, list[str]] = {}
        for w in words:
            if p := plain(w):
                by_size.setdefault(min((len(p) + 3) // 4, 8), []).append((w, p))
        for group in by_size.values():
            for at in range(0, len(group), WORDS):
                part = group[at : at + WORDS]
                code, owner = _codes([p for _, p in part])
                shapes = list(_features(code))
                bound = sum(weight * self.top[f].sum(axis=1) for f, weight in shapes)
                rows = np.flatnonzero(bound >= LEAST)
                if not rows.size:
                    continue
                v = np.zeros((len(rows), len(self.landmarks)), dtype=np.float32)
                for f, weight in shapes:
                    for column in f[rows].T:
                        v += weight * self.own[self.row[column]]
                for i, r in enumerate(rows):
                    if v[i].max() >= LEAST:
                        w = part[owner[r]][0]
                        out[w] = np.maximum(out[w], v[i]) if w in out else v[i]
        return {w: np.minimum(v, 1) for w, v in out.items()}


@dataclass
class Model:
    landmarks: list[str]
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        f = x @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * f + self.shift, -500, 500)))


def pooled(kernel: Kernel, texts: list[set[str]], known: dict[str, np.ndarray | None]) -> np.ndarray:
    """For each document the largest kernel value per landmark. known remembers words (None: below LEAST),
    KNOWN and those of these texts at most."""
    if len(known) > KNOWN:
        for w in list(known)[KNOWN // 2 :]:  # the first ones met are mostly the frequent ones
            del known[w]
    fresh = [w for w in set().union(*texts) if w not in known]
    known.update(dict.fromkeys(fresh))
    known.update(kernel.values(fresh))
    x = np.zeros((len(texts), len(kernel.landmarks)), dtype=np.float32)
    for i, words in enumerate(texts):
        for w in words:
            if (v := known[w]) is not None:
                np.maximum(x[i], v, out=x[i])
    return x


def choose_landmarks(toxic: list[set[str]], clean: list[set[str]], most: int) -> list[str]:
    """Letter strings that mark toxic rows, word edges included.

    In each round the string with the strongest signal is taken and lengthened while a longer one keeps more than half
    of its toxic rows; strings that share three letters with it then count only in other rows.
    """
    seen = {p for words in clean for w in words if (p := plain(w))}

    def parts(w: str, common: set[str] | None) -> set[str]:
        """Strings of a word: those of four letters, or those of up to twelve made of common ones of four."""
        fours = [w[i : i + 4] for i in range(len(w) - 3)]
        if common is None:
            return set(fours)
        out, since = set(), 0
        for j, x in enumerate(fours):
            if x in common:
                out.update(w[i : j + 4] for i in range(max(since, j - 8), j + 1))
            else:  # what holds a rare string of four is as rare
                since = j + 1
        return out

    def row(words: set[str], common: set[str] | None) -> set[str]:
        return set().union(*(parts(p, common) for w in words if (p := plain(w)) not in seen), set())

    common = {x for x, n in Counter(x for words in toxic for x in row(words, None)).items() if n >= 3}
    df = Counter(x for words in toxic for x in row(words, common))
    good = {x for x, n in df.items() if n >= 3}
    df = {x: df[x] for x in good}
    against = Counter()
    for words in clean:
        against.update(set().union(*(parts(plain(w), common) & good for w in words), set()))
    good = {x for x in good if df[x] >= 12 * against[x]}
    where: dict[str, set[int]] = {}
    for i, words in enumerate(toxic):
        for x in row(words, common) & good:
            where.setdefault(x, set()).add(i)

    def signal(x: str) -> float:
        rate = (len(where[x]) / max(1, len(toxic))) / ((against[x] + 0.5) / max(1, len(clean)))
        return len(where[x]) * float(np.log(max(rate, 1e-9)))

    out: list[str] = []
    while where and len(out) < most:
        best = max(where, key=lambda x: (signal(x), len(x), x))
        if signal(best) < SIGNAL:
            break
        while longer := [x for x in where if best in x and x != best and 2 * len(where[x]) > len(where[best])]:
            best = max(longer, key=lambda x: (len(where[x]), -len(x), x))
        out.append(best)
        gone, grams = where[best], {best[i : i + 3] for i in range(len(best) - 2)}
        for x in list(where):
            if any(x[i : i + 3] in grams for i in range(len(x) - 2)):
                where[x] = where[x] - gone
                if len(where[x]) < 3:
                    del where[x]
    return out


def perturbed(words: set[str], rng: np.random.Generator) -> set[str]:
    """The words with one letter inserted into each, as disguises do."""
    out = set()
    for w in sorted(words):
        at = int(rng.integers(1, max(2, len(w))))
        out.add(w[:at] + chr(97 + int(rng.integers(26))) + w[at:])
    return out


def fit(texts: list[str | None], labels: list[int], most: int = LANDMARKS, seed: int = 7) -> Model:
    """Landmarks, Nyström map and support vector machine from labelled texts; without both classes a constant."""
    y = np.where(np.asarray(labels, dtype=np.int64) == 1, 1.0, -1.0)
    words = [words_of(t) for t in texts]
    toxic = [w for w, s in zip(words, y, strict=True) if s > 0]
    clean = [w for w, s in zip(words, y, strict=True) if s < 0]
    landmarks = choose_landmarks(toxic, clean, most)
    if not landmarks or not clean:
        rate = (len(toxic) + 0.5) / (len(words) + 1)
        return Model(["___"], np.zeros(1, dtype=np.float32), 0.0, 1.0, float(np.log(rate / (1 - rate))))
    rng = np.random.default_rng(seed)
    kernel = Kernel(landmarks)
    x = []
    for change in (set, lambda w: perturbed(w, rng)):
        known: dict[str, np.ndarray | None] = {}
        for at in range(0, len(words), TEXTS):
            x.append(pooled(kernel, [change(w) for w in words[at : at + TEXTS]], known))
    x, y = np.vstack(x), np.concatenate([y, y])
    d = np.sqrt(np.diag(kernel.gram))
    value, vector = np.linalg.eigh(kernel.gram / d[:, None] / d[None, :])
    root = vector @ np.diag(1 / np.sqrt(np.maximum(value, 0.05))) @ vector.T
    phi = x @ root
    per_row = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w, b, c = np.zeros(phi.shape[1]), 0.0, 1e-3
    for step in range(1, 1501):
        f = phi @ w + b
        g = np.where(y * f < 1, -y * per_row, 0)
        rate = 2.0 / (1 + 0.02 * step)
        w -= rate * (phi.T @ g + c * w)
        b -= rate * g.sum()
    f = phi @ w + b
    slope, shift = 1.0, 0.0
    for _ in range(60):  # logistic fit of the margins with softened targets, damped Newton steps
        p = 1 / (1 + np.exp(-np.clip(slope * f + shift, -30, 30)))
        t = np.where(y > 0, 0.99, 0.01)
        g1, g0 = (per_row * (p - t) * f).sum(), (per_row * (p - t)).sum()
        q = per_row * p * (1 - p)
        h = np.array([[(q * f * f).sum() + 1e-4, (q * f).sum()], [(q * f).sum(), q.sum() + 1e-4]])
        move = np.linalg.solve(h, [g1, g0])
        slope, shift = slope - 0.7 * move[0], shift - 0.7 * move[1]
    return Model(landmarks, (root @ w).astype(np.float32), float(b), float(max(slope, 1e-3)), float(shift))


def train(docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_PER_CLASS) -> Model:
    """Fit on labelled rows outside the held-out fifth (crc32 of the doc_id's text divisible by 5).

    The ids come first, from the labels alone: twice per_class of each class, by hash. So the texts are one scan with a
    broadcast of at most 4 * per_class ids, and no text is shuffled.
    """
    spark = docs.sparkSession
    marks = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
    marks = marks.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)

    def some(kind: int) -> list[int]:
        rows = marks.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * per_class)
        return list(dict.fromkeys(r["doc_id"] for r in rows.collect()))  # the stated bound

    kinds = dict.fromkeys(some(0), 0)
    if kinds:
        both = marks.where((F.col("toxic") == 1) & F.col("doc_id").isin(list(kinds)))
        kinds |= dict.fromkeys((r["doc_id"] for r in both.collect()), 1)
    kinds |= dict.fromkeys(some(1), 1)
    # From an Arrow table: from a list, every executor would start Python workers of another kind, and keep them.
    ids = pa.table({"doc_id": pa.array(list(kinds), pa.int64()), "toxic": pa.array(list(kinds.values()), pa.int32())})
    wanted = spark.createDataFrame(ids).withColumn("o", F.xxhash64("doc_id"))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where(F.length("text") <= TRAIN_CHARS)
    # One text per id, however often a table repeats it.
    found = rows.join(F.broadcast(wanted), "doc_id").groupBy("o", "doc_id", "toxic").agg(F.min("text").alias("text"))
    found = sorted(found.select("o", "text", "toxic").collect())
    texts: list[str] = []
    given: list[int] = []
    for kind in (1, 0):
        mine = [r["text"] for r in found if r["toxic"] == kind][:per_class]
        texts += mine
        given += [kind] * len(mine)
    model = fit(texts, given)
    del found, texts
    tidy()
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs with score (0 to 1) and predicted (0 or 1) of the whole text; other columns stay.

    Null, empty or wordless texts get the score of a document with no resemblance to any landmark.
    """
    own = [c for c in docs.columns if c not in ("score", "predicted")]
    schema = docs.select(*own).schema.add("score", "double").add("predicted", "integer")
    fields = (model.landmarks, model.weights, model.bias, model.slope, model.shift)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        m = Model(*fields)
        kernel = Kernel(m.landmarks)
        known: dict[str, np.ndarray | None] = {}
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            s = np.empty(batch.num_rows)
            for at in range(0, batch.num_rows, TEXTS):
                s[at : at + TEXTS] = m.scores(pooled(kernel, [words_of(t.as_py()) for t in texts[at : at + TEXTS]], known))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(s), pa.array((s >= 0.5).astype(np.int32))], [*batch.schema.names, "score", "predicted"]
            )
        known.clear()
        tidy()

    return docs.select(*own).mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_PER_CLASS) -> DataFrame:
    """Train on labels and score every row of docs.

    docs needs doc_id and text, labels doc_id and toxic; other columns and label values besides 0 and 1 are ignored,
    a row labelled both ways counts as toxic. Rows with a null doc_id are scored and never held out.
    Returns doc_id, held_out, score, predicted; an empty table gives no rows, no labels a constant score.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = score(rows, train(docs, labels, per_class))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", "predicted")


def drop_toxic(docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_PER_CLASS) -> DataFrame:
    """docs without the rows predicted toxic; all columns are kept as they are. They are staged, so that the whole rows
    go through Python in batches of bounded size."""
    return stage(score(docs, train(docs, labels, per_class)).where("predicted = 0").select(*docs.columns))
