"""Best-fit packing of tokenised documents into sequences of bounded length.

Method: exact-complement hashing. Only the histogram of piece lengths (at most `capacity` numbers, whatever the
corpus size) reaches the driver. From it a plan of *patterns* is made: multisets of lengths with a repeat count.
For the gap left in a sequence the planner looks in its indexes for one length, a sum of two, or a sum of three
that fills the gap exactly and is still available; otherwise it puts the largest length that fits (best fit).
Executors then number the pieces of each length and read sequence and offset from the plan, with no further shuffle.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.llm.common import forget, process_memory, stage, tidy

CAPACITY = 4096
END_ID = 1
CACHED_WORDS = 160_000
TEXTS = 800
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, ord long"


def encoder(path: str):
    """A function from a text to its token ids as little-endian 32-bit bytes, equal to encoding the whole text.

    The tokenizer drops white space and never joins across it, nor letters with what isn't a letter. So a text's ids
    are the ids of its words in turn, and a Latin word that ends in a comma or full stop has the ids of its lower-cased
    letters, then those of the sign; letters go to the merges directly, other words through the whole tokenizer. A text
    that holds one of the tokenizer's added strings (such as its end mark), which it finds before it cuts words, goes
    through the whole tokenizer as it is. Words and letter runs are remembered for the life of the worker process; runs
    not asked for since the memory was last full are forgotten.
    """
    memory = process_memory(f"word ids {path}")
    if memory:
        return memory["encode"]
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    tok = Tokenizer.from_file(path)
    added = [t.content for t in tok.get_added_tokens_decoder().values()]
    merges = tok.model.tokenize
    odd = re.compile("[\x1c-\x1f]")
    spaces = re.compile("[\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")
    latin = re.compile("[A-Za-z\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\xff]+").fullmatch
    as_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
    mapped = str.maketrans({chr(c): as_bytes.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)})
    runs: dict[str, bytes] = {}
    before: dict[str, bytes] = {}
    signs = {s: _packed(tok.encode(s, add_special_tokens=False).ids) for s in ".,"}

    class Words(dict):
        def __missing__(self, word: str) -> bytes:
            if word.isalpha():
                letters, sign = word, b""
            else:
                letters, sign = word[:-1], signs.get(word[-1])
            if sign is None or not letters.isalpha() or not (letters.isascii() or latin(letters)):
                value = _packed(tok.encode(word, add_special_tokens=False).ids)
            else:
                low = letters.lower()
                if (value := runs.get(low)) is None:
                    if (value := before.get(low)) is None:
                        value = _packed([t.id for t in merges(low if low.isascii() else low.translate(mapped))])
                    runs[low] = value
                value += sign
            self[word] = value
            return value

    known = Words()
    ids_of = known.__getitem__

    def encode(text: str) -> bytes:
        if len(known) > CACHED_WORDS:
            known.clear()
        if len(runs) > CACHED_WORDS:
            before.clear()
            before.update(runs)
            runs.clear()
        if any(mark in text for mark in added):
            return _packed(tok.encode(text, add_special_tokens=False).ids)
        return b"".join(map(ids_of, [w for w in spaces.split(text) if w] if odd.search(text) else text.split()))

    memory["encode"] = encode
    return encode


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Tokenise doc_id, text and cut only what is longer than capacity. Null texts count as empty.

    Each task also numbers its pieces per length (task, ord), the first level of the global numbering.
    """
    size, end = 4 * capacity, np.asarray([end_id], dtype="<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "ord"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, encode = TaskContext.get().partitionId(), encoder(tokenizer)
        count = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            rows: list[tuple] = []
            for at in range(0, batch.num_rows, TEXTS):
                for doc_id, text in zip(*(batch.column(c).slice(at, TEXTS).to_pylist() for c in (0, 1)), strict=True):
                    ids = encode(text or "") + end
                    for k in range(0, len(ids), size):
                        part = ids[k : k + size]
                        n = len(part) // 4
                        rows.append((doc_id, k // size, k // 4, n, zlib.crc32(part), task, int(count[n])))
                        count[n] += 1
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            columns = zip(*rows, strict=True) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)
        tidy()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECES)


def plan_patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Patterns (lengths in order, times) that use up the counts, each within capacity.

    counts maps length to number of pieces. Every round uses up at least one length as far as its pattern needs it,
    so the number of patterns depends on the number of distinct lengths and not on the number of pieces. Two plans are
    made: one tries every available length as first of three, the other only the 64 largest and leaves more gaps to
    best fit; neither is always better, so the one with fewer sequences is returned.
    """
    plans = [_plan(counts, capacity, tried) for tried in (capacity, 64)]
    return min(plans, key=lambda plan: sum(times for _, times in plan))


def _plan(counts: dict[int, int], capacity: int, tried: int) -> list[tuple[list[int], int]]:
    """tried: how many lengths, largest first, are tried as first of three."""
    have = np.zeros(capacity + 1, dtype=np.int64)
    for n, c in counts.items():
        if not 1 <= n <= capacity:
            raise ValueError(f"length {n} is outside 1..{capacity}")
        have[n] += c

    def largest(top: int) -> int:
        at = np.flatnonzero(have[1 : top + 1])
        return int(at[-1]) + 1 if at.size else 0

    def pair(gap: int) -> list[int]:
        """Two available lengths with this sum, the larger one as large as can be."""
        if gap < 2:
            return []
        low = np.arange(1, gap // 2 + 1)
        ok = (have[low] > 0) & (have[gap - low] > 0)
        if gap % 2 == 0:
            ok[-1] = have[gap // 2] > 1
        at = np.flatnonzero(ok)
        return [gap - int(low[at[0]]), int(low[at[0]])] if at.size else []

    def exact(gap: int) -> list[int]:
        if have[gap] > 0:
            return [gap]
        if two := pair(gap):
            return two
        lengths = np.flatnonzero(have[:gap])[::-1]
        if lengths.size == 0 or gap > 3 * int(lengths[0]):
            return []
        # Bits of the available lengths, upwards and downwards: one shift tells whether a pair may have a sum.
        up = int.from_bytes(np.packbits(have > 0, bitorder="little").tobytes(), "little")
        down = int.from_bytes(np.packbits(have[::-1] > 0, bitorder="little").tobytes(), "little")
        for a in lengths[:tried].tolist():
            if not up & down >> (capacity - gap + a):
                continue
            have[a] -= 1
            two = pair(gap - int(a))
            have[a] += 1
            if two:
                return [int(a), *two]
        return []

    out: list[tuple[list[int], int]] = []
    while top := largest(capacity):
        used, gap = [top], capacity - top
        have[top] -= 1
        while gap:
            fill = exact(gap)
            if not fill:
                n = largest(gap)
                if not n:
                    break
                fill = [n]
            for n in fill:
                have[n] -= 1
                gap -= n
            used += fill
        need = {n: used.count(n) for n in set(used)}
        more = min(int(have[n]) // k for n, k in need.items())
        for n, k in need.items():
            have[n] -= more * k
        out.append((used, more + 1))
    return out


def slots(patterns: list[tuple[list[int], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: ranks at which a slot's run of pieces begins, the run's first sequence, its offset."""
    by: dict[int, list[tuple[int, int, int]]] = {}
    at: dict[int, int] = {}
    sequence = 0
    for used, times in patterns:
        offset = 0
        for n in used:
            first = at.get(n, 0)
            by.setdefault(n, []).append((first, sequence, offset))
            at[n] = first + times
            offset += n
        sequence += times
    return {n: tuple(np.asarray(c, dtype=np.int64) for c in zip(*v, strict=True)) for n, v in by.items()}


def _placed(batches: Iterator[pa.RecordBatch], plan: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Sequence and offset of each piece, read from the plan's slots."""
    forget()  # the words, which later steps would find the process still holding
    for batch in batches:
        length = batch.column("length").to_numpy()
        rank = batch.column("ord").to_numpy() + batch.column("base").to_numpy()
        sequence, offset = np.empty_like(rank), np.empty_like(rank)
        for n in np.unique(length):
            mine = np.flatnonzero(length == n)
            first, seq, off = plan[int(n)]
            k = np.searchsorted(first, rank[mine], side="right") - 1
            sequence[mine] = seq[k] + rank[mine] - first[k]
            offset[mine] = off[k]
        kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(sequence), pa.array(offset)],
            ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
        )


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pack all documents into as few sequences of at most capacity tokens as the plan finds.

    docs needs doc_id and text; other columns, whatever their names, are ignored. Null or empty text: one piece that
    holds the end id alone. Null doc_ids and repeated doc_ids are packed like any row. An empty table gives no rows.
    Equal lengths are interchangeable, so ties are settled by task and order within it.
    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    """
    spark = docs.sparkSession
    made = stage(pieces(docs, tokenizer, capacity, end_id))
    # Second level of the numbering: where each task's run of a length begins. Rows: tasks x lengths at most.
    per_task = made.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(per_task.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long"))))
    counts = {int(r["length"]): int(r["n"]) for r in starts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = spark.sparkContext.broadcast(slots(plan_patterns(counts, capacity)))  # bounded by the number of lengths

    # Bases are as many as tasks times lengths, so they grow with the corpus: both sides are dealt by (length, task).
    located = made.join(starts.select("length", "task", "base").hint("shuffle_hash"), ["length", "task"])
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return located.mapInArrow(lambda batches: _placed(batches, table.value), schema)
