"""Media columns: progressive JPEG coded and decoded in numpy.

A payload's bytes are the quantised coefficients of 8 x 8 blocks, 64 bytes a block in zigzag order, each stored as
byte + 256; they survive coding exactly. Blocks fill 4:2:0 units (four of luma, one of each chroma). The stream has one
DC scan and eight DC refinements (successive approximation), luma AC scans over two bands (spectral selection) and one
over each chroma, each with a refinement. The decoder accumulates all scans into coefficient arrays, inverse-transforms
them with one matrix product, doubles the chroma planes and gives RGB.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_ROWS = 4095
BIAS = 256


def zigzag() -> np.ndarray:
    """Row-major place of each coefficient in zigzag order."""
    cells = [(r, c) for r in range(8) for c in range(8)]
    cells.sort(key=lambda x: (sum(x), x[0] if sum(x) % 2 else x[1]))
    return np.asarray([r * 8 + c for r, c in cells])


ORDER = zigzag()


def idct_matrix() -> np.ndarray:
    """64 x 64: zigzag coefficients to row-major samples."""
    u, x = np.meshgrid(np.arange(8), np.arange(8), indexing="ij")
    one = np.cos((2 * x + 1) * u * np.pi / 16) / 2
    one[0] /= np.sqrt(2)
    return np.kron(one, one)[ORDER].astype(np.float32)


# Writing


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _table(kind: int, number: int, by_length: dict[int, list[int]]) -> bytes:
    counts = bytes(len(by_length.get(n, [])) for n in range(1, 17))
    return _segment(0xC4, bytes([kind << 4 | number]) + counts + bytes(s for n in range(1, 17) for s in by_length.get(n, [])))


def _scan(parts: list[tuple[int, int, int]], first: int, last: int, high: int, low: int, bits: np.ndarray) -> bytes:
    """A scan header and its bits, filled up with ones and with stuffed zeros."""
    body = bytes([len(parts)]) + bytes(x for c, dc, ac in parts for x in (c, dc << 4 | ac)) + bytes([first, last, high << 4 | low])
    tail = -len(bits) % 8
    if tail:
        bits = np.concatenate([bits, np.ones(tail, dtype=np.uint8)])
    return _segment(0xDA, body) + np.packbits(bits).tobytes().replace(b"\xff", b"\xff\x00")


#: Huffman tables in use: DC 0 codes differences 0 and 1; AC 0 codes a non-zero of eight bits after no zeros; AC 1 codes runs of ended blocks.
TABLES = _table(0, 0, {1: [0], 2: [1]}) + _table(1, 0, {1: [8]}) + _table(1, 1, {4: [n << 4 for n in range(15)]})
HEAD = b"\xff\xd8" + _segment(0xDB, b"\x00" + b"\x01" * 64)
BANDS = ((1, 1, 5), (1, 6, 63), (2, 1, 63), (3, 1, 63))


def _ended(n: int) -> list[tuple[np.ndarray, int]]:
    """Codes of end-of-band runs over n blocks: the bits, and the number of blocks each covers."""
    out = []
    while n:
        size = min(n.bit_length() - 1, 14)
        run = min(n, 2 ** (size + 1) - 1)
        text = f"{size:04b}" + (f"{run - 2**size:0{size}b}" if size else "")
        out.append((np.frombuffer(text.encode(), dtype=np.uint8) - 48, run))
        n -= run
    return out


def encode(payload: bytes) -> bytes:
    """A progressive JPEG whose coefficients are the payload's bytes; the payload is a positive multiple of 64 bytes."""
    if not payload or len(payload) % 64:
        raise ValueError("a payload is a positive multiple of 64 bytes")
    blocks = len(payload) // 64
    units = -(-blocks // 6)
    cols = -(-units // MOST_ROWS)
    rows = -(-units // cols)
    data = np.zeros((rows * cols * 6, 64), dtype=np.uint8)
    data.reshape(-1)[: len(payload)] = np.frombuffer(payload, dtype=np.uint8)
    unit = data.reshape(rows, cols, 6, 64)
    planes = {1: unit[:, :, :4].reshape(rows, cols, 2, 2, 64).transpose(0, 2, 1, 3, 4).reshape(-1, 64)}
    planes[2], planes[3] = unit[:, :, 4].reshape(-1, 64), unit[:, :, 5].reshape(-1, 64)
    frame = struct.pack(">BHHB", 8, rows * 16, cols * 16, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])
    note = b"payload " + str(len(payload)).encode()
    out = [HEAD, _segment(0xFE, note), _segment(0xC2, frame), TABLES]
    three = [(1, 0, 0), (2, 0, 0), (3, 0, 0)]
    dc = data[:, 0]
    # All DC values are 256 to 511: shifted by 8 each is 1, so only each component's first difference is 1.
    start = np.asarray([1, 0, 1, 0, 0, 0, 1, 0, 1, 1, 0, 1], dtype=np.uint8)
    out.append(_scan(three, 0, 0, 0, 8, np.concatenate([start, np.zeros(6 * (rows * cols - 1), dtype=np.uint8)])))
    for c, first, last in BANDS:
        band = np.ascontiguousarray(planes[c][:, first : last + 1]).reshape(-1, 1)
        bits = np.zeros((len(band), 9), dtype=np.uint8)
        bits[:, 1:] = np.unpackbits((band >> 1) | 128, axis=1)
        out.append(_scan([(c, 0, 0)], first, last, 0, 1, bits.reshape(-1)))
    for low in range(7, -1, -1):
        out.append(_scan(three, 0, 0, low + 1, low, dc >> low & 1))
    for c, first, last in BANDS:
        bits, at, parts = planes[c][:, first : last + 1] & 1, 0, []
        for code, run in _ended(len(bits)):
            parts += [code, bits[at : at + run].reshape(-1)]
            at += run
        out.append(_scan([(c, 0, 1)], first, last, 1, 0, np.concatenate(parts)))
    return b"".join(out) + b"\xff\xd9"


# Reading


@dataclass
class Component:
    number: int
    across: int
    down: int
    quant: int
    wide: int = 0
    high: int = 0
    coef: np.ndarray = field(default_factory=lambda: np.empty(0, dtype=np.int32))


class Bits:
    """The bits of one scan."""

    def __init__(self, data: bytes):
        self.bits = np.unpackbits(np.frombuffer(data.replace(b"\xff\x00", b"\xff"), dtype=np.uint8))
        self.at = 0

    def take(self, n: int) -> int:
        value = 0
        for b in self.bits[self.at : self.at + n]:
            value = value << 1 | int(b)
        self.at += n
        return value

    def symbol(self, codes: dict[tuple[int, int], int]) -> int:
        code = 0
        for n in range(1, 17):
            code = code << 1 | int(self.bits[self.at])
            self.at += 1
            if (n, code) in codes:
                return codes[n, code]
        raise ValueError("no such code")

    def signed(self, size: int) -> int:
        v = self.take(size)
        return v if size == 0 or v >> (size - 1) else v - (1 << size) + 1


def _dc_places(c: Component, together: bool, grid: tuple[int, int]) -> np.ndarray:
    """Blocks of a component in the order of a DC scan, a row per unit (alone: per block)."""
    if not together:
        return np.arange(c.high * c.wide).reshape(-1, 1)
    first = (np.arange(grid[0]) * (c.down * c.wide))[:, None] + np.arange(grid[1]) * c.across
    return first.reshape(-1, 1) + [i * c.wide + j for i in range(c.down) for j in range(c.across)]


def _dc_scan(bits: Bits, parts: list, grid: tuple[int, int], high: int, low: int, memory: dict) -> None:
    """DC of one or more components, in unit order when several. memory keeps the orders of one picture."""
    together = len(parts) > 1
    order = []
    for c, _, _ in parts:
        if (c.number, together) not in memory:
            memory[c.number, together] = _dc_places(c, together, grid)
        order.append(memory[c.number, together])
    width = sum(p.shape[1] for p in order)
    n = len(order[0]) * width
    if high:
        got = bits.bits[:n].astype(np.int32).reshape(-1, width) << low
        at = 0
        for (c, _, _), p in zip(parts, order, strict=True):
            c.coef[p.reshape(-1), 0] |= got[:, at : at + p.shape[1]].reshape(-1)
            at += p.shape[1]
        return
    owner = np.repeat(np.arange(len(parts)), [p.shape[1] for p in order])
    diff = np.zeros(n, dtype=np.int64)
    skip = all(codes.get((1, 0)) == 0 for _, codes, _ in parts)
    ones = np.flatnonzero(bits.bits) if skip else None
    i = 0
    while i < n:
        if skip and not bits.bits[bits.at]:
            k = np.searchsorted(ones, bits.at)
            run = min(n - i, (int(ones[k]) if k < len(ones) else len(bits.bits)) - bits.at)
            i, bits.at = i + run, bits.at + run
            continue
        diff[i] = bits.signed(bits.symbol(parts[owner[i % width]][1]))
        i += 1
    diff = diff.reshape(-1, width)
    for m, ((c, _, _), p) in enumerate(zip(parts, order, strict=True)):
        c.coef[p.reshape(-1), 0] = (np.cumsum(diff[:, owner == m].reshape(-1)) << low).astype(np.int32)


def _ac_first(bits: Bits, c: Component, codes: dict, first: int, last: int, low: int) -> None:
    n, width = c.high * c.wide, last - first + 1
    if len(codes) == 1 and (1, 0) in codes and 0 < codes[1, 0] < 16:  # one symbol: no zeros before, always the same size
        size = codes[1, 0]
        got = bits.bits[: n * width * (size + 1)].reshape(n * width, size + 1)[:, 1:]
        if size == 8:
            value = np.packbits(got, axis=1).reshape(-1).astype(np.int32)
        else:
            value = got.astype(np.int32) @ (1 << np.arange(size - 1, -1, -1, dtype=np.int32))
        value = np.where(value >> (size - 1), value, value - (1 << size) + 1)
        c.coef[:, first : last + 1] = value.reshape(n, width) << low
        return
    ended = 0
    for b in range(n):
        if ended:
            ended -= 1
            continue
        k = first
        while k <= last:
            run, size = divmod(bits.symbol(codes), 16)
            if size:
                k += run
                c.coef[b, k] = bits.signed(size) * (1 << low)
                k += 1
            elif run == 15:
                k += 16
            else:
                ended = (1 << run) + bits.take(run) - 1
                break


def _ac_refine(bits: Bits, c: Component, codes: dict, first: int, last: int, low: int) -> None:
    n, step, b = c.high * c.wide, 1 << low, 0
    band = c.coef[:, first : last + 1]
    full = bool((band != 0).all())
    ended = 0
    while b < n:
        if ended and full:  # every coefficient of the run has one correction bit
            m = min(ended, n - b)
            got = bits.bits[bits.at : bits.at + m * band.shape[1]].reshape(m, -1).astype(np.int32)
            bits.at += got.size
            band[b : b + m] += np.where(band[b : b + m] > 0, got, -got) * step
            b, ended = b + m, ended - m
            continue
        k = 0
        if not ended:
            while k < band.shape[1]:
                run, size = divmod(bits.symbol(codes), 16)
                value = 0
                if size:
                    value = step if bits.take(1) else -step
                elif run < 15:
                    ended = (1 << run) + bits.take(run)
                    break
                while k < band.shape[1]:
                    if band[b, k]:
                        if bits.take(1):
                            band[b, k] += step if band[b, k] > 0 else -step
                    elif run:
                        run -= 1
                    else:
                        band[b, k] = value
                        k += 1
                        break
                    k += 1
        if ended:
            if full and k == 0:
                continue
            for j in range(k, band.shape[1]):
                if band[b, j] and bits.take(1):
                    band[b, j] += step if band[b, j] > 0 else -step
            ended -= 1
        b += 1


@dataclass
class Picture:
    width: int
    height: int
    parts: list[Component]
    quant: dict[int, np.ndarray]
    note: bytes

    def rgb(self) -> np.ndarray:
        """Full-resolution height x width x 3 tensor of bytes."""
        base = idct_matrix()
        most_a, most_d = max(c.across for c in self.parts), max(c.down for c in self.parts)
        planes = []
        for c in self.parts:
            q = self.quant[c.quant].astype(np.float32)[:, None]
            flat = c.coef.astype(np.float32) @ (q * base) + np.float32(128)
            plane = flat.reshape(c.high, c.wide, 8, 8).transpose(0, 2, 1, 3).reshape(c.high * 8, c.wide * 8)
            plane = np.clip(plane, 0, 255, out=plane)
            if (a := most_a // c.across) > 1:
                plane = np.repeat(plane, a, axis=1)
            if (d := most_d // c.down) > 1:
                plane = np.repeat(plane, d, axis=0)
            planes.append(plane[: self.height, : self.width])
        out = np.empty((self.height, self.width, 3), dtype=np.uint8)
        if len(planes) == 1:
            out[:] = np.rint(planes[0])[:, :, None]
            return out
        y, cb, cr = planes[0], planes[1] - np.float32(128), planes[2] - np.float32(128)
        out[:, :, 0] = np.clip(np.rint(y + np.float32(1.402) * cr), 0, 255)
        out[:, :, 1] = np.clip(np.rint(y - np.float32(0.344136) * cb - np.float32(0.714136) * cr), 0, 255)
        out[:, :, 2] = np.clip(np.rint(y + np.float32(1.772) * cb), 0, 255)
        return out


def decode(data: bytes) -> Picture:
    """Read a progressive JPEG (Huffman, 8 bits, no restart intervals) into coefficient arrays."""
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG")
    at, quant, codes, pic, memory = 2, {}, {}, None, {}
    note = b""
    while True:
        marker, size = data[at + 1], 0
        if marker == 0xD9:
            break
        size = struct.unpack_from(">H", data, at + 2)[0]
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xDB:
            while body:
                wide = 2 if body[0] >> 4 else 1
                quant[body[0] & 15] = np.frombuffer(body[1 : 1 + 64 * wide], dtype=">u2" if wide == 2 else "u1")
                body = body[1 + 64 * wide :]
        elif marker == 0xC4:
            while body:
                counts, k, code, table = body[1:17], 17, 0, {}
                for n, count in enumerate(counts, 1):
                    for _ in range(count):
                        table[n, code] = body[k]
                        code, k = code + 1, k + 1
                    code <<= 1
                codes[body[0] >> 4, body[0] & 15] = table
                body = body[k:]
        elif marker == 0xC2:
            height, width, n = struct.unpack(">HHB", body[1:6])
            parts = [Component(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)]
            across, down = max(c.across for c in parts), max(c.down for c in parts)
            grid = -(-height // (8 * down)), -(-width // (8 * across))
            for c in parts:
                c.wide, c.high = grid[1] * c.across, grid[0] * c.down
                c.coef = np.zeros((c.wide * c.high, 64), dtype=np.int32)
            pic = Picture(width, height, parts, quant, b"")
        elif marker == 0xFE:
            note = body
        elif marker == 0xDA:
            end = at
            while True:
                end = data.index(b"\xff", end)
                if data[end + 1]:
                    break
                end += 2
            bits, n = Bits(data[at:end]), body[0]
            first, last, high, low = body[1 + 2 * n], body[2 + 2 * n], body[3 + 2 * n] >> 4, body[3 + 2 * n] & 15
            by = {c.number: c for c in pic.parts}
            chosen = [(by[body[1 + 2 * i]], codes.get((0, body[2 + 2 * i] >> 4), {}), codes.get((1, body[2 + 2 * i] & 15), {})) for i in range(n)]
            if first == 0:
                _dc_scan(bits, chosen, grid, high, low, memory)
            elif high:
                _ac_refine(bits, chosen[0][0], chosen[0][2], first, last, low)
            else:
                _ac_first(bits, chosen[0][0], chosen[0][2], first, last, low)
            at = end
        elif marker in (0xC0, 0xC1, 0xDD):
            raise ValueError("only progressive pictures without restart intervals")
    if pic is None:
        raise ValueError("no frame")
    pic.note = note
    return pic


def payload_of(pic: Picture) -> bytes:
    """The bytes that encode() stored."""
    y, cb, cr = pic.parts
    rows, cols = cb.high, cb.wide
    unit = np.empty((rows, cols, 6, 64), dtype=np.uint8)
    unit[:, :, :4] = (y.coef - BIAS).astype(np.uint8).reshape(rows, 2, cols, 2, 64).transpose(0, 2, 1, 3, 4).reshape(rows, cols, 4, 64)
    unit[:, :, 4] = (cb.coef - BIAS).astype(np.uint8).reshape(rows, cols, 64)
    unit[:, :, 5] = (cr.coef - BIAS).astype(np.uint8).reshape(rows, cols, 64)
    return unit.tobytes()[: int(pic.note.split()[1])]


def feature_of(rgb: np.ndarray) -> str:
    """Size, and mean and spread of each colour of the tensor."""
    flat = rgb.reshape(-1, 3)
    total = flat.sum(axis=0, dtype=np.int64)
    square = [int(np.dot(c, c)) for c in flat.astype(np.float64).T]
    n = len(flat)
    parts = [f"{t / n:.4f}~{max(s / n - (t / n) ** 2, 0) ** 0.5:.4f}" for t, s in zip(total.tolist(), square, strict=True)]
    return f"{rgb.shape[1]}x{rgb.shape[0]} " + " ".join(parts)


def store(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: each whole text as a progressive JPEG. Null texts count as empty (64 zero bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                ids, texts = batch.column(0).slice(at, 200), batch.column(1).slice(at, 200).to_pylist()
                raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
                media = [encode(r + b"\0" * (-len(r) % 64 if r else 64)) for r in raw]
                yield pa.RecordBatch.from_arrays([ids, pa.array([len(r) for r in raw], pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def tensors(media: DataFrame) -> DataFrame:
    """doc_id, height, width, rgb from doc_id, media: full-resolution tensors, row by row. Null media: null tensor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                m = batch.column(1)[at].as_py()
                t = None if m is None else decode(m).rgb()
                size = (None, None) if t is None else t.shape[:2]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, 1), pa.array([size[0]], pa.int32()), pa.array([size[1]], pa.int32()), pa.array([None if t is None else t.tobytes()], pa.binary())],
                    ["doc_id", "height", "width", "rgb"],
                )

    return media.select(F.col("doc_id").cast("long"), "media").mapInArrow(run, "doc_id long, height int, width int, rgb binary")


def digests(media: DataFrame) -> DataFrame:
    """Read stored pictures back: payload length, SHA-256 and last 64 bytes' CRC, the file's length and SHA-256, feature.

    media: doc_id, n_bytes, media as store() gives them; other columns are ignored, repeated rows give equal rows.
    """
    types = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, n, m in zip(*(batch.column(c) for c in range(3)), strict=True):
                m = m.as_py()
                pic = decode(m)
                p = payload_of(pic)
                rows.append((doc_id.as_py(), n.as_py(), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), len(m), hashlib.sha256(m).hexdigest(), feature_of(pic.rgb())))
            columns = zip(*rows, strict=True) if rows else [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, types, strict=True)], [n for n, _ in types])

    return media.select("doc_id", "n_bytes", "media").mapInArrow(
        run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    )
