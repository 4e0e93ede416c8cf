"""Vectorised text helpers for Arrow batches, and shared DataFrame steps.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D, which on UTF-8
equals the pattern ``[^\\x20\\x09-\\x0D]+`` on characters. All hashes are seeded
by fixed numbers, so reruns and recomputed tasks agree.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of text handled at once by the numpy code; a longer text is one chunk.
CHUNK = 1 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_RNG = np.random.default_rng(20240229)
BYTE_CODE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
RADIX = np.uint64(0x9E3779B97F4A7C15)
RADIX_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: The first n of 8 bytes, and the longest slice that is hashed 8 bytes at a time.
FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
STEPPED = 512


def slice_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte slice, chained over its 8-byte parts; of long ones by BLAKE2b.

    A polynomial of the place would not do: modulo 2**64 it has one value for certain strings.
    """
    size = end - start
    padded = np.concatenate((raw, np.zeros(8, dtype=np.uint8)))
    eight = np.ndarray(len(raw) + 1, dtype="<u8", buffer=padded, strides=(1,))
    out = mix((eight[start] & FIRST_BYTES[np.minimum(size, 8)]) + mix(size.astype(np.uint64)))
    more, k = np.flatnonzero((size > 8) & (size <= STEPPED)), 8
    while len(more):
        part = eight[start[more] + k] & FIRST_BYTES[np.minimum(size[more] - k, 8)]
        out[more] = mix(out[more] * RADIX + mix(part))
        k += 8
        more = more[size[more] > k]
    for i in np.flatnonzero(size > STEPPED).tolist():
        out[i] = int.from_bytes(blake2b(raw[start[i]: end[i]].tobytes(), digest_size=8).digest(), "little")
    return out


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Prefix:
    """Polynomial prefix sums over a sequence: the hash of any slice in O(1)."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(codes * powers(RADIX, n), out=self.sums[1:])
        self.back = powers(RADIX_INVERSE, n + 1)

    def slices(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start])

    def windows(self, size: int) -> np.ndarray:
        """Hash of every slice of ``size`` elements, by its start."""
        n = len(self.sums) - size
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        return mix((self.sums[size:] - self.sums[:n]) * self.back[:n])


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text or binary column and its n+1 offsets; null counts as empty."""
    kind = pa.large_binary()
    column = column.cast(pa.large_string()).cast(kind) if pa.types.is_string(column.type) else column.cast(kind)
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]: offs[-1]], offs - offs[0]


def chunks(raw: np.ndarray, offs: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``size`` bytes; one row at least."""
    at, n = 0, len(offs) - 1
    while at < n:
        end = int(np.searchsorted(offs, offs[at] + size, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end
        at = end


class Words:
    """Word bounds of consecutive texts: ``start``/``end`` bytes, ``first`` word of each row."""

    def __init__(self, raw: np.ndarray, offs: np.ndarray, lower: bool = False, gaps: np.ndarray = SPACE):
        solid = ~gaps[raw]
        edge = np.zeros(len(raw) + 1, dtype=bool)
        edge[offs] = True
        before = np.empty_like(solid)
        before[1:] = solid[:-1]
        if len(solid):
            before[0] = False
        self.start = np.flatnonzero(solid & (~before | edge[:-1]))
        after = np.empty_like(solid)
        after[:-1] = solid[1:]
        if len(solid):
            after[-1] = False
        self.end = np.flatnonzero(solid & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, offs)
        self.count = np.diff(self.first)
        self.row = np.repeat(np.arange(len(offs) - 1), self.count)
        self.index = np.arange(len(self.start)) - self.first[:-1][self.row]
        self._raw, self._lower = raw, lower

    def hashes(self) -> np.ndarray:
        return slice_hashes(LOWER[self._raw] if self._lower else self._raw, self.start, self.end)

    def room(self) -> np.ndarray:
        """Words from each word to the end of its row, itself included."""
        return self.first[1:][self.row] - np.arange(len(self.start))


def sliding_argmin(value: np.ndarray, size: int) -> np.ndarray:
    """For each start, the position of the leftmost least value among ``size`` elements."""
    n = len(value) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    best = value
    place = np.arange(len(value), dtype=np.int32 if len(value) < 1 << 31 else np.int64)
    span = 1
    while span < size:
        step = min(span, size - span)
        later = best[step:] < best[:-step]
        place = np.where(later, place[step:], place[:-step])
        best = np.where(later, best[step:], best[:-step])
        span += step
    return place[:n]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Smaller batches, for code that holds a batch's texts as Python objects."""
    for b in batches:
        for at in range(0, len(b), rows):
            yield b.slice(at, rows)


def _text_keys(texts: list[bytes]) -> tuple[pa.Array, pa.Array]:
    """128 bits of each text's BLAKE2b as two integers."""
    both = np.frombuffer(b"".join(blake2b(t, digest_size=16).digest() for t in texts), dtype="<i8").reshape(-1, 2)
    return pa.array(both[:, 0].astype(np.int64)), pa.array(both[:, 1].astype(np.int64))


#: Takes the place of a null doc_id: less than any other.
NO_DOC_ID = -(1 << 63)


def text_keys(docs: DataFrame) -> DataFrame:
    """(row_id, r1, r2, size): doc_id, key and bytes of every row's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = [(t or "").encode() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *_text_keys(texts), pa.array([len(t) for t in texts], pa.int64())],
                ["row_id", "r1", "r2", "size"])

    return docs.select("doc_id", "text").mapInArrow(run, "row_id long, r1 long NOT NULL, r2 long NOT NULL, size long")


def distinct_texts(docs: DataFrame) -> DataFrame:
    """(h1, h2, doc_id, copies, z): each text once, as a zstd blob, with its least doc_id.

    Copies in a part of a batch are folded before the shuffle. It is by ``h1``
    alone, so that joins on ``h1`` read the same shuffle again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for b in slices(batches):
            found: dict[str, list] = {}
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                doc_id = NO_DOC_ID if doc_id is None else doc_id
                row = found.setdefault(text or "", [doc_id, 0])
                row[0], row[1] = min(row[0], doc_id), row[1] + 1
            texts = [t.encode() for t in found]
            ids, copies = ([r[i] for r in found.values()] for i in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [*_text_keys(texts), pa.array(ids, pa.int64()), pa.array(copies, pa.int64()),
                 pa.array([squeeze(t) for t in texts], pa.binary())], ["h1", "h2", "doc_id", "copies", "z"])

    folded = docs.select("doc_id", "text").mapInArrow(
        run, "h1 long NOT NULL, h2 long NOT NULL, doc_id long NOT NULL, copies long NOT NULL, z binary")
    return folded.repartition("h1").groupBy("h1", "h2").agg(
        F.min("doc_id").alias("doc_id"), F.sum("copies").alias("copies"), F.first("z").alias("z"))


def unpacked(blobs: list[bytes]) -> list[bytes]:
    grow = zstandard.ZstdDecompressor().decompress
    return [grow(b) if b else b"" for b in blobs]


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a list of texts."""
    offs = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=offs[1:])
    return np.frombuffer(b"".join(texts), dtype=np.uint8), offs


def same_value(a: str, b: str) -> Column:
    """a = b in a form that Spark does not take for a join key."""
    return ~(F.col(a) < F.col(b)) & ~(F.col(a) > F.col(b))


def held_places(lists: pa.Array, first: np.ndarray, n: int) -> np.ndarray:
    """Flags of ``n`` elements at the places that each row lists, counted from its ``first``."""
    out = np.zeros(n + 1, dtype=bool)
    at = np.repeat(first[:-1], lists.value_lengths().fill_null(0).to_numpy()) + lists.flatten().to_numpy()
    out[at[at < n]] = True
    return out


def documents(docs: DataFrame) -> DataFrame:
    """The two columns that operators on documents read; others are pruned in the scan."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def known_locally(key: np.ndarray, spread: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pre-aggregation of one batch before a shuffle by ``key``.

    A key met more than once in the batch is known to be repeated. Its first row
    keeps the key (and tells other tasks); the others move to a key of their own
    (``spread``), so one hot key costs a reducer one row for each batch.
    """
    order = np.argsort(key, kind="stable")
    k = key[order]
    same = np.zeros(len(k), dtype=bool)
    same[1:] = k[1:] == k[:-1]
    known = same.copy()
    known[:-1] |= same[1:]
    out_known, out_key = np.empty(len(k), dtype=bool), key.copy()
    out_known[order] = known
    moved = order[same]
    out_key[moved] = mix(spread[moved] ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    return out_key, out_known


def repeated(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys occur more than once, or which are ``known`` to be repeated."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return rows.withColumn("_n", n).where("known OR _n > 1").drop("_n")


def whole_row(docs: DataFrame) -> Column:
    """All columns as one struct: whatever they are named, no column of a stage clashes with them."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`").alias(c) for c in docs.columns])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
