"""Alignment of two tokenizers over the same texts, and how often their tokens meet.

A is a byte-level BPE (its JSON file), B a SentencePiece BPE model; both encode by
``merges``. Both spell a space and the text, so a token is a byte range of that.

Alignment by diagonal run skipping. The ends of A's and B's tokens are compared at the
current shift between the two arrays: slices of 1, 2, 4, ... ends while they are
equal, then halves, so that a one-to-one stretch is jumped in logarithmically many
comparisons. Where it stops, the irregular group is resolved token by token up to
the next common end, which gives its links (overlapping tokens) and the new shift. The end of a
document is a common end, so documents of one part are aligned in one go.

Counts. A task aligns documents in chunks of about ``CHUNK`` bytes and writes, for a
chunk, its distinct pairs of linked ids with the number of documents that hold
each, and for each document the places of its pairs among them, in rows of ``HELD`` pairs or places at most.
So pairs that occur in every document are written once a chunk. The pairs are counted over all chunks,
joined with the counts, and each chunk gets the counts of its own pairs back.
The chunks are a table in the shared folder, under a name of its own; whoever owns that
folder retires it. The number of pairs is not bounded by the vocabularies in any useful way,
so nothing is broadcast or collected.

Memory: a task holds one Arrow batch of texts (``BATCH`` rows), the tokens of a part (``PART`` bytes, one document at
least) and the pairs of a chunk. A document is aligned whole, so a longer one makes a part of its own size.
Parquet looks at the size of its pages and row groups every 100 rows at the soonest and reads 4,096 rows at once, so what
executors hold does not grow with a task's documents only if no row is large: hence ``HELD``, and row groups of
``BLOCK`` bytes.

Defined results: null and empty texts, and texts that a tokenizer does not spell as a space and the text
(U+2581 is a space to B), have no tokens: zeros and no groups. Strings of special
tokens are plain text. Each row counts as a document, so a repeated row adds to counts
and gets its own row; null doc_ids stay null. Pairs that tie for the highest count of their A id
are all best. An empty table gives none. Other columns, whatever their names, are never read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from towerlens.llm.merges import Merges, ragged_take
from towerlens.llm.op12_pieces import Model, batches_of, read_file
from towerlens.llm.text import documents, read_table
from towerlens.session import shared_dir

#: Bytes of text whose pairs are counted together, and bytes tokenised at once.
CHUNK, PART = 4 << 20, 1 << 19
#: Texts sent to a task at once, pairs of a row, and bytes of a row group of the chunks.
BATCH, HELD, BLOCK = 1000, 4096, 16 << 20


class ByteModel:
    """Vocabulary and merges of a byte-level BPE in a tokenizers JSON file."""

    def __init__(self, data: bytes, pattern: str):
        model, self.split = json.loads(data)["model"], regex.compile(pattern).findall
        vocab = model["vocab"]
        # The format writes a byte as itself where it is a printable character of Latin-1, else as one of 256, 257, ...
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        byte_of = {chr(b): b for b in plain} | {
            chr(256 + n): b for n, b in enumerate(sorted(set(range(256)) - set(plain)))}
        self.symbol = np.zeros(256, dtype=np.int32)
        for c, b in byte_of.items():
            self.symbol[b] = vocab[c]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = Merges({(vocab[x], vocab[y]): (n, vocab[x + y]) for n, (x, y) in enumerate(merges)})
        out: list[bytes] = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            if all(c in byte_of for c in token):
                out[i] = bytes(byte_of[c] for c in token)
        self.bytes = np.frombuffer(b"".join(out), dtype=np.uint8)
        self.ends = np.append(0, np.cumsum([len(x) for x in out]))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and n+1 ends; equal matches of the pattern are encoded once."""
        pieces, first = [], [0]
        for t in texts:
            pieces += self.split(t)
            first.append(len(pieces))
        words = pa.array(pieces, pa.large_string()).dictionary_encode()
        distinct = words.dictionary
        if not len(distinct):
            return np.zeros(0, dtype=np.int32), np.zeros(len(texts) + 1, dtype=np.int64)
        ends = np.frombuffer(distinct.buffers()[1], dtype=np.int64)[: len(distinct) + 1]
        raw = np.frombuffer(distinct.buffers()[2], dtype=np.uint8)[: ends[-1]]
        ids, size = ragged_take(*self.merges.run(self.symbol[raw], ends), words.indices.to_numpy())
        return ids, np.append(0, np.cumsum(size))[first]


def diagonal_runs(a: list[int], b: list[int]) -> tuple[list, list, tuple[list[int], list[int]]]:
    """Groups between common ends, and the links inside irregular ones.

    ``a`` and ``b`` are the ends of two token sequences over the same bytes. One-to-one
    runs come as (i, j, length), irregular groups as (i, i end, j, j end), links as two lists of token numbers.
    """
    runs, odd, left, right = [], [], [], []
    i, j, n = 0, 0, len(a)
    while i < n:
        begin = i
        if a[i] == b[j]:
            i, j, step = i + 1, j + 1, 2
            while i < n and a[i: i + step] == b[j: j + step]:
                i, j, step = i + step, j + step, 2 * step
            if i > n:  # the last slice was shorter than the step
                j, i = j - (i - n), n
            while step > 1 and i < n:
                step >>= 1
                if i + step <= n and a[i: i + step] == b[j: j + step]:
                    i, j = i + step, j + step
            runs.append((begin, j - (i - begin), i - begin))
            if i >= n:
                break
        at, to = i, j
        x, y = a[i], b[j]
        while x != y:
            left.append(i)
            right.append(j)
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        left.append(i)
        right.append(j)
        i, j = i + 1, j + 1
        odd.append((at, i, to, j))
    return runs, odd, (left, right)


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after the other."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


class Aligned:
    """Documents of one part, their tokens one after the other: the end of a document is a common end."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        """``a`` and ``b``: ends of the tokens over all documents' bytes."""
        runs, odd, (left, right) = diagonal_runs(a.tolist(), b.tolist())
        runs, odd = np.array(runs, dtype=np.int64).reshape(-1, 3), np.array(odd, dtype=np.int64).reshape(-1, 4)
        self.left = np.concatenate([ranges(runs[:, 0], runs[:, 2]), np.array(left, dtype=np.int64)])
        self.right = np.concatenate([ranges(runs[:, 1], runs[:, 2]), np.array(right, dtype=np.int64)])
        self.last = np.ones(len(a), dtype=bool), np.ones(len(b), dtype=bool)  # tokens that end a group
        for flags, at, end in ((self.last[0], odd[:, 0], odd[:, 1]), (self.last[1], odd[:, 2], odd[:, 3])):
            flags[ranges(at, end - at - 1)] = False

    def groups(self) -> np.ndarray:
        """n+1 numbers: groups that end before each token of A."""
        return np.append(0, np.cumsum(self.last[0]))

    def in_order(self, x: np.ndarray, y: np.ndarray, n_a: int, n_b: int) -> np.ndarray:
        """Spellings of all tokens, A's of a group before B's: numbers of ``spellings(n_a, n_b)``."""
        ends = [np.flatnonzero(f) + 1 for f in self.last]
        group = [np.cumsum(f) - f for f in self.last]
        out = np.empty(len(x) + len(y), dtype=np.int64)
        out[np.arange(len(x)) + np.append(0, ends[1])[group[0]]] = x + n_a * self.last[0]
        out[np.arange(len(y)) + ends[0][group[1]]] = y + 2 * n_a + n_b * self.last[1]
        return out


def spellings(n_a: int, n_b: int) -> list[str]:
    """Ids in decimal with what follows them: inside A's part of a group, at its end, inside B's, at its end."""
    return [f"{i}{mark}" for n, marks in ((n_a, ",|"), (n_b, ",;")) for mark in marks for i in range(n)]


def pair_times(keys: np.ndarray, docs: np.ndarray, times: np.ndarray | None = None
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys; and places of keys among them, documents and times of each pair of a document, in their order."""
    found = pa.array(keys).dictionary_encode()
    pairs, place = found.dictionary.to_numpy(), found.indices.to_numpy()
    if times is None:
        held = pa.array(docs * len(pairs) + place).value_counts()
        docs, place = np.divmod(np.asarray(held.field(0)), max(len(pairs), 1))
        times = np.asarray(held.field(1))
    order = np.argsort(docs * len(pairs) + place)
    return pairs, place[order], docs[order], times[order]


class Chunk:
    """Aligned documents, until their pairs are counted together."""

    def __init__(self):
        self.size, self.rows, self.keys, self.docs, self.times = 0, [], [], [], []

    def add(self, rows: list[tuple], keys: np.ndarray, docs: np.ndarray, size: int) -> None:
        """Rows of documents, and their links: keys of id pairs and the place of each one's row."""
        pairs, place, docs, times = pair_times(keys, docs)
        self.keys.append(pairs[place])
        self.docs.append(docs + len(self.rows))
        self.times.append(times)
        self.rows += rows
        self.size += size

    def batches(self, number: int) -> Iterator[pa.RecordBatch]:
        """Rows of the documents, each followed by one for each further ``HELD`` of its pairs, then rows of the pairs."""
        pairs, place, docs, times = pair_times(*(np.concatenate(x) for x in (self.keys, self.docs, self.times)))
        of, first, ends = slices_of(np.bincount(docs, minlength=len(self.rows)))
        value_at = pa.array(of, mask=~first)
        values = [pa.array(v, kind).take(value_at) for v, kind in zip(zip(*self.rows), CHUNK_TYPES[2:8])]
        lists = [pa.ListArray.from_arrays(ends, pa.array(v, pa.int32())) for v in (place, times)]
        yield self.batch(number, [pa.array(of, pa.int32()), *values, *lists, *[None] * 4])
        _, _, ends = slices_of(np.array([len(pairs)]))
        n_docs = np.bincount(place, minlength=len(pairs))
        lists = [pa.ListArray.from_arrays(ends, pa.array(v, pa.int32())) for v in (pairs >> 32, pairs & 0xFFFFFFFF, n_docs)]
        yield self.batch(number, [*[None] * 9, pa.array(ends[:-1]), *lists])

    @staticmethod
    def batch(number: int, columns: list[pa.Array | None]) -> pa.RecordBatch:
        size = len(columns[-1] if columns[0] is None else columns[0])
        columns = [pa.nulls(size, kind) if c is None else c for c, kind in zip(columns, CHUNK_TYPES[1:])]
        return pa.RecordBatch.from_arrays([pa.array(np.full(size, number)), *columns], CHUNK_NAMES)


def slices_of(size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lists of these sizes in slices of ``HELD`` values, one at least: the list of each, whether it is the first, n+1 ends."""
    parts = np.maximum(-(-size // HELD), 1)
    of = np.repeat(np.arange(len(size)), parts)
    nth = ranges(np.zeros(len(parts), dtype=np.int64), parts)
    return of, nth == 0, np.append(0, np.cumsum(np.minimum(size[of] - nth * HELD, HELD))).astype(np.int32)


#: ``doc``: number of a document in its chunk, ``place``: that of a row's first pair; from there on, columns are of pairs.
CHUNK_SCHEMA = ("chunk long, doc int, doc_id long, n_a int, n_b int, n_groups int, n_links int, groups string, "
                "held array<int>, times array<int>, place int, a array<int>, b array<int>, docs array<int>")
CHUNK_NAMES, CHUNK_KINDS = zip(*(field.split(" ") for field in CHUNK_SCHEMA.split(", ")))
CHUNK_TYPES = [{"long": pa.int64(), "int": pa.int32(), "string": pa.string()}.get(k, pa.list_(pa.int32())) for k in CHUNK_KINDS]


def aligned_chunks(docs: DataFrame, byte_path: str, pattern: str, piece_path: str, digest: bool = False) -> DataFrame:
    """Rows of the documents and of the pairs of chunks (``Chunk``); ``groups`` are texts, or their SHA-256 where ``digest``."""
    byte_data, piece_data = read_file(byte_path), read_file(piece_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = ByteModel(byte_data, pattern), Model(piece_data)
        sizes = [len(m.ends) - 1 for m in (left, right)]
        spelling, width = spellings(*sizes).__getitem__, [np.diff(m.ends) for m in (left, right)]
        task, number, chunk = TaskContext.get().partitionId(), 0, Chunk()
        for b, texts in batches_of(batches, PART):
            ids = [left.encode([" " + t if t else "" for t in texts]), right.encode(texts)]
            want = np.array([len(t.encode()) + 1 if t else 0 for t in texts])
            # Both spell what they keep in order, so they spell the text if they are as long.
            fine = want > 0
            for (i, e), w in zip(ids, width):
                fine &= np.diff(np.append(0, np.cumsum(w[i]))[e]) == want
            (x, n_a), (y, n_b) = (ragged_take(i, e, np.flatnonzero(fine)) for i, e in ids)
            found = Aligned(np.cumsum(width[0][x]), np.cumsum(width[1][y]))
            order = found.in_order(x, y, *sizes)
            first, both = np.append(0, np.cumsum(n_a)), np.append(0, np.cumsum(n_a + n_b))
            n_groups = np.diff(found.groups()[first])
            rows, at = [], 0
            for doc_id, ok in zip(b.column("doc_id").to_pylist(), fine.tolist()):
                if not ok:
                    rows.append((doc_id, 0, 0, 0, 0, ""))
                    continue
                groups = "".join(map(spelling, order[both[at]: both[at + 1]].tolist()))[:-1]
                rows.append((doc_id, n_a[at], n_b[at], n_groups[at], n_a[at] + n_b[at] - n_groups[at],
                             sha256(groups.encode()).hexdigest() if digest else groups))
                at += 1
            of = np.flatnonzero(fine)[np.searchsorted(first, found.left, side="right") - 1]
            chunk.add(rows, x[found.left].astype(np.int64) << 32 | y[found.right], of, int(want.sum()))
            if chunk.size >= CHUNK:
                yield from chunk.batches(task << 32 | number)
                number, chunk = number + 1, Chunk()
        if chunk.rows:
            yield from chunk.batches(task << 32 | number)

    return documents(docs).mapInArrow(run, CHUNK_SCHEMA)


def chunk_pairs(chunks: DataFrame) -> DataFrame:
    """(chunk, place, a, b, docs): the distinct pairs of each chunk."""
    rows = chunks.where(F.col("place").isNotNull()).select(
        "chunk", F.col("place").alias("first"), F.posexplode(F.arrays_zip("a", "b", "docs")).alias("nth", "p"))
    return rows.select("chunk", (F.col("first") + F.col("nth")).alias("place"), F.col("p.a").alias("a"),
                       F.col("p.b").alias("b"), F.col("p.docs").cast("long").alias("docs"))


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(a, b, n_docs, best): documents that hold each pair of ids linked, and whether none of its A id has more."""
    counts = chunk_pairs(chunks).groupBy("a", "b").agg(F.sum("docs").alias("n_docs"))
    highest = counts.groupBy("a").agg(F.max("n_docs").alias("highest"))
    return counts.join(highest, "a").select("a", "b", "n_docs", (F.col("n_docs") == F.col("highest")).alias("best"))


def scored(rows: pa.Table, pairs: pa.Table) -> pa.Table:
    """Rows of a chunk's documents, given the counts of its pairs."""
    count, best = (np.zeros(len(pairs), dtype=np.int64) for _ in range(2))
    at = pairs.column("place").to_numpy()
    count[at], best[at] = pairs.column("n_docs").to_numpy(), pairs.column("best").to_numpy()
    place, times = (rows.column(k).combine_chunks().flatten().to_numpy() for k in ("held", "times"))
    of = np.repeat(rows.column("doc").to_numpy(), pc.list_value_length(rows.column("held")).to_numpy())
    one = rows.filter(pc.is_valid(rows.column("n_a")))
    total, n_best = (np.zeros(len(one), dtype=np.int64) for _ in range(2))
    for out, value in ((total, count), (n_best, best)):
        np.add.at(out, of, value[place] * times)
    doc = one.column("doc").to_numpy()
    wide = {k: one.column(k).cast(pa.int64()) for k in ("n_a", "n_b", "n_groups", "n_links")}
    return pa.table({"doc_id": one.column("doc_id"), **wide, "n_best": n_best[doc], "count_sum": total[doc],
                     "groups": one.column("groups")})


def counted(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the documents of all chunks, with the counts of their pairs."""
    chunks, held = (spark.read.schema(CHUNK_SCHEMA).parquet(folder) for _ in range(2))
    pairs = chunk_pairs(chunks).select("chunk", "place", "a", "b").join(pair_counts(chunks), ["a", "b"])
    held = held.where(F.col("doc").isNotNull()).drop("place", "a", "b", "docs")
    return held.groupBy("chunk").cogroup(
        pairs.select("chunk", "place", "n_docs", "best").groupBy("chunk")).applyInArrow(
        lambda left, right: scored(left, right),
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string")


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """``BATCH`` rows at most go to Python at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if not 0 < int(before) <= BATCH:
        spark.conf.set(name, str(BATCH))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def align(docs: DataFrame, byte_path: str, pattern: str, piece_path: str, digest: bool = False) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of every document."""
    spark = docs.sparkSession
    folder = f"{shared_dir(spark)}/aligned-{uuid.uuid4().hex}"
    with small_batches(spark):
        aligned_chunks(docs, byte_path, pattern, piece_path, digest).write.option("parquet.block.size", BLOCK).parquet(folder)
    return counted(spark, folder)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = align(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model"), digest=True)
    return out.withColumnRenamed("groups", "groups_sha256")
