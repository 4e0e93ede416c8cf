"""Quality rules: hashed n-gram log-likelihood ratio, and counts of simple faults.

Two multinomials over hashed words and word pairs (2**16 buckets): the raw corpus,
counted over every document, and the trusted target, counted over every document
labelled good (found by a merge join at every size of the labels, so the plan never changes with
them; texts are shuffled and kept in the shared folder compressed). The
target is smoothed with ``PRIOR`` pseudo-counts spread as the raw corpus. A text's
score is the mean of log(target / raw) over its n-grams. The threshold is fixed
before any verdict: the ``QUANTILE`` of the scores of the trusted documents, each
scored without its own counts, so it depends on the data alone and a document's
verdict only on its text and these numbers. What reaches the driver has a fixed
size: two counts a bucket, and histograms of ``CELLS`` cells that narrow the quantile
down to one score.

A document fails the base rules if it has under 20 words, or if more than 30 of
100 words lie in 8-word windows found twice or more in it.

Defined results: null and empty texts have no words and fail the base rules.
Without trusted documents every text passes the ratio. Every row is judged alone,
so repeated rows and null doc_ids get equal verdicts. Other columns are carried by
``keep_rows`` whatever their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from towerlens.llm.text import (
    Prefix, Words, chunks, mix, read_table, slice_hashes, slices, unpacked, utf8, whole_row,
)
from towerlens.session import shared_dir

BUCKET_BITS = 16
PRIOR = 20_000.0
QUANTILE = 0.002
#: Cells of a histogram of scores.
CELLS = 1 << 14

MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30

SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[list(b"#*$%&|<>")] = True


def buckets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of each word and each pair of neighbours."""
    codes = words.hashes()
    pair = mix(codes[:-1] * np.uint64(3) + mix(codes[1:]))
    inside = words.row[:-1] == words.row[1:]
    row = np.concatenate((words.row, words.row[:-1][inside]))
    return row, (np.concatenate((codes, pair[inside])) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def by_chunk(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    raw, offs = utf8(column)
    for i, j in chunks(raw, offs):
        yield i, j, raw[offs[i]: offs[j]], offs[i: j + 1] - offs[i]


def trusted_texts(texts: DataFrame, labels: DataFrame) -> DataFrame:
    """(text): the texts of (doc_id, text) rows that are labelled good, written to the shared folder."""
    spark = texts.sparkSession
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for b in slices(batches):
            blobs = [squeeze((t or "").encode()) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(blobs, pa.binary())], ["doc_id", "z"])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array(unpacked(b.column("z").to_pylist()), pa.binary())], ["text"])

    folder = f"{shared_dir(spark)}/trusted-{uuid.uuid4().hex}"
    packed = texts.where("doc_id IS NOT NULL").mapInArrow(pack, "doc_id long, z binary")
    packed.join(good.hint("merge"), "doc_id", "left_semi").select("z").write.parquet(f"{folder}/texts")
    return spark.read.parquet(f"{folder}/texts").mapInArrow(unpack, "text binary")


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Words and pairs of all texts in each bucket."""
    size = 1 << BUCKET_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(size, np.int64)
        for b in batches:
            for _, _, raw, offs in by_chunk(b.column("text")):
                n += np.bincount(buckets(Words(raw, offs))[1], minlength=size)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(n[used])], ["bucket", "n"])

    counted = texts.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(
        F.sum("n").alias("n")).toPandas()  # 2**16 rows at most
    out = np.zeros(size)
    out[counted.bucket] = counted.n
    return out


def quantile(scores: DataFrame, q: float) -> float | None:
    """percentile(score, q), by histograms that narrow down its two ranks."""
    n, least, most = scores.agg(F.count("score"), F.min("score"), F.max("score")).first()
    if not n:
        return None

    def ranked(rank: int) -> float:
        low, high, before = least, most, 0
        while low < high:
            cell = F.least(F.floor((F.col("score") - low) / (high - low) * CELLS), F.lit(CELLS - 1))
            held = scores.where(F.col("score").between(low, high)).groupBy(cell.alias("cell")).agg(
                F.count(F.lit(1)).alias("n"), F.min("score").alias("low"), F.max("score").alias("high"))
            for r in sorted(held.collect(), key=lambda r: r.cell):  # CELLS rows at most
                if before + r.n > rank:
                    low, high = r.low, r.high
                    break
                before += r.n
        return low

    place = (n - 1) * q
    under, over = int(np.floor(place)), int(np.ceil(place))
    low = ranked(under)
    high = low if over == under else ranked(over)
    return low if low == high else (over - place) * low + (place - under) * high


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """Log-ratio of each bucket, and the threshold of the mean ratio."""
    size = 1 << BUCKET_BITS
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    trusted = trusted_texts(texts, labels)
    raw, target = bucket_counts(texts), bucket_counts(trusted)
    if not target.any():
        return np.zeros(size), -np.inf
    base = (raw + 0.5) / (raw.sum() + 0.5 * size)

    def score_without_self(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, j, raw_, offs in by_chunk(b.column("text")):
                words = Words(raw_, offs)
                row, bucket = buckets(words)
                cell, place, own = np.unique(row * size + bucket, return_inverse=True, return_counts=True)
                own = own[place]
                n = np.bincount(row, minlength=len(offs) - 1)
                left = (target[bucket] - own + PRIOR * base[bucket]) / (target.sum() - n[row] + PRIOR)
                score = np.bincount(row, np.log(left / base[bucket]), minlength=len(n)) / np.maximum(n, 1)
                yield pa.RecordBatch.from_arrays([pa.array(score[words.count >= MIN_WORDS])], ["score"])

    folder = f"{shared_dir(docs.sparkSession)}/trusted-scores-{uuid.uuid4().hex}"
    trusted.mapInArrow(score_without_self, "score double").write.parquet(folder)
    threshold = quantile(docs.sparkSession.read.parquet(folder), QUANTILE)
    ratio = np.log((target + PRIOR * base) / (target.sum() + PRIOR) / base)
    return ratio, -np.inf if threshold is None else float(threshold)


def duplicate_lines(raw: np.ndarray, offs: np.ndarray, words: Words) -> np.ndarray:
    """Lines with a word that equal an earlier line of their row."""
    edge = raw == 10
    begin = np.union1d(np.flatnonzero(edge) + 1, offs[:-1])
    begin = begin[begin < len(raw)]
    if not len(begin):
        return np.zeros(len(offs) - 1, np.int64)
    row = np.searchsorted(offs, begin, side="right") - 1
    stop = np.append(begin[1:], len(raw))
    end = np.where(edge[stop - 1], stop - 1, stop)
    solid = np.searchsorted(words.start, end) > np.searchsorted(words.start, begin)
    begin, end, row = begin[solid], end[solid], row[solid]
    code = slice_hashes(raw, begin, end)
    order = np.lexsort((code, row))
    again = (code[order[1:]] == code[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
    return np.bincount(row[order[1:]][again], minlength=len(offs) - 1)


def repeated_flags(words: Words) -> np.ndarray:
    """Whether each word lies in a window that is found twice or more in its row."""
    starts = np.flatnonzero(words.room() >= REPEAT_WINDOW)
    step = np.zeros(len(words.start) + 1, np.int64)
    if len(starts):
        code = mix(Prefix(words.hashes()).windows(REPEAT_WINDOW)[starts] + mix(words.row[starts].astype(np.uint64)))
        order = np.argsort(code)
        same = code[order[1:]] == code[order[:-1]]
        twice = np.zeros(len(starts), dtype=bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        step[starts[twice]] += 1
        step[starts[twice] + REPEAT_WINDOW] -= 1
    return np.cumsum(step)[:-1] > 0


def repeated_words(words: Words, rows: int) -> np.ndarray:
    return np.bincount(words.row[repeated_flags(words)], minlength=rows)


STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def judge(rows: DataFrame, ratio: np.ndarray, threshold: float) -> DataFrame:
    """``rows`` (carried columns, then text) with the counts, ``score``, ``base_failed`` and ``kept``.

    A text that is a field of the carried row is not sent twice: see ``keep_rows``.
    """
    carried = [c for c in rows.columns if c != "text"]
    own = rows.schema.fields[0].dataType
    inside_row = rows.columns == ["row"]
    at = own.names.index("text") if inside_row else -1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column(0).field(at) if inside_row else b.column(len(carried))
            for i, j, raw, offs in by_chunk(column):
                words, n = Words(raw, offs), j - i
                solid = np.zeros(len(raw) + 1, np.int64)
                inside = np.zeros(len(raw) + 1, np.int64)
                inside[words.start] += 1
                np.subtract.at(inside, words.end, 1)
                leads = (np.cumsum(inside)[:-1] > 0) & ((raw & 0xC0) != 0x80)
                np.cumsum(leads, out=solid[1:])
                marks = np.concatenate(([0], np.cumsum(SYMBOL[raw])))
                row, bucket = buckets(words)
                score = np.bincount(row, ratio[bucket], minlength=n) / np.maximum(np.bincount(row, minlength=n), 1)
                repeats = repeated_words(words, n)
                failed = (words.count < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * words.count)
                out = [words.count, np.diff(solid[offs]), np.diff(marks[offs]), duplicate_lines(raw, offs, words), repeats]
                part = b.slice(i, n)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(carried)], *(pa.array(x, pa.int64()) for x in out), pa.array(score), pa.array(failed),
                     pa.array(~failed & (score >= threshold))],
                    [*carried, *STATS, "score", "base_failed", "kept"])

    schema = T.StructType([rows.schema[c] for c in carried] + [T.StructField(c, T.LongType()) for c in STATS] + [
        T.StructField("score", T.DoubleType()), T.StructField("base_failed", T.BooleanType()),
        T.StructField("kept", T.BooleanType())])
    return rows.mapInArrow(run, schema)


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, score, base_failed, kept)."""
    ratio, threshold = fit(docs, labels)
    return judge(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
                 ratio, threshold)


def keep_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    ratio, threshold = fit(docs, labels)
    whole = docs.select(whole_row(docs).alias("row"))
    if not isinstance(docs.schema["text"].dataType, T.StringType):
        whole = docs.select(whole_row(docs).alias("row"), F.col("text").cast("string").alias("text"))
    return judge(whole, ratio, threshold).where("kept").select("row.*")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return out.select("doc_id", *STATS, "base_failed", "kept", "score")
