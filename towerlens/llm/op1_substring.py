"""Substring dedup by hashes of 35-word windows, in place of a relative Lempel-Ziv parse.

No factors with a source are made; the rows are those that the contract asks for.
The index of the corpus is dealt over the shuffle partitions (the blocks) by seed: of the 16-word sequences in each 35-word window
the one of least hash. Equal windows have equal seeds at equal places, so a
window that occurs in any block is found by looking up its own seed in the one
block that can hold it; that answers for every block without a pass over each.

1. Texts: each distinct text is kept once (compressed), with its number of rows.
   All later steps read this one shuffle.
2. Seeds (one for about 10 words) are shuffled; those met once are dropped.
3. Only windows whose seed is repeated can be repeated; each of them is looked up
   by a 96-bit hash of all its words.
4. Unions of repeated windows are duplicate spans.

A seed or window that a batch meets twice is known to be repeated, as is all of a
text that two rows hold; further rows of a batch take a key of their own, so a
passage that a third of the corpus holds costs a reducer one row a batch.

Defined results: null and empty texts have no words; the sha256 is then that of
the empty string. Every row is a document, so rows equal in doc_id and text
repeat each other. A null doc_id is a value like others. Other columns are never
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from towerlens.llm.text import (Prefix, Words, chunks, distinct_texts, documents, held_places, joined, known_locally,
                                mix, read_table, repeated, same_value, slices, sliding_argmin, text_keys, unpacked)

WINDOW = 35
SEED = 16


def window_seeds(words: Words, codes: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of whole windows, the place of the seed of each, and the hash of every seed sequence."""
    grams = Prefix(codes).windows(seed)
    starts = np.flatnonzero(words.room() >= window)
    if not len(starts):
        return starts, starts, grams
    place = sliding_argmin((grams >> np.uint64(32)).astype(np.uint32), window - seed + 1)
    return starts, place[starts], grams


def seeds(texts: DataFrame, window: int, seed: int) -> DataFrame:
    """(anchor, known, h1, pos): the seeds of all texts, pre-aggregated by batch."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2000):
            raw, offs = joined(unpacked(b.column("z").to_pylist()))
            keys, copies = b.column("h1").to_numpy(), b.column("copies").to_numpy()
            anchors, rows, places = [], [], []
            for i, j in chunks(raw, offs):
                words = Words(raw[offs[i]: offs[j]], offs[i: j + 1] - offs[i])
                _, place, grams = window_seeds(words, words.hashes(), window, seed)
                place = np.unique(place)
                anchors.append(grams[place])
                rows.append(i + words.row[place])
                places.append(words.index[place])
            anchor, row, pos = map(np.concatenate, (anchors, rows, places))
            key, known = known_locally(anchor, keys[row].view(np.uint64) + mix(pos.astype(np.uint64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(known | (copies[row] > 1)), pa.array(keys[row]),
                 pa.array(pos.astype(np.int32))], ["anchor", "known", "h1", "pos"])

    return texts.mapInArrow(
        find, "anchor long, known boolean, h1 long NOT NULL, pos int")


def windows(held: DataFrame, window: int, seed: int) -> DataFrame:
    """(whash, check, known, h1, h2, pos): windows whose seed is one of ``places``."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2000):
            raw, offs = joined(unpacked(b.column("z").to_pylist()))
            h1, h2, copies = (b.column(c).to_numpy() for c in ("h1", "h2", "copies"))
            for i, j in chunks(raw, offs):
                words = Words(raw[offs[i]: offs[j]], offs[i: j + 1] - offs[i])
                codes = words.hashes()
                starts, place, _ = window_seeds(words, codes, window, seed)
                starts = starts[held_places(b.column("places").slice(i, j - i), words.first, len(codes))[place]]
                hashes = Prefix(codes).windows(window)[starts]
                check = Prefix(mix(codes + np.uint64(1))).windows(window)[starts] >> np.uint64(33)
                row, pos = i + words.row[starts], words.index[starts]
                key, known = known_locally(hashes, h1[row].view(np.uint64) + mix(pos.astype(np.uint64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(check.astype(np.int32)), pa.array(known | (copies[row] > 1)),
                     pa.array(h1[row]), pa.array(h2[row]), pa.array(pos.astype(np.int32))],
                    ["whash", "check", "known", "h1", "h2", "pos"])

    return held.mapInArrow(
        find, "whash long, check int, known boolean, h1 long NOT NULL, h2 long, pos int")


def duplicate_spans(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal unions of repeated windows, as word ranges."""
    if not len(starts):
        return []
    starts = np.sort(starts)
    cut = np.flatnonzero(np.diff(starts) > window) + 1
    return [(int(p[0]), int(p[-1]) + window) for p in np.split(starts, cut)]


def substring_dedup(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept): each document without its duplicate spans.

    ``spans`` lists word ranges [begin, end); ``kept`` is the words left, joined
    by one space.
    """
    docs = documents(docs)
    texts = distinct_texts(docs)
    anchors = repeated(seeds(texts, window, seed), "anchor").groupBy("h1").agg(F.collect_set("pos").alias("places"))
    found = repeated(windows(texts.join(anchors, "h1"), window, seed), "whash", "check")
    marks = found.groupBy(F.col("h1").alias("k1"), F.col("h2").alias("k2")).agg(F.collect_set("pos").alias("starts"))
    # only h1 is a join key and no column is left out, so that all steps share the shuffle of the texts
    marked = texts.join(marks, (F.col("h1") == F.col("k1")) & same_value("h2", "k2"), "left")
    # rows come to the texts, so that no text moves again
    cut_from = text_keys(docs).join(marked, (F.col("r1") == F.col("h1")) & same_value("r2", "h2"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows = []
            for text, starts in zip(unpacked(b.column("z").to_pylist()), b.column("starts")):
                words = text.split()
                spans = duplicate_spans(np.array(starts.as_py() or [], dtype=np.int64), window)
                kept, at = [], 0
                for begin, end in spans:
                    kept += words[at:begin]
                    at = end
                kept += words[at:]
                rows.append((len(words), len(words) - len(kept), [{"begin": x, "end": y} for x, y in spans],
                             b" ".join(kept).decode()))
            cols = list(zip(*rows))
            span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [b.column("row_id"),
                 *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), span, pa.string())))],
                ["doc_id", "n_words", "n_removed", "spans", "kept"])

    return cut_from.mapInArrow(
        cut, "doc_id long, n_words long, n_removed long, spans array<struct<begin: long, end: long>>, kept string")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
