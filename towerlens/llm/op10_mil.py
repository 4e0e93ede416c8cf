"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages of ``PASSAGE`` words. Each passage is encoded by
its hashed words and by what its characters look like (capitals, digits, symbols,
word lengths, repetition), then by one tanh layer. Gated attention weighs the
passages, a = softmax(w . (tanh(V h) * sigmoid(U h))), and a logistic unit scores
the weighted sum of passages. Only documents carry labels; the weights of the
passages are learned from them.

Training takes the labelled rows outside the held-out fold, at most ``TRAIN_ROWS``
of them (those of least hash: a bounded sample), as passage features; it is full
batch and seeded, so reruns agree. The model has a fixed size and goes with the
tasks that score every passage of every whole text. Labels, lang, source and
doc_id are never inputs of a score.

Defined results: null and empty texts are one passage without words and get the
score that the model gives to it. Of several labels of a doc_id the largest
counts. Without any label each score is 0.5. A null doc_id is not held out; every
row is scored alone; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from towerlens.llm.op6_quality import repeated_flags
from towerlens.llm.text import Words, chunks, documents, read_table, utf8

PASSAGE = 64
HASHED = 64
TRAIN_ROWS = 4_000
HIDDEN, GATE = 24, 12
STEPS, RATE, DECAY = 150, 0.02, 1e-4
SEED = 11

_BYTES = np.arange(256)
UPPER = (_BYTES >= 65) & (_BYTES <= 90)
LETTER = UPPER | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
STOP = np.isin(_BYTES, list(b".,;:?"))
MARK = ~(LETTER | DIGIT | STOP) & (_BYTES > 32)
SHAPES = 12


def passages(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of each passage, features): at least one passage a row."""
    words, rows = Words(raw, offs), len(offs) - 1
    per_row = np.maximum(-(-words.count // PASSAGE), 1)
    first = np.cumsum(per_row) - per_row
    total = int(per_row.sum())
    at = first[words.row] + words.index // PASSAGE
    n = np.bincount(at, minlength=total)
    some = np.maximum(n, 1)
    code = words.hashes()
    bucket = (code >> np.uint64(40)).astype(np.int64) % HASHED
    sign = 1.0 - 2.0 * ((code >> np.uint64(39)) & np.uint64(1)).astype(np.float64)
    hashed = np.bincount(at * HASHED + bucket, sign, minlength=total * HASHED).reshape(total, HASHED) / some[:, None]

    def in_words(table: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(table[raw])))
        return (sums[words.end] - sums[words.start]).astype(np.float64)

    def mean(values: np.ndarray) -> np.ndarray:
        return np.bincount(at, values, minlength=total) / some

    length = (words.end - words.start).astype(np.float64)
    mark = in_words(MARK)
    upper, letter = in_words(UPPER), in_words(LETTER)
    tail = raw[np.maximum(words.end - 1, 0)] if len(words.end) else raw[:0]
    shapes = [mean(upper / length), mean(in_words(DIGIT) / length), mean(mark / length), mean(mark > 0),
              mean((upper == letter) & (letter > 0)), mean(MARK[tail]), mean(STOP[tail]), np.log1p(mean(length)),
              mean(repeated_flags(words).astype(np.float64)), n / PASSAGE,
              np.log1p(words.count)[np.repeat(np.arange(rows), per_row)] / 10, np.ones(total)]
    return np.repeat(np.arange(rows), per_row), np.column_stack((4 * hashed, *shapes))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Model:
    """Weights of the passage encoder, the gated attention and the logistic unit."""

    def __init__(self, inputs: int, seed: int = SEED):
        rng = np.random.default_rng(seed)
        def shape(*s):
            return rng.normal(0, 1 / np.sqrt(s[0]), s)
        self.mean, self.scale = np.zeros(inputs), np.ones(inputs)
        self.p = {"E": shape(inputs, HIDDEN), "V": shape(HIDDEN, GATE), "U": shape(HIDDEN, GATE),
                  "w": shape(GATE), "c": shape(HIDDEN), "b": np.zeros(1)}

    def forward(self, bag: np.ndarray, x: np.ndarray) -> dict:
        """``bag``: row of each passage, ascending from 0 without gaps."""
        p, first = self.p, np.flatnonzero(np.concatenate(([True], bag[1:] != bag[:-1])))
        h = np.tanh(x @ p["E"])
        t, g = np.tanh(h @ p["V"]), sigmoid(h @ p["U"])
        e = (t * g) @ p["w"]
        e = np.exp(e - np.maximum.reduceat(e, first)[bag])
        a = e / np.add.reduceat(e, first)[bag]
        z = np.add.reduceat(a[:, None] * h, first)
        return {"first": first, "x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "y": sigmoid(z @ p["c"] + p["b"])}

    def gradients(self, bag: np.ndarray, f: dict, error: np.ndarray) -> dict:
        """``error``: derivative of the loss by each document's logit."""
        p = self.p
        dz = error[:, None] * p["c"]
        da = (dz[bag] * f["h"]).sum(axis=1)
        de = f["a"] * (da - np.add.reduceat(f["a"] * da, f["first"])[bag])
        dt, dg = de[:, None] * p["w"] * f["g"] * (1 - f["t"] ** 2), de[:, None] * p["w"] * f["t"] * f["g"] * (1 - f["g"])
        dh = f["a"][:, None] * dz[bag] + dt @ p["V"].T + dg @ p["U"].T
        return {"E": f["x"].T @ (dh * (1 - f["h"] ** 2)), "V": f["h"].T @ dt, "U": f["h"].T @ dg,
                "w": (f["t"] * f["g"]).T @ de, "c": f["z"].T @ error, "b": np.array([error.sum()])}

    def fit(self, bag: np.ndarray, x: np.ndarray, label: np.ndarray) -> Model:
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        self.scale[-1], self.mean[-1] = 1, 0  # the constant
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        for step in range(1, STEPS + 1):
            f = self.forward(bag, x)
            grads = self.gradients(bag, f, (f["y"] - label) / len(label))
            rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
            for k, grad in grads.items():
                grad = grad + DECAY * self.p[k]
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.99 * second[k] + 0.01 * grad ** 2
                self.p[k] = self.p[k] - rate * (first[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
        return self

    def score(self, bag: np.ndarray, x: np.ndarray) -> np.ndarray:
        return self.forward(bag, np.clip((x - self.mean) / self.scale, -8, 8))["y"]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model | None:
    """The model from at most ``rows`` labelled documents outside the held-out fold; None without any."""
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), "quality")
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").cast("double").alias("label"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)  # bounds what is broadcast and collected

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offs = utf8(b.column("text"))
            for i, j in chunks(raw, offs):
                row, x = passages(raw[offs[i]: offs[j]], offs[i: j + 1] - offs[i])
                cut = np.append(np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))), len(row))
                flat = x.astype(np.float32)
                part = b.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("label"),
                     pa.array([flat[s:e].tobytes() for s, e in zip(cut[:-1], cut[1:])], pa.binary())],
                    ["doc_id", "label", "features"])

    bags = docs.join(F.broadcast(picked), "doc_id").select("doc_id", "label", "text").mapInArrow(
        encode, "doc_id long, label double, features binary").toPandas()
    if not len(bags):
        return None
    bags = bags.sort_values(["doc_id", "features"], kind="stable")
    width = HASHED + SHAPES
    parts = [np.frombuffer(f, dtype=np.float32).reshape(-1, width) for f in bags.features]
    bag = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    return Model(width).fit(bag, np.concatenate(parts).astype(np.float64), bags.label.to_numpy())


def quality_scores(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted)."""
    docs = documents(docs)
    model = train(docs, labels, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offs = utf8(b.column("text"))
            for i, j in chunks(raw, offs):
                bag, x = passages(raw[offs[i]: offs[j]], offs[i: j + 1] - offs[i])
                # as trained, features have single precision
                score = np.full(j - i, 0.5) if model is None else model.score(bag, x.astype(np.float32).astype(np.float64))
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i), pa.array(score)], ["doc_id", "score"])

    scored = docs.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
