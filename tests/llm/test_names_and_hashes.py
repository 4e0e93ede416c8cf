"""Unlucky column names, repeated rows in the mix, and strings that a polynomial hash takes for equal."""

import random

import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from towerlens.llm import op1_substring, op4_mixture, op6_quality, op8_jaccard

NAMES = ["_words", "_copies", "_copy", "_d", "_s", "_n", "_sha", "_keep", "_text", "row", "id", "size", "copies", "my col", "a.b",
         "a:b", "tick`s", "least", "sig", "key", "n"]


def odd_words():
    """The two Thue-Morse words of 2,048 letters: any polynomial of odd base has one value for both, modulo 2**64."""
    bits = "0"
    while len(bits) < 2048:
        bits += "".join("10"[int(b)] for b in bits)
    return [bits.translate(str.maketrans("01", x)) for x in ("ab", "ba")]


@pytest.fixture(scope="module")
def odd_docs(spark):
    x, y = odd_words()
    own = [" ".join(f"{c}{i}" for i in range(60)) for c in "pq"]
    rows = [(1, f"{x} " * 40), (2, f"{y} " * 40), (3, f"{x}\n{y}\n{own[0]}"), (4, f"{own[1]} {x} {own[0]}"), (5, f"{y}\n{y}\n")]
    return spark.createDataFrame(rows, "doc_id long, text string"), rows


def test_words_that_differ_are_told_apart(spark, odd_docs):
    docs, rows = odd_docs
    got = op1_substring.substring_dedup(docs).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, brute.sha(r.kept)) for r in got) == sorted(brute.substring(rows))
    no_labels = spark.createDataFrame([], "doc_id long, quality int")
    got = op6_quality.quality_rules(docs, no_labels).collect()
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got} == {
        k: brute.quality_counts(t) for k, t in rows}
    got = op8_jaccard.jaccard_components(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.jaccard(dict(rows))


@pytest.fixture(scope="module")
def named(spark):
    pick = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(pick.choice(words) for _ in range(pick.randrange(30, 60))) for _ in range(12)]
    texts += texts[:3] + [texts[4] + " tail", None, ""]
    docs = spark.createDataFrame([(i, t, "en", "ab"[i % 2], 1) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    return docs.select("*", *[F.concat(F.lit(n + ":"), F.col("doc_id").cast("string")).alias(n) for n in NAMES])


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_columns_keep_their_values_whatever_their_names(spark, sf_small, named, name, stage):
    out = stage(spark, named, sf_small)
    assert out.columns == named.columns
    rows = out.collect()
    assert rows
    for r in rows:
        assert [r[n] for n in NAMES] == [f"{n}:{r.doc_id}" for n in NAMES]


def taken(frame):
    out = {}
    for r in frame.select("source", op4_mixture.word_count(F.col("text")).alias("n")).collect():
        out[r.source] = out.get(r.source, 0) + r.n
    return out


def test_repeated_rows_and_null_ids_do_not_overshoot(spark):
    text = " ".join(["w"] * 10)
    rows = [(None, text, "a")] * 100 + [(7, text, "a")] * 100 + [(i, text, "b") for i in range(100, 200)]
    rows += [(8, " ".join(["v"] * 10), "a")] * 50 + [(8, text, None)] * 9
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = op4_mixture.mix_sources(docs)
    want = {r.source: r.t for r in plan.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("t")).collect()}
    out = op4_mixture.mixed_rows(docs)
    assert taken(out) == want
    for r in plan.select("source", "target").distinct().collect():
        assert abs(want[r.source] - r.target) <= 10
    most = out.groupBy("doc_id", "source", "text").count().join(
        docs.groupBy("doc_id", "source", "text").agg(F.count(F.lit(1)).alias("n")), ["source", "text"])
    assert most.count() and sorted(map(str, out.collect())) == sorted(map(str, op4_mixture.mixed_rows(docs).collect()))
