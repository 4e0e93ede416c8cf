"""Substring, suffix and exact dedup and the Jaccard join against plain versions."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from towerlens.llm import components, op1_substring, op2_suffix, op3_exact, op8_jaccard
from towerlens.llm.text import joined, unpacked


def pairs_of(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def op1_rows(docs):
    out = op1_substring.substring_dedup(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("s"))
    return sorted(map(tuple, out.collect()), key=str)


def op2_rows(docs):
    out = op2_suffix.suffix_dedup(docs).select("doc_id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256))
    return {r[0]: tuple(r[1:]) for r in out.collect()}


def op8_rows(docs):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in op8_jaccard.jaccard_components(docs).collect()}


def spliced(seed, alphabet, sizes, joint):
    """Texts cut from one base, with changes: many shared and nearly shared strings."""
    rnd = random.Random(seed)
    base = [rnd.choice(alphabet) for _ in range(700)]
    out = {}
    for i in range(90):
        at, at2 = rnd.randrange(500), rnd.randrange(650)
        part = base[at:at + rnd.randrange(sizes)] + [rnd.choice(alphabet) for _ in range(rnd.randrange(12))]
        out[i] = joint.join(part + base[at2:at2 + rnd.randrange(sizes)])
        if i % 9 == 0:
            out[i] = joint.join([alphabet[0]] * rnd.randrange(3 * sizes))
    return out


def frame(spark, docs, parts=5):
    return spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(parts)


def test_substring_matches_brute_force(spark):
    docs = spliced(1, [f"w{i}" for i in range(9)], 80, " ")
    assert op1_rows(frame(spark, docs)) == sorted(brute.substring(list(docs.items())), key=str)


def test_substring_of_awkward_rows(awkward):
    assert op1_rows(awkward.repartition(4)) == sorted(brute.substring(pairs_of(awkward)), key=str)


def test_suffix_matches_brute_force(spark):
    docs = spliced(2, "abcd\0", 260, "")
    assert op2_rows(frame(spark, docs)) == brute.suffix(docs)


def test_suffix_cuts_a_hot_leading_string(spark, monkeypatch):
    """A passage in other surroundings each time: no task's rows grow with its number of pieces."""
    rnd = random.Random(7)
    passage = "".join(rnd.choice("abcdefgh") for _ in range(230))
    docs = {i: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(20, 90))) + passage
            + "".join(rnd.choice("ab") for _ in range(90)) for i in range(300)}
    whole = op2_suffix.later_windows

    def bounded(rows, *args):
        assert len(rows) <= 80, f"{len(rows)} pieces at once"
        return whole(rows, *args)

    monkeypatch.setattr(op2_suffix, "later_windows", bounded)
    monkeypatch.setattr(op2_suffix, "SORT_BYTES", 1000)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        assert op2_rows(frame(spark, docs, 30)) == brute.suffix(docs)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_suffix_of_awkward_rows(awkward):
    assert op2_rows(awkward.repartition(4)) == brute.suffix(dict(pairs_of(awkward)))


def test_groups_are_cut_into_blocks(spark, near_copies, monkeypatch):
    monkeypatch.setattr(op8_jaccard, "BLOCK", 9)
    assert op8_rows(frame(spark, near_copies)) == brute.jaccard(near_copies)


def test_blocks_of_near_copies_are_not_all_paired(spark, monkeypatch):
    """A group of near copies of one text: its texts are not sent to every pair of blocks."""
    rnd = random.Random(11)
    base = [f"w{i}" for i in range(120)]
    docs = {i: " ".join(base[:i % 60 + 30] + [f"x{i}"] + base[i % 60 + 31:]) for i in range(300)}
    texts = [(i, t) for i, t in docs.items()]
    sent = spark.sparkContext.accumulator(0)
    whole = op8_jaccard.linked_in_group

    def counted(held):
        sent.add(len(held))
        return whole(held)

    monkeypatch.setattr(op8_jaccard, "linked_in_group", counted)
    monkeypatch.setattr(op8_jaccard, "BLOCK", 10)
    monkeypatch.setattr(op8_jaccard, "PIVOTS", 2, raising=False)
    rnd.shuffle(texts)
    assert op8_rows(frame(spark, dict(texts))) == brute.jaccard(docs)
    assert sent.value < 6 * len(docs)


def test_multikey_order_is_the_order_of_the_suffixes():
    import numpy as np

    rnd = np.random.default_rng(4)
    rows = rnd.integers(0, 2, (500, 6)).astype(np.uint64)
    got = rows[op2_suffix.multikey_order(rows)]
    assert got.tolist() == sorted(rows.tolist())


@pytest.mark.parametrize("capacity", [1, 7, 100_000])
def test_exact_matches_grouping(spark, awkward, capacity):
    docs = awkward.where("doc_id <> 12").unionByName(
        spark.createDataFrame([(i, f"text {i % 13}") for i in range(100, 190)], "doc_id long, text string"),
        allowMissingColumns=True)
    groups = {}
    for doc_id, text in pairs_of(docs):
        groups.setdefault(text or "", []).append(doc_id)
    want = sorted((d, max(g), len(g), d == max(g), brute.sha(t)) for t, g in groups.items() for d in g)
    assert sorted(map(tuple, op3_exact.exact_dedup(docs, capacity).collect())) == want
    kept = op3_exact.keep_rows(docs, capacity)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(max(g) for g in groups.values())


def test_directory_splits_only_overfull_buckets(spark, tmp_path):
    entries = spark.range(1000).select(F.when(F.col("id") < 100, F.shiftleft("id", 53)).otherwise(F.shiftleft("id", 40)).alias("prefix"))
    got = op3_exact.directory(entries, str(tmp_path / "d"), 200, 4).collect()
    assert sum(r.n for r in got) == 1000 and max(r.n for r in got) <= 200
    width = {r.bucket: 1 << (60 - r.depth) for r in got}
    starts = sorted(width)
    assert all(a + width[a] <= b for a, b in zip(starts, starts[1:]))  # buckets don't overlap
    assert len({r.depth for r in got}) > 1


def test_exact_chain_is_told_apart_by_bytes(spark, monkeypatch):
    """All keys collide: only the bytes differ."""
    def keyed(docs):
        text = F.coalesce("text", F.lit(""))
        return docs.select("doc_id", F.lit("00" * 32).alias("sha"), F.lit(1).cast("long").alias("check"),
                           F.lit(1).alias("length"), text.alias("text"))

    monkeypatch.setattr(op3_exact, "_keyed", keyed)
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "c")], "doc_id long, text string")
    got = sorted((r.doc_id, r.keep_id, r.group_size) for r in op3_exact.exact_dedup(docs).collect())
    assert got == [(1, 3, 2), (2, 2, 1), (3, 3, 2), (4, 4, 1)]


@pytest.fixture(scope="module")
def near_copies():
    rnd = random.Random(5)
    vocabulary = [str(i) for i in range(40)]
    base = [[rnd.choice(vocabulary) for _ in range(rnd.choice([3, 5, 6, 7, 8, 9, 11, 12, 14, 18, 25, 40, 60]))]
            for _ in range(30)]
    docs = {}
    for i in range(400):
        w = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 3])):
            p = rnd.randrange(len(w) + 1)
            w[p:p + rnd.randrange(2)] = [rnd.choice(vocabulary)][:rnd.randrange(2)]
        docs[i] = " ".join(w)
    return docs


@pytest.mark.parametrize("batch", ["10000", "37"])
def test_jaccard_matches_brute_force(spark, near_copies, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        assert op8_rows(frame(spark, near_copies)) == brute.jaccard(near_copies)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_jaccard_of_awkward_rows(awkward):
    assert op8_rows(awkward) == brute.jaccard(dict(pairs_of(awkward)))


def test_jaccard_keeps_one_row_of_each_group(spark, near_copies):
    kept = op8_jaccard.keep_rows(frame(spark, near_copies).withColumn("component_id", F.lit("x")))
    want = sorted({c for _, c in brute.jaccard(near_copies).values()} | {k for k, t in near_copies.items() if not t})
    assert sorted(r.doc_id for r in kept.collect()) == want and kept.columns[-1] == "component_id"


def test_jaccard_keeps_rows_by_set_not_by_doc_id(spark):
    a, b = ("one two three four five six seven", "red green blue white black brown grey")
    rows = [(1, a), (1, a), (2, a), (2, b), (None, a), (3, ""), (3, "")]
    kept = op8_jaccard.keep_rows(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(1, a), (2, b), (3, ""), (3, "")]


def test_jaccard_shuffles_whole_rows_once(spark):
    """Rows went by signature and doc_id to the join, and again by signature to the grouping after it."""
    rnd = random.Random(5)
    rows = [(i, " ".join(f"{rnd.getrandbits(64):x}" for _ in range(20))) for i in range(60)]
    rows += [(None, rows[7][1] + " more words than the text before it had"), (None, None), (5, "")]
    again = rows[:9] + rows[60:61]
    kept = op8_jaccard.keep_rows(spark.createDataFrame(rows + again + again, "doc_id long, text string").repartition(3))
    plan = kept._jdf.queryExecution().executedPlan().toString().split("\n")
    grouped = next(i for i, x in enumerate(plan) if re.search(r"Aggregate\(.*first\(row", x))
    join = next(i for i, x in enumerate(plan) if i > grouped and "Join" in x)
    assert not [x for x in plan[grouped:join] if "Exchange" in x]
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(rows)


def test_the_order_of_shingles_counts_every_document(spark):
    """A passage of a few of many documents, none of them in a sample of 20,000, is put last too."""
    few = F.pmod(F.xxhash64(F.col("id")), F.lit(1_000_000)) >= 900_000
    docs = spark.range(0, 30_000, 1, 4).select(F.col("id").alias("doc_id"), F.when(few, "a long passage that is shared by some").otherwise(
        F.concat_ws(" ", *[F.concat(F.lit(c), F.col("id")) for c in "uvwxy"])).alias("text")).union(
        spark.createDataFrame([(None, None), (1, "")], "doc_id long, text string"))
    measured = op8_jaccard.Measured(docs)
    assert measured.sets.count() == 30_002
    loads = [np.frombuffer(unpacked([r.loads])[0], np.int64) for r in measured.loads.collect()]
    n = docs.where(F.col("text").startswith("a long")).count()
    assert sum(int(x.sum()) for x in loads) == 30_000 - n + 4 * n  # a shingle of its own, or the four of the passage
    levels = op8_jaccard.order_levels(measured.loads)
    raw, offs = joined([b"a long passage that is shared by some"])
    assert (levels[op8_jaccard.bucket_of(op8_jaccard.shingles(raw, offs)[1])] > 5).all()
    assert (levels > 0).mean() < 2 * op8_jaccard.ORDER_SHARE


def test_the_order_does_not_change_links(spark, near_copies, monkeypatch):
    flat = lambda loads: np.zeros(op8_jaccard.ORDER_BUCKETS, np.uint8)
    found = op8_rows(frame(spark, near_copies))
    monkeypatch.setattr(op8_jaccard, "order_levels", flat)
    assert found == op8_rows(frame(spark, near_copies)) == brute.jaccard(near_copies)


def test_short_link_tables_take_few_tasks(spark, monkeypatch):
    """Rounds over a short table left files for each of all shuffle partitions."""
    links = spark.range(40).selectExpr("id AS a", "id + 1 AS b").repartition(7)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        assert components.components(links, "a", "b").rdd.getNumPartitions() <= 2
        monkeypatch.setattr(components, "TASK_ROWS", 9)
        out = components.components(links, "a", "b")
        assert out.rdd.getNumPartitions() > 2
        assert sorted(map(tuple, out.collect())) == [(i, 0) for i in range(41)]
    finally:
        spark.conf.unset(key)


def test_light_bounds():
    for n in range(1, 40):
        for m in range(n, 60):
            least = op8_jaccard.need(n, m)
            assert 100 * least >= 75 * (n + m - least) and 100 * (least - 1) < 75 * (n + m - least + 1)
        assert op8_jaccard.prefix_size(n) == n - -(-3 * n // 4) + 1


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)]
    got = components.components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert {r.node: r.label for r in got} == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}


def test_empty_tables(no_documents):
    assert op1_substring.substring_dedup(no_documents).count() == 0
    assert op2_suffix.suffix_dedup(no_documents).count() == 0
    assert op3_exact.exact_dedup(no_documents).count() == 0
    assert op8_jaccard.jaccard_components(no_documents).count() == 0


def test_whole_table_queries(spark, sf_small):
    docs = dict(pairs_of(spark.read.parquet(f"{sf_small}/documents.parquet")))
    got = op1_substring.op1_substring_dedup(spark, sf_small).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute.substring(list(docs.items())), key=str)
    got = op2_suffix.op2_suffix_dedup(spark, sf_small).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == brute.suffix(docs)
    got = op8_jaccard.op8_jaccard_join(spark, sf_small).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == brute.jaccard(docs)
