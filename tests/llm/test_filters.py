"""Quality rules, license scan, URL rules, mixing, tokens and the classifier."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from towerlens.llm import op4_mixture, op5_license, op6_quality, op7_urls, op9_bpe, op10_mil

P = pytest.importorskip("public_tokenizers")
RANKS = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tables(spark, sf_small):
    return [spark.read.parquet(f"{sf_small}/{t}.parquet") for t in ("documents", "labels")]


def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


# quality rules

def counts(frame):
    return sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                   for r in frame.collect()), key=str)


def test_quality_counts_match_brute_force(tables, awkward):
    for docs in (tables[0], awkward):
        want = sorted(((r.doc_id, *brute.quality_counts(r.text)) for r in docs.collect()), key=str)
        assert counts(op6_quality.quality_rules(docs, tables[1])) == want


def test_ratio_matches_plain_multinomials(tables):
    """Score and threshold from the formula, on the operator's own buckets."""
    docs, labels = tables
    ratio, threshold = op6_quality.fit(docs, labels)
    good = {r.doc_id for r in labels.collect() if r.quality == 1}
    rows = docs.collect()
    size = 1 << op6_quality.BUCKET_BITS
    own = []
    for r in rows:
        data = np.frombuffer(r.text.encode(), dtype=np.uint8)
        own.append(op6_quality.buckets(op6_quality.Words(data, np.array([0, len(data)])))[1])
    raw = sum(np.bincount(o, minlength=size) for o in own)
    target = sum(np.bincount(o, minlength=size) for o, r in zip(own, rows) if r.doc_id in good)
    base = (raw + 0.5) / (raw.sum() + 0.5 * size)
    want = np.log((target + op6_quality.PRIOR * base) / (target.sum() + op6_quality.PRIOR) / base)
    assert np.allclose(ratio, want)
    verdicts = {r.doc_id: r for r in op6_quality.quality_rules(docs, labels).collect()}
    for r, o in zip(rows, own):
        v = verdicts[r.doc_id]
        assert v.score == pytest.approx(want[o].mean())
        assert v.kept == (not v.base_failed and v.score >= threshold)
    clean = [verdicts[d] for d in good]
    assert np.mean([v.kept for v in clean if not v.base_failed]) >= 0.97
    junk = [verdicts[r.doc_id] for r in labels.collect() if r.quality == 0]
    assert np.mean([v.kept for v in junk]) <= 0.1


def test_quality_without_labels_keeps_what_passes_the_base_rules(spark, awkward):
    got = op6_quality.quality_rules(awkward, no_labels(spark)).collect()
    assert all(r.kept != r.base_failed for r in got) and len(got) == awkward.count()
    kept = op6_quality.keep_rows(awkward, no_labels(spark))
    assert kept.columns == awkward.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if r.kept)


# license scan

def test_license_scan_matches_brute_force(spark, tables, awkward):
    rnd, rows = random.Random(1), []
    for i in range(200):
        w = rnd.choice(op5_license.TEMPLATES)[1].split()
        for _ in range(rnd.choice([0, 0, 1, 2])):
            w[rnd.randrange(len(w))] = f"z{rnd.randrange(9)}"
        around = [[f"w{rnd.randrange(300)}" for _ in range(rnd.randrange(60))] for _ in range(2)]
        rows.append((i, " ".join([*around[0], "#", "\n// ".join(w), *around[1]])))
    for docs in (spark.createDataFrame(rows, "doc_id long, text string"), tables[0], awkward):
        text = {r.doc_id: r.text for r in docs.collect()}
        got = op5_license.license_scan(docs).collect()
        assert len(got) == docs.count()
        for r in got:
            assert r.licenses == brute.licenses(text[r.doc_id], op5_license.TEMPLATES), r.doc_id


def test_license_bands_bound_the_misses():
    c = op5_license.Classes(op5_license.TEMPLATES, 0.75, 1e-6)
    for stride, group in c.by_stride.items():
        for _, code in group:
            least = 0.75 * len(code) / (2 * stride + 0.25 * len(code))
            assert (1 - least) ** c.bands[stride] <= 1e-6


def test_license_template_that_is_too_short(spark, no_documents):
    with pytest.raises(ValueError):
        op5_license.license_scan(no_documents, (("x", "four words are few"),))


# URL rules

URLS = [
    None, "", "no scheme", "://", "http://", "http://ORG/x", "http://a.ORG", "http://a.org/", "https://example.org/es/x",
    "https://m.Example.ORG/es/?a=/x", "http://example.org/en/1#top", "http://example.org/en/12/", "http://example.org/en/2",
    "http://b.com/fr/1", "http://b.com/de/", "http://b.com/de", "http://com/de/x", "http://notexample.org/es/",
    "ftp://a.net/x://b.org/", "http://é.org/ü", "http://a..org/x", "http://org./x", "http://b.com?x=/de/", "HTTP://B.COM/DE/",
]


def fits(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
        host, path = rest[:end].translate(brute.LOWER), rest[end:].split("?")[0].split("#")[0]
    best = max(((len(h + p), len(h), v, h + p) for v, h, p in op7_urls.RULES
                if (host == h or host.endswith("." + h)) and path.startswith(p)), default=None)
    return host, path, best[3] if best else None, best[2] if best else "allow"


def test_url_rules_match_brute_force(spark, sf_small):
    rows = [(i, u, "<html>") for i, u in enumerate(URLS)] + [(None, URLS[7], None), (3, URLS[8], "x"), (3, URLS[8], "x")]
    for pages in (spark.createDataFrame(rows, "page_id long, url string, html string"),
                  spark.read.parquet(f"{sf_small}/pages.parquet")):
        want = sorted(((r.page_id, *fits(r.url)) for r in pages.collect()), key=str)
        assert sorted(map(tuple, op7_urls.url_verdicts(pages).collect()), key=str) == want


def test_nested_rules_and_ties(spark):
    rules = (("allow", "org", ""), ("block", "org", "/a"), ("allow", "org", "/a/b"), ("block", "x.org", "/a/b/c"),
             ("allow", "y.org", "/a"), ("block", "y.org", "/a"))
    urls = ["http://org/", "http://z.org/a", "http://z.org/a/b", "http://x.org/a/b/c", "http://x.org/a/b/d",
            "http://y.org/a", "http://organic.com/a"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in op7_urls.url_verdicts(pages, rules, "none").collect()}
    assert got == {0: ("org", "allow"), 1: ("org/a", "block"), 2: ("org/a/b", "allow"), 3: ("x.org/a/b/c", "block"),
                   4: ("org/a/b", "allow"), 5: ("y.org/a", "block"), 6: (None, "none")}


def test_no_pages(spark):
    assert op7_urls.url_verdicts(spark.createDataFrame([], "page_id long, url string")).count() == 0


# mixing

def test_targets_match_rounds_of_clamping(spark):
    rnd = random.Random(2)
    for _ in range(4):
        sizes = {f"s{i}": rnd.choice([0, 1, 10, 500, 4000]) for i in range(rnd.randint(1, 9))} | {None: rnd.randrange(900)}
        frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in op4_mixture.source_targets(frame).collect()}
        assert got == pytest.approx(brute.targets(sizes))


def test_mix_comes_near_its_targets(tables, awkward):
    for docs in (tables[0], awkward):
        out = op4_mixture.mix_sources(docs).collect()
        sizes, taken, target, most = {}, {}, {}, {}
        for r in out:
            sizes[r.source] = sizes.get(r.source, 0) + r.size
            taken[r.source] = taken.get(r.source, 0) + r.size * r.copies
            target[r.source], most[r.source] = r.target, max(most.get(r.source, 0), r.size)
            assert 0 <= r.copies <= 2
        assert len(out) == docs.count()
        assert sorted(r.size for r in out) == sorted(len(brute.words(r.text)) for r in docs.collect())
        assert target == pytest.approx(brute.targets(sizes))
        assert all(abs(taken[s] - target[s]) <= most[s] for s in sizes)
        again = op4_mixture.mix_sources(docs.repartition(7)).collect()
        assert sorted(map(tuple, again), key=str) == sorted(map(tuple, out), key=str)


def test_mixed_rows_hold_each_row_as_often_as_planned(tables):
    docs = tables[0].withColumn("copies", F.lit("x"))
    plan = {r.doc_id: r.copies for r in op4_mixture.mix_sources(docs).collect()}
    rows = op4_mixture.mixed_rows(docs)
    got = {r.doc_id: r["count"] for r in rows.groupBy("doc_id").count().collect()}
    assert rows.columns == docs.columns and got == {d: c for d, c in plan.items() if c}


def test_no_documents_to_mix(no_documents):
    assert op4_mixture.mix_sources(no_documents).count() == 0
    assert op4_mixture.mixed_rows(no_documents).count() == 0


# tokens

CASES = ["", "a" * 3000, "ab" * 1500, " " * 2000, "é" * 600, "-" * 900, "=-" * 500, "\n" * 400, "x" + " \t" * 300,
         "日本語" * 30, "🙂" * 40, "I'll they've <|endoftext|> 12345 \r\n\t x"]


@pytest.fixture(scope="module")
def reference_encoding():
    tiktoken = pytest.importorskip("tiktoken")
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=op9_bpe.load_ranks(RANKS), special_tokens={})


def test_transducer_agrees_with_the_library(reference_encoding):
    import regex

    rnd = random.Random(1)
    texts = CASES + ["".join(rnd.choice("abcdeéß thin  \n-=_!?0123🙂") for _ in range(rnd.randrange(300))) for _ in range(150)]
    texts += ["".join(rnd.choice("aenthio") for _ in range(rnd.randrange(2500))) for _ in range(15)]
    ranks = op9_bpe.load_ranks(RANKS)
    machine, decoder = op9_bpe.Transducer(ranks), op9_bpe.Decoder(ranks)
    for text in texts:
        ids = [ranks[t] for piece in regex.findall(P.PATTERN, text) for t in machine.stream(piece.encode())]
        assert ids == reference_encoding.encode_ordinary(text)
        for size in (1, 7, 1 << 14):
            parts = list(decoder.stream(np.array(ids, dtype=np.int32), size))
            assert "".join(p.decode() for p in parts) == text  # each part is whole characters


def test_transducer_emits_with_bounded_lookahead():
    machine = op9_bpe.Transducer(op9_bpe.load_ranks(RANKS))
    text = ("thenationing" * 2000).encode()
    read = 0

    class Counted(bytes):
        def __iter__(self):
            nonlocal read
            for byte in super().__iter__():
                read += 1
                yield byte

    first = next(machine.stream(Counted(text)))
    assert text.startswith(first) and read <= 10 * machine.reach


def test_decoder_refuses_broken_text():
    ranks = op9_bpe.load_ranks(RANKS)
    decoder = op9_bpe.Decoder(ranks)
    for data in (b"\x80", b"\xc3", b"\xe0\x80\x80", b"\xed\xa0\x80", b"\xf4\x90\x80\x80"):
        with pytest.raises(ValueError):
            list(decoder.stream(np.array([ranks[bytes((x,))] for x in data])))


def test_bpe_digests(spark, awkward, tables, reference_encoding):
    for docs in (awkward, tables[0]):
        text = {r.doc_id: r.text or "" for r in docs.collect()}
        got = op9_bpe.digests(docs, RANKS, P.PATTERN).collect()
        assert len(got) == docs.count()
        for r in got:
            ids = reference_encoding.encode_ordinary(text[r.doc_id])
            assert tuple(r) == (r.doc_id, len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(text[r.doc_id]))


def test_no_documents_to_encode(no_documents):
    assert op9_bpe.digests(no_documents, RANKS, P.PATTERN).count() == 0


# classifier

def test_gradients_match_differences():
    rng = np.random.default_rng(3)
    bag, x, label = np.array([0, 0, 0, 1, 2, 2]), rng.normal(size=(6, 5)), np.array([1.0, 0.0, 1.0])
    model = op10_mil.Model(5)

    def loss():
        y = model.forward(bag, x)["y"]
        return -(label * np.log(y) + (1 - label) * np.log(1 - y)).sum()

    f = model.forward(bag, x)
    for name, grad in model.gradients(bag, f, f["y"] - label).items():
        for place in np.ndindex(*grad.shape):
            if rng.random() < 0.3:
                keep = model.p[name][place]
                model.p[name][place] = keep + 1e-6
                up = loss()
                model.p[name][place] = keep - 1e-6
                down = loss()
                model.p[name][place] = keep
                assert grad[place] == pytest.approx((up - down) / 2e-6, abs=1e-5)


def test_classifier_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    out = op10_mil.quality_scores(docs, labels)
    assert out.count() == docs.count()
    held = out.join(labels, "doc_id").where("held_out").collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in held)
    assert np.mean([r.predicted == r.quality for r in held]) >= 0.95
    import zlib

    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in held)


def test_classifier_never_reads_held_out_labels(spark, tables):
    docs, labels = tables
    flipped = labels.withColumn("quality", F.when(op10_mil.held_out(F.col("doc_id")), 1 - F.col("quality"))
                                .otherwise(F.col("quality")))
    a, b = (sorted(map(tuple, op10_mil.quality_scores(docs, x).collect())) for x in (labels, flipped))
    assert a == b


def test_classifier_of_awkward_rows(spark, awkward, tables, no_documents):
    got = op10_mil.quality_scores(awkward, tables[1])
    assert got.count() == awkward.count() and got.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert {r.score for r in op10_mil.quality_scores(awkward, no_labels(spark)).collect()} == {0.5}
    assert op10_mil.quality_scores(no_documents, tables[1]).count() == 0


def test_all_good_labels_count(spark):
    """More good labels than any bounded sample held: all are in the target and in the threshold."""
    docs = spark.range(20_100).selectExpr("id AS doc_id", "concat('w', id % 3, ' v') AS text")
    labels = spark.range(20_100).selectExpr("id AS doc_id", "1 AS quality")
    counts = op6_quality.bucket_counts(op6_quality.trusted_texts(docs, labels))
    assert counts.sum() == 3 * 20_100


def test_quantile_is_the_percentile(spark):
    scores = spark.range(5000).selectExpr("sin(id % 1700) AS score")
    for q in (0.0, 0.002, 0.5, 1.0):
        want = scores.selectExpr(f"percentile(score, {q}) AS q").first().q
        assert abs(op6_quality.quantile(scores, q) - want) < 1e-12
