"""The pipeline's stages against plain versions, and the SQL of the operators that have it."""

import duckdb
import pytest

import corpus_pipeline
import brute
from towerlens.llm import op4_mixture, op6_quality
from towerlens.llm.queries import ORACLE, QUERIES


def plain(stage, rows, table, spark, sf_dir):
    """doc_ids (with repeats) that a stage returns for ``rows`` (doc_id, text, ...)."""
    if stage == "quality_rules":
        labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
        ratio, threshold = op6_quality.fit(table, labels)
        out = []
        for r in rows:
            data = op6_quality.np.frombuffer(r.text.encode(), dtype=op6_quality.np.uint8)
            words = op6_quality.Words(data, op6_quality.np.array([0, len(data)]))
            score = ratio[op6_quality.buckets(words)[1]].mean() if len(words.start) else 0
            if not brute.quality_counts(r.text)[-1] and score >= threshold - 1e-12:
                out.append(r.doc_id)
        return out
    if stage == "exact_dedup":
        last = {}
        for r in rows:
            last[r.text] = max(r.doc_id, last.get(r.text, r.doc_id))
        return list(last.values())
    if stage == "ngram_jaccard_join":
        return [k for k, (_, c) in brute.jaccard({r.doc_id: r.text for r in rows}).items() if k == c]
    if stage == "source_mixing":
        return [r.doc_id for r in op4_mixture.mix_sources(table).collect() for _ in range(r.copies)]
    return [r.doc_id for r in rows]


def test_each_stage_against_a_plain_version(spark, sf_small, tmp_path):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        rows = docs.collect()
        want = sorted(plain(name, rows, docs, spark, sf_small))
        stage(spark, docs, sf_small).write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        assert sorted(r.doc_id for r in out.collect()) == want, name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
            text = {r.doc_id: r.text for r in rows}
            assert all(r.text == text[r.doc_id] for r in out.collect())
        docs_before, docs = docs, out
    text = {r.doc_id: r.text for r in docs_before.collect()}
    assert all(r.decoded_sha256 == brute.sha(text[r.doc_id]) and len(r.ids) == r.n_tokens for r in docs.collect())
    whole = corpus_pipeline.run(spark, sf_small)
    assert sorted(map(str, whole.collect())) == sorted(map(str, docs.collect()))


def test_stages_take_awkward_and_empty_tables(spark, sf_small, awkward, no_documents, tmp_path):
    for k, docs in enumerate((awkward, no_documents)):
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, docs, sf_small).write.parquet(str(tmp_path / f"{k}-{name}"))
            out = spark.read.parquet(str(tmp_path / f"{k}-{name}"))
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns
            # each stage alone, so that rows which an earlier one drops reach it too
            assert out.count() <= 2 * docs.count()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_their_sql(spark, name):
    sf_dir = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    got = QUERIES[name](spark, sf_dir)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLE[name].strip()})").fetchall()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
