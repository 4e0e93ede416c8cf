"""Whitening against plain exact sums and eigenvectors in double precision."""

import math
from fractions import Fraction

import numpy as np
import pytest

from towerlens.llm import op11_whitening as op11
from towerlens.llm.queries import QUERIES

COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def plain(rows, components=4):
    """(id, component, n, deviation, whitened, explained) of rows (id, vector); whitened up to its sign."""
    kept = [(k, tuple(math.floor(256 * float(c)) for c in v)) for k, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({x for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array([[float(Fraction(c) - Fraction(s, n)) for c, s in zip(x, sums)] for x in fit])
    v = y.T @ y / n
    e, axes = np.linalg.eigh(v)
    e, axes = e[::-1], axes[:, ::-1]
    out = []
    for k, x in kept:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        mid = np.array([float(Fraction(c) - Fraction(s, n)) for c, s in zip(x, sums)])
        for i in range(min(components, len(e))):
            if e[i] > np.trace(v) * 1e-13:
                out.append((k, i + 1, n, deviation if deviation < 1 << 63 else None, abs(mid @ axes[:, i] / np.sqrt(e[i])), e[i] / np.trace(v)))
    return sorted(out, key=lambda r: (str(r[0]), r[1:]))


def check(got, rows, components=4):
    want = plain(rows, components)
    have = sorted([tuple(r)[:4] + (abs(r.whitened), r.explained) for r in got], key=lambda r: (str(r[0]), r[1:]))
    assert [r[:4] for r in have] == [r[:4] for r in want]
    assert np.allclose([r[4:] for r in have], [r[4:] for r in want], rtol=1e-8, atol=1e-8)
    assert all(r.identity_error < 1e-10 for r in got)
    assert len({r.identity_error for r in got}) <= 1


def test_query_matches_plain_version(spark, sf_small):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_small}/embeddings.parquet").collect()]
    out = QUERIES["op11_embedding_whitening"](spark, sf_small)
    assert out.columns == COLUMNS
    check(out.collect(), rows)


def test_awkward_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(40)]
    rows += [(40, None), (41, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (42, [math.nan] * 6), (43, [math.inf] + [0.0] * 5)]
    rows += [(None, rows[3][1]), (3, rows[3][1]), (45, [-0.0] * 6), (46, [0.0] * 6)] + [(47, rows[5][1])] * 50
    table = spark.createDataFrame([(i, v, "x") for i, v in rows] + [(50, [1.0, 2.0], "x"), (51, [], "x")],
                                  "id long, vector array<double>, whitened string")
    got = op11.whiten(table.select("id", "vector")).collect()
    check(got, rows)
    assert {r.id for r in got} == {*range(40), None, 45, 46, 47}


def test_large_entries_are_exact(spark):
    rows = [(i, [i * 1e6 + 0.5, (i % 7) * 3e5, -i * 2.5e4]) for i in range(30)] + [(30, [1e300, -1e300, 0.0])]
    got = op11.whiten(spark.createDataFrame(rows[:30], "id long, vector array<double>")).collect()
    check(got, rows[:30])
    far = op11.whiten(spark.createDataFrame(rows, "id long, vector array<double>")).collect()
    assert {r.deviation for r in far if r.id == 30} == {None} and len(far) >= 31


def test_tables_without_components(spark):
    for rows in ([], [(1, None)], [(1, []), (2, [])], [(1, [1.0, 2.0])] * 3):
        table = spark.createDataFrame(rows, "id long, vector array<double>")
        assert op11.whiten(table).collect() == []


@pytest.mark.parametrize("gap", [1e-3, 1e-9, 1e-14, 0.0])
def test_eigenvectors_of_clusters(gap):
    """Eigenvalues closer than 32 bits tell apart: residuals are those of extended precision."""
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.normal(size=(24, 24)))[0]
    value = np.r_[5, 5 - gap, 5 - 2 * gap, 3, 3 - gap, np.linspace(1, 0.1, 19)]
    a = np.asarray(q * value @ q.T, dtype=np.longdouble)
    a = (a + a.T) / 2
    e, x = op11.eigenvectors(a)
    assert np.abs(x.T @ x - np.eye(24)).max() < 1e-17
    assert np.abs(a @ x - x * e).max() < (1e-16 if gap else 1e-15)
    assert np.allclose(e.astype(float), np.sort(value)[::-1], atol=1e-13)


def test_copies_do_not_weigh(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(30)]
    one = op11.whiten(spark.createDataFrame(rows, "id long, vector array<double>")).collect()
    many = op11.whiten(spark.createDataFrame(rows + [(99, rows[0][1])] * 500, "id long, vector array<double>")).collect()
    assert {(r.id, r.component): r.explained for r in one} == {(r.id, r.component): r.explained for r in many if r.id != 99}
