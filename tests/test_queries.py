"""Registered queries against their DuckDB SQL on the smallest scale factor."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from towerlens.plans.catalog import QUERIES

KEYS = list(QUERIES)


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (2, str(v))
    if isinstance(v, (int, float)):
        return (1, "nan" if isinstance(v, float) and math.isnan(v) else repr(float(v)))
    if isinstance(v, dt.datetime):
        return (3, v.replace(tzinfo=None).isoformat())
    return (4, str(v))


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{sf_small}/events.parquet')")
    return con


def test_every_key_has_oracle_or_is_documented():
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:3] == ["operator", "avg_signal", "avg_precission"]


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, sf_small, key):
    df = E.queries()[key](spark, sf_small)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[key])
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    assert sorted(s_cols) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert _rows(s_cols, s_rows) == _rows(o_cols, o_rows)


def test_faulty_records_reach_the_rules(spark, sf_small):
    """The filters fire: none of the cleaning rows passes for want of faults."""
    from towerlens.operators import clean, parse
    from towerlens.sources.events import corrupted, wire_measurements

    wire = wire_measurements(spark, sf_small)
    assert 0 < clean.remove_null_rows(wire).count() < wire.count()
    assert parse.parse_records(corrupted(parse.encode_records(wire))).where("_corrupt IS NOT NULL").count() > 0
    typed = parse.type_records(wire)
    assert typed.where("signal IS NULL").count() > wire.where("signal IS NULL OR trim(signal) = ''").count()
    assert wire.where("operator IS NULL").count() and wire.where("operator = ''").count()


def test_describe_keeps_one_aggregate(spark, sf_small):
    plan = E.queries()["describe_columns"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "RoundRobin" not in plan
