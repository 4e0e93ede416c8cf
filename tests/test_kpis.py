"""KPI aggregates: NULL keys, count variants, join fusion, profiles."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from towerlens.operators import kpis


def test_null_operator_own_group_gone_after_join(spark):
    df = spark.createDataFrame([("a", "1", "2.0"), (None, "3", "4.0"), ("a", "5", None)],
                               "operator string, signal string, precission string")
    sig = kpis.avg_signal_batch(df)
    assert {r.operator for r in sig.collect()} == {"a", None}
    joined = kpis.join_operator_kpis(sig, kpis.avg_precision_batch(df))
    fused = kpis.operator_kpis(df)
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, fused.collect()))
    assert [r.operator for r in fused.collect()] == ["a"]


def test_null_status_counted_by_rows_not_by_status(spark):
    df = spark.createDataFrame([("08001", "d", None)], "postal_code string, description string, status string")
    assert kpis.status_by_postal_code(df).first().status_count == 0
    typed = df.withColumn("record_ts", F.lit("2024-01-01 10:00:00").cast("timestamp"))
    assert kpis.status_by_postal_hour(typed).first().status_count == 1
    assert kpis.status_count_batch(df).first().status_count == 1


def test_generic_aggregate_names_and_allow_list(spark):
    df = spark.createDataFrame([("x", 1), ("x", 3), ("y", None)], "g string, v int")
    out = {r.g: r for r in kpis.generic_aggregate(df, ["g"], [("v", "avg"), ("v", "count")]).collect()}
    assert out["x"].avg_v == 2.0 and out["y"].count_v == 0
    glob = kpis.generic_aggregate(df, [], [("v", "sum")]).first()
    assert glob.sum_v == 4
    try:
        kpis.generic_aggregate(df, [], [("v", "__import__")])
        raise AssertionError("expected ValueError")
    except ValueError:
        pass


def test_distinct_profile_counts_null_as_value(spark):
    df = spark.createDataFrame([("a", "x"), (None, "x"), ("a", None)], "c1 string, c2 string")
    prof = {r.column_name: r.n_distinct for r in kpis.distinct_profile(df, ["c1", "c2"]).collect()}
    assert prof == {"c1": 2, "c2": 2}
    assert df.select(F.count_distinct("c1")).first()[0] == 1


def test_describe_matches_dataframe_describe(spark):
    df = spark.createDataFrame([(1, 2.5), (3, None), (5, 4.5)], "a int, b double")
    df = df.withColumns({"t": F.lit("x y"), "d": F.col("a").cast("string")})
    ours = {r.column_name: r for r in kpis.describe_columns(df).collect()}
    theirs = {r.summary: r for r in df.describe().collect()}
    for c in ("a", "b", "d"):
        for k in ("count", "mean", "stddev"):
            assert abs(ours[c][k] - float(theirs[k][c])) < 1e-9
    for c in ("a", "b"):
        assert (ours[c].min_value, ours[c].max_value) == (float(theirs["min"][c]), float(theirs["max"][c]))
    assert (ours["d"].min_text, ours["d"].max_text) == (theirs["min"].d, theirs["max"].d)
    assert ours["t"].mean is None and ours["t"].min_text == "x y" and ours["t"].min_value is None


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-5, 99)),
                          st.sampled_from(["1", "2", None])), min_size=1, max_size=40))
def test_property_status_sum_and_weighted_mean(spark, rows):
    df = spark.createDataFrame(
        [(op, sig, stt, "08001", "d") for op, sig, stt in rows],
        "operator string, signal int, status string, postal_code string, description string")
    df = df.withColumn("precission", F.col("signal").cast("double"))
    total = kpis.status_by_postal_code(df).agg(F.sum("status_count")).first()[0] or 0
    assert total == sum(1 for _, _, s in rows if s is not None)
    # weighted mean from per-batch sums/counts equals the global mean
    batches = df.withColumn("batch_window", (F.rand(7) * 3).cast("long"))
    per = kpis.average_by_operator(batches, keys=("batch_window",))
    w = per.groupBy("operator").agg((F.sum("sum_signal") / F.sum("n_signal")).alias("m"))
    g = df.groupBy("operator").agg(F.avg("signal").alias("m"))
    a = {r.operator: r.m for r in w.collect()}
    b = {r.operator: r.m for r in g.collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert (a[k] is None and b[k] is None) or abs(a[k] - b[k]) < 1e-9
    random.seed(0)


def test_hot_operator_is_pre_aggregated_before_shuffle(spark):
    # one operator holds well over a third of the rows
    rows = [("hot", str(i % 90), "1.5") for i in range(900)] + \
           [(f"op{i % 5}", str(i), "2.5") for i in range(400)]
    df = spark.createDataFrame(rows, "operator string, signal string, precission string")
    from towerlens.operators.mapping import apply_mapping
    out = kpis.average_by_operator(apply_mapping(df))
    plan = out._jdf.queryExecution().sparkPlan().toString()
    # partial aggregation sits below the exchange: one row per task and key is shuffled
    assert "partial_avg" in plan and "partial_count" in plan
    got = {r.operator: r.n_signal for r in out.collect()}
    assert got["hot"] == 900 and sum(got.values()) == 1300


def test_notebook_join_is_planned_without_join(spark):
    df = spark.createDataFrame([("a", "1", "2")], "operator string, signal string, precission string")
    plan = kpis.operator_kpis(df)._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan and "HashAggregate" in plan
