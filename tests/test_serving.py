"""Serving rollups: range rule, range text, weighting, pivot, pruning."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from towerlens.functions.timeparts import parse_range_hours
from towerlens.operators import serving
from towerlens.schema import AVERAGE_BY_OPERATOR_SCHEMA
from towerlens.sinks.lake import write_batch_table
from towerlens.sources.files import read_lake_table
from towerlens.session import new_run_dir


def _kpi(spark, rows):
    rows = [(i, *r) for i, r in enumerate(rows)]
    cols = "batch_window bigint, operator string, avg_signal double, avg_precission double, sum_signal bigint, " \
           "n_signal bigint, sum_precission double, n_precission bigint, ingest_year string, " \
           "ingest_month string, ingest_day string, ingest_hour string"
    return spark.createDataFrame(rows, cols)


def test_range_bound_excludes_bucket_before_bound(spark):
    rows = [("a", 1.0, 1.0, 1, 1, 1.0, 1, "2024", "05", "03", "04"),
            ("a", 3.0, 3.0, 3, 1, 3.0, 1, "2024", "05", "03", "05")]
    out = serving.time_range_filter(_kpi(spark, rows), "2024-05-03 10:20:00", "6 hours")
    assert [r.ingest_hour for r in out.collect()] == ["05"]


def test_range_text_modes():
    assert parse_range_hours("7 days") == 168
    assert parse_range_hours("7 days", mode="reference") == 7
    assert parse_range_hours("1 hour") == 1 and parse_range_hours("24 hours") == 24


def test_uneven_batches_weighted_vs_unweighted(spark):
    rows = [("a", 1.0, 1.0, 1, 1, 1.0, 1, "2024", "05", "03", "05"),
            ("a", 3.0, 3.0, 9, 3, 9.0, 3, "2024", "05", "03", "05")]
    kpi = _kpi(spark, rows)
    assert serving.operator_metrics(kpi, "2024-05-03 06:00:00", "6 hours").first().avg_signal_strength == 2.0
    assert serving.operator_metrics_weighted(kpi, "2024-05-03 06:00:00", "6 hours").first().avg_signal_strength == 2.5


def test_hourly_metrics_hour_is_timestamp(spark):
    rows = [("b", 2.0, 1.0, 2, 1, 1.0, 1, "2024", "05", "03", "05"),
            ("a", 4.0, 1.0, 4, 1, 1.0, 1, "2024", "05", "03", "05")]
    out = serving.hourly_metrics(_kpi(spark, rows), "2024-05-03 06:00:00", "24 hours").collect()
    assert [r.operator for r in out] == ["a", "b"]
    assert str(out[0].hour) == "2024-05-03 05:00:00"


def test_sort_puts_nulls_last(spark):
    rows = [("a", None, 1.0, None, 0, 1.0, 1, "2024", "05", "03", "05"),
            ("b", 4.0, 1.0, 4, 1, 1.0, 1, "2024", "05", "03", "05")]
    out = serving.operator_metrics(_kpi(spark, rows), "2024-05-03 06:00:00", "6 hours").collect()
    assert [r.operator for r in out] == ["b", "a"]


def test_pivot_null_description_becomes_empty_name(spark):
    ps = spark.createDataFrame([("08001", None, 2), ("08001", "ok", 3), ("08002", "ok", 1)],
                               "postal_code string, status_description string, status_count bigint")
    out = serving.pivot_status(ps)
    assert out.columns == ["postal_code", "", "ok"]
    got = {r.postal_code: (r[1], r[2]) for r in out.collect()}
    assert got == {"08001": (2, 3), "08002": (0, 1)}
    assert [r[0] for r in serving.distinct_status(ps).collect()] == ["", "ok"]


def test_summary_cards(spark):
    om = spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.0, None)],
                               "operator string, avg_signal_strength double, avg_precision double")
    ps = spark.createDataFrame([("08001", "x", 1), (None, "x", 1), ("08001", "y", 1)],
                               "postal_code string, status_description string, status_count bigint")
    r = serving.summary_cards(om, ps).first()
    assert (r.operators, r.avg_signal, r.avg_precision, r.postal_codes) == (2, 2.0, 2.0, 2)


def test_range_filter_is_partition_filter_on_lake_scan(spark):
    path = new_run_dir(spark, "test_prune")
    rows = [(1, "a", 1.0, 1.0, 1, 1, 1.0, 1, "2024", "05", "03", h) for h in ("04", "05")]
    schema = T.StructType([f for f in AVERAGE_BY_OPERATOR_SCHEMA.fields if f.name != "batch_key"])
    df = spark.createDataFrame(rows, schema)
    write_batch_table(df, path, "t-0")
    kpi = read_lake_table(spark, path, AVERAGE_BY_OPERATOR_SCHEMA)
    q = serving.time_range_filter(kpi, "2024-05-03 10:20:00", "6 hours")
    scan = q._jdf.queryExecution().sparkPlan().collectLeaves().head()
    assert scan.nodeName().startswith("Scan parquet")
    filters = scan.partitionFilters().toString()
    assert "ingest_year" in filters and "ingest_hour" in filters and "concat(" in filters
    assert [r.ingest_hour for r in q.collect()] == ["05"]
    assert q.select(F.count("*")).first()[0] == 1


def test_rows_of_one_window_are_merged_before_the_mean_of_means(spark):
    rows = [(1, "a", 1.0, 1.0, 1, 1, 1.0, 1, "2024", "05", "03", "05"),
            (1, "a", 4.0, 4.0, 8, 2, 8.0, 2, "2024", "05", "03", "05"),
            (2, "a", 5.0, None, 5, 1, None, 0, "2024", "05", "03", "05")]
    kpi = spark.createDataFrame(rows, "batch_window bigint, operator string, avg_signal double, avg_precission double, "
                                      "sum_signal bigint, n_signal bigint, sum_precission double, n_precission bigint, "
                                      "ingest_year string, ingest_month string, ingest_day string, ingest_hour string")
    r = serving.operator_metrics(kpi, "2024-05-03 06:00:00", "6 hours").first()
    assert (r.avg_signal_strength, r.avg_precision) == (4.0, 3.0)
    assert serving.hourly_metrics(kpi, "2024-05-03 06:00:00", "6 hours").first().avg_signal_strength == 4.0


def test_first_hour_of_a_range():
    assert serving.range_start("2024-05-03 10:20:00", "6 hours") == "2024-05-03 05:00:00"
    assert serving.range_start("2024-05-03 10:00:00", "6 hours") == "2024-05-03 04:00:00"
    assert serving.range_start("2024-05-03 10:00:00", "7 days", "reference") == "2024-05-03 03:00:00"


def test_pivot_width_is_the_engines_limit(spark):
    import pytest

    ps = spark.createDataFrame([("08001", str(i), 1) for i in range(12)],
                               "postal_code string, status_description string, status_count bigint")
    spark.conf.set("spark.sql.pivotMaxValues", "11")
    try:
        with pytest.raises(Exception, match="(?i)pivot"):
            serving.pivot_status(ps).collect()
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")
    assert len(serving.pivot_status(ps).columns) == 13
