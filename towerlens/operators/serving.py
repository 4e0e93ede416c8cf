"""Serving rollups over the KPI tables.

Inputs are the per-batch KPI tables (``average_by_operator``,
``status_by_postal_code``) with their zero-padded text partition columns
``ingest_year/month/day/hour``. A range "last N hours before as_of" keeps the
hour buckets whose label ``'yyyy-MM-dd HH:00:00'`` is at or after the bound
text ``as_of − N h``. The bound is a constant expression, so on a table scan
the filter is evaluated against partition values only (``PartitionFilters``):
pruned hours are never opened (nor listed, where a catalog holds the partitions).

Means of means are over arrival windows. Two micro-batches may each hold a row of
one window and operator, so such rows are merged from their sums and counts
before windows are averaged: the result does not depend on where batches were cut.

Sort orders put NULLs last, as the original SQL engine did.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from towerlens.functions.timeparts import hour_label, parse_range_hours, range_bound_text
from towerlens.session import shared_dir


# Orders of the served results.

def operator_order() -> list:
    return [F.desc_nulls_last("avg_signal_strength")]


def status_order() -> list:
    return [F.asc_nulls_last("postal_code"), F.desc_nulls_last("status_count")]


def hourly_order() -> list:
    return [F.asc_nulls_last("hour"), F.asc_nulls_last("operator")]


def range_start(as_of: str, time_range: str, mode: str = "interval") -> str:
    """The first hour that a range can hold: what a filter on record times may use."""
    bound = datetime.fromisoformat(as_of) - timedelta(hours=parse_range_hours(time_range, mode))
    hour = bound.replace(minute=0, second=0, microsecond=0)
    return str(hour if hour == bound else hour + timedelta(hours=1))


def time_range_filter(kpi: DataFrame, as_of: str | None, time_range: str = "1 hour",
                      mode: str = "interval") -> DataFrame:
    """Keep hour buckets whose label is at or after ``as_of − range``.

    The label test is a ``concat`` over four partition columns: Spark prunes
    folders with it, but a metastore cannot evaluate it and would return
    every partition. The implied (year, month) bound is added as plain
    comparisons, which a metastore can apply; it never changes the result.
    """
    hours = parse_range_hours(time_range, mode)
    bound = range_bound_text(as_of, hours)
    y, m = F.substring(bound, 1, 4), F.substring(bound, 6, 2)
    coarse = (F.col("ingest_year") > y) | ((F.col("ingest_year") == y) & (F.col("ingest_month") >= m))
    return kpi.filter(coarse & (hour_label() >= bound))


def merged_windows(kpi: DataFrame, *keys) -> DataFrame:
    """One row per arrival window and operator: means from the sums and counts of its rows."""
    out = kpi.groupBy("batch_window", "operator", *keys).agg(
        F.sum("sum_signal").alias("sum_signal"), F.sum("n_signal").alias("n_signal"),
        F.sum("sum_precission").alias("sum_precission"), F.sum("n_precission").alias("n_precission"))
    return out.withColumns({
        "avg_signal": F.try_divide("sum_signal", "n_signal"),
        "avg_precission": F.try_divide("sum_precission", "n_precission")})


def with_hour_label(kpi: DataFrame, name: str = "hour_label") -> DataFrame:
    return kpi.withColumn(name, hour_label())


def _sorted(df: DataFrame, ordered: bool, *keys) -> DataFrame:
    """Sort for presentation only; a result that feeds another computation
    (cards, pivot) is left unsorted so no global sort is planned for it."""
    return df.orderBy(*keys) if ordered else df


def operator_metrics(kpi: DataFrame, as_of: str | None, time_range: str = "1 hour",
                     mode: str = "interval", ordered: bool = True) -> DataFrame:
    """Mean of the window means per operator (unweighted, as served)."""
    out = (merged_windows(time_range_filter(kpi, as_of, time_range, mode))
           .groupBy("operator")
           .agg(F.avg("avg_signal").alias("avg_signal_strength"),
                F.avg("avg_precission").alias("avg_precision")))
    return _sorted(out, ordered, *operator_order())


def operator_metrics_weighted(kpi: DataFrame, as_of: str | None, time_range: str = "1 hour",
                              mode: str = "interval", ordered: bool = True) -> DataFrame:
    """Exact per-operator means over all rows in range (batches weighted by rows)."""
    out = (time_range_filter(kpi, as_of, time_range, mode)
           .groupBy("operator")
           .agg(F.try_divide(F.sum("sum_signal"), F.sum("n_signal")).alias("avg_signal_strength"),
                F.try_divide(F.sum("sum_precission"), F.sum("n_precission")).alias("avg_precision")))
    return _sorted(out, ordered, *operator_order())


def postal_code_status(status: DataFrame, as_of: str | None, time_range: str = "1 hour",
                       mode: str = "interval", ordered: bool = True) -> DataFrame:
    out = (time_range_filter(status, as_of, time_range, mode)
           .groupBy("postal_code", "description")
           .agg(F.sum("status_count").cast("bigint").alias("status_count"))
           .withColumnRenamed("description", "status_description"))
    return _sorted(out, ordered, *status_order())


def hourly_metrics(kpi: DataFrame, as_of: str | None, time_range: str = "24 hours",
                   mode: str = "interval", ordered: bool = True) -> DataFrame:
    out = (merged_windows(time_range_filter(kpi, as_of, time_range, mode), hour_label().alias("hour_text"))
           .groupBy("operator", "hour_text")
           .agg(F.avg("avg_signal").alias("avg_signal_strength"),
                F.avg("avg_precission").alias("avg_precision"))
           .select("operator",
                   F.to_timestamp_ntz("hour_text", F.lit("yyyy-MM-dd HH:mm:ss")).alias("hour"),
                   "avg_signal_strength", "avg_precision"))
    return _sorted(out, ordered, *hourly_order())


def summary_cards(op_metrics: DataFrame, postal_status: DataFrame) -> DataFrame:
    """One row: operators, mean of operator means (signal, precision), postal codes.

    Both inputs go through one aggregate over their tagged union (no join).
    A NULL postal code counts as the value ''.
    """
    a = op_metrics.select(F.lit(0).alias("_src"), "avg_signal_strength", "avg_precision",
                          F.lit(None).cast("string").alias("postal_code"))
    b = postal_status.select(F.lit(1).alias("_src"),
                             F.lit(None).cast("double").alias("avg_signal_strength"),
                             F.lit(None).cast("double").alias("avg_precision"),
                             F.coalesce("postal_code", F.lit("")).alias("postal_code"))
    is_a = F.col("_src") == 0
    return a.unionByName(b).agg(
        F.count_if(is_a).alias("operators"),
        F.avg(F.when(is_a, F.col("avg_signal_strength"))).alias("avg_signal"),
        F.avg(F.when(is_a, F.col("avg_precision"))).alias("avg_precision"),
        F.count_distinct(F.when(~is_a, F.col("postal_code"))).alias("postal_codes"),
    )


def distinct_status(postal_status: DataFrame) -> DataFrame:
    """Distinct status texts (NULL as ''), sorted."""
    return (postal_status.select(F.coalesce("status_description", F.lit(""))
                                 .alias("status_description"))
            .distinct().orderBy("status_description"))


def pivot_status(postal_status: DataFrame, values: list[str] | None = None) -> DataFrame:
    """postal code × status text → summed count, 0 where absent.

    The counts become one map per postal code, which is spread over columns. Columns
    must be known when the plan is built: ``values``, or else the keys of the
    maps, in order. For these the maps are computed at once and kept by a
    checkpoint in the shared folder, so the source is read once; keys and
    columns come from the kept maps, a row a postal code. How many columns there may be is the
    engine's own limit (``spark.sql.pivotMaxValues``), which fails and cuts nothing.
    """
    spark = postal_status.sparkSession
    counts = postal_status.groupBy(
        F.coalesce("postal_code", F.lit("")).alias("postal_code"),
        F.coalesce("status_description", F.lit("")).alias("status_description"),
    ).agg(F.sum("status_count").alias("status_count"))
    maps = counts.groupBy("postal_code").agg(
        F.map_from_entries(F.collect_list(F.struct("status_description", "status_count"))).alias("counts"))
    if values is None:
        shared_dir(spark)  # names the checkpoint folder where the session has none
        maps = maps.checkpoint()
        most = int(spark.conf.get("spark.sql.pivotMaxValues"))
        keys = maps.select(F.explode(F.map_keys("counts")).alias("key")).distinct().orderBy("key").limit(most + 1)
        values = [r.key for r in keys.collect()]
        if len(values) > most:
            raise ValueError(f"more than {most} status texts: raise spark.sql.pivotMaxValues")
    return maps.select("postal_code", *[F.coalesce(F.col("counts")[v], F.lit(0)).cast("bigint").alias(v) for v in values])
