"""KPI aggregates.

All aggregates here are algebraic (sum, count, avg, min, max, bool_and,
distinct), so Spark runs them as partial + final ``HashAggregate``: every task
collapses its rows to one row per group before the shuffle. A group key that
holds a third of all rows therefore costs one row per task in the exchange,
not a third of the data in one reducer; no salting is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from towerlens.functions.casts import lenient_double
from towerlens.functions.timeparts import batch_window, calendar_parts
from towerlens.schema import RECORD_TS

# Aggregate function names accepted by the generic aggregate.
AGG_FUNCTIONS = {
    "avg": F.avg, "mean": F.mean, "sum": F.sum, "count": F.count,
    "min": F.min, "max": F.max, "stddev": F.stddev, "stddev_samp": F.stddev_samp,
    "stddev_pop": F.stddev_pop, "variance": F.variance, "var_samp": F.var_samp,
    "var_pop": F.var_pop, "count_distinct": F.count_distinct,
    "approx_count_distinct": F.approx_count_distinct,
}


def generic_aggregate(df: DataFrame, groups: list[str], aggs: list[tuple[str, str]]) -> DataFrame:
    """Group by ``groups`` (global aggregate when empty) and apply (column, function).

    Result columns are named ``<function>_<column>``.
    """
    cols: list[Column] = []
    for column, func in aggs:
        if func not in AGG_FUNCTIONS:
            raise ValueError(f"aggregate function {func!r} is not allowed")
        cols.append(AGG_FUNCTIONS[func](column).alias(f"{func}_{column}"))
    return df.groupBy(*groups).agg(*cols) if groups else df.agg(*cols)


def with_batch_window(df: DataFrame, seconds: int = 100, ts_col: str = RECORD_TS) -> DataFrame:
    """Tag each record with the id of the micro-batch window it arrived in."""
    return df.withColumn("batch_window", batch_window(ts_col, seconds))


def average_by_operator(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Mean signal and mean GPS precision per operator (per ``keys``, e.g. batch).

    Sums and counts are kept so that later rollups can weight by rows.
    """
    return df.groupBy(*keys, "operator").agg(
        F.avg("signal").alias("avg_signal"),
        F.avg("precission").alias("avg_precission"),
        F.sum("signal").cast("bigint").alias("sum_signal"),
        F.count("signal").alias("n_signal"),
        F.sum("precission").alias("sum_precission"),
        F.count("precission").alias("n_precission"),
    )


def status_by_postal_code(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Number of non-NULL status reports per postal code and status text."""
    return df.groupBy(*keys, "postal_code", "description").agg(
        F.count("status").alias("status_count"))


def _hourly(df: DataFrame, ts_col: str) -> DataFrame:
    return df.select("*", *calendar_parts(ts_col))


def signal_by_operator_hour(typed: DataFrame, ts_col: str = RECORD_TS) -> DataFrame:
    return (_hourly(typed, ts_col)
            .groupBy("operator", "year", "month", "day", "hour")
            .agg(F.avg("signal").alias("avg_signal_strength")))


def precision_by_operator_hour(typed: DataFrame, ts_col: str = RECORD_TS) -> DataFrame:
    return (_hourly(typed, ts_col)
            .groupBy("operator", "year", "month", "day", "hour")
            .agg(F.avg("precission").alias("avg_gps_precision")))


def status_by_postal_hour(typed: DataFrame, ts_col: str = RECORD_TS) -> DataFrame:
    """Rows (not non-NULL statuses) per postal code, status text and hour."""
    return (_hourly(typed, ts_col)
            .withColumnRenamed("postal_code", "postal_code_str")
            .groupBy("postal_code_str", "description", "year", "month", "day", "hour")
            .agg(F.count(F.lit(1)).alias("status_count")))


def avg_signal_batch(df: DataFrame) -> DataFrame:
    return (df.withColumn("signal", lenient_double("signal"))
            .groupBy("operator").agg(F.avg("signal").alias("avg_signal_strength")))


def avg_precision_batch(df: DataFrame) -> DataFrame:
    return (df.withColumn("precission", lenient_double("precission"))
            .groupBy("operator").agg(F.avg("precission").alias("avg_gps_precision")))


def status_count_batch(df: DataFrame) -> DataFrame:
    """Rows per postal code and status code (``count(*)``)."""
    return df.groupBy("postal_code", "status").agg(F.count(F.lit(1)).alias("status_count"))


def join_operator_kpis(left: DataFrame, right: DataFrame, on: str = "operator") -> DataFrame:
    """Inner equi-join of two per-operator KPI frames (NULL keys drop out).

    No broadcast hint: both sides are aggregates, and AQE switches to a
    broadcast join at runtime only when the measured size of a side is under
    ``spark.sql.adaptive.autoBroadcastJoinThreshold``.
    """
    return left.join(right, on=on, how="inner")


def operator_kpis(df: DataFrame) -> DataFrame:
    """Mean signal and mean precision per operator, as the join of the two
    single-KPI frames would give it, in one aggregate.

    Both join sides come from the same rows grouped by the same key, so they
    hold the same key set; the inner join only removes the NULL key. One scan
    and one shuffle instead of two scans, two shuffles and a join.
    """
    return (df.withColumn("signal", lenient_double("signal"))
            .withColumn("precission", lenient_double("precission"))
            .groupBy("operator")
            .agg(F.avg("signal").alias("avg_signal_strength"),
                 F.avg("precission").alias("avg_gps_precision"))
            .filter(F.col("operator").isNotNull()))


def _name_value_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"),
                               F.col(c).cast("string").alias("value")) for c in cols])
    return df.select(F.inline(pairs))


def distinct_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct values of several columns in one scan: (column_name, value).

    NULL is one of the values when present.
    """
    return _name_value_pairs(df, cols).distinct()


def distinct_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Number of distinct values per column, NULL counted as a value
    (``select(c).distinct().count()``, unlike ``count(DISTINCT c)``)."""
    return (distinct_values(df, cols).groupBy("column_name")
            .agg(F.count(F.lit(1)).alias("n_distinct")))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def describe_columns(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A row for each column (all by default): count, mean, stddev, min and max.

    (column_name, count, mean, stddev, min_value, max_value, min_text, max_text).
    Text columns have their least and greatest text; their mean and deviation
    are those of the values that read as numbers, NULL when none does. One
    aggregate with a partial result a task, then a stack of its one row.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    values, aggs, rows = [], [], []
    for i, c in enumerate(cols or df.columns):
        col = F.col(f"`{c}`")
        text = isinstance(kinds[c], T.StringType)
        # the number is read once, below the aggregate
        values += [col.alias(f"v{i}"), (col.try_cast("double") if text else col.cast("double")).alias(f"d{i}")]
        col, number = F.col(f"v{i}"), F.col(f"d{i}")
        aggs += [F.count(col).alias(f"n{i}"), F.avg(number).alias(f"m{i}"), F.stddev_samp(number).alias(f"s{i}"),
                 F.min(col if text else number).alias(f"a{i}"), F.max(col if text else number).alias(f"z{i}")]
        none = [F.lit(None).cast("double")] * 2 if text else [F.lit(None).cast("string")] * 2
        ends = [F.col(f"a{i}"), F.col(f"z{i}")]
        rows.append(F.struct(*(x.alias(n) for x, n in zip(
            [F.lit(c), F.col(f"n{i}"), F.col(f"m{i}"), F.col(f"s{i}"), *(none + ends if text else ends + none)],
            ["column_name", "count", "mean", "stddev", "min_value", "max_value", "min_text", "max_text"]))))
    return df.select(*values).agg(*aggs).select(F.inline(F.array(*rows)))
