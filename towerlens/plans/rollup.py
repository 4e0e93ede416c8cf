"""Hourly roll-up of the KPI tables, and exact distinct counts by mergeable bitmaps.

A dashboard question over days need not read every window. With each batch the
hours that it touches are rolled up again from the window tables (those hours only) and
written as leaves of the batch; a reader takes the newest committed leaf of an hour, as
the commit records tell it, so a 7-day question reads 168 leaves.

* ``operator_rollup``: sums and counts of records, and, since the served mean is one of window means,
  the sum of window means and their number. Windows that two batches share are merged first.
* ``status_rollup``: status counts per postal code and text.
* ``code_bitmaps``: which postal codes an hour holds, as bitmaps of code numbers
  (``bitmap_construct_agg``). Bitmaps of hours merge by OR, so a count over any range is exact and reads
  no row. ``codes`` numbers the texts (NULL counts as ''); a number, once committed, stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from towerlens.functions.timeparts import hour_label
from towerlens.operators import serving
from towerlens.schema import AVERAGE_BY_OPERATOR_SCHEMA, BATCH_KEY, INGEST_COLS, STATUS_BY_POSTAL_CODE_SCHEMA
from towerlens.sinks.commits import read_commits
from towerlens.sinks.lake import LEAF_COLS, cluster_by_partition, write_batch_table
from towerlens.sources.files import read_lake_table, read_lake_table_if_any


def _leaves(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(*f) for f in fields] + [T.StructField(c, T.StringType()) for c in LEAF_COLS])


SCHEMAS = {
    "operator_rollup": _leaves(
        ("operator", T.StringType()), ("sum_window_signal", T.DoubleType()), ("n_window_signal", T.LongType()),
        ("sum_window_precission", T.DoubleType()), ("n_window_precission", T.LongType()),
        ("sum_signal", T.LongType()), ("n_signal", T.LongType()), ("sum_precission", T.DoubleType()),
        ("n_precission", T.LongType())),
    "status_rollup": _leaves(("postal_code", T.StringType()), ("description", T.StringType()), ("status_count", T.LongType())),
    "code_bitmaps": _leaves(("bucket", T.LongType()), ("bits", T.BinaryType())),
}
CODES_SCHEMA = T.StructType([T.StructField("code", T.StringType()), T.StructField("number", T.LongType()),
                             T.StructField(BATCH_KEY, T.StringType())])


def _visible(table: DataFrame, spark: SparkSession, out_dir: str, own_key: str) -> DataFrame:
    """Rows of committed batches and of the batch that is being written."""
    keys = read_commits(spark, out_dir).select(BATCH_KEY).where(F.col(BATCH_KEY) != own_key)
    return table.join(keys.union(spark.range(1).select(F.lit(own_key))), BATCH_KEY, "left_semi")


def _touched(spark: SparkSession, out_dir: str, name: str, schema: T.StructType, key: str) -> DataFrame:
    """All rows of the hours in which the batch ``key`` has rows."""
    table = read_lake_table(spark, f"{out_dir}/{name}", schema)
    hours = read_lake_table(spark, f"{out_dir}/{name}", schema).where(F.col(BATCH_KEY) == key).select(*INGEST_COLS).distinct()
    return _visible(table, spark, out_dir, key).join(hours, INGEST_COLS, "left_semi")


def update_rollup(spark: SparkSession, out_dir: str, key: str) -> list[str]:
    """Roll up again the hours that the batch ``key`` has written to; before its commit record.

    Returns their labels, for that record. (Hours whose records were all blank have no rows and no leaf.)
    """
    windows = serving.merged_windows(_touched(spark, out_dir, "average_by_operator", AVERAGE_BY_OPERATOR_SCHEMA, key), *INGEST_COLS)
    operators = windows.groupBy("operator", *INGEST_COLS).agg(
        F.sum("avg_signal").alias("sum_window_signal"), F.count("avg_signal").alias("n_window_signal"),
        F.sum("avg_precission").alias("sum_window_precission"), F.count("avg_precission").alias("n_window_precission"),
        *[F.sum(c).alias(c) for c in ("sum_signal", "n_signal", "sum_precission", "n_precission")])
    write_batch_table(cluster_by_partition(operators), f"{out_dir}/operator_rollup", key)
    status = _touched(spark, out_dir, "status_by_postal_code", STATUS_BY_POSTAL_CODE_SCHEMA, key).groupBy(
        "postal_code", "description", *INGEST_COLS).agg(F.sum("status_count").alias("status_count"))
    write_batch_table(cluster_by_partition(status), f"{out_dir}/status_rollup", key)
    own = read_lake_table(spark, f"{out_dir}/status_rollup", SCHEMAS["status_rollup"]).where(F.col(BATCH_KEY) == key)
    _write_bitmaps(spark, out_dir, key, own.select(F.coalesce("postal_code", F.lit("")).alias("code"), *INGEST_COLS).distinct())
    hours = read_lake_table(spark, f"{out_dir}/operator_rollup", SCHEMAS["operator_rollup"]).where(F.col(BATCH_KEY) == key)
    return sorted(r[0] for r in hours.select(hour_label()).distinct().collect() if r[0] is not None)


def _write_bitmaps(spark: SparkSession, out_dir: str, key: str, held: DataFrame) -> None:
    """Number the codes that have no number, then one set of bitmaps an hour."""
    path = f"{out_dir}/codes"
    known = _visible(read_lake_table_if_any(spark, path, CODES_SCHEMA), spark, out_dir, key).where(F.col(BATCH_KEY) != key)
    first = known.agg(F.max("number")).first()[0]
    new = held.select("code").distinct().join(known, "code", "left_anti").select(
        "code", (F.monotonically_increasing_id() + (0 if first is None else first + 1)).alias("number"))
    (new.withColumn(BATCH_KEY, F.lit(key)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BATCH_KEY).parquet(path))
    codes = _visible(read_lake_table(spark, path, CODES_SCHEMA), spark, out_dir, key).select("code", "number")
    bits = held.join(codes, "code").groupBy(*INGEST_COLS, F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
    write_batch_table(cluster_by_partition(bits.select("bucket", "bits", *INGEST_COLS)), f"{out_dir}/code_bitmaps", key)


def read_rollup(spark: SparkSession, out_dir: str, name: str, at: int | None = None) -> DataFrame:
    """The newest committed leaf of each hour.

    Which leaf that is comes from the commit records, so older leaves of an hour are pruned
    and may be retired at any time.
    """
    commits = read_commits(spark, out_dir)
    commits = commits if at is None else commits.where(F.col("seq") <= at)
    newest = commits.select(F.explode("hours").alias("_hour"), "seq", BATCH_KEY).groupBy("_hour").agg(
        F.max_by(BATCH_KEY, "seq").alias("_key"))
    table = read_lake_table_if_any(spark, f"{out_dir}/{name}", SCHEMAS[name])
    return table.join(newest, (hour_label() == F.col("_hour")) & (F.col(BATCH_KEY) == F.col("_key")), "left_semi")


def _mean_of_means(field: str) -> Column:
    return F.try_divide(F.sum(f"sum_window_{field}"), F.sum(f"n_window_{field}"))


def operator_metrics(spark: SparkSession, out_dir: str, as_of: str | None, time_range: str,
                     at: int | None = None) -> DataFrame:
    """``serving.operator_metrics`` from the roll-up."""
    rows = serving.time_range_filter(read_rollup(spark, out_dir, "operator_rollup", at), as_of, time_range)
    return rows.groupBy("operator").agg(_mean_of_means("signal").alias("avg_signal_strength"),
                                        _mean_of_means("precission").alias("avg_precision"))


def operator_metrics_weighted(spark: SparkSession, out_dir: str, as_of: str | None, time_range: str,
                              at: int | None = None) -> DataFrame:
    rows = serving.time_range_filter(read_rollup(spark, out_dir, "operator_rollup", at), as_of, time_range)
    return rows.groupBy("operator").agg(
        F.try_divide(F.sum("sum_signal"), F.sum("n_signal")).alias("avg_signal_strength"),
        F.try_divide(F.sum("sum_precission"), F.sum("n_precission")).alias("avg_precision"))


def hourly_metrics(spark: SparkSession, out_dir: str, as_of: str | None, time_range: str, at: int | None = None) -> DataFrame:
    rows = serving.time_range_filter(read_rollup(spark, out_dir, "operator_rollup", at), as_of, time_range)
    return rows.groupBy("operator", hour_label().alias("hour")).agg(
        _mean_of_means("signal").alias("avg_signal_strength"), _mean_of_means("precission").alias("avg_precision")
    ).withColumn("hour", F.to_timestamp_ntz("hour", F.lit("yyyy-MM-dd HH:mm:ss")))


def postal_code_status(spark: SparkSession, out_dir: str, as_of: str | None, time_range: str,
                       at: int | None = None) -> DataFrame:
    return serving.postal_code_status(read_rollup(spark, out_dir, "status_rollup", at), as_of, time_range, ordered=False)


def distinct_codes(spark: SparkSession, out_dir: str, as_of: str | None, time_range: str, at: int | None = None) -> DataFrame:
    """(postal_codes): how many codes the range holds, from merged bitmaps alone."""
    rows = serving.time_range_filter(read_rollup(spark, out_dir, "code_bitmaps", at), as_of, time_range)
    merged = rows.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("bigint").alias("postal_codes"))


def summary_cards(spark: SparkSession, out_dir: str, as_of: str | None, time_range: str, at: int | None = None) -> DataFrame:
    """``serving.summary_cards`` from the roll-up and the bitmaps: one row."""
    means = operator_metrics(spark, out_dir, as_of, time_range, at).agg(
        F.count(F.lit(1)).alias("operators"), F.avg("avg_signal_strength").alias("avg_signal"),
        F.avg("avg_precision").alias("avg_precision"), F.lit(None).cast("bigint").alias("postal_codes"))
    codes = distinct_codes(spark, out_dir, as_of, time_range, at).select(
        F.lit(None).cast("bigint").alias("operators"), F.lit(None).cast("double").alias("avg_signal"),
        F.lit(None).cast("double").alias("avg_precision"), "postal_codes")
    return means.unionByName(codes).agg(*[F.max(c).alias(c) for c in means.columns])
