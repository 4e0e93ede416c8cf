"""Event-time KPIs with an exact late-record path: one read of the source, one ``foreachBatch``.

A stateful aggregate drops records behind the watermark without a trace; its progress
only counts partial groups. Here the watermark is stored instead: each batch's commit
record holds the newest record time so far, and the watermark that judges a batch is
that of the batches before it, less the delay. A record is late if its window had
ended by then (the engine's own rule). Late records are split off *before* any
aggregate and kept whole in a table, with the window that they missed and the watermark.

The other records become sums and counts per window and group (``*_parts``), in
folders by window hour and batch. These are the state: any batch, replay or
restart adds its own leaves, and closed windows are the merge of their parts. Windows
that close with a batch are appended to the final tables, once: no later record
can reach them. Only the hours that close are read again. Everything is written under the
batch's key and committed last (``sinks.commits``), so readers see a batch whole or not at all.

A record without a time is in no window: it is kept in the raw table only.

From one read of a batch come: raw records by event hour, dead letters, late records,
parts and final windows of both KPIs.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from towerlens.functions.timeparts import MICRO_BATCH_SECONDS, calendar_parts
from towerlens.plans.microbatch import query_id
from towerlens.schema import BATCH_KEY, CORRUPT, RECORD_TS
from towerlens.sinks.commits import CommitLog, committed, read_commits, utc
from towerlens.sinks.lake import cluster_by_partition
from towerlens.sources.files import read_lake_table_if_any
from towerlens.streaming.jobs import WINDOW_HOUR, replace_leaves, trigger_options

OPERATOR_PARTS = [("operator", T.StringType()), ("sum_signal", T.LongType()), ("n_signal", T.LongType()),
                  ("sum_precission", T.DoubleType()), ("n_precission", T.LongType()), ("n_records", T.LongType())]
STATUS_PARTS = [("postal_code", T.StringType()), ("description", T.StringType()), ("status_count", T.LongType())]
#: Final tables: name → (columns of its parts, keys).
TABLES = {"operator_hourly": (OPERATOR_PARTS, ["operator"]),
          "network_status": (STATUS_PARTS, ["postal_code", "description"])}


def _parts_schema(name: str) -> T.StructType:
    times = [T.StructField(c, T.TimestampType()) for c in ("window_start", "window_end")]
    return T.StructType([*times, *(T.StructField(*c) for c in TABLES[name][0]),
                         *(T.StructField(c, T.IntegerType()) for c in WINDOW_HOUR), T.StructField(BATCH_KEY, T.StringType())])


def with_window(typed: DataFrame, seconds: int) -> DataFrame:
    """Event-time window of each record. The length divides a day, so that windows begin at midnight too."""
    if 86400 % seconds:
        raise ValueError("the window must divide a day")
    start = F.timestamp_seconds(F.floor(F.unix_micros(RECORD_TS) / (seconds * 1_000_000)) * seconds)
    return typed.withColumns({"window_start": start, "window_end": start + F.make_interval(secs=F.lit(seconds))})


def merged(parts: DataFrame, name: str) -> DataFrame:
    """One row per window and group from its parts."""
    columns, keys = TABLES[name]
    return parts.groupBy("window_start", "window_end", *keys).agg(
        *[F.sum(c).alias(c) for c, _ in columns if c not in keys])


def served(rows: DataFrame, name: str) -> DataFrame:
    """Merged sums and counts as the KPI that is served."""
    if name != "operator_hourly":
        return rows.select("window_start", "window_end", "postal_code", "description", "status_count")
    return rows.select("window_start", "window_end", "operator",
                       F.try_divide("sum_signal", "n_signal").alias("avg_signal_strength"),
                       F.try_divide("sum_precission", "n_precission").alias("avg_gps_precision"), "n_records")


def between_hours(low: datetime | None, high: datetime) -> Column:
    """Window hours in [low, high], as a test of the partition columns alone."""
    label = sum(F.col(c).cast("bigint") * 100 ** (3 - i) for i, c in enumerate(WINDOW_HOUR))
    first, last = (None if t is None else int(t.astimezone(timezone.utc).strftime("%Y%m%d%H")) for t in (low, high))
    return label <= last if first is None else label.between(first, last)


class EventTimeLedger:
    """foreachBatch callable; ``shape`` types good records (``operators.parse.type_records``, which also
    frees the names of the calendar columns)."""

    def __init__(self, out_dir: str, tag: str, window_seconds: int = 3600, delay_seconds: int = 60,
                 shape: Callable[[DataFrame], DataFrame] = lambda good: good, raw: bool = True):
        if 86400 % window_seconds:
            raise ValueError("the window must divide a day")
        self.out_dir, self.tag, self.shape, self.raw = out_dir, tag, shape, raw
        self.window, self.delay = window_seconds, timedelta(seconds=delay_seconds)
        self.log = CommitLog(out_dir)

    def path(self, name: str) -> str:
        return f"{self.out_dir}/{name}"

    def __call__(self, batch_df: DataFrame, epoch_id: int) -> None:
        spark = batch_df.sparkSession
        key = f"{self.tag}-{query_id(batch_df) or 'batch'}-{epoch_id}"
        newest = self.log.past(spark, key)[1]
        watermark = None if newest is None else newest - self.delay
        batch = batch_df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self._dead_letters(batch, key)
            good = batch.where(F.col(CORRUPT).isNull()).drop(CORRUPT) if CORRUPT in batch.columns else batch
            typed = with_window(self.shape(good).withColumn(RECORD_TS, F.col(RECORD_TS).cast("timestamp")), self.window)
            late = F.coalesce(F.col("window_end") <= F.lit(watermark).cast("timestamp"), F.lit(False))
            n_rows, n_late, last = typed.agg(F.count(F.lit(1)), F.count_if(late), F.max(F.unix_micros(RECORD_TS))).first()
            last_ts = utc(last)
            if self.raw and n_rows:
                hour = ["year", "month", "day", "hour"]
                rows = typed.drop("window_start", "window_end").select("*", *calendar_parts(RECORD_TS))
                replace_leaves(cluster_by_partition(rows, hour), self.path("raw"), key, hour)
            if n_late:
                self._write(typed.where(late).withColumn("watermark", F.lit(watermark).cast("timestamp")), "late", key)
            if n_rows > n_late:
                self._write_parts(typed.where(~late & F.col("window_end").isNotNull()), key)
            self._write_closed(spark, key, watermark, last_ts)
            self.log.commit(spark, key, n_rows, n_late, watermark, last_ts)
        finally:
            batch.unpersist()

    def _write(self, rows: DataFrame, name: str, key: str) -> None:
        rows = rows.select("*", *calendar_parts("window_start", "window_"))
        replace_leaves(cluster_by_partition(rows, WINDOW_HOUR), self.path(name), key, WINDOW_HOUR)

    def _dead_letters(self, batch: DataFrame, key: str) -> None:
        if CORRUPT in batch.columns:
            letters = batch.where(F.col(CORRUPT).isNotNull()).select(
                *[c for c in ("key", RECORD_TS, CORRUPT) if c in batch.columns])
            if not letters.isEmpty():
                replace_leaves(letters, self.path("dead_letter"), key, [])

    def _write_parts(self, typed: DataFrame, key: str) -> None:
        windows = typed.groupBy("window_start", "window_end", "operator").agg(
            F.sum("signal").cast("bigint").alias("sum_signal"), F.count("signal").alias("n_signal"),
            F.sum("precission").alias("sum_precission"), F.count("precission").alias("n_precission"),
            F.count(F.lit(1)).alias("n_records"))
        self._write(windows, "operator_hourly_parts", key)
        counts = typed.groupBy("window_start", "window_end", "postal_code", "description").agg(
            F.count(F.lit(1)).alias("status_count"))
        self._write(counts, "network_status_parts", key)

    def _write_closed(self, spark: SparkSession, key: str, before: datetime | None, last_ts: datetime | None) -> None:
        """Append the windows that this batch closes: their ends lie in (old watermark, new watermark]."""
        after = None if last_ts is None else last_ts - self.delay
        if after is None or (before is not None and after <= before):
            return
        window = timedelta(seconds=self.window)
        end = F.col("window_end") <= F.lit(after).cast("timestamp")
        if before is not None:
            end &= F.col("window_end") > F.lit(before).cast("timestamp")
        for name in TABLES:
            parts = read_parts(spark, self.out_dir, name, key).where(
                between_hours(None if before is None else before - window, after) & end)
            self._write(served(merged(parts, name), name), name, key)


def read_parts(spark: SparkSession, out_dir: str, name: str, own_key: str | None = None,
               at: int | None = None) -> DataFrame:
    """Committed parts of a table, and those of the batch ``own_key`` that is being written."""
    table = read_lake_table_if_any(spark, f"{out_dir}/{name}_parts", _parts_schema(name))
    keys = read_commits(spark, out_dir)
    keys = (keys if at is None else keys.where(F.col("seq") <= at)).select(BATCH_KEY)
    if own_key is not None:
        keys = keys.where(F.col(BATCH_KEY) != own_key).union(spark.range(1).select(F.lit(own_key)))
    return table.join(keys, BATCH_KEY, "left_semi")


def open_windows(spark: SparkSession, out_dir: str, name: str, delay_seconds: int = 60,
                 at: int | None = None) -> DataFrame:
    """Windows that the stored watermark has not closed yet, as counted so far."""
    commits = read_commits(spark, out_dir)
    newest = (commits if at is None else commits.where(F.col("seq") <= at)).agg(F.max(F.unix_micros("newest_ts"))).first()[0]
    parts = read_parts(spark, out_dir, name, at=at)
    if newest is not None:
        parts = parts.where(F.col("window_end") > F.lit(utc(newest) - timedelta(seconds=delay_seconds)).cast("timestamp"))
    return served(merged(parts, name), name)


def final_windows(spark: SparkSession, out_dir: str, name: str, at: int | None = None) -> DataFrame:
    """Closed windows of the committed batches."""
    return committed(spark.read.parquet(f"{out_dir}/{name}"), out_dir, at).drop(*WINDOW_HOUR, BATCH_KEY)


def late_records(spark: SparkSession, out_dir: str, at: int | None = None) -> DataFrame:
    """Every late record of the committed batches, whole, with its window and the watermark that it was behind."""
    return committed(spark.read.parquet(f"{out_dir}/late"), out_dir, at).drop(*WINDOW_HOUR, BATCH_KEY)


def start_ledger_job(stream: DataFrame, ledger: EventTimeLedger, checkpoint: str, available_now: bool = False,
                     seconds: int = MICRO_BATCH_SECONDS, name: str = "event_time_ledger") -> StreamingQuery:
    return (stream.writeStream.queryName(name).option("checkpointLocation", checkpoint)
            .trigger(**trigger_options(available_now, seconds)).foreachBatch(ledger).start())
