"""Streaming jobs.

* ``start_microbatch_job``: the live job, ``foreachBatch`` every 100 s with
  idempotent writes (see ``plans.microbatch``).
* ``event_time_*`` + ``start_event_time_sink``: per-hour KPIs in event time.
  The group key is a ``window()`` over a watermarked TIMESTAMP, so state for
  a window is dropped once the watermark passes its end, and append mode
  emits each window exactly once, final. (Grouping by plain calendar columns
  would keep every group in state forever and merge late rows into old
  hours.) Both operator means are computed by one stateful query, not one
  query per KPI, so the source is read once.
* ``start_update_sink``: early, changing results (update mode) through
  ``foreachBatch``; each batch's changed groups go to the folder of their window
  hour, and readers take the latest row per group.
* ``start_raw_sink``: raw records as Parquet partitioned by event hour, records
  that are no JSON as dead letters; both from one read of the source.

KPI tables are partitioned by the hour in which a window starts.

Each query has its own checkpoint folder; restart resumes from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from towerlens.functions.timeparts import MICRO_BATCH_SECONDS, calendar_parts
from towerlens.plans.microbatch import MicroBatchWriter, query_id
from towerlens.schema import BATCH_KEY, CORRUPT, RECORD_TS
from towerlens.sinks.lake import cluster_by_partition

WINDOW_HOUR = ["window_year", "window_month", "window_day", "window_hour"]

DEFAULT_DELAY = "1 minute"


def trigger_options(available_now: bool = False,
                    seconds: int = MICRO_BATCH_SECONDS) -> dict:
    """Trigger keyword arguments: a processing-time trigger, or availableNow."""
    return {"availableNow": True} if available_now else {"processingTime": f"{seconds} seconds"}


def start_microbatch_job(stream: DataFrame, out_dir: str, checkpoint: str,
                         name: str = "microbatch_kpis", available_now: bool = False,
                         window_seconds: int = MICRO_BATCH_SECONDS,
                         null_is_blank: bool = False, catalog: dict[str, str] | None = None
                         ) -> tuple[StreamingQuery, MicroBatchWriter]:
    """``catalog``: tables that get each batch's partitions (see ``MicroBatchWriter``)."""
    writer = MicroBatchWriter(out_dir, name, window_seconds, null_is_blank, catalog)
    q = (stream.writeStream.queryName(name)
         .option("checkpointLocation", checkpoint)
         .trigger(**trigger_options(available_now, window_seconds))
         .foreachBatch(writer)
         .start())
    return q, writer


def _windowed(typed: DataFrame, window: str, delay: str) -> DataFrame:
    return typed.withWatermark(RECORD_TS, delay)


def _window_cols() -> list:
    return [F.col("window.start").cast("timestamp_ntz").alias("window_start"),
            F.col("window.end").cast("timestamp_ntz").alias("window_end")]


def event_time_operator_kpis(typed: DataFrame, window: str = "1 hour",
                             delay: str = DEFAULT_DELAY) -> DataFrame:
    """Mean signal and mean GPS precision per operator and event-time window."""
    return (_windowed(typed, window, delay)
            .groupBy(F.window(RECORD_TS, window), "operator")
            .agg(F.avg("signal").alias("avg_signal_strength"),
                 F.avg("precission").alias("avg_gps_precision"),
                 F.count(F.lit(1)).alias("n_records"))
            .select(*_window_cols(), "operator", "avg_signal_strength",
                    "avg_gps_precision", "n_records"))


def event_time_status_counts(typed: DataFrame, window: str = "1 hour",
                             delay: str = DEFAULT_DELAY) -> DataFrame:
    """Rows per postal code, status text and event-time window."""
    return (_windowed(typed, window, delay)
            .groupBy(F.window(RECORD_TS, window), "postal_code", "description")
            .agg(F.count(F.lit(1)).alias("status_count"))
            .select(*_window_cols(), "postal_code", "description", "status_count"))


def _window_hour() -> list:
    return calendar_parts("window_start", "window_")


def start_event_time_sink(kpis: DataFrame, path: str, checkpoint: str,
                          available_now: bool = False, seconds: int = MICRO_BATCH_SECONDS,
                          name: str | None = None) -> StreamingQuery:
    """Append final windows to Parquet, in folders by window hour (one write per closed window).

    Rows are dealt out by window hour before the write, so a batch writes one file
    for each hour that it closes, however many tasks its aggregate has.
    """
    w = (kpis.select("*", *_window_hour()).repartition(*WINDOW_HOUR).writeStream.outputMode("append").format("parquet")
         .partitionBy(*WINDOW_HOUR)
         .option("path", path).option("checkpointLocation", checkpoint)
         .trigger(**trigger_options(available_now, seconds)))
    if name:
        w = w.queryName(name)
    return w.start()


def start_raw_sink(stream: DataFrame, path: str, checkpoint: str,
                   available_now: bool = False,
                   seconds: int = MICRO_BATCH_SECONDS) -> StreamingQuery:
    """Raw records to Parquet partitioned by the UTC event hour (INT parts)."""
    out = stream.select("*", *calendar_parts(RECORD_TS))
    return (out.writeStream.outputMode("append").format("parquet")
            .partitionBy("year", "month", "day", "hour")
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(**trigger_options(available_now, seconds))
            .start())


class _RawWriter:
    """Raw records by event hour and dead letters, both from one read of a batch."""

    def __init__(self, path: str, dead_letters: str, shape):
        self.path, self.dead_letters, self.shape = path, dead_letters, shape

    def __call__(self, batch_df: DataFrame, epoch_id: int) -> None:
        key = f"{query_id(batch_df) or 'batch'}-{epoch_id}"
        batch = batch_df.persist()
        try:
            bad = F.col(CORRUPT).isNotNull()
            good = self.shape(batch.where(~bad).drop(CORRUPT)).select("*", *calendar_parts(RECORD_TS))
            replace_leaves(good, self.path, key, ["year", "month", "day", "hour"])
            letters = batch.where(bad).select(*[c for c in ("key", RECORD_TS, CORRUPT) if c in batch.columns])
            if not letters.isEmpty():
                replace_leaves(letters, self.dead_letters, key, [])
        finally:
            batch.unpersist()


def replace_leaves(df: DataFrame, path: str, key: str, by: list[str]) -> None:
    """Write one batch into folders ``by`` and, innermost, its key; a replay replaces its own leaves."""
    (df.withColumn(BATCH_KEY, F.lit(key)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*by, BATCH_KEY).parquet(path))


def start_raw_and_dead_letters(parsed: DataFrame, path: str, dead_letters: str, checkpoint: str, shape,
                               available_now: bool = False, seconds: int = MICRO_BATCH_SECONDS) -> StreamingQuery:
    """``parsed`` records to ``path`` (after ``shape``, which types them) and to ``dead_letters``."""
    return (parsed.writeStream.option("checkpointLocation", checkpoint)
            .trigger(**trigger_options(available_now, seconds))
            .foreachBatch(_RawWriter(path, dead_letters, shape)).start())


class _UpdateWriter:
    """Changed groups of a batch, in folders by window hour.

    Each row has the query that wrote it (the id in its checkpoint), the batch and
    the time of writing.
    """

    def __init__(self, path: str):
        self.path = path

    def __call__(self, batch_df: DataFrame, epoch_id: int) -> None:
        query = query_id(batch_df) or "batch"
        out = batch_df.select("*", F.lit(query).alias("query_id"), F.lit(epoch_id).cast("bigint").alias("epoch_id"),
                              F.current_timestamp().alias("written_at"), *_window_hour())
        replace_leaves(cluster_by_partition(out, WINDOW_HOUR), self.path, f"{query}-{epoch_id}", WINDOW_HOUR)


def start_update_sink(kpis: DataFrame, path: str, checkpoint: str,
                      available_now: bool = False, seconds: int = MICRO_BATCH_SECONDS,
                      name: str = "kpi_updates") -> StreamingQuery:
    """Update mode: every batch appends the groups whose value changed."""
    return (kpis.writeStream.outputMode("update").queryName(name)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger_options(available_now, seconds))
            .foreachBatch(_UpdateWriter(path))
            .start())


UPDATE_COLS = ["query_id", "epoch_id", "written_at", BATCH_KEY, *WINDOW_HOUR]


def _latest(updates: DataFrame, keys: list[str]) -> DataFrame:
    """The newest row of each group: of the query that began last, the latest batch.

    Batch ids begin again with a new checkpoint, so they compare within one query
    only; queries are ordered by the first time at which they wrote.
    """
    begun = updates.groupBy("query_id").agg(F.min("written_at").alias("_begun"))
    values = [c for c in updates.columns if c not in keys]
    newest = F.max_by(F.struct(*values), F.struct("_begun", "epoch_id")).alias("v")
    return updates.join(begun, "query_id").groupBy(*keys).agg(newest).select(*keys, "v.*")


def read_latest_updates(spark: SparkSession, path: str, keys: list[str], where=None,
                        compacted: str | None = None) -> DataFrame:
    """Current value of every group. ``where``: a filter on the window hour columns (pruned folders)."""
    df = spark.read.parquet(path)
    if compacted:
        df = df.unionByName(spark.read.parquet(compacted).select(df.columns))
    return _latest(df if where is None else df.where(where), keys).drop(*UPDATE_COLS)


def compact_updates(spark: SparkSession, path: str, compacted: str, keys: list[str], where=None) -> None:
    """Write the newest row of each group of the hours in ``where``, few files an hour.

    A rerun replaces the hours it writes. ``read_latest_updates`` with ``compacted``
    gives the same result as without; batches that came since still win, by their
    place among the batches. Old batch folders of these hours may then be retired.
    """
    df = spark.read.parquet(path)
    latest = _latest(df if where is None else df.where(where), keys).select(df.columns)
    (cluster_by_partition(latest, WINDOW_HOUR).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*WINDOW_HOUR).parquet(compacted))
