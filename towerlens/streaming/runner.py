"""Job runners: the live micro-batch job and the event-time (calendar hour) job.

Both read one stream of JSON measurement records (Kafka ``value`` in
production, JSON files in tests), parse them with the all-text wire schema
and send corrupt records to a dead-letter folder.

``python -m towerlens.streaming.runner live|hourly --source-format kafka
--option kafka.bootstrap.servers=... --option subscribe=metrics --out <dir>``
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from towerlens.functions.timeparts import MICRO_BATCH_SECONDS, interval_seconds
from towerlens.operators.parse import parse_records, type_records
from towerlens.schema import AVERAGE_BY_OPERATOR_SCHEMA, RECORD_TS, STATUS_BY_POSTAL_CODE_SCHEMA
from towerlens.session import apply_job_conf
from towerlens.sinks.commits import read_commits
from towerlens.sinks.lake import register_tables
from towerlens.sources.stream import stream_source
from towerlens.streaming import jobs
from towerlens.streaming.ledger import EventTimeLedger, start_ledger_job
from towerlens.streaming.listener import LateRowsListener

JSON_FILE_SCHEMA = T.StructType([T.StructField("key", T.StringType()),
                                 T.StructField("value", T.StringType())])


def parsed_stream(spark: SparkSession, source_format: str, path: str | None,
                  options: dict[str, str], starting: str = "earliest", ts_col: str | None = None,
                  bookmark: str | None = None) -> DataFrame:
    """``ts_col``: an arrival-time field of the file records (text or timestamp)."""
    schema = JSON_FILE_SCHEMA if source_format != "kafka" else None
    if schema is not None and ts_col:
        schema = T.StructType([*schema.fields, T.StructField(ts_col, T.TimestampType())])
    s = stream_source(spark, path, fmt=source_format, schema=schema, starting=starting,
                      options=options, ts_col=ts_col, bookmark=bookmark)
    keep = [c for c in s.columns if c in ("key", "value", RECORD_TS)]
    return parse_records(s.select(*keep).withColumn("key", F.col("key").cast("string")))


def start_live_job(spark: SparkSession, parsed: DataFrame, out_dir: str,
                   available_now: bool = False,
                   window_seconds: int = MICRO_BATCH_SECONDS,
                   catalog: dict[str, str] | None = None) -> list[StreamingQuery]:
    """foreachBatch every ``window_seconds``: raw, two KPI tables and dead letters from one read."""
    q, _ = jobs.start_microbatch_job(parsed, out_dir, f"{out_dir}/_checkpoints/live", catalog=catalog,
                                     available_now=available_now, window_seconds=window_seconds)
    return [q]


def start_hourly_job(spark: SparkSession, parsed: DataFrame, out_dir: str,
                     available_now: bool = False, delay: str = jobs.DEFAULT_DELAY,
                     seconds: int = MICRO_BATCH_SECONDS) -> list[StreamingQuery]:
    """Operator means and status counts per hour window, raw records, dead letters and late records.

    One query, so one read of the source (see ``streaming.ledger``).
    """
    ledger = EventTimeLedger(out_dir, "hourly", 3600, interval_seconds(delay),
                             shape=lambda good: type_records(good.drop("key")))
    return [start_ledger_job(parsed, ledger, f"{out_dir}/_checkpoints/hourly", available_now, seconds, name="hourly")]


def await_all(spark: SparkSession, queries: list[StreamingQuery],
              available_now: bool = False) -> None:
    """Continuous triggers: block until one query ends (they only end on error
    or stop), then stop the rest and raise the first error.
    availableNow: every query ends by itself once its input is done; wait for all.
    """
    try:
        if available_now:
            for q in queries:
                q.awaitTermination()
        else:
            spark.streams.resetTerminated()  # else a query that ended before would end this wait
            ended = [q for q in queries if not q.isActive]
            for q in ended:
                q.awaitTermination()
            if not ended:
                spark.streams.awaitAnyTermination()
    finally:
        errors = [q.exception() for q in queries if q.exception() is not None]
        for q in queries:
            if q.isActive:
                q.stop()
    if errors:
        raise RuntimeError(str(errors[0]))


def kpi_catalog(spark: SparkSession, database: str, out_dir: str) -> dict[str, str]:
    """Register the live job's KPI tables once; returns what ``MicroBatchWriter`` extends."""
    tables = {"average_by_operator": AVERAGE_BY_OPERATOR_SCHEMA, "status_by_postal_code": STATUS_BY_POSTAL_CODE_SCHEMA}
    register_tables(spark, database, {n: (f"{out_dir}/{n}", s) for n, s in tables.items()},
                    database_location=f"{out_dir}/_catalog/{database}.db", discover=False)
    return {n: f"{database}.{n}" for n in tables}


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="towerlens.streaming.runner")
    ap.add_argument("job", choices=["live", "hourly"])
    ap.add_argument("--source-format", default="kafka")
    ap.add_argument("--source-path", default=None)
    ap.add_argument("--option", action="append", default=[], help="key=value source option")
    ap.add_argument("--starting", choices=["earliest", "latest"], default="earliest")
    ap.add_argument("--out", required=True)
    ap.add_argument("--window-seconds", type=int, default=MICRO_BATCH_SECONDS)
    ap.add_argument("--delay", default=jobs.DEFAULT_DELAY)
    ap.add_argument("--available-now", action="store_true")
    ap.add_argument("--rocksdb", action="store_true",
                    help="keep streaming state in RocksDB (large key spaces)")
    ap.add_argument("--max-offsets-per-trigger", type=int, default=None,
                    help="Kafka: cap records per micro-batch (bounded batch size on backlog)")
    ap.add_argument("--database", default=None,
                    help="live: catalog database whose KPI tables get each batch's partitions")
    ap.add_argument("--ts-col", default=None, help="arrival-time field of file records")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"towerlens-{a.job}").getOrCreate()
    apply_job_conf(spark)
    if a.rocksdb:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                       "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    opts = dict(o.split("=", 1) for o in a.option)
    if a.max_offsets_per_trigger and a.source_format == "kafka":
        opts.setdefault("maxOffsetsPerTrigger", str(a.max_offsets_per_trigger))
    late = LateRowsListener()
    spark.streams.addListener(late)
    parsed = parsed_stream(spark, a.source_format, a.source_path, opts, a.starting, a.ts_col,
                           f"{a.out}/_checkpoints/start-{a.job}")
    try:
        if a.job == "live":
            catalog = kpi_catalog(spark, a.database, a.out) if a.database else None
            qs = start_live_job(spark, parsed, a.out, a.available_now, a.window_seconds, catalog)
        else:
            qs = start_hourly_job(spark, parsed, a.out, a.available_now, a.delay, a.window_seconds)
        await_all(spark, qs, a.available_now)
    finally:
        spark.streams.removeListener(late)
        for name, n in sorted(late.dropped.items()):
            print(f"{name}: {n} groups of late rows dropped")
        if a.job == "hourly":
            n = read_commits(spark, a.out).agg(F.sum("n_late")).first()[0] or 0
            print(f"{n} late records in {a.out}/late")


if __name__ == "__main__":
    main()
