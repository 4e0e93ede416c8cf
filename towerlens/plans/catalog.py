"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Every query reads the driver's ``events`` table (through the adapter in
``sources.events``) in full. Queries that exercise sinks or streams write
under a fresh folder in the shared working folder (``spark.checkpoint.dir``)
and return the written data read back. Double columns are rounded for
comparison with the SQL oracle, because the engines add in a different order
and the last bits differ: means, deviations and other bounded figures to
``DIGITS`` places (at 6 places, means of 2-decimal values over 32·k rows land
exactly on rounding ties), sums of doubles (``sum_*``) to ``SUM_DIGITS``
places, since the absolute error of a sum grows with its magnitude.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from towerlens.operators import clean, kpis, serving
from towerlens.operators.mapping import apply_mapping
from towerlens.operators.parse import (
    encode_records, parse_records, type_records, with_processing_time,
)
from towerlens.plans import rollup
from towerlens.plans.microbatch import MicroBatchWriter, clean_records, clean_records_by_window, kpi_frames
from towerlens.schema import (
    AVERAGE_BY_OPERATOR_SCHEMA, BATCH_KEY, INGEST_COLS, PAYLOAD_FIELDS, RECORD_TS,
    STATUS_BY_POSTAL_CODE_SCHEMA, WIRE_SCHEMA,
)
from towerlens.session import apply_job_conf, new_run_dir
from towerlens.sinks.commits import committed, snapshot
from towerlens.sinks.lake import publish_records, register_tables, write_result
from towerlens.sources.events import RECORD_ID, corrupted, load_table, wire_from_events
from towerlens.sources.files import CSV_NULL_TOKEN, read_lake_table, scan_csv
from towerlens.sources.inferred import InferredBatches
from towerlens.sources.stream import stream_source, with_record_ts
from towerlens.streaming import jobs, ledger
from towerlens.streaming.runner import kpi_catalog

DIGITS = 9
SUM_DIGITS = 4

# Parameters of the registered serving queries. The test data covers January
# 2024, so "now" is pinned to its end; in production as_of is None (clock).
AS_OF = "2024-01-31 00:00:00"
OPERATOR_RANGE = "7 days"
HOURLY_RANGE = "24 hours"
STREAM_START = "2024-01-15 00:00:00"
WINDOW = "1 hour"
DELAY = "1 minute"
LATE_WINDOW = "1 day"
LATE_DELAY = "1 hour"
COMPACT_UNTIL = "2024-01-20 00:00:00"

DISTINCT_COLUMNS = ["network", "operator", "activity"]
PROFILE_COLUMNS = ["network", "operator", "activity", "description"]
FIRST_N = 250

#: Records of a file that arrives: tasks of a batch are files or parts of them, however the table is cut.
STAGE_ROWS = 200_000
PREVIEW = 10


def rounded(df: DataFrame, digits: int = DIGITS, sum_digits: int = SUM_DIGITS) -> DataFrame:
    def fix(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if not isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return c
        return F.round(c, sum_digits if f.name.startswith("sum_") else digits).alias(f.name)
    return df.select(*[fix(f) for f in df.schema.fields])


def _wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_job_conf(spark)
    return wire_from_events(load_table(spark, sf_dir, "events"))


def _typed(spark, sf_dir):
    return type_records(_wire(spark, sf_dir))


def _mapped(spark, sf_dir):
    return clean_records(_wire(spark, sf_dir))


def _kpi_tables(spark, sf_dir, time_range=None, mode="interval"):
    """Both KPI frames; with a range only of the records that it can need."""
    since = serving.range_start(AS_OF, time_range, mode) if time_range else None
    return kpi_frames(_mapped(spark, sf_dir), since=since)


# ---------------------------------------------------------------- batch KPIs

def q_average_by_operator(spark, sf_dir):
    return rounded(kpis.average_by_operator(_mapped(spark, sf_dir)))


def q_status_by_postal_code(spark, sf_dir):
    return kpis.status_by_postal_code(_mapped(spark, sf_dir))


def q_signal_by_operator_hour(spark, sf_dir):
    return rounded(kpis.signal_by_operator_hour(_typed(spark, sf_dir)))


def q_precision_by_operator_hour(spark, sf_dir):
    return rounded(kpis.precision_by_operator_hour(_typed(spark, sf_dir)))


def q_status_by_postal_hour(spark, sf_dir):
    return kpis.status_by_postal_hour(_typed(spark, sf_dir))


def q_avg_signal_batch(spark, sf_dir):
    return rounded(kpis.avg_signal_batch(_wire(spark, sf_dir)))


def q_avg_precision_batch(spark, sf_dir):
    return rounded(kpis.avg_precision_batch(_wire(spark, sf_dir)))


def q_status_count_batch(spark, sf_dir):
    return kpis.status_count_batch(_wire(spark, sf_dir))


def q_kpi_operator_join(spark, sf_dir):
    """Inner join of two KPI frames, each computed on its own."""
    w = _wire(spark, sf_dir)
    return rounded(kpis.join_operator_kpis(kpis.avg_signal_batch(w), kpis.avg_precision_batch(w)))


def q_operator_kpis(spark, sf_dir):
    """The same result in one aggregate."""
    return rounded(kpis.operator_kpis(_wire(spark, sf_dir)))


GENERIC_GROUPS = ["network"]
GENERIC_AGGS = [("signal", "max"), ("speed", "min"), ("status", "count")]
GLOBAL_AGGS = [("signal", "avg"), ("precission", "sum"), ("status", "count")]


def q_generic_aggregate(spark, sf_dir):
    return rounded(kpis.generic_aggregate(_typed(spark, sf_dir), GENERIC_GROUPS, GENERIC_AGGS))


def q_generic_aggregate_global(spark, sf_dir):
    return rounded(kpis.generic_aggregate(_typed(spark, sf_dir), [], GLOBAL_AGGS))


def q_distinct_values(spark, sf_dir):
    return kpis.distinct_values(_wire(spark, sf_dir), DISTINCT_COLUMNS)


def q_distinct_profile(spark, sf_dir):
    return kpis.distinct_profile(_wire(spark, sf_dir), PROFILE_COLUMNS)


def q_row_count(spark, sf_dir):
    return kpis.row_count(_wire(spark, sf_dir))


def q_describe_columns(spark, sf_dir):
    typed = _typed(spark, sf_dir)
    return rounded(kpis.describe_columns(typed.drop(RECORD_ID, RECORD_TS)))


def q_preview_rows(spark, sf_dir):
    """The first rows that come, counted: which rows these are is not defined."""
    return kpis.row_count(_wire(spark, sf_dir).limit(PREVIEW))


# ------------------------------------------------------- projections, casts

def q_calendar_parts(spark, sf_dir):
    from towerlens.functions.timeparts import calendar_parts
    return _typed(spark, sf_dir).select(RECORD_ID, *calendar_parts(RECORD_TS))


def q_ingest_partitions(spark, sf_dir):
    from towerlens.functions.timeparts import ingest_parts
    return _wire(spark, sf_dir).select(RECORD_ID, *ingest_parts(RECORD_TS))


def q_cast_numeric(spark, sf_dir):
    from towerlens.functions.casts import lenient_double
    w = _wire(spark, sf_dir)
    return rounded(w.select(RECORD_ID, lenient_double("signal").alias("signal"),
                            lenient_double("precission").alias("precission")))


def q_apply_mapping(spark, sf_dir):
    return rounded(apply_mapping(_wire(spark, sf_dir)))


def q_remove_null_rows(spark, sf_dir):
    return clean.remove_null_rows(_wire(spark, sf_dir))


def q_drop_null_fields(spark, sf_dir):
    """The columns that are left, as text, since which they are depends on the data."""
    left = clean.drop_null_fields(_wire(spark, sf_dir))
    shown = [F.concat(F.lit(f"{c}="), F.coalesce(c, F.lit("<null>"))) for c in left.columns if c in PAYLOAD_FIELDS]
    return left.select(RECORD_ID, RECORD_TS, F.concat_ws("|", *shown).alias("fields"))


def q_drop_fields(spark, sf_dir):
    w = _wire(spark, sf_dir)
    nested = w.select(RECORD_ID, RECORD_TS, F.struct(*PAYLOAD_FIELDS).alias("payload"))
    dropped = clean.drop_fields(nested, [("payload", "satellites"), ("payload", "provider")])
    return dropped.select(RECORD_ID, RECORD_TS, "payload.*")


def q_parse_records(spark, sf_dir):
    w = _wire(spark, sf_dir)
    return parse_records(corrupted(encode_records(w)).drop("key", RECORD_TS))


def q_with_record_ts(spark, sf_dir):
    apply_job_conf(spark)
    ev = load_table(spark, sf_dir, "events")
    return (with_record_ts(ev, "ts")
            .select(F.col("event_id").alias(RECORD_ID),
                    F.col(RECORD_TS).cast("timestamp_ntz").alias(RECORD_TS)))


def q_with_processing_time(spark, sf_dir):
    w = with_processing_time(_wire(spark, sf_dir))
    return w.select(RECORD_ID, "operator",
                    F.col("processing_time").isNotNull().alias("has_processing_time"))


# ------------------------------------------------------------------ serving

def q_hour_label(spark, sf_dir):
    avg, _ = _kpi_tables(spark, sf_dir)
    return serving.with_hour_label(avg).select("batch_window", "operator", "hour_label")


def q_time_range_filter(spark, sf_dir):
    avg, _ = _kpi_tables(spark, sf_dir, OPERATOR_RANGE)
    return rounded(serving.time_range_filter(avg, AS_OF, OPERATOR_RANGE)
                   .select("batch_window", "operator", "avg_signal", "avg_precission",
                           "ingest_year", "ingest_month", "ingest_day", "ingest_hour"))


def q_operator_metrics(spark, sf_dir):
    avg, _ = _kpi_tables(spark, sf_dir, OPERATOR_RANGE)
    return rounded(serving.operator_metrics(avg, AS_OF, OPERATOR_RANGE))


def q_operator_metrics_weighted(spark, sf_dir):
    avg, _ = _kpi_tables(spark, sf_dir, OPERATOR_RANGE)
    return rounded(serving.operator_metrics_weighted(avg, AS_OF, OPERATOR_RANGE))


def q_postal_code_status(spark, sf_dir):
    _, status = _kpi_tables(spark, sf_dir, OPERATOR_RANGE)
    return serving.postal_code_status(status, AS_OF, OPERATOR_RANGE)


def q_hourly_metrics(spark, sf_dir):
    avg, _ = _kpi_tables(spark, sf_dir, HOURLY_RANGE)
    return rounded(serving.hourly_metrics(avg, AS_OF, HOURLY_RANGE))


def q_summary_cards(spark, sf_dir):
    avg, status = _kpi_tables(spark, sf_dir, OPERATOR_RANGE)
    return rounded(serving.summary_cards(
        serving.operator_metrics(avg, AS_OF, OPERATOR_RANGE, ordered=False),
        serving.postal_code_status(status, AS_OF, OPERATOR_RANGE, ordered=False)))


def q_pivot_status(spark, sf_dir):
    _, status = _kpi_tables(spark, sf_dir, OPERATOR_RANGE)
    return _named_pivot(serving.pivot_status(serving.postal_code_status(status, AS_OF, OPERATOR_RANGE,
                                                                        ordered=False)))


def _named_pivot(pivot):
    """SQL has no column with an empty name."""
    return pivot.withColumnRenamed("", "blank")


def _placed(df, *order):
    """The place of each row in a served order (ties share one): the result is a few rows."""
    return df.withColumn("position", F.rank().over(Window.orderBy(*order)).cast("bigint"))


def q_operator_metrics_order(spark, sf_dir):
    avg, _ = _kpi_tables(spark, sf_dir, OPERATOR_RANGE)
    out = rounded(serving.operator_metrics(avg, AS_OF, OPERATOR_RANGE, ordered=False))
    return _placed(out, *serving.operator_order())


def q_postal_code_status_order(spark, sf_dir):
    _, status = _kpi_tables(spark, sf_dir, OPERATOR_RANGE)
    return _placed(serving.postal_code_status(status, AS_OF, OPERATOR_RANGE, ordered=False), *serving.status_order())


def q_hourly_metrics_order(spark, sf_dir):
    avg, _ = _kpi_tables(spark, sf_dir, HOURLY_RANGE)
    return _placed(rounded(serving.hourly_metrics(avg, AS_OF, HOURLY_RANGE, ordered=False)), *serving.hourly_order())


def q_operator_metrics_reference_range(spark, sf_dir):
    """The range read as the original did: "7 days" is 7 hours."""
    avg, _ = _kpi_tables(spark, sf_dir, OPERATOR_RANGE, "reference")
    return rounded(serving.operator_metrics(avg, AS_OF, OPERATOR_RANGE, mode="reference"))


def q_distinct_status(spark, sf_dir):
    _, status = _kpi_tables(spark, sf_dir, OPERATOR_RANGE)
    return serving.distinct_status(serving.postal_code_status(status, AS_OF, OPERATOR_RANGE,
                                                              ordered=False))


# -------------------------------------------------------------- lake tables

def _write_one_batch(spark, sf_dir, name, raw=True) -> MicroBatchWriter:
    """Run the micro-batch body once over the whole table (one batch)."""
    writer = MicroBatchWriter(new_run_dir(spark, name), f"{name}-backfill", raw=raw)
    writer(_wire(spark, sf_dir), 0)
    return writer


def _lake(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Both KPI tables as the catalog holds them, written anew for each query.

    The writer adds its partitions to the catalog, so a range is pruned there and
    the table's folders are not listed.
    """
    out = new_run_dir(spark, "lake")
    tables = kpi_catalog(spark, "towerlens_" + out.rsplit("-", 1)[-1], out)
    MicroBatchWriter(out, "lake-backfill", raw=False, catalog=tables)(_wire(spark, sf_dir), 0)
    return spark.table(tables["average_by_operator"]), spark.table(tables["status_by_postal_code"])


def q_lake_operator_metrics(spark, sf_dir):
    return rounded(serving.operator_metrics(_lake(spark, sf_dir)[0], AS_OF, OPERATOR_RANGE))


def q_lake_hourly_metrics(spark, sf_dir):
    return rounded(serving.hourly_metrics(_lake(spark, sf_dir)[0], AS_OF, HOURLY_RANGE))


def q_lake_postal_code_status(spark, sf_dir):
    return serving.postal_code_status(_lake(spark, sf_dir)[1], AS_OF, OPERATOR_RANGE)


def _lake_status(status):
    return serving.postal_code_status(status, AS_OF, OPERATOR_RANGE, ordered=False)


def q_lake_summary_cards(spark, sf_dir):
    avg, status = _lake(spark, sf_dir)
    return rounded(serving.summary_cards(serving.operator_metrics(avg, AS_OF, OPERATOR_RANGE, ordered=False),
                                         _lake_status(status)))


def q_lake_pivot_status(spark, sf_dir):
    return _named_pivot(serving.pivot_status(_lake_status(_lake(spark, sf_dir)[1])))


def q_lake_distinct_status(spark, sf_dir):
    return serving.distinct_status(_lake_status(_lake(spark, sf_dir)[1]))


def _raw_schema(wire_like: T.StructType) -> T.StructType:
    return T.StructType(list(wire_like.fields)
                        + [T.StructField(c, T.StringType()) for c in INGEST_COLS + [BATCH_KEY]])


def q_batch_raw_sink(spark, sf_dir):
    writer = _write_one_batch(spark, sf_dir, "batch_raw_sink")
    schema = _raw_schema(_wire(spark, sf_dir).schema)
    return read_lake_table(spark, writer.paths()["raw"], schema).drop(BATCH_KEY)


def q_batch_kpi_sink(spark, sf_dir):
    writer = _write_one_batch(spark, sf_dir, "batch_kpi_sink")
    return read_lake_table(spark, writer.paths()["status_by_postal_code"],
                           STATUS_BY_POSTAL_CODE_SCHEMA).drop(BATCH_KEY)


def q_scan_kpi_table(spark, sf_dir):
    writer = _write_one_batch(spark, sf_dir, "scan_kpi_table")
    kpi = read_lake_table(spark, writer.paths()["average_by_operator"], AVERAGE_BY_OPERATOR_SCHEMA)
    return rounded(serving.operator_metrics(kpi, AS_OF, OPERATOR_RANGE))


def q_register_tables(spark, sf_dir):
    writer = _write_one_batch(spark, sf_dir, "register_tables")
    db = "towerlens_" + writer.out_dir.rsplit("-", 1)[-1]
    p = writer.paths()
    register_tables(spark, db, {
        "average_by_operator": (p["average_by_operator"], AVERAGE_BY_OPERATOR_SCHEMA),
        "status_by_postal_code": (p["status_by_postal_code"], STATUS_BY_POSTAL_CODE_SCHEMA),
    }, database_location=f"{writer.out_dir}/_catalog/{db}.db")
    return spark.table(f"{db}.status_by_postal_code").drop(BATCH_KEY)


def q_compacted_kpi_table(spark, sf_dir):
    """Closed hours compacted, then a late batch into one of them: nothing is hidden.

    Two batches by record id: the first is compacted up to COMPACT_UNTIL, the
    second arrives afterwards, also for hours that are compacted already.
    """
    from towerlens.sinks.lake import compact_hours, read_compacted

    writer = MicroBatchWriter(new_run_dir(spark, "compacted_kpi_table"), "backfill", raw=False)
    live = writer.paths()["average_by_operator"]
    comp = f"{writer.out_dir}/average_by_operator_compacted"
    wire = _wire(spark, sf_dir)
    late = F.col(RECORD_ID) % 2 == 1
    writer(wire.where(~late), 0)
    compact_hours(spark, live, comp, AVERAGE_BY_OPERATOR_SCHEMA, COMPACT_UNTIL)
    writer(wire.where(late), 1)
    rows = read_compacted(spark, live, comp, AVERAGE_BY_OPERATOR_SCHEMA)
    # the two batches hold rows of the same windows: served as one row each
    return rounded(serving.merged_windows(rows, *INGEST_COLS).select(
        "batch_window", "operator", "avg_signal", "avg_precission", "sum_signal", "n_signal", "sum_precission",
        "n_precission", *INGEST_COLS))


def q_write_result(spark, sf_dir):
    avg, _ = _kpi_tables(spark, sf_dir, OPERATOR_RANGE)
    path = new_run_dir(spark, "write_result")
    write_result(serving.operator_metrics(avg, AS_OF, OPERATOR_RANGE), path)
    schema = "operator STRING, avg_signal_strength DOUBLE, avg_precision DOUBLE"
    reader = spark.read.schema(schema).option("header", "true").option("emptyValue", "")
    return rounded(reader.option("nullValue", CSV_NULL_TOKEN).csv(path))


def _replayed(spark, path):
    """Published records read back; a key that is a time is shown as 'time'."""
    back = spark.read.schema("key STRING, value STRING").json(path)
    by_time = F.col("key").rlike(r"^[0-9]+\.[0-9]{6}$")
    return parse_records(back.withColumn("key", F.when(by_time, F.lit("time")).otherwise(F.col("key"))))


def q_replay_records(spark, sf_dir):
    path = new_run_dir(spark, "replay_records")
    publish_records(encode_records(_wire(spark, sf_dir)), fmt="json", path=path)
    return _replayed(spark, path)


def q_replay_first_n(spark, sf_dir):
    """The first records by id, as the replay tool's limit publishes them."""
    path = new_run_dir(spark, "replay_first_n")
    w = _wire(spark, sf_dir)
    publish_records(encode_records(w), fmt="json", path=path, limit=FIRST_N, order=[RECORD_ID])
    return _replayed(spark, path)


def q_scan_csv_null_token(spark, sf_dir):
    w = _wire(spark, sf_dir).select(*PAYLOAD_FIELDS)
    path = new_run_dir(spark, "scan_csv")
    (w.write.mode("overwrite").option("header", "true").option("nullValue", CSV_NULL_TOKEN)
     .csv(path))
    return scan_csv(spark, path, WIRE_SCHEMA)


# ---------------------------------------------------------------- streaming

def _events_stream(spark, sf_dir, **kw) -> DataFrame:
    schema = load_table(spark, sf_dir, "events").schema
    return stream_source(spark, sf_dir.rstrip("/"), fmt="parquet", schema=schema,
                         options={"pathGlobFilter": "events.parquet"}, ts_col="ts", **kw)


def _wire_stream(spark, sf_dir, **kw) -> DataFrame:
    """Stream of wire records; record_ts kept as TIMESTAMP_NTZ for batch writes."""
    ev = _events_stream(spark, sf_dir, **kw)
    return wire_from_events(ev.drop(RECORD_TS))


def _typed_stream(spark, sf_dir) -> DataFrame:
    t = type_records(_wire_stream(spark, sf_dir))
    return t.withColumn(RECORD_TS, F.col(RECORD_TS).cast("timestamp"))


def _run(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def q_microbatch_kpis(spark, sf_dir):
    apply_job_conf(spark)
    out = new_run_dir(spark, "microbatch_kpis")
    q, writer = jobs.start_microbatch_job(_wire_stream(spark, sf_dir), out, f"{out}/_checkpoint",
                                          available_now=True)
    _run(q)
    return rounded(read_lake_table(spark, writer.paths()["average_by_operator"],
                                   AVERAGE_BY_OPERATOR_SCHEMA).drop(BATCH_KEY))


def _days(ev: DataFrame, parts: int) -> list:
    """The midnights that cut the table's time span into ``parts`` about equal parts."""
    low, high = ev.agg(F.min("ts"), F.max("ts")).first()
    cuts = [low + (high - low) * i / parts for i in range(1, parts)]
    return [c.replace(hour=0, minute=0, second=0, microsecond=0) for c in cuts]


def q_stream_restart(spark, sf_dir):
    """Restarts and a new checkpoint: no batch lost, none counted twice.

    The first half of the time span arrives, the job runs, then runs again from
    its checkpoint with nothing new. The second half is read by a new query with
    a new checkpoint, whose batch ids begin at 0 again, into the same tables.
    Halves meet at midnight, which is also the bound of a 100-second window.
    """
    apply_job_conf(spark)
    out = new_run_dir(spark, "stream_restart")
    ev = load_table(spark, sf_dir, "events")
    cut = F.lit(_days(ev, 2)[0]).cast("timestamp_ntz")
    for stage, rows, runs in (("a", F.col("ts") < cut, 2), ("b", F.col("ts") >= cut, 1)):
        ev.filter(rows).write.parquet(f"{out}/stage-{stage}")
        for _ in range(runs):
            s = stream_source(spark, f"{out}/stage-{stage}", fmt="parquet", schema=ev.schema, ts_col="ts")
            q, writer = jobs.start_microbatch_job(wire_from_events(s.drop(RECORD_TS)), out,
                                                  f"{out}/_checkpoint-{stage}", available_now=True)
            _run(q)
    return read_lake_table(spark, writer.paths()["status_by_postal_code"],
                           STATUS_BY_POSTAL_CODE_SCHEMA).drop(BATCH_KEY)


def q_stream_kpi_append(spark, sf_dir):
    apply_job_conf(spark)
    out = new_run_dir(spark, "stream_kpi_append")
    kpi = jobs.event_time_operator_kpis(_typed_stream(spark, sf_dir), WINDOW, DELAY)
    _run(jobs.start_event_time_sink(kpi, f"{out}/data", f"{out}/_checkpoint", available_now=True))
    return rounded(spark.read.parquet(f"{out}/data").drop(*jobs.WINDOW_HOUR))


def q_stream_kpi_update(spark, sf_dir):
    apply_job_conf(spark)
    out = new_run_dir(spark, "stream_kpi_update")
    kpi = jobs.event_time_status_counts(_typed_stream(spark, sf_dir), WINDOW, DELAY)
    _run(jobs.start_update_sink(kpi, f"{out}/data", f"{out}/_checkpoint", available_now=True))
    return jobs.read_latest_updates(spark, f"{out}/data",
                                    ["window_start", "window_end", "postal_code", "description"])


def q_stream_raw_sink(spark, sf_dir):
    apply_job_conf(spark)
    out = new_run_dir(spark, "stream_raw_sink")
    stream = _wire_stream(spark, sf_dir).withColumn(RECORD_TS, F.col(RECORD_TS).cast("timestamp"))
    stream = stream.withColumnRenamed("hour", "measured_at_text")
    _run(jobs.start_raw_sink(stream, f"{out}/data", f"{out}/_checkpoint", available_now=True))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in stream.schema.fields]
                          + [T.StructField(c, T.IntegerType()) for c in ("year", "month", "day", "hour")])
    back = spark.read.schema(schema).parquet(f"{out}/data")
    return back.withColumn(RECORD_TS, F.col(RECORD_TS).cast("timestamp_ntz"))


def _passthrough(spark, stream: DataFrame, name: str) -> DataFrame:
    out = new_run_dir(spark, name)
    q = (stream.writeStream.format("parquet").option("path", f"{out}/data")
         .option("checkpointLocation", f"{out}/_checkpoint").trigger(availableNow=True).start())
    _run(q)
    return spark.read.parquet(f"{out}/data")


def q_stream_source(spark, sf_dir):
    """Start position 'latest' at STREAM_START: only records arriving from then on."""
    apply_job_conf(spark)
    ev = _events_stream(spark, sf_dir, starting="latest", start_ts=STREAM_START)
    return _passthrough(spark, wire_from_events(ev.drop(RECORD_TS)), "stream_source")


def q_stream_source_earliest(spark, sf_dir):
    """Replayed JSON records read from the start, parsed with the wire schema."""
    apply_job_conf(spark)
    stage = new_run_dir(spark, "stream_stage")
    publish_records(corrupted(encode_records(_wire(spark, sf_dir))), fmt="json", path=stage)
    s = stream_source(spark, stage, fmt="json", schema=T.StructType([
        T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]),
        starting="earliest")
    parsed = parse_records(s).drop(RECORD_TS, "key")
    return _passthrough(spark, parsed, "stream_source_earliest")


def q_stream_inferred_schema(spark, sf_dir):
    """JSON without a schema: the first batch is inferred whole.

    A field that only the last record of the time span has is found, and one whose
    values are of two kinds is text; records of a second batch keep to the schema.
    """
    apply_job_conf(spark)
    out = new_run_dir(spark, "stream_inferred_schema")
    ev = load_table(spark, sf_dir, "events")
    last = ev.agg(F.max("event_id")).first()[0]
    cut = F.lit(_days(ev, 2)[0]).cast("timestamp_ntz")
    fields = {
        RECORD_ID: F.col("event_id"), "operator": F.col("event_type"), "precission": F.col("value"),
        "place": F.struct(F.col("user_id"), F.date_format("ts", "HH:mm").alias("at")),
        "mixed": F.when(F.col("event_id") % 2 == 0, F.to_variant_object(F.array("user_id"))).otherwise(
            F.parse_json(F.col("user_id").cast("string"))),
        "rare": F.when(F.col("event_id") == last, F.lit("seen"))}
    rows = ev.select("ts", F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()])).alias("value"))
    rows = rows.withColumn("value", F.when(F.col("ts") == ev.agg(F.min("ts")).first()[0], F.lit("no json"))
                           .otherwise(F.col("value")))
    parts = ((F.col("ts") < cut) | (F.col("value").contains('"rare"')), (F.col("ts") >= cut) & ~F.col("value").contains('"rare"'))
    for part in parts:
        rows.where(part).select("value").write.mode("append").json(f"{out}/stage")
        s = stream_source(spark, f"{out}/stage", fmt="json", schema="value STRING")

        def body(batch, epoch):
            jobs.replace_leaves(batch.drop(RECORD_TS), f"{out}/data", str(epoch), [])

        q = (s.writeStream.option("checkpointLocation", f"{out}/_checkpoint").trigger(availableNow=True)
             .foreachBatch(InferredBatches(f"{out}/_schema", body)).start())
        _run(q)
    back = spark.read.parquet(f"{out}/data")
    return rounded(back.select("*", "place.*").drop("place", BATCH_KEY))


def q_late_data_drop(spark, sf_dir):
    """Files arrive in three time-ordered chunks, then the first chunk again.

    Daily windows with a 1-hour watermark delay: the replayed chunk is behind
    the watermark, so it changes nothing; windows still open at the end are
    not emitted.
    """
    apply_job_conf(spark)
    out = new_run_dir(spark, "late_data_drop")
    stage, ckpt, data = f"{out}/stage", f"{out}/_checkpoint", f"{out}/data"
    ev = load_table(spark, sf_dir, "events")
    first, second = (F.lit(d).cast("timestamp_ntz") for d in _days(ev, 3))
    ts = F.col("ts")
    chunks = [ts < first, (ts >= first) & (ts < second), ts >= second, ts < first]
    for cond in chunks:
        ev.filter(cond).write.mode("append").parquet(stage)
        s = stream_source(spark, stage, fmt="parquet", schema=ev.schema, ts_col="ts")
        typed = type_records(wire_from_events(s.drop(RECORD_TS)))
        typed = typed.withColumn(RECORD_TS, F.col(RECORD_TS).cast("timestamp"))
        kpi = jobs.event_time_operator_kpis(typed, LATE_WINDOW, LATE_DELAY)
        _run(jobs.start_event_time_sink(kpi, data, ckpt, available_now=True))
    return rounded(spark.read.parquet(data).drop(*jobs.WINDOW_HOUR))


def _ledger(spark, sf_dir, name) -> str:
    """Event-time job over four batches; returns its folder.

    Three time-ordered chunks, then every other record of the whole span again: those
    whose day has ended by the stored watermark are late, the others count twice.
    """
    apply_job_conf(spark)
    out = new_run_dir(spark, name)
    ev = load_table(spark, sf_dir, "events")
    first, second = (F.lit(d).cast("timestamp_ntz") for d in _days(ev, 3))
    ts = F.col("ts")
    for cond in (ts < first, (ts >= first) & (ts < second), ts >= second, F.col("event_id") % 2 == 0):
        ev.filter(cond).write.mode("append").option("maxRecordsPerFile", STAGE_ROWS).parquet(f"{out}/stage")
        s = stream_source(spark, f"{out}/stage", fmt="parquet", schema=ev.schema, ts_col="ts")
        job = ledger.EventTimeLedger(out, "ledger", 86400, 3600, shape=type_records, raw=False)
        _run(ledger.start_ledger_job(wire_from_events(s.drop(RECORD_TS)), job, f"{out}/_checkpoint",
                                     available_now=True, name=name))
    return out


def _no_zone(df: DataFrame) -> DataFrame:
    """Times as SQL shows them."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, T.TimestampType) else f.name for f in df.schema.fields])


def q_late_records(spark, sf_dir):
    """The late records themselves: input rows, not groups."""
    return rounded(_no_zone(ledger.late_records(spark, _ledger(spark, sf_dir, "late_records"))))


def q_ledger_operator_windows(spark, sf_dir):
    out = _ledger(spark, sf_dir, "ledger_operator_windows")
    return rounded(_no_zone(ledger.final_windows(spark, out, "operator_hourly")))


def q_ledger_status_windows(spark, sf_dir):
    out = _ledger(spark, sf_dir, "ledger_status_windows")
    return _no_zone(ledger.final_windows(spark, out, "network_status"))


def q_ledger_open_windows(spark, sf_dir):
    """Windows that are still open, with what was counted so far."""
    out = _ledger(spark, sf_dir, "ledger_open_windows")
    return rounded(_no_zone(ledger.open_windows(spark, out, "operator_hourly", 3600)))


def q_rollup_dashboard(spark, sf_dir):
    """Every dashboard result from the hourly roll-up, as tagged rows.

    Two batches meet within a window, so the second one rolls up the hour of the cut again.
    """
    writer = MicroBatchWriter(new_run_dir(spark, "rollup_dashboard"), "rollup", raw=False, rollup=True)
    wire = _wire(spark, sf_dir)
    cut = F.lit(_days(load_table(spark, sf_dir, "events"), 3)[1]).cast("timestamp_ntz") + F.expr("INTERVAL 1850 SECONDS")
    for n, part in enumerate((F.col(RECORD_TS) < cut, F.col(RECORD_TS) >= cut)):
        writer(wire.where(part), n)
    at = snapshot(spark, writer.out_dir)
    results = {
        "operators": rollup.operator_metrics(spark, writer.out_dir, AS_OF, OPERATOR_RANGE, at),
        "weighted": rollup.operator_metrics_weighted(spark, writer.out_dir, AS_OF, OPERATOR_RANGE, at),
        "hours": rollup.hourly_metrics(spark, writer.out_dir, AS_OF, HOURLY_RANGE, at),
        "status": rollup.postal_code_status(spark, writer.out_dir, AS_OF, OPERATOR_RANGE, at),
        "cards": rollup.summary_cards(spark, writer.out_dir, AS_OF, OPERATOR_RANGE, at)}
    rows = None
    for name, result in results.items():
        tagged = rounded(result).withColumn("result", F.lit(name))
        rows = tagged if rows is None else rows.unionByName(tagged, allowMissingColumns=True)
    return rows


class _Killed(Exception):
    pass


def q_committed_kpis(spark, sf_dir):
    """Three batches, the last one killed after its first table: readers see two in both tables.

    Its first KPI table is written whole, so a reader by folder would count it.
    """
    class DiesBetweenTables(MicroBatchWriter):
        def write_kpis(self, avg, status, key):
            self.write_average(avg, key)
            raise _Killed

    out = new_run_dir(spark, "committed_kpis")
    wire = _wire(spark, sf_dir)
    first, second = (F.lit(d).cast("timestamp_ntz") for d in _days(load_table(spark, sf_dir, "events"), 3))
    ts = F.col(RECORD_TS)
    writer = MicroBatchWriter(out, "committed", raw=False)
    writer(wire.where(ts < first), 0)
    writer(wire.where((ts >= first) & (ts < second)), 1)
    try:
        DiesBetweenTables(out, "committed", raw=False)(wire.where(ts >= second), 2)
    except _Killed:
        pass
    at, p = snapshot(spark, out), writer.paths()
    rows = [committed(read_lake_table(spark, p[name], schema), out, at).groupBy("batch_window").agg(
        F.sum(value).cast("bigint").alias("n")).select(F.lit(name).alias("table_name"), "batch_window", "n")
        for name, schema, value in (("average_by_operator", AVERAGE_BY_OPERATOR_SCHEMA, "n_signal"),
                                    ("status_by_postal_code", STATUS_BY_POSTAL_CODE_SCHEMA, "status_count"))]
    return rows[0].unionByName(rows[1])


def q_window_blank_kpis(spark, sf_dir):
    """KPIs of a backfill whose blank fields are decided in each arrival window."""
    return rounded(kpi_frames(clean_records_by_window(_wire(spark, sf_dir)))[0])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "average_by_operator": q_average_by_operator,
    "status_by_postal_code": q_status_by_postal_code,
    "signal_by_operator_hour": q_signal_by_operator_hour,
    "precision_by_operator_hour": q_precision_by_operator_hour,
    "status_by_postal_hour": q_status_by_postal_hour,
    "avg_signal_batch": q_avg_signal_batch,
    "avg_precision_batch": q_avg_precision_batch,
    "status_count_batch": q_status_count_batch,
    "kpi_operator_join": q_kpi_operator_join,
    "operator_kpis": q_operator_kpis,
    "generic_aggregate": q_generic_aggregate,
    "generic_aggregate_global": q_generic_aggregate_global,
    "distinct_values": q_distinct_values,
    "distinct_profile": q_distinct_profile,
    "row_count": q_row_count,
    "describe_columns": q_describe_columns,
    "preview_rows": q_preview_rows,
    "calendar_parts": q_calendar_parts,
    "hour_label": q_hour_label,
    "time_range_filter": q_time_range_filter,
    "ingest_partitions": q_ingest_partitions,
    "cast_numeric": q_cast_numeric,
    "apply_mapping": q_apply_mapping,
    "remove_null_rows": q_remove_null_rows,
    "drop_null_fields": q_drop_null_fields,
    "drop_fields": q_drop_fields,
    "parse_records": q_parse_records,
    "with_record_ts": q_with_record_ts,
    "with_processing_time": q_with_processing_time,
    "operator_metrics": q_operator_metrics,
    "operator_metrics_weighted": q_operator_metrics_weighted,
    "hourly_metrics": q_hourly_metrics,
    "postal_code_status": q_postal_code_status,
    "summary_cards": q_summary_cards,
    "pivot_status": q_pivot_status,
    "distinct_status": q_distinct_status,
    "operator_metrics_order": q_operator_metrics_order,
    "postal_code_status_order": q_postal_code_status_order,
    "hourly_metrics_order": q_hourly_metrics_order,
    "operator_metrics_reference_range": q_operator_metrics_reference_range,
    "lake_operator_metrics": q_lake_operator_metrics,
    "lake_hourly_metrics": q_lake_hourly_metrics,
    "lake_postal_code_status": q_lake_postal_code_status,
    "lake_summary_cards": q_lake_summary_cards,
    "lake_pivot_status": q_lake_pivot_status,
    "lake_distinct_status": q_lake_distinct_status,
    "scan_kpi_table": q_scan_kpi_table,
    "batch_raw_sink": q_batch_raw_sink,
    "batch_kpi_sink": q_batch_kpi_sink,
    "register_tables": q_register_tables,
    "compacted_kpi_table": q_compacted_kpi_table,
    "write_result": q_write_result,
    "replay_records": q_replay_records,
    "replay_first_n": q_replay_first_n,
    "scan_csv_null_token": q_scan_csv_null_token,
    "microbatch_kpis": q_microbatch_kpis,
    "stream_restart": q_stream_restart,
    "stream_kpi_append": q_stream_kpi_append,
    "stream_kpi_update": q_stream_kpi_update,
    "stream_raw_sink": q_stream_raw_sink,
    "stream_source": q_stream_source,
    "stream_source_earliest": q_stream_source_earliest,
    "stream_inferred_schema": q_stream_inferred_schema,
    "late_data_drop": q_late_data_drop,
    "late_records": q_late_records,
    "ledger_operator_windows": q_ledger_operator_windows,
    "ledger_status_windows": q_ledger_status_windows,
    "ledger_open_windows": q_ledger_open_windows,
    "committed_kpis": q_committed_kpis,
    "rollup_dashboard": q_rollup_dashboard,
    "window_blank_kpis": q_window_blank_kpis,
}
