"""Structured Streaming: stream = batch, restart, late data, update mode."""

import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from towerlens.operators.parse import encode_records, parse_records, type_records
from towerlens.plans.microbatch import clean_records, kpi_frames
from towerlens.schema import AVERAGE_BY_OPERATOR_SCHEMA, RECORD_TS
from towerlens.session import new_run_dir
from towerlens.sources.events import load_table, wire_from_events, wire_measurements
from towerlens.sources.files import read_lake_table
from towerlens.sources.stream import stream_source
from towerlens.streaming import jobs


def _events_stream(spark, sf):
    ev = load_table(spark, sf, "events")
    return stream_source(spark, sf, fmt="parquet", schema=ev.schema,
                         options={"pathGlobFilter": "events.parquet"}, ts_col="ts")


def _run(q):
    q.awaitTermination()
    assert q.exception() is None


def test_microbatch_stream_equals_batch_and_restart_is_noop(spark, sf_small):
    out = new_run_dir(spark, "t_mb")
    ckpt = f"{out}/_ck"
    stream = wire_from_events(_events_stream(spark, sf_small).drop(RECORD_TS))
    q, writer = jobs.start_microbatch_job(stream, out, ckpt, available_now=True)
    _run(q)
    table = read_lake_table(spark, writer.paths()["average_by_operator"], AVERAGE_BY_OPERATOR_SCHEMA)
    n = table.count()
    batch_avg, _ = kpi_frames(clean_records(wire_measurements(spark, sf_small)))
    cols = ["batch_window", "operator", "n_signal", "sum_signal"]
    assert sorted(map(str, table.select(cols).collect())) == \
        sorted(map(str, batch_avg.select(cols).collect()))
    q2, _ = jobs.start_microbatch_job(
        wire_from_events(_events_stream(spark, sf_small).drop(RECORD_TS)), out, ckpt,
        available_now=True)
    _run(q2)
    assert read_lake_table(spark, writer.paths()["average_by_operator"],
                           AVERAGE_BY_OPERATOR_SCHEMA).count() == n


def _typed_stream_from(spark, stage, schema):
    s = stream_source(spark, stage, fmt="json", schema=schema, ts_col="ts")
    typed = type_records(parse_records(s.drop("ts")))
    return typed


def test_late_file_dropped_and_counted(spark):
    """10-minute windows, delay 1 min; files at 00:0x, 00:1x, 00:2x, then 00:0x again."""
    out = new_run_dir(spark, "t_late")
    stage, ckpt, data = f"{out}/stage", f"{out}/_ck", f"{out}/data"
    os.makedirs(stage)
    schema = T.StructType([T.StructField("ts", T.StringType()), T.StructField("value", T.StringType())])

    def put(name, minute_base):
        with open(f"{stage}/{name}.json", "w") as fh:
            for i, op in enumerate(["a", "b", "a"]):
                rec = {"operator": op, "signal": str(10 + i), "precission": "1.0"}
                fh.write(json.dumps({"ts": f"2024-01-01 00:{minute_base + i:02d}:00",
                                     "value": json.dumps(rec)}) + "\n")

    from towerlens.streaming.listener import LateRowsListener

    listener = LateRowsListener()
    spark.streams.addListener(listener)
    try:
        for name, base in [("f1", 0), ("f2", 10), ("f3", 20), ("f4", 1)]:
            put(name, base)
            kpi = jobs.event_time_operator_kpis(_typed_stream_from(spark, stage, schema),
                                                "10 minutes", "1 minute")
            q = jobs.start_event_time_sink(kpi, data, ckpt, available_now=True, name="late_test")
            _run(q)
        import time
        for _ in range(50):  # listener events arrive asynchronously
            if listener.dropped.get("late_test", 0) >= 2:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert listener.dropped.get("late_test") == 2
    rows = spark.read.parquet(data).orderBy("window_start", "operator").collect()
    got = [(str(r.window_start), r.operator, r.n_records) for r in rows]
    # the window 00:20 is still open; the late file changed nothing
    assert got == [("2024-01-01 00:00:00", "a", 2), ("2024-01-01 00:00:00", "b", 1),
                   ("2024-01-01 00:10:00", "a", 2), ("2024-01-01 00:10:00", "b", 1)]
    assert [n for _, _, n in listener.log] == [2]  # partial groups (a, b), not 3 rows


def test_update_mode_latest_value_per_group(spark):
    out = new_run_dir(spark, "t_upd")
    stage, ckpt, data = f"{out}/stage", f"{out}/_ck", f"{out}/data"
    os.makedirs(stage)
    schema = T.StructType([T.StructField("ts", T.StringType()), T.StructField("value", T.StringType())])
    for n, (name, minute) in enumerate([("f1", 1), ("f2", 2)]):
        with open(f"{stage}/{name}.json", "w") as fh:
            rec = {"postal_code": "08001", "description": "ok", "status": "1"}
            fh.write(json.dumps({"ts": f"2024-01-01 00:{minute:02d}:00", "value": json.dumps(rec)}) + "\n")
        kpi = jobs.event_time_status_counts(_typed_stream_from(spark, stage, schema), "1 hour", "1 minute")
        _run(jobs.start_update_sink(kpi, data, ckpt, available_now=True))
        latest = jobs.read_latest_updates(spark, data, ["window_start", "window_end", "postal_code",
                                                        "description"]).collect()
        assert [r.status_count for r in latest] == [n + 1]


def test_latest_start_skips_older_records(spark, sf_small):
    ev = load_table(spark, sf_small, "events")
    s = stream_source(spark, sf_small, fmt="parquet", schema=ev.schema,
                      options={"pathGlobFilter": "events.parquet"}, ts_col="ts",
                      starting="latest", start_ts="2024-01-15 00:00:00")
    out = new_run_dir(spark, "t_latest")
    q = (s.writeStream.format("parquet").option("path", f"{out}/d")
         .option("checkpointLocation", f"{out}/c").trigger(availableNow=True).start())
    _run(q)
    got = spark.read.parquet(f"{out}/d").count()
    assert got == ev.filter(F.col("ts") >= F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")).count()
    assert 0 < got < ev.count()


def test_replay_to_stream_roundtrip(spark, sf_small):
    wire = wire_measurements(spark, sf_small)
    enc = encode_records(wire)
    back = parse_records(enc.select("value"))
    assert back.filter(F.col("_corrupt").isNotNull()).count() == 0
    assert back.count() == wire.count()


def test_runners_on_replayed_json(spark, sf_small):
    from towerlens.sinks.lake import publish_records
    from towerlens.streaming import runner

    out = new_run_dir(spark, "t_runner")
    stage = f"{out}/stage"
    wire = wire_measurements(spark, sf_small)
    publish_records(encode_records(wire), fmt="json", path=stage)
    with open(f"{stage}/bad.json", "w") as fh:
        fh.write('{"key": "k", "value": "not json"}\n')
    parsed = runner.parsed_stream(spark, "json", stage, {})
    live = runner.start_live_job(spark, parsed, f"{out}/live", available_now=True)
    runner.await_all(spark, live, available_now=True)
    assert all(not q.isActive and q.exception() is None for q in live)
    assert spark.read.parquet(f"{out}/live/raw").count() == wire.count()
    assert spark.read.parquet(f"{out}/live/dead_letter").count() == 1
    hourly = runner.start_hourly_job(spark, runner.parsed_stream(spark, "json", stage, {}),
                                     f"{out}/hourly", available_now=True)
    runner.await_all(spark, hourly, available_now=True)
    assert spark.read.parquet(f"{out}/hourly/raw").count() == wire.count()
    assert spark.read.parquet(f"{out}/hourly/dead_letter").count() == 1
    assert len(live) == 1 and len(hourly) == 1  # reads of the source
    plan = hourly[0]._jsq.streamingQuery().lastExecution().toString()
    assert plan.count("FileScan json") == 1
    # a second run of each job has nothing to do
    runner.await_all(spark, runner.start_live_job(spark, parsed, f"{out}/live", available_now=True), available_now=True)
    assert spark.read.parquet(f"{out}/live/raw").count() == wire.count()


def test_recreated_checkpoint_keeps_older_batches(spark, sf_small):
    """A checkpoint that is lost and begun anew at its old path: batch 0 again, another query id."""
    import shutil

    out = new_run_dir(spark, "t_lost")
    ev = load_table(spark, sf_small, "events")
    for part, name in ((F.col("event_id") % 2 == 0, "a"), (F.col("event_id") % 2 == 1, "b")):
        ev.filter(part).write.parquet(f"{out}/stage-{name}")
        s = stream_source(spark, f"{out}/stage-{name}", fmt="parquet", schema=ev.schema, ts_col="ts")
        q, writer = jobs.start_microbatch_job(wire_from_events(s.drop(RECORD_TS)), out, f"{out}/_ck", available_now=True)
        _run(q)
        shutil.rmtree(f"{out}/_ck")
    assert spark.read.parquet(writer.paths()["raw"]).count() == ev.count()


def test_latest_update_of_the_newest_query(spark):
    """Seven batches of one query, then a new checkpoint: its first batch is the newest."""
    out = new_run_dir(spark, "t_upd2")
    schema = T.StructType([T.StructField("ts", T.StringType()), T.StructField("value", T.StringType())])
    keys = ["window_start", "window_end", "postal_code", "description"]

    def put(stage, name, n):
        os.makedirs(stage, exist_ok=True)
        with open(f"{stage}/{name}.json", "w") as fh:
            for i in range(n):
                rec = {"postal_code": "08001", "description": "ok", "status": "1"}
                fh.write(json.dumps({"ts": f"2024-01-01 00:{i:02d}:00", "value": json.dumps(rec)}) + "\n")

    for stage, files in (("a", [1, 1, 1]), ("b", [9])):
        for k, n in enumerate(files):
            put(f"{out}/{stage}", f"f{k}", n)
            kpi = jobs.event_time_status_counts(_typed_stream_from(spark, f"{out}/{stage}", schema), "1 hour", "1 minute")
            _run(jobs.start_update_sink(kpi, f"{out}/data", f"{out}/_ck-{stage}", available_now=True))
    latest = jobs.read_latest_updates(spark, f"{out}/data", keys).collect()
    assert [r.status_count for r in latest] == [9]
    jobs.compact_updates(spark, f"{out}/data", f"{out}/compacted", keys)
    again = jobs.read_latest_updates(spark, f"{out}/data", keys, compacted=f"{out}/compacted").collect()
    assert [r.status_count for r in again] == [9]
    assert spark.read.parquet(f"{out}/compacted").count() == 1


def test_latest_start_is_fixed_and_survives_a_restart(spark):
    """A record that arrives after the start and is read later is kept; older ones are not."""
    import datetime as dt

    import pytest

    out = new_run_dir(spark, "t_start")
    schema = T.StructType([T.StructField("at", T.TimestampType()), T.StructField("n", T.IntegerType())])

    def put(n, seconds):
        at = dt.datetime.now(dt.timezone.utc) + dt.timedelta(seconds=seconds)
        spark.createDataFrame([(at, n)], schema).write.mode("append").parquet(f"{out}/stage")

    def run():
        s = stream_source(spark, f"{out}/stage", fmt="parquet", schema=schema, ts_col="at", starting="latest",
                          bookmark=f"{out}/start")
        _run(s.writeStream.format("parquet").option("path", f"{out}/d").option("checkpointLocation", f"{out}/c")
             .trigger(availableNow=True).start())
        return sorted(r.n for r in spark.read.schema("n int").parquet(f"{out}/d").collect())

    put(1, -3600)
    assert run() == []
    put(2, 0)
    assert run() == [2]
    put(3, 0)
    assert run() == [2, 3]
    with pytest.raises(ValueError):
        stream_source(spark, f"{out}/stage", fmt="parquet", schema=schema, starting="latest")


def test_live_job_extends_the_catalog(spark, sf_small):
    from towerlens.sinks.lake import publish_records
    from towerlens.streaming import runner

    out = new_run_dir(spark, "t_catalog")
    db = "tl_live_" + os.path.basename(out).split("-")[-1]
    publish_records(encode_records(wire_measurements(spark, sf_small)), fmt="json", path=f"{out}/stage")
    catalog = runner.kpi_catalog(spark, db, out)
    runner.await_all(spark, runner.start_live_job(spark, runner.parsed_stream(spark, "json", f"{out}/stage", {}), out,
                                                  available_now=True, catalog=catalog), available_now=True)
    table = spark.table(f"{db}.average_by_operator")
    assert table.count() == read_lake_table(spark, f"{out}/average_by_operator", AVERAGE_BY_OPERATOR_SCHEMA).count() > 0


def test_a_failing_query_stops_the_others(spark):
    """The runner waits for any query to end: an error in one is raised, and the rest are stopped."""
    import pytest
    from pyspark.errors import StreamingQueryException

    from towerlens.streaming import runner

    out = new_run_dir(spark, "t_fails")
    source = spark.readStream.format("rate").option("rowsPerSecond", 5).load()

    def fails(batch, epoch):
        raise RuntimeError("disk full")

    healthy = (source.writeStream.option("checkpointLocation", f"{out}/a").foreachBatch(lambda b, e: None)
               .trigger(processingTime="1 second").start())
    failing = (source.writeStream.option("checkpointLocation", f"{out}/b").foreachBatch(fails)
               .trigger(processingTime="1 second").start())
    with pytest.raises(StreamingQueryException, match="disk full"):
        runner.await_all(spark, [healthy, failing])
    assert not healthy.isActive and not failing.isActive and healthy.exception() is None
    spark.streams.resetTerminated()
