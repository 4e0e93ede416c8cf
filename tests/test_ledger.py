"""Commit records, the event-time ledger with its late records, and blank fields by window."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from towerlens.operators import clean, serving
from towerlens.operators.kpis import average_by_operator
from towerlens.operators.parse import type_records as typed
from towerlens.plans import catalog, microbatch
from towerlens.plans.microbatch import MicroBatchWriter, clean_records, clean_records_by_window, kpi_frames
from towerlens.schema import AVERAGE_BY_OPERATOR_SCHEMA, BATCH_KEY, PAYLOAD_FIELDS, RECORD_TS, STATUS_BY_POSTAL_CODE_SCHEMA
from towerlens.session import new_run_dir
from towerlens.sinks.commits import CommitLog, committed, read_commits, snapshot
from towerlens.sources.events import wire_measurements
from towerlens.sources.files import read_lake_table
from towerlens.streaming import jobs, ledger

T0 = dt.datetime(2024, 1, 1)


def records(spark, rows):
    """Wire records (record_id, minute, operator, signal); the other fields have a text."""
    cols = {f: F.lit("x") for f in PAYLOAD_FIELDS} | {"operator": F.col("op"), "signal": F.col("sig"),
                                                      "precission": F.lit("1.5"), "status": F.lit("1")}
    frame = spark.createDataFrame([(i, T0 + dt.timedelta(minutes=m), op, sig) for i, m, op, sig in rows],
                                  "record_id long, at timestamp_ntz, op string, sig string")
    return frame.select(*[cols[f].alias(f) for f in PAYLOAD_FIELDS], F.col("at").alias(RECORD_TS), "record_id")


def tables(spark, writer):
    return [read_lake_table(spark, writer.paths()[n], s) for n, s in (
        ("average_by_operator", AVERAGE_BY_OPERATOR_SCHEMA), ("status_by_postal_code", STATUS_BY_POSTAL_CODE_SCHEMA))]


# commit records

def test_a_batch_killed_between_two_tables_is_in_none(spark, monkeypatch):
    out = new_run_dir(spark, "t_kill")
    writer = MicroBatchWriter(out, "t")
    first, second = (records(spark, [(i, 10 * k, "a", "5") for i in range(3)]) for k in (1, 2))
    assert snapshot(spark, out) == -1 and read_commits(spark, out).count() == 0
    writer(first, 0)
    real, calls = microbatch.write_batch_table, []

    def dies(df, path, *args, **kw):
        calls.append(path)
        if path.endswith("status_by_postal_code"):
            raise RuntimeError("executor lost")
        real(df, path, *args, **kw)

    monkeypatch.setattr(microbatch, "write_batch_table", dies)
    with pytest.raises(RuntimeError):
        writer(second, 1)
    avg, status = tables(spark, writer)
    assert avg.count() == 2 and status.count() == 1  # by folder: half a batch
    assert [committed(t, out).count() for t in (avg, status)] == [1, 1]
    assert committed(spark.read.parquet(writer.paths()["raw"]), out).count() == 3
    monkeypatch.setattr(microbatch, "write_batch_table", real)
    MicroBatchWriter(out, "t")(second, 1)  # the replay after a restart
    avg, status = tables(spark, writer)
    assert [committed(t, out).count() for t in (avg, status)] == [2, 2]
    assert [committed(t, out, 0).count() for t in (avg, status)] == [1, 1]  # an older snapshot
    assert snapshot(spark, out) == 1


def test_replays_keep_their_number_and_their_past(spark):
    out = new_run_dir(spark, "t_log")
    times = [T0.replace(tzinfo=dt.timezone.utc) + dt.timedelta(hours=h) for h in (5, 3, 9)]
    log = CommitLog(out)
    for n, t in enumerate(times):
        assert log.past(spark, f"k-{n}")[0] == n
        log.commit(spark, f"k-{n}", 10, last_ts=t)
    for again in (log, CommitLog(out)):  # in the same process, and after a restart
        seq, newest = again.past(spark, "k-2")
        assert (seq, newest) == (2, times[0])
        again.commit(spark, "k-2", 10, last_ts=times[2])
        assert again.past(spark, "k-3") == (3, times[2])
    rows = read_commits(spark, out).orderBy("seq").collect()
    assert [(r.seq, r[BATCH_KEY]) for r in rows] == [(0, "k-0"), (1, "k-1"), (2, "k-2")]


# late records

def run_ledger(spark, out, batches, **kw):
    job = ledger.EventTimeLedger(out, "t", 600, 60, shape=typed, **kw)
    for epoch, rows in batches:
        job(records(spark, rows), epoch)
    return job


def finals(spark, out):
    return sorted((r.window_start.minute, r.operator, r.n_records, r.avg_signal_strength)
                  for r in ledger.final_windows(spark, out, "operator_hourly").collect())


BATCHES = [(0, [(1, 1, "a", "10"), (2, 2, "b", "20"), (3, 3, "a", "30")]), (1, [(4, 12, "a", "1"), (5, 9, "a", "2")]),
           (2, [(6, 25, "b", "7"), (7, 8, "a", "100")]), (3, [(8, 5, "a", "9"), (9, 19, None, "9"), (10, 26, "b", "3")])]


def test_late_records_are_kept_whole(spark):
    """Windows of 10 minutes, delay 1 minute: the watermark is 0:02, 0:11, 0:24 after the batches."""
    out = new_run_dir(spark, "t_ledger")
    run_ledger(spark, out, BATCHES)
    late = ledger.late_records(spark, out).orderBy("record_id").collect()
    # 7 came when the watermark was 0:11; 8 and 9 when it was 0:24: input rows with all their fields
    assert [(r.record_id, r.watermark.minute, r.window_end.minute, r.network) for r in late] == [
        (7, 11, 10, "x"), (8, 24, 10, "x"), (9, 24, 20, "x")]
    assert [(r.n_rows, r.n_late) for r in read_commits(spark, out).orderBy("seq").collect()] == [
        (3, 0), (2, 0), (2, 1), (3, 2)]
    # 5 was behind newer records, but its window was open
    assert finals(spark, out) == [(0, "a", 3, 14.0), (0, "b", 1, 20.0), (10, "a", 1, 1.0)]
    opened = ledger.open_windows(spark, out, "operator_hourly").collect()
    assert [(r.window_start.minute, r.operator, r.n_records) for r in opened] == [(20, "b", 2)]


@pytest.mark.parametrize("dies_at", ["late", "operator_hourly_parts", "network_status_parts", "operator_hourly", "commits"])
def test_a_killed_batch_is_replayed_once(spark, dies_at, monkeypatch):
    """Killed at any of its writes and replayed by a new process: as if nothing had happened."""
    want, out = new_run_dir(spark, "t_want"), new_run_dir(spark, "t_dies")
    run_ledger(spark, want, BATCHES)
    run_ledger(spark, out, BATCHES[:2])
    real = ledger.replace_leaves

    def dies(df, path, key, by):
        if path.endswith("/" + dies_at):
            raise RuntimeError("executor lost")
        real(df, path, key, by)

    monkeypatch.setattr(ledger, "replace_leaves", dies)
    if dies_at == "commits":
        monkeypatch.setattr(CommitLog, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("executor lost")))
    with pytest.raises(RuntimeError):
        run_ledger(spark, out, BATCHES[2:3])
    assert read_commits(spark, out).count() == 2
    monkeypatch.undo()
    run_ledger(spark, out, BATCHES[2:])
    assert finals(spark, out) == finals(spark, want)
    assert [sorted(r.record_id for r in ledger.late_records(spark, o).collect()) for o in (out, want)] == [[7, 8, 9]] * 2


def test_batches_may_be_cut_anywhere(spark):
    """Time-ordered records: the windows do not depend on where batches end."""
    rows = [(i, i // 3, "ab"[i % 2], str(i)) for i in range(120)]
    out = [new_run_dir(spark, "t_cut") for _ in range(2)]
    run_ledger(spark, out[0], [(0, rows)])
    run_ledger(spark, out[1], [(k, rows[at:at + 37]) for k, at in enumerate(range(0, 120, 37))])
    assert finals(spark, out[0]) == finals(spark, out[1]) and len(finals(spark, out[0])) == 6


def test_empty_batches_and_records_without_a_time(spark):
    out = new_run_dir(spark, "t_none")
    job = run_ledger(spark, out, BATCHES[:2])
    job(records(spark, [(1, 1, "a", "1")]).where("false"), 2)
    job(records(spark, [(99, 1, "a", "1")]).withColumn(RECORD_TS, F.lit(None).cast("timestamp_ntz")), 3)
    assert read_commits(spark, out).count() == 4
    assert finals(spark, out) == [(0, "a", 3, 14.0), (0, "b", 1, 20.0)]
    raw = spark.read.parquet(f"{out}/raw")
    assert raw.where("record_id = 99").count() == 1 and raw.count() == 6


def test_only_closing_hours_are_read_again(spark):
    out = new_run_dir(spark, "t_prune")
    run_ledger(spark, out, BATCHES)
    low, high = T0, T0 + dt.timedelta(hours=1)
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = (ledger.read_parts(spark, out, "operator_hourly").where(ledger.between_hours(low, high))
            ._jdf.queryExecution().executedPlan().toString())
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = plan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    assert "window_year" in filters and "window_hour" in filters


def test_ledger_matches_the_stateful_aggregate(spark, sf_small, tmp_path):
    """The engine's windows in append mode, record for record."""
    ev = wire_measurements(spark, sf_small)
    ts = F.col(RECORD_TS)
    ev = ev.where(ts < F.lit("2024-01-04").cast("timestamp_ntz"))
    cuts = [ts < F.lit("2024-01-02").cast("timestamp_ntz"), ts >= F.lit("2024-01-02").cast("timestamp_ntz")]
    out = new_run_dir(spark, "t_engine")
    for k, cut in enumerate(cuts):
        ev.where(cut).write.mode("append").parquet(f"{out}/stage")
        s = spark.readStream.schema(ev.schema).parquet(f"{out}/stage")
        job = ledger.EventTimeLedger(out, "t", 3600, 60, shape=typed, raw=False)
        q = ledger.start_ledger_job(s, job, f"{out}/_ck", available_now=True)
        q.awaitTermination()
        assert q.exception() is None
        kpis = jobs.event_time_operator_kpis(typed(s).withColumn(RECORD_TS, ts.cast("timestamp")))
        q = jobs.start_event_time_sink(kpis, f"{out}/engine", f"{out}/_ck2", available_now=True)
        q.awaitTermination()
        assert q.exception() is None
    cols = ["window_start", "window_end", "operator", "n_records", F.round("avg_signal_strength", 9), F.round("avg_gps_precision", 9)]
    mine = ledger.final_windows(spark, out, "operator_hourly").select(
        *[F.col(c).cast("timestamp_ntz") if isinstance(c, str) and c.startswith("window") else c for c in cols])
    assert sorted(map(str, map(tuple, mine.collect()))) == sorted(
        map(str, map(tuple, spark.read.parquet(f"{out}/engine").select(*cols).collect())))


# window-hour sink

def test_a_batch_writes_one_file_an_hour(spark, sf_small):
    out = new_run_dir(spark, "t_files")
    ev = wire_measurements(spark, sf_small).where("record_ts < timestamp_ntz'2024-01-04 00:00:00'")
    ev.write.parquet(f"{out}/stage")
    s = typed(spark.readStream.schema(ev.schema).parquet(f"{out}/stage")).withColumn(RECORD_TS, F.col(RECORD_TS).cast("timestamp"))
    q = jobs.start_event_time_sink(jobs.event_time_operator_kpis(s, "10 minutes"), f"{out}/data", f"{out}/_ck", available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    files = [d for d, _, names in os.walk(f"{out}/data") for n in names if n.endswith(".parquet")]
    assert len(files) == len(set(files)) > 30
    assert spark.read.parquet(f"{out}/data").count() > len(files)


# blank fields by window

def test_backfill_decides_as_many_small_batches_did(spark):
    """'null' is the only text of a field in one window: there it is blank, elsewhere it is a text."""
    wire = records(spark, [(1, 1, "null", "1"), (2, 1, " null ", "2"), (3, 4, "null", "3"), (4, 4, "a", "4"),
                           (5, 8, "", "5"), (6, 8, "b", "6"), (7, 20, "c", "7")])
    window = F.floor(F.unix_micros(F.col(RECORD_TS).cast("timestamp")) / 100_000_000)
    small = None
    for w in [r[0] for r in wire.select(window).distinct().collect()]:
        part = average_by_operator(clean_records(wire.where(window == w)))
        small = part if small is None else small.unionByName(part)
    key = ["operator", "sum_signal", "n_signal"]
    whole = kpi_frames(clean_records_by_window(wire))[0]
    rows = sorted(map(str, whole.select(key).collect()))
    assert rows == sorted(map(str, small.select(key).collect()))
    assert "operator=None" in rows[1] + rows[0] + rows[-1]
    one = sorted(map(str, kpi_frames(clean_records(wire))[0].select(key).collect()))
    assert rows != one  # decided for the batch as a whole
    out = new_run_dir(spark, "t_blank")
    writer = MicroBatchWriter(out, "t", raw=False, blank_by_window=True)
    writer(wire, 0)
    assert sorted(map(str, tables(spark, writer)[0].select(key).collect())) == rows


def test_blank_flags_of_null_keys_and_odd_names(spark):
    df = spark.createDataFrame([(None, "null", -1, "x"), (None, "", -1, None), (1, "null", -1, "x"), (1, "v", 2, "")],
                               "`my key` int, `a.b` string, `n n` int, c string")
    got = clean.clear_null_fields_by(df, ["my key"])
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(None, None, None, "x"), (None, None, None, None), (1, "null", -1, "x"), (1, "v", 2, "")], key=str)
    assert clean.clear_null_fields_by(df.select("my key"), ["my key"]).count() == 4


# pivot

def test_pivot_reads_its_source_once(spark, sf_small):
    _, status = kpi_frames(clean_records(wire_measurements(spark, sf_small)))
    counts = serving.postal_code_status(status, "2024-01-31 00:00:00", "7 days", ordered=False)
    out = serving.pivot_status(counts)
    assert "FileScan" not in out._jdf.queryExecution().executedPlan().toString()  # columns come from the kept maps
    given = serving.pivot_status(counts, out.columns[1:])
    assert given._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, given.collect()))
    total = counts.agg(F.sum("status_count")).first()[0]
    assert sum(sum(r[1:]) for r in out.collect()) == total


def test_pivot_fails_rather_than_cuts(spark):
    many = spark.range(30).selectExpr("'p' AS postal_code", "cast(id AS string) AS status_description", "1L AS status_count")
    spark.conf.set("spark.sql.pivotMaxValues", "20")
    try:
        with pytest.raises(ValueError):
            serving.pivot_status(many)
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")
    assert len(serving.pivot_status(many).columns) == 31


# what a large batch costs

def test_an_arriving_batch_is_dealt_over_files_of_bounded_length(spark, tmp_path, monkeypatch):
    """One long row group of the table was one task of each batch."""
    base = dt.datetime(2024, 1, 1)
    rows = [(i, base + dt.timedelta(minutes=17 * i), i % 7, "abc"[i % 3], i / 4, f'{{"k": {i % 9}}}') for i in range(400)]
    ev = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    ev.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    found = []
    for limit in (10_000, 25):
        monkeypatch.setattr(catalog, "STAGE_ROWS", limit)
        out = catalog._ledger(spark, str(tmp_path), "t_stage_rows")
        staged = spark.read.parquet(f"{out}/stage").groupBy(F.input_file_name()).count()
        assert staged.agg(F.max("count")).first()[0] <= limit
        found.append([sorted(map(str, t.collect())) for t in (
            ledger.late_records(spark, out).drop("watermark"), ledger.open_windows(spark, out, "operator_hourly", 3600),
            ledger.final_windows(spark, out, "operator_hourly"))])
    assert found[0] == found[1] and all(found[0])


def test_the_text_of_an_event_is_parsed_once(spark, sf_small):
    wire = wire_measurements(spark, sf_small)
    plan = wire._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("get_json_object") == 1
