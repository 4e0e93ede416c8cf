"""The hourly roll-up against the window tables."""

import pytest
from pyspark.sql import functions as F

from towerlens.operators import serving
from towerlens.plans import rollup
from towerlens.plans.microbatch import MicroBatchWriter, clean_records, kpi_frames
from towerlens.schema import RECORD_TS
from towerlens.session import new_run_dir
from towerlens.sinks.commits import read_commits, snapshot
from towerlens.sources.events import wire_measurements

AS_OF, RANGE = "2024-01-04 00:00:00", "2 days"


@pytest.fixture(scope="module")
def wire(spark, sf_small):
    """Three days of records, so that few folders are written."""
    return wire_measurements(spark, sf_small).where("record_ts < timestamp_ntz'2024-01-04 00:00:00'").cache()


def numbers(df):
    return sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in df.collect())


def results(spark, out, at=None):
    return [rollup.operator_metrics(spark, out, AS_OF, RANGE, at), rollup.operator_metrics_weighted(spark, out, AS_OF, RANGE, at),
            rollup.hourly_metrics(spark, out, AS_OF, RANGE, at).select("operator", "hour", "avg_signal_strength", "avg_precision"),
            rollup.postal_code_status(spark, out, AS_OF, RANGE, at), rollup.summary_cards(spark, out, AS_OF, RANGE, at)]


def plain(wire):
    avg, status = kpi_frames(clean_records(wire))
    ops = serving.operator_metrics(avg, AS_OF, RANGE, ordered=False)
    postal = serving.postal_code_status(status, AS_OF, RANGE, ordered=False)
    return [ops, serving.operator_metrics_weighted(avg, AS_OF, RANGE, ordered=False),
            serving.hourly_metrics(avg, AS_OF, RANGE, ordered=False), postal, serving.summary_cards(ops, postal)]


@pytest.fixture(scope="module")
def rolled(spark, wire):
    """Two batches that share every window, written by two processes."""
    out = new_run_dir(spark, "t_rollup")
    for n in (0, 1):
        MicroBatchWriter(out, "t", raw=False, rollup=True)(wire.where(F.col("record_id") % 2 == n), n)
    return out


def test_rollup_equals_the_windows(spark, wire, rolled):
    for got, want in zip(results(spark, rolled), plain(wire)):
        assert numbers(got) == numbers(want)
    # the first snapshot holds the first batch alone
    for got, want in zip(results(spark, rolled, 0), plain(wire.where("record_id % 2 = 0"))):
        assert numbers(got) == numbers(want)


def test_one_leaf_an_hour_is_read(spark, wire, rolled):
    hours = wire.select(F.date_trunc("hour", RECORD_TS)).distinct().count()
    rows = rollup.read_rollup(spark, rolled, "code_bitmaps")
    assert rows.select("ingest_year", "ingest_month", "ingest_day", "ingest_hour").distinct().count() == rows.select(
        "ingest_year", "ingest_month", "ingest_day", "ingest_hour", "batch_key").distinct().count() <= hours
    commits = read_commits(spark, rolled).orderBy("seq").collect()
    assert all(len(c.hours) <= hours for c in commits) and max(len(c.hours) for c in commits) > hours / 2


def test_replay_and_a_batch_without_commit(spark, wire):
    out = new_run_dir(spark, "t_rollup2")
    parts = [wire.where(F.col("record_id") % 3 == n) for n in range(3)]
    MicroBatchWriter(out, "t", raw=False, rollup=True)(parts[0], 0)
    dies = MicroBatchWriter(out, "t", raw=False, rollup=True)
    dies.log.commit = lambda *a, **k: (_ for _ in ()).throw(RuntimeError("executor lost"))
    with pytest.raises(RuntimeError):
        dies(parts[1], 1)
    assert numbers(results(spark, out)[0]) == numbers(plain(parts[0])[0])  # its leaves are there, but not seen
    for n in (1, 1, 2):  # the replay, a replay after the commit, and the next batch
        MicroBatchWriter(out, "t", raw=False, rollup=True)(parts[n], n)
    assert snapshot(spark, out) == 2
    for got, want in zip(results(spark, out), plain(wire)):
        assert numbers(got) == numbers(want)


def test_codes_are_numbered_once(spark, rolled):
    codes = spark.read.parquet(f"{rolled}/codes")
    assert codes.count() == codes.select("code").distinct().count() == codes.select("number").distinct().count()
    everything = rollup.distinct_codes(spark, rolled, "2024-01-04 00:00:00", "30 days").first().postal_codes
    assert everything == codes.count()
    assert rollup.distinct_codes(spark, rolled, "2030-01-01 00:00:00", "1 hour").first().postal_codes == 0
