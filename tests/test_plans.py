"""End-to-end plans: dashboard from lake tables, notebook from CSV."""

from towerlens.plans.dashboard import build_dashboard
from towerlens.plans.microbatch import MicroBatchWriter, clean_records, kpi_frames
from towerlens.plans.notebook import notebook_frames
from towerlens.operators import serving
from towerlens.schema import AVERAGE_BY_OPERATOR_SCHEMA, PAYLOAD_FIELDS
from towerlens.session import new_run_dir
from towerlens.sources.events import wire_measurements
from towerlens.sources.files import read_lake_table

AS_OF = "2024-01-31 00:00:00"


def test_dashboard_from_lake_equals_in_memory(spark, sf_small):
    out = new_run_dir(spark, "t_dash")
    w = MicroBatchWriter(out, "t")
    wire = wire_measurements(spark, sf_small)
    w(wire, 0)
    d = build_dashboard(spark, w.paths()["average_by_operator"], w.paths()["status_by_postal_code"],
                        as_of=AS_OF, time_range="7 days")
    try:
        avg, status = kpi_frames(clean_records(wire))
        expect = serving.operator_metrics(avg, AS_OF, "7 days").collect()
        got = d.operator_metrics.collect()
        assert [r.operator for r in got] == [r.operator for r in expect]
        for a, b in zip(got, expect):
            assert abs((a.avg_signal_strength or 0) - (b.avg_signal_strength or 0)) < 1e-9
        # NULL is served as ''
        n_postal = serving.postal_code_status(status, AS_OF, "7 days").na.fill("", ["postal_code"]) \
            .select("postal_code").distinct().count()
        cards = d.summary_cards.first()
        assert cards.operators == len(expect) and cards.postal_codes == n_postal
        piv = d.pivot_status()
        assert piv.count() == n_postal and len(piv.columns) == 1 + d.distinct_status().count()
        assert d.hourly_metrics.count() > 0
    finally:
        d.close()


def test_notebook_frames_from_csv(spark, sf_small):
    path = new_run_dir(spark, "t_nb")
    wire = wire_measurements(spark, sf_small).select(*PAYLOAD_FIELDS)
    wire.write.mode("overwrite").option("header", "true").option("nullValue", "empty_values").csv(path)
    f = notebook_frames(spark, path)
    assert f["row_count"].first().n_rows == wire.count()
    prof = {r.column_name: r.n_distinct for r in f["distinct_profile"].collect()}
    assert prof["operator"] == wire.select("operator").distinct().count()
    assert prof["description"] == wire.select("description").distinct().count()
    named = wire.where("operator IS NOT NULL").select("operator").distinct().count()
    assert f["kpi_operator"].count() == f["kpi_operator_fused"].count() == named
    assert f["status_count"].count() == wire.select("postal_code", "status").distinct().count()
    summary = {r.column_name: r for r in f["describe"].collect()}
    assert len(summary) == 14
    assert summary["satellites"]["count"] == 0  # blank text → NULL after lenient cast
    assert summary["network"].mean is None and summary["network"].max_text == "net_2"
    assert summary["postal_code"].mean > 8000  # digits read as numbers


def test_plans_have_no_full_shuffle_of_raw_rows(spark, sf_small):
    from towerlens.plans.catalog import QUERIES

    for key in ("average_by_operator", "status_by_postal_code", "hourly_metrics", "describe_columns"):
        plan = QUERIES[key](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
        assert "RoundRobinPartitioning" not in plan and "REPARTITION" not in plan


def test_range_reaches_the_scan(spark, sf_small):
    from towerlens.plans.catalog import QUERIES

    plan = QUERIES["hourly_metrics"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-30T00:00)" in plan


def test_lake_queries_prune_hours(spark, sf_small):
    from towerlens.plans.catalog import QUERIES

    for key in ("lake_operator_metrics", "lake_postal_code_status", "lake_hourly_metrics", "lake_summary_cards",
                "lake_distinct_status"):
        leaves = QUERIES[key](spark, sf_small)._jdf.queryExecution().sparkPlan().collectLeaves()
        scans = [leaves.apply(i) for i in range(leaves.size())]
        assert scans and all("ingest_hour" in x.partitionFilters().toString() for x in scans), key


def test_merged_windows_do_not_depend_on_the_cut_of_batches(spark, sf_small):
    """A stream cut in the middle of windows serves what one pass serves."""
    from towerlens.schema import AVERAGE_BY_OPERATOR_SCHEMA, RECORD_TS
    from towerlens.sources.files import read_lake_table

    wire = wire_measurements(spark, sf_small)
    out, whole = new_run_dir(spark, "t_cut"), new_run_dir(spark, "t_whole")
    w = MicroBatchWriter(out, "t")
    w(wire.where("pmod(unix_micros(cast(record_ts AS timestamp)), 100000000) < 37000000"), 0)
    w(wire.where("pmod(unix_micros(cast(record_ts AS timestamp)), 100000000) >= 37000000"), 1)
    one = MicroBatchWriter(whole, "t")
    one(wire, 0)
    got, want = (read_lake_table(spark, x.paths()["average_by_operator"], AVERAGE_BY_OPERATOR_SCHEMA) for x in (w, one))
    assert got.count() >= want.count() and RECORD_TS not in got.columns
    for a, b in zip(serving.operator_metrics(got, AS_OF, "7 days").collect(),
                    serving.operator_metrics(want, AS_OF, "7 days").collect()):
        assert a.operator == b.operator and abs((a.avg_signal_strength or 0) - (b.avg_signal_strength or 0)) < 1e-9


def test_lake_queries_read_the_tables_of_now(spark, sf_small, tmp_path):
    """A table replaced at the same path is read by the next query of the session."""
    from towerlens.plans.catalog import QUERIES

    events = spark.read.parquet(f"{sf_small}/events.parquet")
    seen = []
    for part in (events.where("event_id % 2 = 0"), events):
        part.write.mode("overwrite").parquet(f"{tmp_path}/events.parquet")
        seen.append(QUERIES["lake_postal_code_status"](spark, str(tmp_path)).collect())
    assert seen[0] != seen[1]


def test_catalog_tables_list_only_the_hours_of_a_question(spark, sf_small):
    """Partitions come from the catalog: the scan is over the range's leaves, the table's folder is not listed."""
    import re

    from towerlens.streaming.runner import kpi_catalog

    out = new_run_dir(spark, "t_pruned")
    tables = kpi_catalog(spark, "tl_pruned_" + out.rsplit("-", 1)[-1], out)
    wire = wire_measurements(spark, sf_small).where("record_ts < timestamp_ntz'2024-01-04 00:00:00'")
    MicroBatchWriter(out, "t", raw=False, catalog=tables)(wire, 0)
    table = spark.table(tables["average_by_operator"])
    query = serving.operator_metrics(table, "2024-01-04 00:00:00", "1 days")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100")
    plan = query._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    hours = table.where("ingest_day = '03'").select("ingest_hour").distinct().count()
    assert int(re.search(r"InMemoryFileIndex\((\d+) paths\)", plan)[1]) == hours < table.select(
        "ingest_day", "ingest_hour").distinct().count()
    by_path = read_lake_table(spark, f"{out}/average_by_operator", AVERAGE_BY_OPERATOR_SCHEMA)
    assert sorted(map(str, query.collect())) == sorted(
        map(str, serving.operator_metrics(by_path, "2024-01-04 00:00:00", "1 days").collect()))
