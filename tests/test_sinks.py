"""Lake writes: idempotent batches, CSV null token, table registration."""

import os

from towerlens.plans.microbatch import MicroBatchWriter
from pyspark.sql import functions as F

from towerlens.schema import AVERAGE_BY_OPERATOR_SCHEMA, STATUS_BY_POSTAL_CODE_SCHEMA, WIRE_SCHEMA
from towerlens.session import new_run_dir
from towerlens.sinks.lake import register_tables
from towerlens.sources.events import wire_measurements
from towerlens.sources.files import read_lake_table, scan_csv


def test_replayed_batch_does_not_duplicate(spark, sf_small):
    out = new_run_dir(spark, "test_replay")
    w = MicroBatchWriter(out, "t")
    wire = wire_measurements(spark, sf_small)
    w(wire, 0)
    first = spark.read.parquet(w.paths()["raw"]).count()
    w(wire, 0)
    assert spark.read.parquet(w.paths()["raw"]).count() == first == wire.count()
    w(wire, 1)
    assert spark.read.parquet(w.paths()["raw"]).count() == 2 * first


def test_empty_batch_writes_nothing(spark, sf_small):
    out = new_run_dir(spark, "test_empty")
    w = MicroBatchWriter(out, "t")
    w(wire_measurements(spark, sf_small).limit(0), 0)
    assert not os.path.exists(w.paths()["raw"])


def test_csv_null_token_rules(spark):
    path = new_run_dir(spark, "test_csv")
    os.makedirs(path)
    with open(f"{path}/a.csv", "w") as fh:
        fh.write("operator,network,postal_code\nempty_values,,\"\"\nx,\"08014\",08014\n")
    rows = scan_csv(spark, path, WIRE_SCHEMA).select("operator", "network", "postal_code").collect()
    assert tuple(rows[0]) == (None, None, "")
    assert tuple(rows[1]) == ("x", "08014", "08014")


def test_register_tables_sees_new_partitions(spark, sf_small):
    out = new_run_dir(spark, "test_register")
    w = MicroBatchWriter(out, "t")
    w(wire_measurements(spark, sf_small), 0)
    db = "tl_test_" + os.path.basename(out).split("-")[-1]
    tables = {"average_by_operator": (w.paths()["average_by_operator"], AVERAGE_BY_OPERATOR_SCHEMA)}
    register_tables(spark, db, tables, database_location=f"{out}/_catalog")
    n1 = spark.table(f"{db}.average_by_operator").count()
    w(wire_measurements(spark, sf_small), 1)
    register_tables(spark, db, tables, database_location=f"{out}/_catalog")
    assert spark.table(f"{db}.average_by_operator").count() == 2 * n1
    direct = read_lake_table(spark, w.paths()["average_by_operator"], AVERAGE_BY_OPERATOR_SCHEMA)
    assert direct.count() == 2 * n1
    assert dict(direct.dtypes)["ingest_month"] == "string"


def test_batch_partitions_added_without_repair(spark, sf_small):
    out = new_run_dir(spark, "test_addpart")
    db = "tl_add_" + os.path.basename(out).split("-")[-1]
    w0 = MicroBatchWriter(out, "t")
    w0(wire_measurements(spark, sf_small).limit(0), 0)  # nothing written, nothing registered
    w0(wire_measurements(spark, sf_small), 0)
    register_tables(spark, db, {"average_by_operator": (w0.paths()["average_by_operator"],
                                                        AVERAGE_BY_OPERATOR_SCHEMA)},
                    database_location=f"{out}/_catalog")
    n0 = spark.table(f"{db}.average_by_operator").count()
    w = MicroBatchWriter(out, "t", catalog={"average_by_operator": f"{db}.average_by_operator"})
    w(wire_measurements(spark, sf_small), 1)
    assert spark.table(f"{db}.average_by_operator").count() == 2 * n0
    w(wire_measurements(spark, sf_small), 1)  # replay: same partitions, same rows
    assert spark.table(f"{db}.average_by_operator").count() == 2 * n0


def test_replay_first_n_in_file_order(spark):
    from towerlens.operators.parse import encode_records, parse_records
    from towerlens.sinks.lake import publish_records

    src = new_run_dir(spark, "test_first_n")
    os.makedirs(src)
    with open(f"{src}/a.csv", "w") as fh:
        fh.write("operator,network\n" + "".join(f"op{i},net_{i % 3}\n" for i in range(50)))
    rows = scan_csv(spark, src, WIRE_SCHEMA)
    out = new_run_dir(spark, "test_first_n_out")
    numbered = rows.withColumn("n", F.substring("operator", 3, 9).cast("int"))
    publish_records(encode_records(numbered), fmt="json", path=out, limit=7, order=["n"])
    back = parse_records(spark.read.schema("key string, value string").json(out))
    assert sorted(r.operator for r in back.collect()) == sorted(f"op{i}" for i in range(7))
    publish_records(encode_records(rows), fmt="json", path=f"{out}-any", limit=7)
    assert spark.read.json(f"{out}-any").count() == 7


def test_compaction_hides_nothing(spark, sf_small):
    """Late batches in compacted hours are read, each once, before and after the next compaction."""
    from towerlens.sinks.lake import compact_hours, read_compacted

    out = new_run_dir(spark, "test_compact")
    w = MicroBatchWriter(out, "t", raw=False)
    wire = wire_measurements(spark, sf_small)
    live_path, comp = w.paths()["average_by_operator"], f"{out}/average_by_operator_compacted"
    until = "2024-01-20 00:00:00"

    def check():
        live = read_lake_table(spark, live_path, AVERAGE_BY_OPERATOR_SCHEMA)
        both = read_compacted(spark, live_path, comp, AVERAGE_BY_OPERATOR_SCHEMA)
        cols = sorted(live.columns)
        assert sorted(map(str, both.select(cols).collect())) == sorted(map(str, live.select(cols).collect()))

    w(wire.filter("record_id % 3 = 0"), 0)
    w(wire.filter("record_id % 3 = 1"), 1)
    compact_hours(spark, live_path, comp, AVERAGE_BY_OPERATOR_SCHEMA, until)
    check()
    w(wire.filter("record_id % 3 = 2"), 2)  # also into hours that are compacted
    check()
    compact_hours(spark, live_path, comp, AVERAGE_BY_OPERATOR_SCHEMA, until)
    check()
    for root, _, files in os.walk(comp):
        data = [f for f in files if f.endswith(".parquet")]
        assert len(data) <= 1, root


def test_window_must_divide_an_hour(tmp_path):
    import pytest

    for seconds in (70, 0, -100, 7200):
        with pytest.raises(ValueError):
            MicroBatchWriter(str(tmp_path), "t", window_seconds=seconds)


def test_fallback_keys_differ_by_record(spark):
    from towerlens.operators.parse import encode_records

    rows = spark.createDataFrame([(None, "a")] * 40 + [("", "a")] * 40 + [("net_1", "a")],
                                 "network string, operator string").repartition(3)
    keys = [r.key for r in encode_records(rows).collect()]
    assert keys.count("net_1") == 1 and len(set(keys)) > 70
    assert all("E" not in k and float(k) > 1.6e9 for k in keys if k != "net_1")


def test_null_time_has_the_writers_partition(spark, sf_small):
    from towerlens.sinks.lake import add_batch_partitions

    out = new_run_dir(spark, "test_null_time")
    db = "tl_null_" + os.path.basename(out).split("-")[-1]
    wire = wire_measurements(spark, sf_small).limit(20)
    w = MicroBatchWriter(out, "t")
    w(wire.withColumn("record_ts", F.lit(None).cast("timestamp_ntz")), 0)
    register_tables(spark, db, {"status_by_postal_code": (w.paths()["status_by_postal_code"], STATUS_BY_POSTAL_CODE_SCHEMA)},
                    database_location=f"{out}/_catalog")
    n = spark.table(f"{db}.status_by_postal_code").count()
    assert n > 0
    add_batch_partitions(spark, f"{db}.status_by_postal_code", "t-batch-0", [(None, None, None, None)])
    assert spark.table(f"{db}.status_by_postal_code").count() == n


def test_shared_folder_is_needed_on_a_cluster():
    import pytest

    from towerlens.session import shared_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        Context.master = master
        with pytest.raises(RuntimeError):
            shared_dir(Session())
