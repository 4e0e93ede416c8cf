"""Schema inference over a whole first batch."""

import json

import pytest
from pyspark.sql import types as T

from towerlens.session import new_run_dir
from towerlens.sources import inferred
from towerlens.streaming.jobs import replace_leaves


def texts(spark, *values):
    return spark.createDataFrame([(v if v is None or isinstance(v, str) else json.dumps(v),) for v in values], "value string")


def kind(schema, name):
    return schema[name].dataType.simpleString()


def test_types_merge_over_all_records(spark):
    df = texts(spark, {"a": 1, "c": {"d": 1.5, "n": None}, "my `col": [1, 2]}, {"a": 2.5, "OBJECT<x>": True}, "no json", "[1]",
               None, {"b": 3, "big": 10 ** 30, "arr": [{"k": 1}, {"k": "s"}]}, {"b": "x", "c": {"e": "q"}, "whole": 2 ** 40})
    s = inferred.infer_schema(df.repartition(3))
    assert {f.name: f.dataType.simpleString() for f in s.fields} == {
        "a": "double", "b": "string", "big": "string", "c": "struct<d:double,e:string,n:string>", "my `col": "array<bigint>",
        "OBJECT<x>": "boolean", "arr": "array<struct<k:string>>", "whole": "bigint"}
    rows = {r["_corrupt"]: r for r in inferred.parse_inferred(df, s).collect()}
    assert {"no json", "[1]"} <= set(rows)
    good = [r for r in inferred.parse_inferred(df, s).where("_corrupt IS NULL").collect()]
    assert [r.arr[0].k for r in good if r.arr] == ["1"] and {r.b for r in good} == {None, "3", "x"}


def test_no_record_no_schema(spark):
    assert inferred.infer_schema(texts(spark, "no json", None, "3")) is None
    assert inferred.infer_schema(texts(spark).where("false")) is None


def test_a_field_of_the_last_file_is_found_and_types_stay(spark, tmp_path):
    out = new_run_dir(spark, "t_infer")
    for n in range(60):
        with open(tmp_path / f"f{n:03d}.json", "w") as f:
            f.write(json.dumps({"value": json.dumps({"n": n} | ({"only_here": 7} if n == 59 else {}))}) + "\n")
    got = []

    def run():
        s = spark.readStream.schema("value string").json(str(tmp_path))
        batches = inferred.InferredBatches(f"{out}/schema", lambda b, e: got.append([e, b.columns, b.count()]))
        q = s.writeStream.option("checkpointLocation", f"{out}/ck").trigger(availableNow=True).foreachBatch(batches).start()
        q.awaitTermination()
        assert q.exception() is None

    run()
    assert got == [[0, ["n", "only_here", "_corrupt"], 60]]
    with open(tmp_path / "later.json", "w") as f:
        f.write(json.dumps({"value": json.dumps({"n": 1.5, "newer": 1})}) + "\n")
    run()  # a restart: the schema that was kept
    assert got[1][1:] == [["n", "only_here", "_corrupt"], 1]
    assert kind(inferred.kept_schema(spark, f"{out}/schema"), "n") == "bigint"


def test_first_batches_without_a_record_fix_nothing(spark):
    out = new_run_dir(spark, "t_infer2")
    job = inferred.InferredBatches(f"{out}/schema", lambda b, e: replace_leaves(b, f"{out}/data", str(e), []))
    job(texts(spark, "no json"), 0)
    assert inferred.kept_schema(spark, f"{out}/schema") is None
    job(texts(spark, {"a": 1}), 1)
    inferred.keep_schema(spark, f"{out}/schema", T.StructType([]))  # a second writer changes nothing
    job = inferred.InferredBatches(f"{out}/schema", job.body)
    job(texts(spark, {"a": 2}, {"b": 1}), 2)
    back = spark.read.option("mergeSchema", "true").parquet(f"{out}/data")
    assert sorted((r.a, r._corrupt) for r in back.where("a IS NOT NULL").collect()) == [(1, None), (2, None)]
    assert back.count() == 4


def test_new_fields_are_counted(spark):
    schema = inferred.infer_schema(texts(spark, {"a": 1}))
    found = inferred.new_fields(texts(spark, {"a": 1, "z": 2}, {"z": 1, "y": None}, "no json", "[1]"), schema)
    assert sorted(map(tuple, found.collect())) == [("y", 1), ("z", 2)]


@pytest.mark.parametrize("value", ['{"a":"\\u0000"}', "{}", '{"a":{}}', '{"a":[]}'])
def test_small_objects(spark, value):
    df = texts(spark, value)
    assert inferred.parse_inferred(df, inferred.infer_schema(df)).where("_corrupt IS NULL").count() == 1
