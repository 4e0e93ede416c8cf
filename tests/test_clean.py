"""Drop-null-fields, drop-fields, remove-null-rows, mapping (FIXTURES F6)."""

from pyspark.sql import types as T

from towerlens.operators.clean import (
    drop_fields, drop_null_fields, find_null_fields, remove_null_rows,
)
from towerlens.operators.mapping import apply_mapping
from towerlens.schema import LIVE_MAPPING


def test_blank_text_column_dropped(spark):
    df = spark.createDataFrame([("", "x"), (" ", "y"), ("null", "z")], "a string, b string")
    assert find_null_fields(df) == [("a",)]
    assert drop_null_fields(df).columns == ["b"]


def test_real_null_keeps_column_unless_null_is_blank(spark):
    df = spark.createDataFrame([("", "x"), (None, "y")], "a string, b string")
    assert find_null_fields(df) == []
    assert find_null_fields(df, null_is_blank=True) == [("a",)]


def test_minus_one_columns_dropped(spark):
    df = spark.createDataFrame([(-1, -1.0, -1, 5)], "i int, d double, l bigint, k int")
    assert find_null_fields(df) == [("i",), ("d",), ("l",)]


def test_mixed_column_kept(spark):
    df = spark.createDataFrame([("x",), ("",)], "a string")
    assert find_null_fields(df) == []


def test_null_typed_column_always_dropped(spark):
    df = spark.sql("SELECT NULL AS n, 1 AS k")
    assert find_null_fields(df) == [("n",)]


def test_other_types_never_dropped(spark):
    df = spark.sql("SELECT CAST(-1 AS FLOAT) AS f, CAST(-1 AS SMALLINT) AS s, array('') AS a")
    assert find_null_fields(df) == []


def test_nested_struct_leaf_dropped(spark):
    schema = "s struct<a: string, b: string>, k int"
    df = spark.createDataFrame([(("", "v"), 1), (("null", "w"), 2)], schema)
    assert find_null_fields(df) == [("s", "a")]
    out = drop_null_fields(df)
    assert out.schema["s"].dataType.fieldNames() == ["b"]


def test_array_of_struct_leaf_dropped(spark):
    schema = "arr array<struct<x: string, y: int>>, k int"
    df = spark.createDataFrame([([("", 1), (" ", 2)], 1), ([], 2), ([("null", 3)], 3)], schema)
    assert find_null_fields(df) == [("arr", "x")]
    out = drop_null_fields(df)
    elem = out.schema["arr"].dataType.elementType
    assert elem.fieldNames() == ["y"]
    assert [r.arr[0].y if r.arr else None for r in out.orderBy("k").collect()] == [1, None, 3]


def test_array_of_struct_with_null_element_kept(spark):
    schema = "arr array<struct<x: string>>"
    df = spark.createDataFrame([([("",)],), (None,)], schema)
    assert find_null_fields(df) == []


def test_struct_emptied_is_dropped(spark):
    df = spark.createDataFrame([(("", ""), 1)], "s struct<a: string, b: string>, k int")
    assert drop_null_fields(df).columns == ["k"]


def test_drop_fields_paths(spark):
    schema = "s struct<a: string, b: string>, arr array<struct<x: int, y: int>>, k int"
    df = spark.createDataFrame([(("1", "2"), [(1, 2)], 3)], schema)
    out = drop_fields(df, [("s", "a"), ("arr", "y"), ("k",)])
    assert out.columns == ["s", "arr"]
    r = out.first()
    assert r.s.asDict() == {"b": "2"} and r.arr[0].asDict() == {"x": 1}


def test_empty_frame_drops_every_checkable_column(spark):
    df = spark.createDataFrame([], "a string, b int, c date")
    assert find_null_fields(df) == [("a",), ("b",)]


def test_blank_row_removed(spark):
    df = spark.createDataFrame(
        [(None, "", "2024-01-01 00:00:00"), ("x", "", "2024-01-01 00:00:00"), (" ", None, None)],
        "operator string, network string, record_ts string")
    out = remove_null_rows(df)
    assert [r.operator for r in out.collect()] == ["x"]


def test_missing_mapped_column_becomes_typed_null(spark):
    df = spark.createDataFrame([("a", "1.5")], "operator string, precission string")
    out = apply_mapping(df, LIVE_MAPPING)
    assert out.schema["signal"].dataType == T.IntegerType()
    r = out.first()
    assert r.signal is None and r.precission == 1.5 and r.operator == "a"
    assert out.columns == [m[2] for m in LIVE_MAPPING]


def test_scan_returns_row_count_with_decision(spark):
    from towerlens.operators.clean import scan_null_fields

    df = spark.createDataFrame([("", "x"), ("null", "y")], "a string, b string")
    assert scan_null_fields(df) == ([("a",)], 2)
    assert scan_null_fields(df.limit(0)) == ([("a",), ("b",)], 0)


def test_names_with_dots_are_not_paths(spark):
    df = spark.createDataFrame([("", "", ("",))], "`a.b` string, `q``t` string, a struct<b: string>")
    assert find_null_fields(df) == [("a.b",), ("q`t",), ("a", "b")]
    assert drop_fields(df, [("a.b",)]).columns == ["q`t", "a"]
    assert drop_fields(df, [("a", "b")]).columns == ["a.b", "q`t"]


def test_row_with_blank_kpi_fields_is_kept_for_its_other_fields(spark):
    from towerlens.plans.microbatch import clean_records
    from towerlens.schema import PAYLOAD_FIELDS

    schema = ", ".join(f"{f} string" for f in PAYLOAD_FIELDS) + ", record_ts timestamp_ntz"
    blank = {f: None for f in PAYLOAD_FIELDS} | {"record_ts": None, "provider": "", "satellites": "null"}
    full = {f: "1" for f in PAYLOAD_FIELDS} | {"provider": "null", "satellites": ""}
    rows = [full, blank | {"network": "net_1"}, blank, blank | {"provider": "null"}]
    out = clean_records(spark.createDataFrame([blank | r for r in rows], schema))
    # provider and satellites are blank columns: a row that has only these is blank too
    assert {(r.network, r.operator) for r in out.collect()} == {("1", "1"), ("net_1", None)}
