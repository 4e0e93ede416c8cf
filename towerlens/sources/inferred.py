"""Schema inference for JSON streams over a whole batch, kept beside the checkpoint.

A schema read off the first lines of a stream misses what comes later. Here every record
of the first batch that holds any is parsed to VARIANT and ``schema_of_variant_agg``
merges their schemas, one value a task, so a field that only the last record has is found.
The schema is written beside the checkpoint before it is first used; later batches and
restarts read it, so a column never changes its type. It is the fields of one JSON object, so it is small.

Numbers are BIGINT where all are whole, else DOUBLE. A field whose values are of several
kinds, or all null, is text (objects and arrays among them as JSON). Records that are no JSON
object, and whole numbers in a text field, are treated by ``from_json`` as ever: no object →
``_corrupt``, a number in a text field → its text. Fields that first come after the schema was
fixed are counted by ``new_fields`` and can be read from the raw records.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from towerlens.schema import CORRUPT
from towerlens.sources.files import read_lake_table_if_any

_KEPT = T.StructType([T.StructField("schema", T.StringType())])


def _object(value: Column) -> Column:
    """The record as VARIANT where it is a JSON object, else NULL."""
    variant = F.try_parse_json(value)
    return F.when(F.schema_of_variant(variant).startswith("OBJECT<"), variant)


def _plain(dtype: T.DataType) -> T.DataType:
    """Types that ``from_json`` reads back without loss of kind."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _plain(f.dataType)) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_plain(dtype.elementType))
    if isinstance(dtype, T.DecimalType):
        return T.DoubleType() if dtype.scale else T.LongType() if dtype.precision <= 18 else T.StringType()
    if isinstance(dtype, (T.NullType, T.VariantType)):
        return T.StringType()
    return dtype


def infer_schema(records: DataFrame, value: str = "value") -> T.StructType | None:
    """Merged schema of all JSON objects in ``records``; None where there is none."""
    found = records.agg(F.schema_of_variant_agg(_object(F.col(value))).alias("s")).first().s
    if not found.startswith("OBJECT<"):
        return None
    # names are quoted by backticks unless they are plain words, so a type is never inside a name
    parts = re.split(r"(`(?:[^`]|``)*`)", found)
    ddl = "".join(part if i % 2 else re.sub(r"\bOBJECT<", "STRUCT<", part) for i, part in enumerate(parts))
    return _plain(T.DataType.fromDDL(ddl))


def kept_schema(spark: SparkSession, bookmark: str) -> T.StructType | None:
    row = read_lake_table_if_any(spark, bookmark, _KEPT).first()
    return None if row is None else T.StructType.fromJson(json.loads(row["schema"]))


def keep_schema(spark: SparkSession, bookmark: str, schema: T.StructType) -> None:
    """Write the schema once; a second writer changes nothing."""
    spark.createDataFrame([(schema.json(),)], _KEPT).coalesce(1).write.mode("ignore").parquet(bookmark)


def parse_inferred(records: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """The fields of ``schema``, and ``_corrupt`` with the text of records that are no JSON object."""
    fields = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(value, fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    good = _object(F.col(value)).isNotNull()
    cols = [F.when(good, F.col("_parsed")[f.name]).alias(f.name) for f in schema.fields]
    return records.withColumn("_parsed", parsed).select(
        *[c for c in records.columns if c != value], *cols,
        F.when(~good | F.col("_parsed")[CORRUPT].isNotNull(), F.col(value)).alias(CORRUPT))


def new_fields(records: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """(field, n_records): top-level fields that ``schema`` lacks."""
    known = F.array(*[F.lit(f.name) for f in schema.fields])
    keys = F.when(_object(F.col(value)).isNotNull(), F.json_object_keys(value))
    return (records.select(F.explode(F.array_except(keys, known)).alias("field"))
            .groupBy("field").agg(F.count(F.lit(1)).alias("n_records")))


class InferredBatches:
    """foreachBatch callable: fixes the schema with the first batch that has records, then parses each batch.

    ``body`` gets the parsed batch and its id. Batches before the first JSON object have
    nothing to parse: their records are passed on as corrupt ones.
    """

    def __init__(self, bookmark: str, body: Callable[[DataFrame, int], None], value: str = "value"):
        self.bookmark, self.body, self.value = bookmark, body, value
        self.schema: T.StructType | None = None

    def __call__(self, batch_df: DataFrame, epoch_id: int) -> None:
        spark = batch_df.sparkSession
        if self.schema is None:
            self.schema = kept_schema(spark, self.bookmark)
        if self.schema is None:
            found = infer_schema(batch_df, self.value)
            if found is not None:
                keep_schema(spark, self.bookmark, found)
                self.schema = kept_schema(spark, self.bookmark)
        self.body(parse_inferred(batch_df, self.schema or T.StructType([]), self.value), epoch_id)
