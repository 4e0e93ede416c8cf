"""File scans: CSV with a null token, JSON records, partitioned lake tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from towerlens.schema import WIRE_SCHEMA

# Fixed value: the null token of the measurement CSV export.
CSV_NULL_TOKEN = "empty_values"


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             null_token: str = CSV_NULL_TOKEN) -> DataFrame:
    """CSV with a header row; every field text.

    Columns are taken by header name (only the first line is read for that;
    no inference pass over the data), so files whose columns come in another
    order, or lack some fields, still map correctly: a field of ``schema``
    missing from the header becomes a NULL column. Extra columns are dropped.

    The token and an unquoted empty cell read as NULL; a quoted ``""`` stays
    ``''``.
    """
    schema = schema or WIRE_SCHEMA
    raw = (spark.read
           .option("header", "true")
           .option("inferSchema", "false")
           .option("nullValue", null_token)
           .option("emptyValue", "")
           .option("mode", "PERMISSIVE")
           .csv(path))
    have = set(raw.columns)
    return raw.select(*[
        (F.col(f"`{f.name}`").cast(f.dataType) if f.name in have
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])


def read_lake_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Partitioned Parquet table with an explicit schema.

    Partition columns are declared STRING in ``schema`` so zero-padded values
    ("05") are kept as text, which the hour-label range filter relies on.
    Filters on those columns become ``PartitionFilters`` (no file is opened
    for a pruned hour).
    """
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def read_lake_table_if_any(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``read_lake_table``, or no rows where nothing was written yet."""
    try:
        return read_lake_table(spark, path, schema)
    except AnalysisException as absent:
        if absent.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
