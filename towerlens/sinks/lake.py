"""Lake writes.

Layout: ``<table>/ingest_year=YYYY/ingest_month=MM/ingest_day=DD/ingest_hour=HH/
batch_key=<query>-<batch>/part-*.parquet``. The ingest hour is derived from the
records' own arrival time (not the driver clock), and ``batch_key`` identifies
the writing query and micro-batch. A batch write replaces the leaves that it
writes (dynamic partition overwrite), so a retried or replayed batch leaves the
table unchanged instead of duplicating rows, and no other batch's files are ever
touched. Hours come first: a catalog table lists and opens only the hours of a
question. A read by path lists the table's folders first and then opens only
those hours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from towerlens.functions.timeparts import hour_label, ingest_parts
from towerlens.schema import BATCH_KEY, INGEST_COLS, RECORD_TS
from towerlens.sources.files import CSV_NULL_TOKEN, read_lake_table

LEAF_COLS = INGEST_COLS + [BATCH_KEY]

#: How Spark names the partition of a NULL value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

#: Partitions that one catalog statement adds.
ADD_AT_ONCE = 200


def add_ingest_partitions(df: DataFrame, ts: str = RECORD_TS) -> DataFrame:
    return df.select("*", *ingest_parts(ts))


def cluster_by_partition(df: DataFrame, partition_cols: list[str] | None = None) -> DataFrame:
    """Cluster a frame by its partition columns before a write.

    A rebalance: rows of one folder go together where they are few (a file a
    folder), and AQE splits a folder that is large over several tasks.
    """
    return df.hint("rebalance", *(partition_cols or INGEST_COLS))


def write_batch_table(df: DataFrame, path: str, batch_key: str,
                      compression: str = "snappy",
                      partition_cols: list[str] | None = None) -> None:
    """Idempotent write of one batch into a partitioned Parquet table."""
    (df.withColumn(BATCH_KEY, F.lit(batch_key)).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .option("compression", compression)
       .partitionBy(*(partition_cols or INGEST_COLS), BATCH_KEY)
       .parquet(path))


def register_tables(spark: SparkSession, database: str,
                    tables: dict[str, tuple[str, T.StructType]],
                    partition_cols: list[str] | None = None,
                    database_location: str | None = None, discover: bool = True) -> list[str]:
    """Create catalog tables over partition folders and discover partitions.

    ``tables`` maps name → (location, schema including partition columns).
    New partition folders become visible after ``MSCK REPAIR TABLE``; this
    is re-run on every call, so it also picks up hours written since. Without
    ``discover`` the tables may have no folder yet (a job is about to write it).
    ``database_location`` puts the database folder on shared storage when
    the session's warehouse folder is not (the tables themselves are external).
    """
    parts = list(partition_cols or LEAF_COLS)
    loc = f" LOCATION '{database_location}'" if database_location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{loc}")
    names = []
    for name, (location, schema) in tables.items():
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        pcols = ", ".join(f"`{c}`" for c in parts)
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({cols}) "
                  f"USING parquet PARTITIONED BY ({pcols}) LOCATION '{location}'")
        if discover:
            spark.sql(f"MSCK REPAIR TABLE `{database}`.`{name}`")
        names.append(f"{database}.{name}")
    return names


def add_batch_partitions(spark: SparkSession, table: str, batch_key: str,
                         hours: list[tuple]) -> None:
    """Register one batch's partitions in the catalog without listing the table.

    ``MSCK REPAIR`` lists every folder of the table, which grows with every
    batch; after a write the new partitions are known (the batch's hours), so
    they are added directly, ``ADD_AT_ONCE`` a statement. Re-running it for a
    replayed batch is harmless.
    """
    for at in range(0, len(hours), ADD_AT_ONCE):
        specs = " ".join(
            "PARTITION (" + ", ".join(
                [f"{c}='{NULL_PARTITION if v is None else v}'" for c, v in zip(INGEST_COLS, h)]
                + [f"{BATCH_KEY}='{batch_key}'"]) + ")"
            for h in hours[at: at + ADD_AT_ONCE])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}")


def write_result(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write a (small, already aggregated) query result to a location.

    CSV has the null token for NULL, so that it stays apart from empty text.
    """
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w = w.option("header", "true").option("nullValue", CSV_NULL_TOKEN)
    w.format(fmt).save(path)


def publish_records(encoded: DataFrame, fmt: str = "json", path: str | None = None,
                    options: dict[str, str] | None = None, limit: int | None = None,
                    order: list[str] | None = None) -> None:
    """Publish (key, value) records: Kafka in production, files in tests.

    ``limit`` is the "first N records" choice of the replay tool: the first N by
    ``order`` (columns of ``encoded``), or any N without one.
    """
    if limit is not None:
        encoded = (encoded.orderBy(*order) if order else encoded).limit(limit)
    w = encoded.select("key", "value").write.format(fmt).options(**(options or {}))
    if fmt != "kafka":
        w = w.mode("append")
    w.save(path) if path else w.save()


def compact_hours(spark: SparkSession, table_path: str, compacted_path: str,
                  schema: T.StructType, until_label: str, since_label: str | None = None) -> None:
    """Rewrite the per-batch files of closed hours into few files per hour.

    Hours with label in [since, until) are read from the live table (partition
    filter) and written to ``compacted_path`` partitioned by the ingest columns,
    replacing only those hour folders (dynamic overwrite), so a rerun is harmless
    and also takes in batches that came late. Rows keep their ``batch_key`` (as a
    column), which says what the compacted hour holds. The live table is never
    modified: without an atomic swap, deleting there would let readers see gaps
    or duplicates. Read both through ``read_compacted``.
    """
    sel = read_lake_table(spark, table_path, schema).filter(hour_label() < F.lit(until_label))
    if since_label:
        sel = sel.filter(hour_label() >= F.lit(since_label))
    (cluster_by_partition(sel)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*INGEST_COLS).parquet(compacted_path))


def read_compacted(spark: SparkSession, table_path: str, compacted_path: str,
                   schema: T.StructType, where: Column | None = None) -> DataFrame:
    """Compacted hours, and of the live table every batch that they don't hold, whatever its hour.

    Same rows as the live table alone. ``where`` is a filter on the ingest columns
    for both sides. A (hour, batch) leaf of the live table is skipped if the
    compacted hour has rows of that batch.
    """
    moved = T.StructType([f for f in schema.fields if f.name not in INGEST_COLS]
                         + [f for f in schema.fields if f.name in INGEST_COLS])
    old, live = read_lake_table(spark, compacted_path, moved), read_lake_table(spark, table_path, schema)
    if where is not None:
        old, live = old.where(where), live.where(where)
    held = old.select(*LEAF_COLS).distinct()
    return old.unionByName(live.join(held, LEAF_COLS, "left_anti"))
