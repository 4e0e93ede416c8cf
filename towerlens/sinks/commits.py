"""Commit records: what makes the tables of one batch appear together.

A micro-batch writes several tables, each with its own ``batch_key`` leaves. Its
commit record, one row under the same key, is written after all of them. Readers
keep the leaves whose key is committed, so a batch that died between two tables
is seen in none, and its replay, which replaces its own leaves, makes it appear in all.

Records number the batches in ``seq`` and carry the newest record time of all batches
so far, so the next batch needs the last record only. A replay finds its own record, takes the
one before it as its past, and writes the same again. A reader of several tables takes
``snapshot`` once and passes it to each read: batches that commit meanwhile stay out of all
of them. There is one writer at a time, as for any checkpoint.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from towerlens.schema import BATCH_KEY
from towerlens.sources.files import read_lake_table_if_any

#: ``hours``: labels of the ingest hours with rows of the batch, where its writer keeps a roll-up. ``watermark`` is the one that the batch was judged by; ``newest_ts`` counts the batch in.
COMMIT_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("n_late", T.LongType()),
    T.StructField("watermark", T.TimestampType()),
    T.StructField("newest_ts", T.TimestampType()),
    T.StructField("hours", T.ArrayType(T.StringType())),
    T.StructField("committed_at", T.TimestampType()),
    T.StructField(BATCH_KEY, T.StringType()),
])


def commits_path(out_dir: str) -> str:
    return f"{out_dir}/commits"


def utc(micros: int | None) -> datetime | None:
    """A time from ``unix_micros``: with its zone, so that no session's or driver's own zone matters."""
    return None if micros is None else datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=micros)


def read_commits(spark: SparkSession, out_dir: str) -> DataFrame:
    """One row a committed batch; none where nothing was committed yet."""
    return read_lake_table_if_any(spark, commits_path(out_dir), COMMIT_SCHEMA)


class CommitLog:
    """The writer's side: the last two records, read once and then kept up to date."""

    def __init__(self, out_dir: str):
        self.out_dir = out_dir
        self.last: list | None = None  # newest first

    def past(self, spark: SparkSession, batch_key: str) -> tuple[int, datetime | None]:
        """(number of this batch, newest record time of the batches before it)."""
        if self.last is None:
            rows = read_commits(spark, self.out_dir).orderBy(F.desc("seq")).limit(2)
            self.last = [(r[0], r[1], utc(r[2])) for r in rows.select("seq", BATCH_KEY, F.unix_micros("newest_ts")).collect()]
        before = self.last[1:] if self.last and self.last[0][1] == batch_key else self.last
        return (before[0][0] + 1, before[0][2]) if before else (0, None)

    def commit(self, spark: SparkSession, batch_key: str, n_rows: int, n_late: int = 0,
               watermark: datetime | None = None, last_ts: datetime | None = None,
               hours: list[str] | None = None) -> None:
        """Write the batch's record: the last act of its body."""
        seq, newest = self.past(spark, batch_key)
        newest = max((t for t in (newest, last_ts) if t is not None), default=None)
        row = spark.createDataFrame([(seq, n_rows, n_late, watermark, newest, hours)], T.StructType(COMMIT_SCHEMA.fields[:6]))
        (row.withColumns({"committed_at": F.current_timestamp(), BATCH_KEY: F.lit(batch_key)}).coalesce(1)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH_KEY)
         .parquet(commits_path(self.out_dir)))
        rest = [r for r in self.last if r[1] != batch_key]
        self.last = [(seq, batch_key, newest), *rest][:2]


def snapshot(spark: SparkSession, out_dir: str) -> int:
    """The newest commit's number, -1 where there is none."""
    last = read_commits(spark, out_dir).agg(F.max("seq").alias("last")).first().last
    return -1 if last is None else last


def committed(table: DataFrame, out_dir: str, at: int | None = None) -> DataFrame:
    """Rows of ``table`` (with its ``batch_key``) whose batch is committed, up to snapshot ``at``.

    A semi-join on a partition column: leaves of other batches are pruned when
    the query runs.
    """
    keys = read_commits(table.sparkSession, out_dir)
    if at is not None:
        keys = keys.where(F.col("seq") <= at)
    return table.join(keys.select(BATCH_KEY), BATCH_KEY, "left_semi").select(table.columns)
