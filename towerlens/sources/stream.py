"""Streaming sources.

Production runs read a message bus (Kafka: ``key``, ``value``, ``timestamp``);
tests read the file source. Both give the same columns downstream:
``value`` (JSON text) or already-parsed fields, plus ``record_ts``.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from towerlens.schema import RECORD_TS


def start_time(spark: SparkSession, bookmark: str | None = None) -> str:
    """The time at which a "latest" start begins: now, or what the bookmark holds.

    The first call writes the bookmark (a folder beside the checkpoint), later
    ones read it, so a restarted query keeps its start.
    """
    now = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    if bookmark is None:
        return now
    spark.createDataFrame([(now,)], "started string").coalesce(1).write.mode("ignore").json(bookmark)
    return spark.read.schema("started string").json(bookmark).first().started


def stream_source(spark: SparkSession, path: str | None = None, fmt: str = "parquet",
                  schema: T.StructType | None = None, starting: str = "earliest",
                  start_ts: str | None = None, options: dict[str, str] | None = None,
                  ts_col: str | None = None, bookmark: str | None = None) -> DataFrame:
    """Open a stream.

    ``starting`` is ``earliest`` (everything in the source) or ``latest``.
    For Kafka it maps to ``startingOffsets``. The file source has no start
    position, so ``latest`` keeps records whose arrival time (``ts_col``, needed
    then) is at or after ``start_ts``; without one, at or after the time at which
    this stream was first built, kept in ``bookmark`` across restarts.

    ``ts_col`` names the arrival-time column; it becomes a TIMESTAMP
    ``record_ts`` (watermarks need TIMESTAMP, not TIMESTAMP_NTZ). Without one,
    Kafka's ``timestamp`` is used, else the processing time.
    """
    if starting not in ("earliest", "latest"):
        raise ValueError("starting must be 'earliest' or 'latest'")
    if starting == "latest" and fmt != "kafka" and ts_col is None:
        raise ValueError("a source without positions needs ts_col to start at 'latest'")
    opts = dict(options or {})
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        opts.setdefault("startingOffsets", starting)
    if schema is not None and fmt != "kafka":
        reader = reader.schema(schema)
    df = reader.options(**opts).load(path) if path else reader.options(**opts).load()
    if ts_col is None and fmt == "kafka":
        ts_col = "timestamp"
    df = with_record_ts(df, ts_col)
    if starting == "latest" and fmt != "kafka":
        bound = start_ts or start_time(spark, bookmark)
        df = df.filter(F.col(RECORD_TS) >= F.lit(bound).cast("timestamp"))
    return df


def with_record_ts(df: DataFrame, ts_col: str | None = None) -> DataFrame:
    """Record arrival time as a TIMESTAMP column ``record_ts``.

    From the source's own time column when there is one, else the processing
    time (constant within one micro-batch).
    """
    src = F.col(ts_col).cast("timestamp") if ts_col else F.current_timestamp()
    return df.withColumn(RECORD_TS, src)
