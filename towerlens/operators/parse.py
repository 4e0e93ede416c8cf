"""Record encoding and parsing.

Wire records are JSON objects whose values are text (the producer dumps CSV
rows unchanged). Parsing with a typed schema would turn every quoted number
into NULL, so records are parsed with the all-string wire schema and typed
afterwards with lenient casts. A record that is not valid JSON keeps its text
in ``_corrupt`` (all payload fields NULL) so it can be routed to a
dead-letter path instead of silently becoming an empty row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from towerlens.functions.casts import lenient_cast
from towerlens.schema import (
    CORRUPT, MEASURED_AT, PAYLOAD_FIELDS, RECORD_TS, TYPED_FIELDS,
    WIRE_SCHEMA_WITH_CORRUPT,
)

_JSON_OPTS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def encode_records(df: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Row → (key, value): value is the JSON object of the payload fields.

    NULL fields are written as JSON null (as a dict dump would). The key is
    the network name when present and non-empty, else the current time in
    seconds, as text. That time is drawn for each record (the query's clock
    plus a part of a second by row), so such records spread over the
    partitions of the bus.
    """
    fields = [f for f in (fields or PAYLOAD_FIELDS) if f in df.columns]
    part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1_000_000))
    micros = (F.unix_micros(F.current_timestamp()) + part).cast("decimal(20,0)")
    now_key = (micros / 1_000_000).cast("decimal(20,6)").cast("string")
    key = F.coalesce(F.nullif(F.col("network"), F.lit("")), now_key) \
        if "network" in df.columns else now_key
    keep = [c for c in df.columns if c not in fields]
    return df.select(
        *keep,
        key.alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
    )


def parse_records(df: DataFrame, value_col: str = "value") -> DataFrame:
    """value (bytes or text) → all-text payload fields + ``_corrupt``.

    Other columns (record_ts, key, ...) pass through.
    """
    keep = [c for c in df.columns if c != value_col]
    parsed = F.from_json(F.col(value_col).cast("string"), WIRE_SCHEMA_WITH_CORRUPT,
                         _JSON_OPTS)
    return df.select(*keep, parsed.alias("_p")).select(*keep, "_p.*")


def split_corrupt(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good records, dead-letter records)."""
    bad = F.col(CORRUPT).isNotNull()
    return parsed.filter(~bad).drop(CORRUPT), parsed.filter(bad)


def type_records(wire: DataFrame) -> DataFrame:
    """All-text record → canonical types; payload ``hour`` → ``measured_at_text``."""
    src = {f: f for f in PAYLOAD_FIELDS}
    src[MEASURED_AT] = MEASURED_AT if ("hour" not in wire.columns
                                       and MEASURED_AT in wire.columns) else "hour"
    out: list[Column] = []
    for name, typ in TYPED_FIELDS:
        s = src[name]
        if s in wire.columns:
            out.append(lenient_cast(s, typ).alias(name) if typ != "string"
                       else F.col(s).alias(name))
        else:
            out.append(F.lit(None).cast(typ).alias(name))
    fields = set(PAYLOAD_FIELDS) | {MEASURED_AT}
    rest = [F.col(c) for c in wire.columns if c not in fields]
    return wire.select(*out, *rest)


def with_processing_time(df: DataFrame, col: str = "processing_time") -> DataFrame:
    """Processing-time stamp (one value per query / micro-batch)."""
    return df.withColumn(col, F.current_timestamp())

