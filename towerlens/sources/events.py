"""Adapter: the driver's ``events`` table as measurement records.

There is no telemetry table in the test data, so each ``events`` row stands in
for one measurement. The mapping is ours (not from any real network):

=============  ==============================================================
field          expression over ``events``
=============  ==============================================================
hour           ``date_format(ts, 'HH:mm:ss')`` (device time text)
lat / long     text built from ``user_id`` (``41.xxx`` / ``2.xxx``)
signal         ``props.k`` as text
network        ``net_<user_id % 3>``
operator       ``event_type``
status         ``k % 4`` as text; description ``state_<k % 4>``
speed          ``value`` as text
satellites     ``''`` (no source column: a blank field)
precission     ``value`` as text
provider       ``'null'`` (no source column: the text null)
activity       ``act_<user_id % 5>``
postal_code    ``08`` + ``user_id % 20`` zero-padded to 3 digits
record_ts      ``ts`` (arrival time), record_id ``event_id``
=============  ==============================================================

Every field is text, as it arrives on the wire. Real feeds are not clean, so
some records are made faulty by their id (``FAULTS``): records with only blank
fields, records whose KPI fields are blank but others are not, missing keys,
numbers that are not numbers. The scan reads only the columns it needs; all
expressions are built-in, so the projection stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from towerlens.schema import PAYLOAD_FIELDS, RECORD_TS

RECORD_ID = "record_id"
K_TEXT = "_k_text"
EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]

KPI_FIELDS = ["signal", "operator", "status", "description", "precission", "postal_code"]
#: (fields, modulus, remainder of event_id, text put there or None for NULL), in order.
FAULTS = (
    (["operator"], 61, 17, None),
    (["signal"], 67, 19, "abc"),
    (["signal"], 71, 23, "12.5"),
    (["precission"], 73, 29, ""),
    (["description"], 79, 31, None),
    (["postal_code"], 83, 37, None),
    (["status"], 43, 7, None),
    (["network"], 89, 41, None),
    (["network"], 97, 43, ""),
    (KPI_FIELDS, 59, 13, ""),
    (PAYLOAD_FIELDS, 106, 11, None),
    (PAYLOAD_FIELDS, 106, 64, ""),
)
#: Records whose encoded value is no JSON: event_id modulo CORRUPT_EVERY is CORRUPT_AT.
CORRUPT_EVERY, CORRUPT_AT = 101, 47


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def wire_from_events(events: DataFrame) -> DataFrame:
    # a column of its own: three fields use it, and the text is parsed once
    events = events.select("*", F.get_json_object("props", "$.k").alias(K_TEXT))
    k_text = F.col(K_TEXT)
    k = k_text.try_cast("int")
    status = (k % 4).cast("string")
    uid = F.col("user_id")
    cols = {
        "hour": F.date_format("ts", "HH:mm:ss"),
        "lat": F.concat(F.lit("41."), F.lpad((uid % 1000).cast("string"), 3, "0")),
        "long": F.concat(F.lit("2."), F.lpad(((uid * 7) % 1000).cast("string"), 3, "0")),
        "signal": k_text,
        "network": F.concat(F.lit("net_"), (uid % 3).cast("string")),
        "operator": F.col("event_type"),
        "status": status,
        "description": F.concat(F.lit("state_"), status),
        "speed": F.col("value").cast("string"),
        "satellites": F.lit(""),
        "precission": F.col("value").cast("string"),
        "provider": F.lit("null"),
        "activity": F.concat(F.lit("act_"), (uid % 5).cast("string")),
        "postal_code": F.concat(F.lit("08"), F.lpad((uid % 20).cast("string"), 3, "0")),
    }
    for fields, every, at, text in FAULTS:
        for f in fields:
            cols[f] = F.when(F.col("event_id") % every == at, F.lit(text).cast("string")).otherwise(cols[f])
    return events.select(
        *[cols[f].alias(f) for f in PAYLOAD_FIELDS],
        F.col("ts").alias(RECORD_TS),
        F.col("event_id").alias(RECORD_ID),
    )


def corrupted(encoded: DataFrame) -> DataFrame:
    """(record_id, value): some values replaced by text that is no JSON."""
    bad = F.col(RECORD_ID) % CORRUPT_EVERY == CORRUPT_AT
    return encoded.withColumn("value", F.when(bad, F.concat(F.lit("no json "), F.col(RECORD_ID).cast("string")))
                              .otherwise(F.col("value")))


def wire_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-text measurement records (plus record_ts, record_id)."""
    return wire_from_events(load_table(spark, sf_dir, "events"))
