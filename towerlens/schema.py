"""Record schemas of the measurement data.

Three shapes of one record exist:

* the *wire* record: the JSON object / CSV row as produced, every field text;
* the *typed* record: numbers parsed leniently (bad text becomes NULL);
* the *mapped* record: the pick / rename / cast list of the live cleaning job.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The 14 payload field names of a measurement record, in the
# order the producer emits them ("precission" is spelled as in the source data).
PAYLOAD_FIELDS = [
    "hour", "lat", "long", "signal", "network", "operator", "status",
    "description", "speed", "satellites", "precission", "provider",
    "activity", "postal_code",
]

# The payload field "hour" is the device's own time text. It is renamed on
# parse so that calendar columns named "hour" cannot overwrite it.
MEASURED_AT = "measured_at_text"

RECORD_TS = "record_ts"
CORRUPT = "_corrupt"

# All-string wire schema: quoted numbers and bare numbers both parse into it.
WIRE_SCHEMA = T.StructType(
    [T.StructField(f, T.StringType(), True) for f in PAYLOAD_FIELDS])

WIRE_SCHEMA_WITH_CORRUPT = T.StructType(
    WIRE_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType(), True)])

# Canonical type per payload field (postal_code stays text so
# that leading zeros survive).
TYPED_FIELDS = [
    (MEASURED_AT, "string"),
    ("lat", "double"),
    ("long", "double"),
    ("signal", "int"),
    ("network", "string"),
    ("operator", "string"),
    ("status", "string"),
    ("description", "string"),
    ("speed", "double"),
    ("satellites", "double"),
    ("precission", "double"),
    ("provider", "string"),
    ("activity", "string"),
    ("postal_code", "string"),
]

# The live cleaning job's mapping, (source, source type,
# target, target type), 15 entries. Only signal and precission change type.
LIVE_MAPPING = [
    ("hour", "string", "hour", "string"),
    ("lat", "string", "lat", "string"),
    ("long", "string", "long", "string"),
    ("signal", "string", "signal", "int"),
    ("network", "string", "network", "string"),
    ("operator", "string", "operator", "string"),
    ("status", "string", "status", "string"),
    ("description", "string", "description", "string"),
    ("speed", "string", "speed", "string"),
    ("satellites", "string", "satellites", "string"),
    ("precission", "string", "precission", "double"),
    ("provider", "string", "provider", "string"),
    ("activity", "string", "activity", "string"),
    ("postal_code", "string", "postal_code", "string"),
    (RECORD_TS, "timestamp", RECORD_TS, "timestamp"),
]

# Blank sets of the drop-null-fields rule.
NULL_STRING_SET = ("", "null")
NULL_NUMBER_SET = (-1,)

# Ingest partition columns of the lake tables (zero-padded text).
INGEST_COLS = ["ingest_year", "ingest_month", "ingest_day", "ingest_hour"]
BATCH_KEY = "batch_key"

AVERAGE_BY_OPERATOR_SCHEMA = T.StructType([
    T.StructField("batch_window", T.LongType()),
    T.StructField("operator", T.StringType()),
    T.StructField("avg_signal", T.DoubleType()),
    T.StructField("avg_precission", T.DoubleType()),
    T.StructField("sum_signal", T.LongType()),
    T.StructField("n_signal", T.LongType()),
    T.StructField("sum_precission", T.DoubleType()),
    T.StructField("n_precission", T.LongType()),
] + [T.StructField(c, T.StringType()) for c in INGEST_COLS + [BATCH_KEY]])

STATUS_BY_POSTAL_CODE_SCHEMA = T.StructType([
    T.StructField("batch_window", T.LongType()),
    T.StructField("postal_code", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("status_count", T.LongType()),
] + [T.StructField(c, T.StringType()) for c in INGEST_COLS + [BATCH_KEY]])
