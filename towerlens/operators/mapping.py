"""Declarative pick / rename / cast.

``mappings`` is a list of (source, source type, target, target type). Each
source column is cast leniently (bad text → NULL) and renamed; columns not in
the list are dropped. A source column that is absent (for example removed by
``drop_null_fields`` because the batch had only blanks in it) becomes a typed
NULL column, so the output schema never depends on the batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from towerlens.functions.casts import lenient_cast
from towerlens.schema import LIVE_MAPPING


def apply_mapping(df: DataFrame, mappings=LIVE_MAPPING) -> DataFrame:
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    out = []
    for src, _src_type, dst, dst_type in mappings:
        if src not in types:
            out.append(F.lit(None).cast(dst_type).alias(dst))
        elif types[src] == dst_type or (types[src].startswith("timestamp")
                                        and dst_type == "timestamp"):
            out.append(F.col(f"`{src}`").alias(dst))
        else:
            out.append(lenient_cast(F.col(f"`{src}`"), dst_type).alias(dst))
    return df.select(*out)
