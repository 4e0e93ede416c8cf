"""Serving plan: every figure the dashboard shows, from the lake tables.

The KPI tables are read with explicit schemas and filtered once by the range
rule (a partition filter, so only the hours in range are opened; a catalog
table does not list the others either).
The filtered frames are small (rows per batch window × operator / postal
code over the range) and are persisted for the five results built from them,
then released with ``close()``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from towerlens.operators import serving
from towerlens.schema import AVERAGE_BY_OPERATOR_SCHEMA, STATUS_BY_POSTAL_CODE_SCHEMA
from towerlens.sources.files import read_lake_table

# Fixed value: the dashboard's default range choice.
DEFAULT_RANGE = "6 hours"


@dataclass
class Dashboard:
    operator_metrics: DataFrame
    operator_metrics_weighted: DataFrame
    postal_code_status: DataFrame
    hourly_metrics: DataFrame
    summary_cards: DataFrame
    _cached: list[DataFrame] = field(default_factory=list, repr=False)
    _as_of: str | None = None
    _range: str = DEFAULT_RANGE
    _mode: str = "interval"

    def pivot_status(self, values: list[str] | None = None) -> DataFrame:
        return serving.pivot_status(self._unordered_status(), values)

    def distinct_status(self) -> DataFrame:
        return serving.distinct_status(self._unordered_status())

    def _unordered_status(self) -> DataFrame:
        return serving.postal_code_status(self._cached[1], self._as_of, self._range, self._mode,
                                          ordered=False)

    def close(self) -> None:
        for df in self._cached:
            df.unpersist()


def _read(spark: SparkSession, source: str, schema) -> DataFrame:
    """A folder path, or a catalog table name (partitions pruned in the metastore)."""
    if "/" in source or ":" in source:
        return read_lake_table(spark, source, schema)
    return spark.table(source)


def build_dashboard(spark: SparkSession, average_source: str, status_source: str,
                    as_of: str | None = None, time_range: str = DEFAULT_RANGE,
                    mode: str = "interval") -> Dashboard:
    """Sources are folder paths or registered table names (``db.table``)."""
    avg = serving.time_range_filter(
        _read(spark, average_source, AVERAGE_BY_OPERATOR_SCHEMA), as_of, time_range, mode)
    status = serving.time_range_filter(
        _read(spark, status_source, STATUS_BY_POSTAL_CODE_SCHEMA), as_of, time_range, mode)
    avg = avg.persist(StorageLevel.MEMORY_AND_DISK)
    status = status.persist(StorageLevel.MEMORY_AND_DISK)
    # the range was applied above; "as_of" here only re-applies the same rule
    cards = serving.summary_cards(
        serving.operator_metrics(avg, as_of, time_range, mode, ordered=False),
        serving.postal_code_status(status, as_of, time_range, mode, ordered=False))
    return Dashboard(
        operator_metrics=serving.operator_metrics(avg, as_of, time_range, mode),
        operator_metrics_weighted=serving.operator_metrics_weighted(avg, as_of, time_range, mode),
        postal_code_status=serving.postal_code_status(status, as_of, time_range, mode),
        hourly_metrics=serving.hourly_metrics(avg, as_of, time_range, mode),
        summary_cards=cards,
        _cached=[avg, status], _as_of=as_of, _range=time_range, _mode=mode,
    )
