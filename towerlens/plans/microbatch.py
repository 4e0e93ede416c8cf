"""The live job's micro-batch body.

guard → persist → raw write (uncleaned) → drop blank fields → drop blank
rows → mapping → two KPI aggregates → two KPI writes → unpersist. Records that
are no JSON go to a dead-letter table of the same batch.

KPIs are keyed by the arrival window of each record (``batch_window``,
100-second windows by default). A trigger does not line up with these windows,
so two batches may each write a row for one window and operator; readers that
average the windows merge such rows from their sums and counts first
(``operators.serving``). The blank-field decision is made for a batch as a
whole: text that only a blank column holds ('null', '') is cleared in a batch
whose column holds nothing else, and kept in a batch where it does. A backfill of many windows in one
batch decides once for all of them, unless it decides ``blank_by_window``: then each
arrival window decides alone, as if it had been a batch.

The last act of a batch is its commit record (``sinks.commits``): readers that ask
for committed batches see all of its tables or none.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from towerlens.functions.timeparts import MICRO_BATCH_SECONDS, check_window, ingest_parts
from towerlens.operators.clean import (
    clear_null_fields_by, drop_fields, drop_null_fields, remove_null_rows, scan_null_fields,
)
from towerlens.operators.kpis import average_by_operator, status_by_postal_code, with_batch_window
from towerlens.operators.mapping import apply_mapping
from towerlens.plans.rollup import update_rollup
from towerlens.schema import CORRUPT, INGEST_COLS, RECORD_TS
from towerlens.sinks.commits import CommitLog
from towerlens.sinks.lake import add_batch_partitions, add_ingest_partitions, cluster_by_partition, write_batch_table


def clean_records(batch: DataFrame, null_is_blank: bool = False) -> DataFrame:
    """drop blank fields → drop blank rows (over all payload fields) → mapping."""
    return apply_mapping(remove_null_rows(drop_null_fields(batch, null_is_blank=null_is_blank)))


def clean_records_by_window(batch: DataFrame, window_seconds: int = MICRO_BATCH_SECONDS,
                            null_is_blank: bool = False) -> DataFrame:
    """The same, with the blank fields of each arrival window on its own."""
    tagged = with_batch_window(batch, window_seconds)
    cleared = clear_null_fields_by(tagged, ["batch_window"], null_is_blank=null_is_blank).drop("batch_window")
    return apply_mapping(remove_null_rows(cleared))


def kpi_frames(mapped: DataFrame, window_seconds: int = MICRO_BATCH_SECONDS,
               since: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(average_by_operator, status_by_postal_code) per arrival window.

    Ingest partition text comes from the window start; the window length divides
    an hour, so no window straddles one. ``since`` (a time) keeps the records from
    then on: the range of a question, applied below the aggregates, where it
    reaches the scan.
    """
    check_window(window_seconds)
    if since is not None:
        mapped = mapped.where(F.col(RECORD_TS) >= F.lit(since).cast("timestamp_ntz"))
    tagged = with_batch_window(mapped, window_seconds)
    start = F.timestamp_seconds(F.col("batch_window") * F.lit(window_seconds))
    avg = average_by_operator(tagged, keys=("batch_window",)).select("*", *ingest_parts(start))
    status = status_by_postal_code(tagged, keys=("batch_window",)).select("*", *ingest_parts(start))
    return avg, status


@dataclass
class MicroBatchWriter:
    """foreachBatch callable writing raw rows, both KPI tables and dead letters.

    The batches of a streaming query are tagged with the id that its checkpoint
    holds, so batch ids that begin again with a new checkpoint (at whatever path)
    never replace older batches. Outside a stream, ``tag`` is the identity.
    """

    out_dir: str
    tag: str
    window_seconds: int = MICRO_BATCH_SECONDS
    null_is_blank: bool = False
    # catalog tables (name → qualified table) to extend with each batch's
    # partitions, e.g. {"average_by_operator": "db.average_by_operator"}
    catalog: dict[str, str] | None = None
    raw: bool = True
    blank_by_window: bool = False
    # keep the hourly roll-up (plans.rollup) of the hours that each batch touches
    rollup: bool = False

    def __post_init__(self) -> None:
        check_window(self.window_seconds)
        self.log = CommitLog(self.out_dir)

    def paths(self) -> dict[str, str]:
        return {n: f"{self.out_dir}/{n}" for n in
                ("raw", "average_by_operator", "status_by_postal_code", "dead_letter")}

    def __call__(self, batch_df: DataFrame, epoch_id: int) -> None:
        batch = batch_df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            key = f"{self.tag}-{query_id(batch_df) or 'batch'}-{epoch_id}"
            p = self.paths()
            if CORRUPT in batch.columns:
                bad = batch.where(F.col(CORRUPT).isNotNull()).select(
                    *[c for c in ("key", RECORD_TS, CORRUPT) if c in batch.columns])
                if not bad.isEmpty():
                    write_batch_table(add_ingest_partitions(bad), p["dead_letter"], key)
            good = batch.where(F.col(CORRUPT).isNull()).drop(CORRUPT, "key") if CORRUPT in batch.columns else batch
            # one job: the blank-field decision and the empty-batch guard
            blank, n_rows = scan_null_fields(good, null_is_blank=self.null_is_blank)
            if n_rows == 0:
                self.log.commit(batch_df.sparkSession, key, 0)
                return
            if self.raw:
                write_batch_table(cluster_by_partition(add_ingest_partitions(good)), p["raw"], key, compression="none")
            if self.blank_by_window:
                mapped = clean_records_by_window(good, self.window_seconds, self.null_is_blank)
            else:
                mapped = apply_mapping(remove_null_rows(drop_fields(good, blank)))
            avg, status = kpi_frames(mapped, self.window_seconds)
            self.write_kpis(avg, status, key)
            hours = update_rollup(batch_df.sparkSession, self.out_dir, key) if self.rollup else None
            if self.catalog:
                self._register(good, key)
            self.log.commit(batch_df.sparkSession, key, n_rows, hours=hours)
        finally:
            batch.unpersist()

    def write_kpis(self, avg: DataFrame, status: DataFrame, key: str) -> None:
        self.write_average(avg, key)
        write_batch_table(cluster_by_partition(status), self.paths()["status_by_postal_code"], key, compression="snappy")

    def write_average(self, avg: DataFrame, key: str) -> None:
        write_batch_table(cluster_by_partition(avg), self.paths()["average_by_operator"], key, compression="none")

    def _register(self, batch: DataFrame, key: str) -> None:
        """Add the batch's hours to the catalog (1-2 for a live batch, a row for each hour of a backlog)."""
        hours = [tuple(r) for r in batch.select(*ingest_parts(RECORD_TS)).distinct().sort(*INGEST_COLS).collect()]
        spark = batch.sparkSession
        for table in self.catalog.values():
            add_batch_partitions(spark, table, key, hours)


def query_id(batch_df: DataFrame) -> str | None:
    """Id of the streaming query whose batch this is, as its checkpoint holds it."""
    return batch_df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
