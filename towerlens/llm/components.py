"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from towerlens.session import shared_dir

#: Rows of a link table that one task holds.
TASK_ROWS = 200_000


def few_tasks(df: DataFrame, rows: int) -> DataFrame:
    """``df`` of ``rows`` rows in as many tasks as they need: each task of a shuffle leaves files, however short."""
    return df.coalesce(-(-rows // TASK_ROWS) or 1)


def written(df: DataFrame) -> DataFrame:
    """``df`` from the shared checkpoint folder, in as many tasks as its rows need."""
    df = df.checkpoint()
    return few_tasks(df, df.count())


def _least(edges: DataFrame) -> DataFrame:
    """(u, m): the least node among u and its neighbours in ``edges`` (u, v)."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, label): the least node of each node's component; nodes without a link have no row.

    Each round groups by node (summed before the shuffle, so a hub costs a row a
    task) and is written to the shared checkpoint folder. Only a count and a
    checksum of the edges reach the driver.
    """
    shared_dir(links.sparkSession)
    edges = links.select(F.least(a, b).alias("v"), F.greatest(a, b).alias("u")).where("u <> v").distinct().checkpoint()
    rows, seen = edges.count(), None
    while True:
        edges = few_tasks(edges, rows)
        both = few_tasks(edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), 2 * rows)
        large = both.join(_least(both), "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = few_tasks(few_tasks(large, rows).distinct(), rows)
        least = _least(large)
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v"))
        edges = few_tasks(few_tasks(small, rows).distinct(), rows).checkpoint()
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state == seen:
            break
        rows, seen = state.n, state
    edges = few_tasks(edges, rows)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
