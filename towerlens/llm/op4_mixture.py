"""Mixing sources to target weights by capped water-filling.

Sources share a budget in proportion to their weights. No source gives more than
``max_epochs`` times its size: such sources are clamped there, and the excess is
shared among the others by weight until none is above. Clamping goes by the
ratio cap / weight, so with sources in that order the clamped ones are a prefix;
running sums over the source table (one row a source) find it.

Rates become repetitions: with r = target / source size each document is taken
floor(r) times, and a seeded part of the documents once more so that their words
fill the rest of the target. The order of that part is the MD5 of seed and
doc_id. Its cut is found in two steps: sizes are summed by the first three hex
digits (4096 bins a source, summed before the shuffle) and running sums of bins
tell where each bin begins; inside its bin a document's place is a second running
sum. So a source with a third of all rows is never in one task. The words taken miss the target by half a document at most.

Defined results: null and empty texts have size 0 and follow the same cut. A
null source is the last source. Rows equal in all of doc_id, size and order are
interchangeable; repeated rows count as often as they are there. Other columns are never read, and
``mixed_rows`` carries them, whatever their names.
An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from towerlens.llm.text import read_table, whole_row

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MAX_EPOCHS = 2
SEED = 17


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null: 0.

    A word begins where a solid character follows the beginning or a space, so
    marks are written for spaces and solid runs and the marked starts counted.
    """
    solid = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return F.when(solid == "", 0).otherwise(
        F.length(solid) - F.length(F.replace(solid, F.lit(" "), F.lit(""))) + 1).cast("long")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, budget: float = BUDGET,
                   max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, source_size): capped water-filling.

    The windows run over the source table in one task: a row for each source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("double")
    ranked = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_epochs)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    ranked = (ranked
              .withColumn("given", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
              .withColumn("open", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
              .withColumn("budget", F.sum("source_size").over(whole) * budget)
              .withColumn("rank", F.row_number().over(order)))
    fits = F.col("weight") * (F.col("budget") - F.col("given")) <= F.col("cap") * F.col("open")
    level = F.min(F.when(fits, F.struct("rank", "given", "open"))).over(whole)
    return ranked.withColumn("level", level).select(
        "source", "source_size",
        F.when(F.col("level").isNull() | (F.col("rank") < F.col("level.rank")), F.col("cap"))
        .otherwise(F.col("weight") * (F.col("budget") - F.col("level.given")) / F.col("level.open"))
        .cast("double").alias("target"))


def mix_sources(docs: DataFrame, weights: tuple = WEIGHTS, budget: float = BUDGET,
                max_epochs: float = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies): how often the mix takes each document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       word_count(F.col("text").cast("string")).alias("size"))
    ticket = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    rows = rows.withColumn("ticket", ticket).withColumn("bin", F.substring("ticket", 1, 3))
    bins = rows.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"))
    sizes = bins.groupBy("source").agg(F.sum("bin_size").alias("source_size"))
    targets = source_targets(sizes, weights, budget, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = targets.withColumn("whole", whole.cast("long")).withColumn(
        "rest", F.col("target") - F.col("whole") * F.col("source_size"))
    # 4096 bins a source: these tables stay small whatever the number of documents
    upto = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("before", F.coalesce(F.sum("bin_size").over(upto), F.lit(0)))
    marks = bins.withColumnRenamed("source", "_s").join(plan, F.col("_s").eqNullSafe(F.col("source")))
    marks = marks.select(
        F.col("_s"), F.col("bin").alias("_bin"), "before", "source_size", "target", "whole", "rest")
    held = rows.join(marks, (F.col("bin") == F.col("_bin")) & F.col("source").eqNullSafe(F.col("_s")))
    # a group of this window is one bin of one source: a 4096th of its documents
    in_bin = Window.partitionBy("source", "bin").orderBy("ticket", "doc_id", "size")
    running = F.coalesce(F.sum("size").over(in_bin.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    more = F.col("before") + running + F.col("size") / 2 <= F.col("rest")
    return held.select("doc_id", "source", "size", "source_size", "target",
                       (F.col("whole") + more.cast("long")).alias("copies"))


#: What rows and their plan share; nulls are equal to each other.
SAME = ["id", "no_id", "named", "no_name", "size"]


def _same(doc_id: Column, source: Column) -> list[Column]:
    return [F.coalesce(doc_id, F.lit(0)).alias("id"), doc_id.isNull().alias("no_id"),
            F.coalesce(source, F.lit("")).alias("named"), source.isNull().alias("no_name")]


def mixed_rows(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with each row as often as the mix takes it.

    Rows that share doc_id, source and size lie next to each other in the order, so the first ``more``
    of them (by a hash of the text) are taken once more than the others.
    """
    plan = mix_sources(docs, **settings).select(*_same(F.col("doc_id"), F.col("source")), "size", "copies")
    plan = plan.groupBy(*SAME).agg(F.min("copies").alias("least"), F.sum("copies").alias("all"),
                                   F.count(F.lit(1)).alias("n"))
    plan = plan.select(*SAME, "least", (F.col("all") - F.col("n") * F.col("least")).alias("more"))
    text = F.col("text").cast("string")
    rows = docs.select(whole_row(docs).alias("row"), *_same(F.col("doc_id").cast("long"), F.col("source").cast("string")),
                       word_count(text).alias("size"), F.xxhash64(text).alias("mark"))
    place = F.row_number().over(Window.partitionBy(*SAME).orderBy("mark"))
    taken = rows.join(plan, SAME).withColumn("copies", F.col("least") + (place <= F.col("more")).cast("long"))
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    return taken.where("copies > 0").select("row", again).select("row.*")


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix_sources(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


SQL = r"""
WITH rows_ AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(concat('17:', coalesce(CAST(doc_id AS VARCHAR), 'null'))) AS ticket FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS source_size, CAST(sum(size) * 2 AS DOUBLE) AS cap,
         CAST([3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight
  FROM rows_ GROUP BY source),
ranked AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS given,
         sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_,
         sum(source_size) OVER () * 1.5::DOUBLE AS budget,
         row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS rank_ FROM sources),
level_ AS (SELECT * FROM ranked WHERE weight * (budget - given) <= cap * open_ ORDER BY rank_ LIMIT 1),
targets AS (
  SELECT r.source, r.source_size,
         CASE WHEN l.rank_ IS NULL OR r.rank_ < l.rank_ THEN r.cap
              ELSE r.weight * (r.budget - l.given) / l.open_ END AS target
  FROM ranked r LEFT JOIN level_ l ON true),
rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM targets),
run AS (
  SELECT r.doc_id, r.size, t.source_size, t.target, t.whole, t.target - t.whole * t.source_size AS rest,
         coalesce(sum(r.size) OVER (PARTITION BY r.source ORDER BY r.ticket, r.doc_id, r.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_
  FROM rows_ r JOIN rates t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(size * (whole + CASE WHEN before_ + size / 2.0 <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM run
"""
