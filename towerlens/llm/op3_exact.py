"""Exact dedup by grouping and an equi-join on the whole key, in DataFrame functions only.

This replaces the probe of an extendible-hash index: the directory below only sorts the
index files, no row is looked up through it.

1. Entries: rows with the same SHA-256 and the same bytes fold into one entry
   (largest doc_id, number of rows). The grouping compares whole texts, and its
   map side folds the copies of a hot text before anything is shuffled.
2. Directory: a bucket is a prefix of the SHA-256. All buckets begin with
   ``depth`` bits; while a bucket holds more than ``capacity`` entries the
   directory doubles: that bucket is split by one more bit, others keep their
   depth. Only the number of buckets left to split reaches the driver.
3. Index files: each entry goes with its bucket to Parquet in the shared folder,
   range-partitioned by key, sorted by bucket and key.
4. Collisions: entries of one SHA-256 with other bytes form a chain, told apart
   by length and a second hash; should these agree too, by the bytes.
5. Probe: each row meets its entry by a join on the whole key. Only keys move; AQE splits the
   partition of a hot key.

Defined results: null counts as the empty text. The largest doc_id stays; among
rows that share it all stay (repeated rows tie). A null doc_id is less than any
other. Other columns are ignored by the index and carried by ``keep_rows``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from towerlens.llm.text import documents, read_table, whole_row
from towerlens.session import shared_dir

#: Entries a bucket holds before it splits.
CAPACITY = 100_000
#: Bits of the directory at its start, and at most (the bits of the prefix column).
DEPTH, MAX_DEPTH = 4, 60

KEYS = ["sha", "check", "length"]


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.sha2(text, 256).alias("sha"), F.xxhash64(text).alias("check"),
                       F.octet_length(text).alias("length"), text.alias("text"))


def _prefix() -> F.Column:
    """The first 60 bits of the key."""
    return F.conv(F.substring("sha", 1, MAX_DEPTH // 4), 16, 10).cast("long")


def directory(entries: DataFrame, folder: str, capacity: int, depth: int) -> DataFrame:
    """(bucket, depth): the buckets after all splits; a bucket is its prefix padded with zero bits."""
    done, spark = None, entries.sparkSession
    left = entries.select("prefix")
    while True:
        width = 1 << (MAX_DEPTH - depth)
        load = left.groupBy((F.col("prefix") - F.col("prefix") % width).alias("bucket")).agg(
            F.count(F.lit(1)).alias("n")).withColumn("depth", F.lit(depth))
        load.write.parquet(f"{folder}/directory/{depth}")
        load = spark.read.schema("bucket long, n long, depth int").parquet(f"{folder}/directory/{depth}")
        over = load.where(F.col("n") > capacity)
        if depth == MAX_DEPTH or over.isEmpty():
            return load if done is None else done.unionByName(load)
        stays = load.where(F.col("n") <= capacity)
        done = stays if done is None else done.unionByName(stays)
        bucket = (F.col("prefix") - F.col("prefix") % width).alias("bucket")
        left = left.select("prefix", bucket).join(over.select("bucket"), "bucket", "left_semi").select("prefix")
        depth += 1


def build_index(docs: DataFrame, capacity: int = CAPACITY, depth: int = DEPTH) -> DataFrame:
    """Write the index to the shared folder and return it: one row for each distinct text.

    (bucket, sha, check, length, keep_id, group_size, text): ``text``
    is held only where a chain needs the bytes.
    """
    spark = docs.sparkSession
    folder = f"{shared_dir(spark)}/exact-index-{uuid.uuid4().hex}"
    entries = (_keyed(docs).groupBy(*KEYS, "text")
               .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    alike = F.count(F.lit(1))
    # entries that agree in SHA-256, second hash and length: none, unless bytes differ under all three
    light = entries.select(*KEYS, "keep_id", "group_size", _prefix().alias("prefix"))
    light.write.parquet(f"{folder}/entries")
    light = spark.read.parquet(f"{folder}/entries")
    clash = light.groupBy(*KEYS).agg(alike.alias("same")).where("same > 1").drop("same")
    buckets = directory(light, folder, capacity, depth)
    # 60 values at most; an empty table has no bucket
    depths = sorted(r.depth for r in buckets.select("depth").distinct().collect()) or [depth]
    slot = F.coalesce(*(F.col(f"b{d}") for d in depths))
    placed = light
    for d in depths:
        own = buckets.where(F.col("depth") == d).select(F.col("bucket").alias(f"b{d}"))
        width = 1 << (MAX_DEPTH - d)
        placed = placed.join(own, (F.col("prefix") - F.col("prefix") % width) == F.col(f"b{d}"), "left")
    placed = placed.select(slot.alias("bucket"), *KEYS, "keep_id", "group_size")
    plain = placed.join(clash, KEYS, "left_anti").withColumn("text", F.lit(None).cast("string"))
    if not clash.isEmpty():
        bytes_needed = entries.join(clash, KEYS, "left_semi")
        plain = plain.unionByName(bytes_needed.select(F.lit(0).cast("long").alias("bucket"), *KEYS, "keep_id",
                                                      "group_size", "text"))
    plain.repartitionByRange("sha").sortWithinPartitions("bucket", "sha").write.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index")


def probe(docs: DataFrame, index: DataFrame) -> DataFrame:
    """(doc_id, sha, keep_id, group_size) of each row, by the index."""
    keyed = _keyed(docs)
    plain = index.where("text IS NULL").drop("text", "bucket")
    found = keyed.select("doc_id", *KEYS).join(plain, KEYS, "left")
    if not index.where("text IS NOT NULL").isEmpty():
        chained = index.where("text IS NOT NULL").drop("bucket")
        by_bytes = keyed.join(chained, [*KEYS, "text"]).drop("text")
        found = found.where("group_size IS NOT NULL").unionByName(by_bytes.select(found.columns))
    return found.select("doc_id", "sha", "keep_id", "group_size")


def exact_dedup(docs: DataFrame, capacity: int = CAPACITY, depth: int = DEPTH) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): a row for each document, dropped ones too."""
    docs = documents(docs)
    return probe(docs, build_index(docs, capacity, depth)).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"))


def keep_rows(docs: DataFrame, capacity: int = CAPACITY, depth: int = DEPTH) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    index = build_index(documents(docs), capacity, depth)
    out = exact_rows(docs, index)
    return out.select("row.*")


def exact_rows(docs: DataFrame, index: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is the one that its entry keeps, as one struct ``row``."""
    owner = index.select("sha", "keep_id", F.col("text").alias("chained"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(whole_row(docs).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.sha2(text, 256).alias("key"))
    same = (F.col("key") == F.col("sha")) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    own = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    same &= F.coalesce(F.col("chained") == own, F.lit(True))
    return rows.join(owner, same, "left_semi").select("row")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"))


SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
