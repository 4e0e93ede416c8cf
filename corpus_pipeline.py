"""Training-data pipeline over ``documents``: five stages, each one operator of ``towerlens.llm``.

Quality rules drop what fails them, exact dedup keeps one row of equal texts,
the Jaccard join one document of each group of near copies, mixing takes each
source as often as its target asks, and BPE turns texts into token ids that are
decoded again to check them. Every stage reads the whole table that the one
before wrote; all but the last return the columns of ``documents``, whatever
they are named. An empty table goes through all stages. Stages whose tasks run Python get whole rows
in Arrow batches of ``ARROW_ROWS`` rows, so that a batch of long documents stays small beside an executor. SQL cannot express the
first stage (a fitted likelihood ratio), so ``ORACLE_SQL`` is None and tests
compare each stage with a plain version.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from towerlens.llm import op3_exact, op4_mixture, op6_quality, op8_jaccard, op9_bpe
from towerlens.llm.text import read_table
from towerlens.session import shared_dir


#: Rows that a Python worker and its JVM hold at once.
ARROW_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return op6_quality.keep_rows(docs, read_table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op3_exact.keep_rows(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return op8_jaccard.keep_rows(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op4_mixture.mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256) of each row that the mix takes."""
    import public_tokenizers

    small_batches(spark)
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    out = op9_bpe.decode(op9_bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                      F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard_join", near_dedup),
    ("source_mixing", source_mixing),
    ("byte_level_bpe", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage is written to the shared folder and read again."""
    folder = f"{shared_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
