"""URL filter: sort-merge range join of URLs with nested host and path rules.

Canonical key: the labels of a host reversed and joined by dots, a zero byte,
then the path. A rule for a host and a path prefix is the interval of keys that
begin with its key. A URL is probed once for its host and once for each parent
domain, so rules of parent domains are intervals over the same keys.

Distinct (host, path) pairs are probed, so a URL that a third of the rows hold
costs one probe. Keys are cut into cells at sampled splitters (a bounded sample,
which only balances the work); a rule goes to every cell its interval touches.
Each task reads its cells in key order, rules before probes, and keeps the stack
of rules that are still open; the top of the stack is the innermost rule. Of the
rules found for a URL's domains the longest (host and path together) wins, then
the longest host.

Defined results: null URLs and URLs without ``://`` have an empty host and path,
and no rule. A path that is empty begins with no rule path but the empty one. Of
rules with equal host and path, block wins. URLs without a rule get ``default``.
Repeated rows and null page_ids each return a row; other columns are never read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from towerlens.llm.text import read_table

#: (verdict, host, path prefix)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
DEFAULT = "allow"
#: Probe keys sampled for the splitters of the cells.
SPLITTER_SAMPLE = 4096

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(pages: DataFrame) -> DataFrame:
    """(page_id, host, path)."""
    at = F.locate("://", F.col("url"))
    rest = F.when(at > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise(F.lit(""))
    out = pages.select("page_id", F.coalesce(rest, F.lit("")).alias("rest"))
    out = out.withColumn("authority", F.regexp_extract("rest", r"^[^/?#]*", 0))
    path = F.regexp_extract(F.expr("substring(rest, length(authority) + 1)"), r"^[^?#]*", 0)
    return out.select("page_id", F.translate("authority", UPPER, LOWER).alias("host"), path.alias("path"))


def canonical(labels: F.Column, path: F.Column) -> F.Column:
    return F.encode(F.concat(F.array_join(F.reverse(labels), "."), F.lit("\0"), path), "UTF-8")


def probes(pairs: DataFrame) -> DataFrame:
    """(key, host, path): a row for the host and each parent domain."""
    labels = F.split("host", r"\.", -1)
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda i: F.slice(labels, i, F.size(labels)))
    return pairs.where("host <> ''").select("host", "path", F.explode(parents).alias("labels")).select(
        canonical(F.col("labels"), F.col("path")).alias("key"), "host", "path")


def rule_table(spark: SparkSession, rules: tuple) -> DataFrame:
    """(key, verdict, rule, width, host_width)."""
    rows = spark.createDataFrame(list(rules), "verdict string, rule_host string, prefix string")
    keyed = rows.select(
        canonical(F.split("rule_host", r"\.", -1), F.col("prefix")).alias("key"), "verdict",
        F.concat("rule_host", "prefix").alias("rule"), F.length("rule_host").alias("host_width"))
    return keyed.groupBy("key").agg(F.max_by(F.struct("verdict", "rule", "host_width"), "verdict").alias("r")).select(
        "key", "r.*", F.length("r.rule").alias("width"))


def sweep(rows: DataFrame, splitters: list[bytes]) -> DataFrame:
    """Innermost open rule of each probe. ``rows``: key, host, path; verdict, rule, ... are set on rules."""
    fields = [f for f in rows.columns if f != "key"]

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            take, cell = [], []
            for i, (key, rule) in enumerate(zip(b.column("key").to_pylist(), b.column("rule").to_pylist())):
                low = bisect_right(splitters, key)
                high = low
                while rule is not None and high < len(splitters) and splitters[high].startswith(key):
                    high += 1
                take += [i] * (high - low + 1)
                cell += range(low, high + 1)
            out = b.take(pa.array(take, pa.int64()))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(cell, pa.int32())], [*out.schema.names, "cell"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack, at = [], None
        for b in batches:
            rows_, top = [], []
            for i, (cell, key, rule) in enumerate(zip(*(b.column(c).to_pylist() for c in ("cell", "key", "rule")))):
                if cell != at:
                    stack, at = [], cell
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if rule is not None:
                    stack.append((key, rule, b.column("verdict")[i].as_py(), b.column("width")[i].as_py(),
                                  b.column("host_width")[i].as_py()))
                elif stack:
                    rows_.append(i)
                    top.append(stack[-1][1:])
            found = [list(c) for c in zip(*top)] if top else [[]] * 4
            pick = pa.array(rows_, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("host").take(pick), b.column("path").take(pick), pa.array(found[0], pa.string()),
                 pa.array(found[1], pa.string()), pa.array(found[2], pa.int32()), pa.array(found[3], pa.int32())],
                ["host", "path", "rule", "verdict", "width", "host_width"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    dealt = rows.mapInArrow(cells, f"{kinds}, cell int").repartition("cell")
    dealt = dealt.sortWithinPartitions("cell", "key", F.col("rule").isNull())
    return dealt.select("key", *fields, "cell").mapInArrow(
        walk, "host string, path string, rule string, verdict string, width int, host_width int")


def url_verdicts(pages: DataFrame, rules: tuple = RULES, default: str = DEFAULT) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page."""
    spark = pages.sparkSession
    split = split_url(pages)
    probe = probes(split.select("host", "path").distinct())
    sample = [bytes(r.key) for r in probe.select("key").orderBy(F.xxhash64("key"), "key").limit(SPLITTER_SAMPLE).collect()]
    sample = sorted(set(sample))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    splitters = sample[:: max(1, len(sample) // n)][1:]
    rows = rule_table(spark, rules).unionByName(probe, allowMissingColumns=True)
    found = sweep(rows, splitters).groupBy("host", "path").agg(
        F.max(F.struct("width", "host_width", "verdict", "rule")).alias("best"))
    return split.join(found, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return url_verdicts(pages.select(F.col("page_id"), F.col("url").cast("string").alias("url")))


SQL = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM parts),
rules(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
pairs AS (SELECT DISTINCT host, path FROM split),
fits AS (
  SELECT host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
  FROM pairs JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY host, path)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM split LEFT JOIN fits USING (host, path)
"""
