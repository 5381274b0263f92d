"""URL filters: prefix rules as key intervals, joined with URLs by a sorted sweep that keeps a stack of nested rules."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import partitions, table
from .url_keys import range_splits, url_key, url_key_sql

_ROW = "part int, key string, kind int, id bigint, action string"


def match_rules(pages: DataFrame, rules: DataFrame, url_col: str = "url", id_col: str = "page_id", default_action: str = "allow") -> DataFrame:
    """(page_id, url_key, n_rules, rule, action) of every page: how many rules hold for it, and the most specific one.

    rules has (prefix, action), where prefix is a prefix of url_key() keys: ``com,example,`` covers all hosts below the
    domain, ``com,example)/a/`` a folder. A prefix is the interval of the keys that start with it, so two intervals nest or
    are apart. URLs and interval starts are range-partitioned by key and sorted; a rule is sent to every part that its
    interval meets. The sweep pushes a rule when it starts and pops those that ended; the top of the stack is the longest.

    A page without a key (null or hostless URL) meets no rule. Where no rule holds, n_rules is 0, rule null and action the
    default. Rules of a null prefix are left out, the empty prefix holds for every key. Of rules with equal prefixes all
    count and the greatest action (null is least) is told. Rows of a null or repeated page_id are pages of their own. Other
    columns are not looked at. Ids are whole numbers. An empty table of pages gives no rows, one of rules the default for all.
    """
    spark = pages.sparkSession
    urls = pages.select(url_key(F.col(url_col)).alias("key"), F.col(id_col).cast("bigint").alias("id"))
    known = urls.where("key is not null")
    parts = partitions(spark)
    least = -(1 << 63)
    bounds = [(k.encode(), i) for k, i in range_splits(known.select("key", F.coalesce("id", F.lit(least)).alias("id")), ["key", "id"], parts, known.count())]

    def place_urls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, ids = b.column(0).to_pylist(), b.column(1).to_pylist()
            part = [bisect_right(bounds, (k.encode(), least if i is None else i)) for k, i in zip(keys, ids, strict=True)]
            n = len(part)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), b.column(0), pa.array([1] * n, pa.int32()), b.column(1), pa.nulls(n, pa.string())], ["part", "key", "kind", "id", "action"])

    def place_rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for prefix, action in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                raw = prefix.encode()
                lo = bisect_right(bounds, (raw, least))
                hi = bisect_left(bounds, (raw + b"\xff", least))  # no UTF-8 key goes beyond prefix + 0xff
                out += [(p, prefix, action) for p in range(lo, hi + 1)]
            if out:
                n = len(out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.string()), pa.array([0] * n, pa.int32()), pa.nulls(n, pa.int64()), pa.array([r[2] for r in out], pa.string())],
                    ["part", "key", "kind", "id", "action"],
                )

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, stack = None, []
        for b in batches:
            out = []
            for part, key, kind, ident, action in zip(*(b.column(c).to_pylist() for c in ("part", "key", "kind", "id", "action")), strict=True):
                if part != at:
                    at, stack = part, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    stack.append((key, action))
                else:
                    out.append((ident, key, len(stack), *(stack[-1] if stack else (None, default_action))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()), strict=True)], ["page_id", "url_key", "n_rules", "rule", "action"])

    placed = known.mapInArrow(place_urls, _ROW).union(rules.select(F.col("prefix").cast("string").alias("prefix"), F.col("action").cast("string").alias("action")).where("prefix is not null").mapInArrow(place_rules, _ROW))
    # Every part is a partition of its own: ranges are even, and so are tasks.
    ordered = placed.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "key", "kind", F.asc_nulls_first("action"))
    fields = "page_id bigint, url_key string, n_rules bigint, rule string, action string"
    unknown = urls.where("key is null").select(F.col("id").alias("page_id"), F.col("key").alias("url_key"), F.lit(0).cast("bigint").alias("n_rules"), F.lit(None).cast("string").alias("rule"), F.lit(default_action).alias("action"))
    return ordered.mapInArrow(sweep, fields).union(unknown)


def nested_rules(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Rules for a table without any: one for each domain, host, and first folder that its URLs have."""
    key = pages.select(url_key(F.col(url_col)).alias("key")).where("key is not null")
    prefixes = key.select(F.explode(F.array(F.regexp_extract("key", r"^[^,)]*,[^,)]*", 0), F.regexp_extract("key", r"^[^)]*\)", 0), F.regexp_extract("key", r"^[^)]*\)/[^/?]*/", 0))).alias("prefix"))
    return prefixes.where("prefix <> ''").distinct().withColumn("action", F.when(F.length("prefix") % 3 == 0, "block").otherwise("allow"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return match_rules(pages, nested_rules(pages))


QUERIES = {"op10_url_filters": op10_url_filters}
ORACLE_SQL = {
    "op10_url_filters": f"""
WITH keys AS (SELECT page_id, {url_key_sql("url")} AS url_key FROM pages),
prefixes AS (
  SELECT DISTINCT unnest([regexp_extract(url_key, '^[^,)]*,[^,)]*', 0), regexp_extract(url_key, '^[^)]*\\)', 0), regexp_extract(url_key, '^[^)]*\\)/[^/?]*/', 0)]) AS prefix
  FROM keys WHERE url_key IS NOT NULL),
rules AS (SELECT prefix, CASE WHEN length(prefix) % 3 = 0 THEN 'block' ELSE 'allow' END AS action FROM prefixes WHERE prefix <> '')
SELECT page_id, url_key, count(prefix) AS n_rules, arg_max(prefix, length(prefix)) AS rule, coalesce(arg_max(action, length(prefix)), 'allow') AS action
FROM keys LEFT JOIN rules ON starts_with(url_key, prefix)
GROUP BY page_id, url_key
"""
}
