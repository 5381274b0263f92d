"""Capture index of web archives: sorted runs, k-way loser-tree merging, globally ordered capture histories."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, partitions, table, whole_groups
from .url_keys import range_splits, url_key, url_key_sql


class LoserTree:
    """Merges k sorted sequences: each inner node keeps the loser of its match, so a pop replays one path of log2(k) matches."""

    def __init__(self, runs: Sequence[Sequence]):
        self.runs = runs
        self.k = len(runs)
        self.at = [0] * self.k
        self.loser = [-1] * max(1, self.k)
        winners = [-1] * self.k + list(range(self.k))
        for node in range(self.k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            if self._beats(b, a):
                a, b = b, a
            winners[node], self.loser[node] = a, b
        self.winner = winners[1] if self.k > 1 else 0

    def _beats(self, a: int, b: int) -> bool:
        """Whether run a's head goes before run b's; an ended run loses, ties go to the earlier run."""
        i, j = self.at[a], self.at[b]
        if i >= len(self.runs[a]):
            return False
        if j >= len(self.runs[b]):
            return True
        x, y = self.runs[a][i], self.runs[b][j]
        return x < y or (x == y and a < b)

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """(run, index) in merged order."""
        if not self.k:
            return
        while True:
            w = self.winner
            if self.at[w] >= len(self.runs[w]):
                return
            yield w, self.at[w]
            self.at[w] += 1
            node = (w + self.k) >> 1
            while node:
                other = self.loser[node]
                if self._beats(other, w):
                    self.loser[node], w = w, other
                node >>= 1
            self.winner = w


_PIECE = "part int, key array<string>, ts array<bigint>, id array<bigint>, digest array<string>"
_MERGED = "part int, pos bigint, key string, ts bigint, id bigint, digest string, nth bigint, revisit boolean"
_ORDER = [("key", "ascending"), ("ts", "ascending"), ("id", "ascending"), ("digest", "ascending")]


def _merge(piece: pa.Table) -> pa.Table:
    columns = {c: piece.column(c).to_pylist() for c in ("key", "ts", "id", "digest")}
    runs = [[(k, t, i, d is not None, d) for k, t, i, d in zip(*r, strict=True)] for r in zip(*columns.values(), strict=True)]
    out = [runs[r][i] for r, i in LoserTree(runs)]
    key, ts, ident, _, digest = (list(c) for c in zip(*out, strict=True))
    nth, revisit = [], []
    for i, (k, _, _, _, d) in enumerate(out):
        same = i > 0 and k == key[i - 1]
        nth.append(nth[-1] + 1 if same else 1)
        revisit.append(same and d is not None and d == digest[i - 1])
    n = len(key)
    part = piece.column("part")[0].as_py()
    return pa.table(
        [pa.array([part] * n, pa.int32()), pa.array(range(n), pa.int64()), pa.array(key, pa.string()), pa.array(ts, pa.int64()), pa.array(ident, pa.int64()), pa.array(digest, pa.string()), pa.array(nth, pa.int64()), pa.array(revisit, pa.bool_())],
        names=["part", "pos", "key", "ts", "id", "digest", "nth", "revisit"],
    )


def _sorted_run(batches: list[pa.RecordBatch]) -> pa.Table:
    """The rows in order of (key, ts, id, digest), null digests first. Arrow compares strings by their bytes."""
    t = pa.Table.from_batches(batches)
    return t.take(pc.sort_indices(t, sort_keys=_ORDER, null_placement="at_start")).combine_chunks()


def _cuts(run: pa.Table, splits: list[tuple[bytes, int, int]]) -> list[tuple[int, int, int]]:
    """(part, first row, row after the last) of the parts that a sorted run has rows of: a search for each split that falls into it."""

    def row(i: int) -> tuple[bytes, int, int]:
        return run["key"][i].as_py().encode(), run["ts"][i].as_py(), run["id"][i].as_py()

    out, lo, n = [], 0, run.num_rows
    while lo < n:
        part = bisect_right(splits, row(lo))
        hi = n if part == len(splits) else bisect_left(range(n), splits[part], lo=lo, key=row)
        out.append((part, lo, hi))
        lo = hi
    return out


def capture_histories(captures: DataFrame, ts: Column, url_col: str = "url", id_col: str = "page_id", digest: Column | None = None, rows_per_part: int = 200_000) -> DataFrame:
    """(position, url_key, ts, page_id, digest, capture_no, revisit) in global order of (url_key, ts, page_id, digest).

    Each task sorts its captures into runs of up to rows_per_part rows and cuts them at splits of the (url_key, ts, page_id)
    space; a part's run pieces are merged by a loser tree. Parts are joined by a summary of one row each: position counts from 0
    over all parts, capture_no from 1 over a URL's history even where splits cut it, and revisit tells that the digest (the MD5
    of column html, if none is given) equals that of the URL's capture before. Splits and summaries are one row for each part of
    rows_per_part captures; nothing else goes to the driver.

    Captures without a URL key (null or hostless URLs), timestamp or id are left out. A null body has a null digest and
    is no revisit. Captures equal in key, timestamp and id are all kept, ordered by digest, a null one first, whatever runs they
    come from. Ids are whole numbers. Other columns are not looked at. An empty table gives no rows.
    """
    spark = captures.sparkSession
    digest = F.md5(F.col("html").cast("binary")) if digest is None else digest
    index = captures.select(url_key(F.col(url_col)).alias("key"), ts.cast("bigint").alias("ts"), F.col(id_col).cast("bigint").alias("id"), digest.cast("string").alias("digest")).where("key is not null and ts is not null and id is not null")
    light = index.select("key", "ts", "id")
    n = light.count()
    parts = max(1, min(n // 64 + 1, max(partitions(spark), -(-n // rows_per_part))))
    splits = [(k.encode(), t, i) for k, t, i in range_splits(light, ["key", "ts", "id"], parts, n)] if parts > 1 else []

    def sort_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces(run: pa.Table) -> pa.RecordBatch:
            at = _cuts(run, splits)
            ends = np.array([0, *(hi for _, _, hi in at)], np.int32)
            arrays = [pa.ListArray.from_arrays(pa.array(ends), run[c].combine_chunks() if run[c].num_chunks != 1 else run[c].chunk(0)) for c in ("key", "ts", "id", "digest")]
            return pa.RecordBatch.from_arrays([pa.array([p for p, _, _ in at], pa.int32()), *arrays], ["part", "key", "ts", "id", "digest"])

        held: list[pa.RecordBatch] = []
        for b in batches:
            if b.num_rows:
                held.append(b)
            if sum(x.num_rows for x in held) >= rows_per_part:
                yield pieces(_sorted_run(held))
                held = []
        if held:
            yield pieces(_sorted_run(held))

    def merge_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in whole_groups(batches, "part"):
            yield from _merge(piece).to_batches()

    # Every part is a partition of its own.
    merged = materialize(index.mapInArrow(sort_runs, _PIECE).repartitionById(parts, F.col("part")).mapInArrow(merge_parts, _MERGED))
    ends = (
        merged.groupBy("part")
        .agg(F.count("*").alias("n"), F.min_by("key", "pos").alias("first"), F.max_by("key", "pos").alias("last"), F.max_by("nth", "pos").alias("nth"), F.max_by("digest", "pos").alias("digest"))
        .orderBy("part")
        .toLocalIterator()
    )
    carried, at = [], 0
    last, seen, before = None, 0, None
    for e in ends:
        carried.append((e["part"], at, last, seen, before))
        at += e["n"]
        seen = e["nth"] + (seen if e["last"] == last and e["first"] == last else 0)
        last, before = e["last"], e["digest"]
    carry = spark.createDataFrame(carried, "part int, c_at bigint, c_key string, c_nth bigint, c_digest string")
    # One row for each part; beyond this size (a few hundred bytes each) the join is left to Spark.
    carry = F.broadcast(carry) if len(carried) <= 50_000 else carry
    goes_on = F.coalesce(F.col("key") == F.col("c_key"), F.lit(False))
    return merged.join(carry, "part").select(
        (F.col("c_at") + F.col("pos")).alias("position"),
        F.col("key").alias("url_key"),
        "ts",
        F.col("id").alias("page_id"),
        "digest",
        (F.col("nth") + F.when(goes_on, F.col("c_nth")).otherwise(0)).alias("capture_no"),
        F.when(goes_on & (F.col("nth") == 1), F.coalesce(F.col("digest") == F.col("c_digest"), F.lit(False))).otherwise(F.col("revisit")).alias("revisit"),
    )


#: The table has each URL once and no capture time: of each page three captures within 2024 are derived from page_id, of which those
#: of every third page change their body at the second, and those of the others at the third if page_id is even.
BASE, YEAR = 1704067200, 31536000


def op6_warc_index_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histories of all pages, with three captures of each."""
    body = F.md5(F.col("html").cast("binary"))
    pages = table(spark, sf_dir, "pages").select("page_id", "url", body.alias("body"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("nth"))
    changed = F.when(F.col("page_id") % 3 == 0, F.col("nth") >= 1).otherwise((F.col("nth") == 2) & (F.col("page_id") % 2 == 0))
    captures = pages.withColumn("digest", F.when(changed, F.md5(F.concat("body", F.lit("/2")).cast("binary"))).otherwise(F.col("body")))
    return capture_histories(captures, F.lit(BASE) + (F.col("page_id") * 7919 + F.col("nth") * 86400 * 97) % YEAR, digest=F.col("digest"))


QUERIES = {"op6_warc_index_merge": op6_warc_index_merge}
ORACLE_SQL = {
    "op6_warc_index_merge": f"""
WITH captures AS (
  SELECT {url_key_sql("url")} AS url_key, {BASE} + (page_id * 7919 + nth * 86400 * 97) % {YEAR} AS ts, page_id,
         CASE WHEN (page_id % 3 = 0 AND nth >= 1) OR (page_id % 3 <> 0 AND nth = 2 AND page_id % 2 = 0) THEN md5(md5(html) || '/2') ELSE md5(html) END AS digest
  FROM pages, (SELECT unnest([0, 1, 2]) AS nth)
)
SELECT row_number() OVER (ORDER BY url_key, ts, page_id, digest NULLS FIRST) - 1 AS position, url_key, ts, page_id, digest,
       row_number() OVER h AS capture_no, coalesce(digest = lag(digest) OVER h, false) AS revisit
FROM captures WHERE url_key IS NOT NULL AND page_id IS NOT NULL
WINDOW h AS (PARTITION BY url_key ORDER BY ts, page_id, digest NULLS FIRST)
"""
}
