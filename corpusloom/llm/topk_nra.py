"""Exact top-k neighbours by no-random-access aggregation over sorted lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import partitions, table

SLACK = 1e-5
DIGITS = 6
SHARD = 4096


class _Best:
    """The k best (rounded score, id) of each query so far, ties to the lesser id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = np.full((queries, k), -np.inf)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max)

    def add(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(row):
            return
        touched = np.unique(row)
        row = np.concatenate([np.repeat(touched, self.k), row])
        score = np.concatenate([self.score[touched].ravel(), score])
        ids = np.concatenate([self.ids[touched].ravel(), ids])
        order = np.lexsort((ids, -score, row))
        row, score, ids = row[order], score[order], ids[order]
        first = np.flatnonzero(np.diff(row, prepend=-1))
        rank = np.arange(len(row)) - np.repeat(first, np.diff([*first, len(row)]))
        top = rank < self.k
        self.score[row[top], rank[top]] = score[top]
        self.ids[row[top], rank[top]] = ids[top]


def nra(queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, data_ids: np.ndarray, best: _Best, depths: tuple[float, ...], read: list[tuple[int, float]] | None = None) -> None:
    """Add the neighbours in data (unit rows) that may be among the k best of queries (unit rows) to best.

    Every dimension has a list of data sorted by its coordinate; a query reads a list from the top where its own coordinate
    is positive and from the bottom where it is negative, so that its terms fall as it reads. After each depth of the lists,
    an entry's upper bound takes its read terms and, for each unread one, the last term read of that list (an entry unread in
    all lists has the last terms alone). Once a query's k-th best score known so far passes the upper bound of an entry, that one is
    out; a query without entries left stops, and at the last depth the rest are resolved: their unread terms are fetched and
    the scores are exact. While queries know no k scores, the first rows of data are scored to have some.
    read, if given, gets (pairs scored, share of the list entries read) of each 1024 queries.
    """
    n = len(data)
    if n > 8 * best.k and not np.isfinite(best.score[:, -1]).all():
        cut = max(8 * best.k, n // 8)
        nra(queries, query_ids, data[:cut], data_ids[:cut], best, depths, read)
        data, data_ids = data[cut:], data_ids[cut:]
        n = len(data)
    lists = np.sort(data, axis=0).astype(np.float32)
    f32 = data.astype(np.float32)
    stages = sorted({int(d * n) for d in depths if 0 < int(d * n) < n})
    tops = [(np.maximum(f32, lists[n - r]).T, np.minimum(f32, lists[r - 1]).T) for r in stages]
    for lo in range(0, len(queries), 1024):
        q = queries[lo : lo + 1024]
        bar = best.score[lo : lo + 1024, -1].astype(np.float32)
        going = np.flatnonzero(np.isfinite(bar))
        alive = np.ones((len(q), n), np.bool_)
        entries, at = 0.0, 0
        for r, (top, bottom) in zip(stages, tops, strict=True):
            if not len(going):
                break
            entries += len(going) * (r - at)
            at = r
            x = q[going].astype(np.float32)
            alive[going] &= np.maximum(x, 0) @ top + np.minimum(x, 0) @ bottom >= (bar[going] - SLACK)[:, None]
            going = going[alive[going].any(axis=1)]
        i, j = np.nonzero(alive)
        entries += len(i) * (1 - at / n)
        other = query_ids[lo + i] != data_ids[j]
        i, j = i[other], j[other]
        if read is not None:
            read.append((len(i), entries / max(1, len(q) * n)))
        for a in range(0, len(i), 1 << 17):
            x, y = i[a : a + (1 << 17)], j[a : a + (1 << 17)]
            score = np.round(np.einsum("ij,ij->i", q[x], data[y]), DIGITS) + 0.0
            near = score >= best.score[lo + x, -1]
            best.add(lo + x[near], score[near], data_ids[y[near]])


def top_k(
    queries: DataFrame,
    vectors: DataFrame,
    k: int = 10,
    depths: tuple[float, ...] = (0.5, 0.75),
    query_block: int = 16384,
    data_block: int = 65536,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, neighbor_id, score): for every row of queries the k rows of vectors of the greatest cosine similarity.

    score is rounded to six digits; ranks go by score, then by neighbor_id. Rows are spread by a hash of the id over a grid of
    query blocks and data blocks; each cell searches its data shard by shard (nra()), and a last step merges the cells of a query.
    All pairs of blocks meet, so the result is exact whatever the grid, and no side is sent whole to any task.

    A query is compared with vectors of its own length only. Left out are null ids and vectors that are null, of zero length, or
    hold nulls or values that are not finite. Rows of one id are no neighbours of each other; repeated rows are otherwise rows of
    their own, so a repeated id is asked, and found, as often as it stands (equal ranks then go by id alone). Fewer than k others
    give fewer rows. Ids are whole numbers. Other columns are not looked at. Empty tables give no rows.
    """

    def good(df: DataFrame) -> DataFrame:
        picked = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<float>").alias("v")).where("id is not null and v is not null")
        return picked.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)).withColumn("dim", F.size("v"))

    spark = vectors.sparkSession
    parts = partitions(spark)
    asked, held = good(queries), good(vectors)
    n_asked, n_held = asked.count(), held.count()
    nq = max(1, -(-n_asked // query_block))
    nd = max(1, -(-n_held // data_block), min(-(-parts // nq), n_held // SHARD))
    # A row number that is stable over recomputation is not needed: blocks go by a hash of the id.
    block = lambda m: F.pmod(F.xxhash64("id"), F.lit(m)).cast("int")
    cell = F.col("q") * nd + F.col("d")
    left = asked.select(F.explode(F.sequence(F.lit(0), F.lit(nd - 1))).alias("d"), block(nq).alias("q"), "dim", "id", "v").select(cell.alias("cell"), "dim", F.lit(0).alias("kind"), "id", "v")
    right = held.select(F.explode(F.sequence(F.lit(0), F.lit(nq - 1))).alias("q"), block(nd).alias("d"), "dim", "id", "v").select(cell.alias("cell"), "dim", F.lit(1).alias("kind"), "id", "v")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, q_rows, d_rows, best, own, q_ids = None, [], [], None, None, None

        def unit(rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            v = np.concatenate([x for _, x in rows]).astype(np.float64)
            return np.concatenate([i for i, _ in rows]), v / np.sqrt((v * v).sum(axis=1, keepdims=True))

        def flush(least: int) -> None:
            nonlocal best, own, q_ids, d_rows
            if sum(len(i) for i, _ in d_rows) < max(1, least) or not (q_rows or best):
                return
            if best is None:
                q_ids, own = unit(q_rows)
                best = _Best(len(q_ids), k)
            d_ids, data = unit(d_rows)
            d_rows = []
            for a in range(0, len(d_ids), SHARD):
                nra(own, q_ids, data[a : a + SHARD], d_ids[a : a + SHARD], best, depths)

        def result() -> Iterator[pa.RecordBatch]:
            if best is not None:
                i, j = np.nonzero(np.isfinite(best.score))
                if len(i):
                    yield pa.RecordBatch.from_arrays([pa.array(q_ids[i]), pa.array(best.ids[i, j]), pa.array(best.score[i, j])], ["query_id", "neighbor_id", "score"])

        for b in batches:
            if not b.num_rows:
                continue
            c, dim, kind, ids = (b.column(x).to_numpy() for x in ("cell", "dim", "kind", "id"))
            flat = b.column("v").flatten().to_numpy(zero_copy_only=False)
            start = np.concatenate([[0], np.cumsum(dim)])
            mark = np.flatnonzero((np.diff(c) != 0) | (np.diff(dim) != 0) | (np.diff(kind) != 0)) + 1
            for lo, hi in zip([0, *mark], [*mark, len(c)], strict=True):
                if (c[lo], dim[lo]) != at:
                    flush(1)
                    yield from result()
                    at, q_rows, d_rows, best = (c[lo], dim[lo]), [], [], None
                (d_rows if kind[lo] else q_rows).append((ids[lo:hi], flat[start[lo] : start[hi]].reshape(hi - lo, dim[lo])))
                flush(SHARD)
        flush(1)
        yield from result()

    # One partition for each run of cells, so that no task gets more than its share of them.
    cells = left.union(right).repartitionById(min(parts, nq * nd), F.col("cell") % min(parts, nq * nd)).sortWithinPartitions("cell", "dim", "kind")
    found = cells.mapInArrow(search, "query_id bigint, neighbor_id bigint, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "neighbor_id")
    return found.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k).select("query_id", "rank", "neighbor_id", "score")


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every twentieth id as a query, against all rows."""
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors.where("vec_id % 20 = 0"), vectors)


QUERIES = {"op7_exact_topk": op7_exact_topk}
ORACLE_SQL = {
    "op7_exact_topk": """
WITH unit AS (
  SELECT vec_id, [x / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) FOR x IN embedding::DOUBLE[]] AS v FROM embeddings),
pairs AS (
  SELECT q.vec_id AS query_id, d.vec_id AS neighbor_id, round(list_dot_product(q.v, d.v), 6) + 0.0 AS score FROM unit q JOIN unit d ON q.vec_id <> d.vec_id AND len(q.v) = len(d.v) WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, neighbor_id) AS rank FROM pairs)
SELECT query_id, rank, neighbor_id, score FROM ranked WHERE rank <= 10
"""
}
