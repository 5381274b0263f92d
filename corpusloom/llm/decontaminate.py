"""Benchmark decontamination: n-gram seeds, an exact bound on common words, then Smith-Waterman alignment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .common import anti, table

MATCH, MISMATCH, GAP = 2, -1, -1


def align(item: np.ndarray, passage: np.ndarray) -> int:
    """Smith-Waterman local alignment score of two word sequences (hashes), linear gaps."""
    if not len(item) or not len(passage):
        return 0
    slope = np.arange(len(passage) + 1, dtype=np.int64) * -GAP
    prev = np.zeros(len(passage) + 1, np.int64)
    best = 0
    for w in item:
        diag = prev[:-1] + np.where(passage == w, MATCH, MISMATCH)
        here = np.concatenate([[0], np.maximum(np.maximum(diag, prev[1:] + GAP), 0)])
        prev = np.maximum.accumulate(here + slope) - slope
        best = max(best, int(prev.max()))
    return best


class _Items:
    """Word hashes and seeds of benchmark items, one for each row of ids and texts that has words."""

    def __init__(self, ids: list[int], texts: list[str | None], n: int):
        self.ids, self.words = [], []
        for i, t in zip(ids, texts, strict=True):
            w = K.word_hashes(t or "")
            if i is not None and len(w):
                self.ids.append(i)
                self.words.append(w)
        seeds = []
        for w in self.words:  # an item shorter than n is one seed of all its words
            seeds.append(K.ngram_hash(w, np.zeros(len(w), np.int64), min(n, len(w)))[0])
        self.sizes = sorted({min(n, len(w)) for w in self.words})
        seed = np.concatenate([np.zeros(0, np.uint64), *seeds])
        order = np.argsort(seed, kind="stable")
        self.seed = seed[order]
        self.item = np.repeat(np.arange(len(seeds)), [len(g) for g in seeds])[order]
        self.offset = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(g)) for g in seeds)])[order].astype(np.int64)
        self.unique = np.unique(seed)
        self.maybe = None  # tells most n-grams that are no seed by their first bits
        if len(self.unique) > 256:
            self.maybe = np.zeros(1 << 20, np.bool_)
            self.maybe[(self.unique >> np.uint64(44)).astype(np.int64)] = True

    def hits(self, g: np.ndarray) -> np.ndarray:
        """Indices of the n-grams that are seeds."""
        at = np.arange(len(g)) if self.maybe is None else np.flatnonzero(self.maybe[(g >> np.uint64(44)).astype(np.int64)])
        where = np.searchsorted(self.unique, g[at])
        return at[self.unique[np.minimum(where, len(self.unique) - 1)] == g[at]]


def _slack(m: int, min_score: float) -> int:
    """Words of a passage beyond the item's m that an alignment of min_score can pass over: a match gains 2, each of them costs 1."""
    return max(0, int(MATCH * m * (1 - min_score) + 1e-9))


def _score_row(h: np.ndarray, lo: int, hi: int, at: np.ndarray, item: np.ndarray, offset: np.ndarray, min_score: float) -> float:
    """Best alignment of an item with the passages around its seeds (of seed offsets offset, at words at) of one document [lo, hi).

    The score is over that of the whole item. A passage reaches as far as an alignment of min_score through its seed can. One
    that holds too few of the item's words to reach min_score is not aligned.
    """
    m = len(item)
    slack = _slack(m, min_score)
    a = np.maximum(lo, at - offset - slack)
    b = np.minimum(hi, at - offset + m + slack)
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    top = np.maximum.accumulate(b)
    cut = np.flatnonzero(a[1:] > top[:-1]) + 1
    best = 0
    for x, y in zip(a[np.concatenate([[0], cut]).astype(int)], top[np.concatenate([cut - 1, [len(a) - 1]]).astype(int)], strict=True):
        passage = h[int(x) : int(y)]
        if np.isin(item, passage).sum() / m >= min_score:
            best = max(best, align(item, passage))
    return best / (MATCH * m)


def _scores(text, known: _Items, min_score: float) -> Iterator[tuple[int, int, float]]:
    """(row of text, item, score) of min_score or more; a very long text may tell a pair more than once."""
    if not len(known.seed):
        return
    reach = max(len(w) + 2 * _slack(len(w), min_score) for w in known.words)
    for i, _, body, offsets, _ in K.pieces(text, back=reach):
        s, e, row = K.words(body, offsets)
        h = K.span_hash(K.prefix_hash(body), s, e)
        at_all, g_all = [], []
        for n in known.sizes:
            g, at = K.ngram_hash(h, row, n)
            ok = known.hits(g)
            at_all.append(at[ok])
            g_all.append(g[ok])
        at, g = np.concatenate(at_all), np.concatenate(g_all)
        a, b = np.searchsorted(known.seed, g, "left"), np.searchsorted(known.seed, g, "right")
        times = b - a
        hit = np.repeat(np.arange(len(g)), times)
        which = np.arange(len(hit)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(a, times)
        key = row[at[hit]] * len(known.ids) + known.item[which]
        order = np.argsort(key, kind="stable")
        hit, which, key = hit[order], which[order], key[order]
        cuts = np.flatnonzero(np.diff(key)) + 1
        for x, y in zip([0, *cuts], [*cuts, len(key)], strict=True):
            if x == y:
                continue
            r, k = divmod(int(key[x]), len(known.ids))
            lo, hi = np.searchsorted(row, [r, r + 1])
            score = _score_row(h, int(lo), int(hi), at[hit[x:y]], known.words[k], known.offset[which[x:y]], min_score)
            if score >= min_score:
                yield i + r, k, score


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = 3,
    min_score: float = 0.5,
    max_broadcast_bytes: int = 64 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, score): documents that hold a copy of a benchmark item, exact, edited or paraphrased in part.

    Seeds are the items' word n-grams, all of them: one that is common may be the only one left of an item that leaked edited,
    and how often a seed stands in the corpus does not tell a common phrase from an item that leaked often. Where a document
    holds a seed, the words around, as far as an alignment of min_score through the seed can reach, are aligned with the item
    (Smith-Waterman on words: match 2, mismatch and gap -1), unless they hold too few of the item's words to reach min_score in
    any order. score is the best alignment score over that of the whole item; pairs of min_score or more are told. Case and
    punctuation do not count. A copy that keeps no n words in a row of the item has no seed and is not found.

    The benchmark is sent to all tasks if its texts are of max_broadcast_bytes at most. Beyond that the seeds are a table:
    documents' n-grams are joined to it by a shuffle. Both ways give the same rows.

    Ids are whole numbers. Null ids, and null or wordless texts of either side, match nothing. Rows that repeat an item_id, with
    equal or other texts, are texts of one item, and rows that repeat a doc_id of one document: their pair has the best score.
    Texts are worked on in pieces of about 1 MB, whatever their length. Other columns are not looked at. An empty table on either
    side gives no rows.
    """
    items = benchmark.select(F.col(item_col).cast("bigint").alias("item"), F.col(item_text_col).cast("string").alias("text")).where("item is not null and text is not null")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    picked = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null and text is not null")
    found = (_by_broadcast if size <= max_broadcast_bytes else _by_join)(picked, items, n, min_score)
    return found.groupBy("id", "item").agg(F.max("score").alias("score")).select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "score")


_FOUND = "id bigint, item bigint, score double"


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names)


def _by_broadcast(picked: DataFrame, items: DataFrame, n: int, min_score: float) -> DataFrame:
    rows = items.distinct().collect()
    known = _Items([r[0] for r in rows], [r[1] for r in rows], n)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(b.column(0)[r].as_py(), known.ids[k], s) for r, k, s in _scores(b.column(1), known, min_score)]
            if out:
                yield _batch(out, ["id", "item", "score"])

    return picked.mapInArrow(score, _FOUND)


def _by_join(picked: DataFrame, items: DataFrame, n: int, min_score: float) -> DataFrame:
    """The same for a benchmark of any size: seeds are a table of (seed, width, text key), and each candidate pair gets its two texts."""
    spark = picked.sparkSession
    texts = items.distinct().withColumn("key", F.xxhash64("item", "text"))

    def item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                known = _Items([key], [text], n)
                if len(known.seed):
                    m = len(known.unique)
                    yield pa.RecordBatch.from_arrays([pa.array(known.unique.view(np.int64)), pa.array([known.sizes[0]] * m, pa.int32()), pa.array([key] * m, pa.int64())], ["seed", "width", "key"])

    seeds = texts.select("key", "text").mapInArrow(item_seeds, "seed bigint, width int, key bigint")
    sizes = sorted(r[0] for r in seeds.select("width").distinct().collect())
    if not sizes:
        return spark.createDataFrame([], _FOUND)

    def doc_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, _, body, offsets, _ in K.pieces(b.column(1), back=max(sizes)):
                s, e, row = K.words(body, offsets)
                h = K.span_hash(K.prefix_hash(body), s, e)
                for size in sizes:
                    g, at = K.ngram_hash(h, row, size)
                    pair = np.unique(np.stack([g, row[at].astype(np.uint64)]), axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array(pair[0].view(np.int64)), b.column(0).take(pa.array(i + pair[1].astype(np.int64)))], ["gram", "id"])

    grams = picked.mapInArrow(doc_grams, "gram bigint, id bigint")
    pairs = grams.join(seeds.select("seed", "key").distinct(), F.col("gram") == F.col("seed")).select("id", "key").distinct()
    full = pairs.join(picked, "id").join(texts.withColumnRenamed("text", "item_text"), "key").select("id", "item", "text", "item_text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in range(b.num_rows):
                ident, item, text, item_text = (b.column(c).slice(r, 1) for c in range(4))
                known = _Items(item.to_pylist(), item_text.to_pylist(), n)
                out += [(ident[0].as_py(), known.ids[k], s) for _, k, s in _scores(text, known, min_score)]
            if out:
                yield _batch(out, ["id", "item", "score"])

    return full.mapInArrow(score, _FOUND)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """docs without those of contamination(); rows of a null id stay, as do null and empty texts."""
    return anti(docs, contamination(docs, benchmark, **options).select("doc_id").distinct(), options.get("id_col", "doc_id"))


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op1_benchmark_decontamination": op1_benchmark_decontamination}
ORACLE_SQL: dict[str, str] = {}
