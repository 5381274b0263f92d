"""SimHash near-duplicates by an LSH forest."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .common import anti, materialize, partitions, table, whole_groups
from .components import connected_components

SKETCH = 128
EMPTY = 255 << 24


def _short(h: np.ndarray, count: np.ndarray) -> np.ndarray:
    """One feature for each row of word hashes: that of its first count words."""
    out = h[:, 0].copy()
    with np.errstate(over="ignore"):
        for k in range(1, h.shape[1]):
            more = count > k
            out[more] = out[more] * np.uint64(0x9FB21C651E98DF25) + h[more, k]
    return K.mix64(out)


def _features(body: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every word shingle; a row of fewer words has its whole word sequence as the only one."""
    s, e, row = K.words(body, offsets)
    h = K.span_hash(K.prefix_hash(body), s, e)
    g, at = K.ngram_hash(h, row, shingle)
    rows = row[at]
    count = np.bincount(row, minlength=len(offsets) - 1)
    short = np.flatnonzero((count > 0) & (count < shingle))
    if len(short):
        own = np.minimum(np.searchsorted(row, short)[:, None] + np.arange(shingle)[None, :], len(h) - 1)
        g, rows = np.concatenate([g, _short(h[own], count[short])]), np.concatenate([rows, short])
        order = np.argsort(rows, kind="stable")
        g, rows = g[order], rows[order]
    return g, rows


def _lows(g: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Least value of each of SKETCH bins of each row's features; EMPTY for a bin without any."""
    low = np.full(n * SKETCH, EMPTY, np.int64)
    at = rows * SKETCH + (g >> np.uint64(57)).astype(np.int64)
    value = ((g >> np.uint64(20)) & np.uint64(0xFFFFFFF)).astype(np.int64) % EMPTY
    np.minimum.at(low, at, value)
    return low.reshape(n, SKETCH)


def _sketch(low: np.ndarray) -> np.ndarray:
    """One-permutation MinHash, SKETCH bytes a row: 255 is an empty bin."""
    return np.where(low == EMPTY, 255, low % 255).astype(np.uint8)


class _Long:
    """What is kept of one row that comes in pieces: bit counts, bin minima, and the first words (for a row without a shingle)."""

    def __init__(self, row: int, shingle: int):
        self.row, self.shingle = row, shingle
        self.ones, self.total = np.zeros((1, 64), np.int64), np.zeros(1, np.int64)
        self.low = np.full((1, SKETCH), EMPTY, np.int64)
        self.head = np.zeros(0, np.uint64)

    def add(self, body: np.ndarray, offsets: np.ndarray) -> None:
        s, e, row = K.words(body, offsets)
        h = K.span_hash(K.prefix_hash(body), s, e)
        if len(self.head) < self.shingle:
            self.head = np.concatenate([self.head, h])[: self.shingle]
        self._count(K.ngram_hash(h, row, self.shingle)[0])

    def _count(self, g: np.ndarray) -> None:
        rows = np.zeros(len(g), np.int64)
        ones, total = K.bit_counts(g, rows, 1)
        self.ones, self.total, self.low = self.ones + ones, self.total + total, np.minimum(self.low, _lows(g, rows, 1))

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.total[0] and len(self.head):
            self._count(_short(self.head[None, :], np.array([len(self.head)])))
        return K.majority(self.ones, self.total), _sketch(self.low)


def _signed(ids: pa.Array, rows: np.ndarray, sig: np.ndarray, sketch: np.ndarray) -> pa.RecordBatch:
    at = np.arange(len(rows) + 1, dtype=np.int32) * SKETCH
    packed = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(sketch).reshape(-1))])
    return pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), pa.array(sig.view(np.int64)), packed], ["id", "sig", "sketch"])


def signatures(docs: DataFrame, shingle: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, sig, sketch) of each row that has an id and at least one word. A long text is worked on in pieces of about 1 MB."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ended(x: _Long | None) -> Iterator[pa.RecordBatch]:
            if x is not None and len(x.head):
                yield _signed(ids, np.array([x.row]), *x.result())

        for b in batches:
            ids, long = b.column(0), None
            for i, j, body, offsets, at in K.pieces(b.column(1), back=shingle - 1):
                if not at:
                    yield from ended(long)
                    long = _Long(i, shingle) if j - i == 1 else None
                if long is not None:
                    long.add(body, offsets)
                    continue
                g, rows = _features(body, offsets, shingle)
                has = np.flatnonzero(np.bincount(rows, minlength=j - i) > 0)
                if len(has):
                    yield _signed(ids, i + has, K.simhash64(g, rows, j - i)[has], _sketch(_lows(g, rows, j - i)[has]))
            yield from ended(long)

    picked = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null and text is not null")
    return picked.mapInArrow(run, "id bigint, sig bigint, sketch binary")


def forest_shape(n: int, hamming: int, recall: float) -> tuple[int, int]:
    """(tries, depth): the cheapest pair at which a pair of signatures that differ in ``hamming`` bits shares a prefix of
    that depth in some try with probability ``recall`` at least. Cost counts rows sent and pairs compared."""
    best = (math.inf, 1, 1)
    for depth in range(4, 41):
        share = math.comb(64 - hamming, depth) / math.comb(64, depth)
        if share <= 0:
            break
        tries = max(1, math.ceil(math.log(1 - recall) / math.log1p(-share)))
        best = min(best, (tries * (2000 + 2.0 * n / 2**depth), tries, depth))
    return best[1], best[2]


def _permutations(tries: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return np.stack([rng.permutation(64) for _ in range(tries)])


def _permute(sig: np.ndarray, order: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(sig.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return np.packbits(bits[:, order], axis=1).reshape(-1).view(">u8").astype(np.uint64)


def _prefix_masks(orders: np.ndarray, depth: int) -> np.ndarray:
    """For each try, the signature bits that make up the first depth bits of its order."""
    return np.bitwise_or.reduce(np.uint64(1) << (63 - orders[:, :depth]).astype(np.uint64), axis=1)


def forest_pairs(sigs: DataFrame, n: int, max_hamming: int, target_hamming: int, recall: float, leaf: int = 512, seed: int = 7, task_rows: int | None = None) -> DataFrame:
    """(a, b, distance), a < b: pairs of (id, sig) rows within max_hamming bits that some try brings together.

    Each try orders the signatures by a random permutation of their bits. Where a subtree holds more than ``leaf`` rows the
    prefix deepens bit by bit; sparse subtrees climb up to three bits further. Nowhere is it deeper than the depth at which
    the tries together reach the target recall, and every pair below the prefix is compared.

    A subtree of more than task_rows rows (a partition's fair share, if not given) is cut into blocks by a hash of the id, and
    each pair of blocks is a task's group of its own: all its pairs are compared, by many tasks.
    """
    tries, depth = forest_shape(n, target_hamming, recall)
    root = max(1, depth - 3)
    orders = _permutations(tries, seed)
    masks = _prefix_masks(orders, depth)
    parts = partitions(sigs.sparkSession)

    def keys(sig: np.ndarray, t: int) -> np.ndarray:
        return (t << root) | (_permute(sig, orders[t]) >> np.uint64(64 - root)).astype(np.int64)

    def only_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sig = b.column(0).to_numpy().view(np.uint64)
            for t in range(tries):
                key, count = np.unique(keys(sig, t), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(count)], ["key", "n"])

    # Subtrees beyond a partition's share: fewer than there are partitions.
    limit = task_rows or max(1 << 16, n * tries // parts)
    hot = sorted(tuple(r) for r in sigs.select("sig").mapInArrow(only_keys, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") > limit).collect())
    blocks = {k: -(-m // limit) for k, m in hot}
    first_cell, at = {}, 1
    for k, x in blocks.items():
        first_cell[k] = at
        at += x * x
    cell_start = np.array([*first_cell.values()], np.int64)
    hot_keys = np.array([*first_cell], np.int64)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sig, ids = b.column(1).to_numpy().view(np.uint64), b.column(0).to_numpy()
            for t in range(tries):
                key = keys(sig, t)
                cold = ~np.isin(key, hot_keys)
                cells, rows, side = [key[cold]], [np.flatnonzero(cold)], [np.zeros(int(cold.sum()), np.int8)]
                for k in np.unique(key[~cold]).tolist():
                    own, x = np.flatnonzero(key == k), blocks[k]
                    mine = (K.mix64(ids[own].view(np.uint64)) % np.uint64(x)).astype(np.int64)
                    for other in range(x):  # the cells (lesser block, greater block) that hold this row's block
                        cells.append(-(first_cell[k] + np.minimum(mine, other) * x + np.maximum(mine, other)))
                        rows.append(own)
                        side.append(np.where(mine == other, 2, mine > other).astype(np.int8))
                row = np.concatenate(rows)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(cells)), pa.array(np.concatenate(side)), pa.array(sig[row].view(np.int64)), pa.array(ids[row])], ["key", "side", "sig", "id"])

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def leaves(p: np.ndarray, lo: int, hi: int, d: int) -> Iterator[tuple[int, int]]:
            stack = [(lo, hi, d)]
            while stack:
                lo, hi, d = stack.pop()
                if hi - lo < 2:
                    continue
                if hi - lo <= leaf or d >= depth:
                    yield lo, hi
                    continue
                bit = np.uint64(1) << np.uint64(63 - d)
                mid = lo + int(np.searchsorted((p[lo:hi] & bit) > 0, True))
                stack += [(lo, mid, d + 1), (mid, hi, d + 1)]

        def group(key: int, side: np.ndarray, sig: np.ndarray, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
            tree = (key if key >= 0 else int(hot_keys[np.searchsorted(cell_start, -key, "right") - 1])) >> root
            p = _permute(sig, orders[tree])
            order = np.argsort(p, kind="stable")
            p, sig, ids, side = p[order], sig[order], ids[order], side[order]
            mixed = key < 0 and side[0] != 2
            for lo, hi in leaves(p, 0, len(p), root):
                step = max(1, (1 << 20) // (hi - lo))
                for a in range(lo, hi, step):
                    x = sig[a : a + step, None] ^ sig[None, a:hi]
                    i, j = np.nonzero(np.bitwise_count(x) <= max_hamming)
                    ok = j > i
                    if mixed:
                        ok &= side[a + i] != side[a + j]
                    i, j = i[ok], j[ok]
                    x = x[i, j]
                    # Of the tries that surely compare a pair, only the first tells it.
                    new = np.ones(len(x), np.bool_)
                    for m in masks[:tree]:
                        new &= (x & m) != 0
                    if new.any():
                        u, v = ids[a + i[new]], ids[a + j[new]]
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v)), pa.array(np.bitwise_count(x[new]).astype(np.int32))], ["a", "b", "distance"])

        for t in whole_groups(batches, "key"):
            key, side, sig, ids = (t.column(c).to_numpy() for c in ("key", "side", "sig", "id"))
            sig = sig.view(np.uint64)
            ends = np.flatnonzero(np.diff(key)) + 1
            for lo, hi in zip([0, *ends], [*ends, len(key)], strict=True):
                if hi - lo > 1:
                    yield from group(int(key[lo]), side[lo:hi], sig[lo:hi], ids[lo:hi])

    spread_rows = sigs.select("id", "sig").mapInArrow(spread, "key bigint, side tinyint, sig bigint, id bigint")
    grouped = spread_rows.repartition(parts, "key").sortWithinPartitions("key")
    # A pair in a climbed (shorter) prefix may be told by two tries; distinct settles those.
    return grouped.mapInArrow(match, "a bigint, b bigint, distance int").distinct()


def _verify(pairs: DataFrame, min_jaccard: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(-1, SKETCH) for c in ("sa", "sb"))
            some = (x != 255) | (y != 255)
            same = ((x == y) & some).sum(axis=1)
            ok = same >= min_jaccard * some.sum(axis=1)
            keep = pa.array(np.flatnonzero(ok))
            yield pa.RecordBatch.from_arrays([b.column("a").take(keep), b.column("b").take(keep)], ["a", "b"])

    return pairs.mapInArrow(run, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    shingle: int = 2,
    max_hamming: int = 14,
    target_hamming: int = 14,
    recall: float = 0.95,
    min_jaccard: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, rep_id, links) of every document that is not the one its group keeps; rep_id is the group's least id.

    Documents are duplicates if their 64-bit SimHash over word shingles differs in max_hamming bits at most and the Jaccard
    similarity of their shingles, estimated by a one-permutation MinHash of 128 bins, is min_jaccard at least; groups are
    the connected components. Documents of one signature and sketch form a group by an exact grouping first, so that
    thousands of equal copies cost one row in the forest. For all others the forest reaches ``recall`` for pairs that
    differ in target_hamming bits, and more for closer ones. links counts the other signatures that the document's own was
    found to be a duplicate of: 0 for a document that has equal copies only.

    Null ids and null, empty or wordless texts are in no group. Texts of fewer words than a shingle match if their words
    are equal. Rows that repeat an id are one document: they never pair with each other, and its row has the least rep_id and the
    most links of them. Of equally good representatives the least id is kept. Ids are whole numbers. Other columns are not looked
    at. An empty table gives no rows.
    """
    spark = docs.sparkSession
    sigs = materialize(signatures(docs, shingle, id_col, text_col).withColumn("sk", F.xxhash64("sketch")))
    same = materialize(sigs.groupBy("sig", "sk").agg(F.min("id").alias("rep"), F.first("sketch").alias("sketch")))
    n = same.count()
    pairs = forest_pairs(same.select(F.col("rep").alias("id"), "sig"), n, max_hamming, target_hamming, recall)
    side = same.select("rep", "sketch")
    pairs = pairs.where("a <> b").join(side.toDF("a", "sa"), "a").join(side.toDF("b", "sb"), "b").select("a", "b", "sa", "sb")
    linked = materialize(_verify(pairs, min_jaccard))
    groups = connected_components(linked)
    degree = linked.union(linked.select("b", "a")).groupBy(F.col("a").alias("of")).agg(F.count("*").alias("links"))
    reps = (
        same.select("sig", "sk", "rep")
        .join(groups, F.col("rep") == F.col("node"), "left")
        .join(degree, F.col("rep") == F.col("of"), "left")
        .select("sig", "sk", F.coalesce("component", "rep").alias("rep_id"), F.coalesce("links", F.lit(0)).alias("links"))
    )
    members = sigs.select("id", "sig", "sk").join(reps, ["sig", "sk"])
    return members.where("id <> rep_id").groupBy(F.col("id").alias("doc_id")).agg(F.min("rep_id").alias("rep_id"), F.max("links").alias("links"))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """docs with one document of each group of near_duplicates(): the one of the least id.

    Rows of a null id, and null, empty or wordless texts, stay; rows that repeat an id stay or go together.
    """
    id_col = options.get("id_col", "doc_id")
    return anti(docs, near_duplicates(docs, **options).select("doc_id"), id_col)


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op9_simhash_near_dedup": op9_simhash_near_dedup}
ORACLE_SQL: dict[str, str] = {}
