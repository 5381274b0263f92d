"""Substring deduplication by content-defined chunking with a gear rolling hash."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import kernels as K
from .common import fresh, partitions, table

WINDOW = 16
MAX_BYTES = 1024
GEAR = np.random.default_rng(0x6EA2).integers(0, 1 << 32, 256, dtype=np.uint32)
_BASE2 = 0xD6E8FEB86659FD93
_BASE2_INV = pow(_BASE2, -1, 1 << 64)
SPACE = np.zeros(256, np.bool_)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def gear(body: np.ndarray) -> np.ndarray:
    """Gear hash of the WINDOW bytes that end at each byte, h(i) = sum of GEAR[b(i-k)] << k."""
    h = GEAR[body]
    step = 1
    while step < WINDOW:
        g = h.copy()
        g[step:] += h[:-step] << np.uint32(step)
        h, step = g, step * 2
    return h


def chunk_spans(body: np.ndarray, offsets: np.ndarray, bits: int, before: int = 0, within: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row, whether it starts at a row or a cut of the first kind) of the chunks of all rows, in order; together they cover every byte.

    A cut may follow a run of white space where ``bits`` bits of the gear hash are zero, so a chunk holds 2**bits words on
    average and cuts depend on the last WINDOW bytes alone. A stretch of over MAX_BYTES without such a cut is cut at any
    character where eight bits are zero, and what then is longer yet, every MAX_BYTES (at the next character's start).

    To go on within a long row, body starts ``before`` bytes ahead of a chunk's start (WINDOW at least), where ``within`` tells
    that it is a cut of the second kind; positions count from that start, and offsets are those of one row without these bytes.
    """
    h, body = gear(body)[before:], body[before:]
    n = len(body)
    lens = np.diff(offsets)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z, z.astype(np.bool_)
    space = SPACE[body]
    ends_run = space.copy()
    ends_run[:-1] &= ~space[1:]
    cut = np.flatnonzero(ends_run & ((h >> np.uint32(16 - bits)) & np.uint32((1 << bits) - 1) == 0)) + 1
    row = np.searchsorted(offsets, cut, side="left") - 1
    cut = cut[cut - offsets[row] >= (0 if before else WINDOW)]
    bounds = first = np.unique(np.concatenate([cut, offsets[:-1][lens > 0], offsets[-1:]]))
    start, end = bounds[:-1], bounds[1:]
    long = np.flatnonzero((end - start > MAX_BYTES) | (within & (start == 0)))
    if len(long):
        extra = []
        for k in long:
            s, e = int(start[k]), int(end[k])
            heads = (body[s:e] & 0xC0) != 0x80
            inner = np.flatnonzero(heads[1:] & ((h[s : e - 1] >> np.uint32(8)) & np.uint32(255) == 0)) + 1
            inner = inner[inner >= (0 if within and s == 0 else WINDOW)]
            edges = [0, *inner.tolist(), e - s]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                while b - a > MAX_BYTES:
                    a += MAX_BYTES
                    while a < b and not heads[a]:
                        a += 1
                    if a < b:
                        extra.append(s + a)
            extra += (s + inner).tolist()
        bounds = np.unique(np.concatenate([bounds, np.array(extra, np.int64)]))
        start, end = bounds[:-1], bounds[1:]
    return start, end, np.searchsorted(offsets, start, side="right") - 1, np.isin(start, first)


def _prefix2(body: np.ndarray) -> np.ndarray:
    out = np.zeros(len(body) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((body.astype(np.uint64) + np.uint64(7)) * K._pow_table(_BASE2, len(body)), out=out[1:])
    return out


def _digests(body: np.ndarray, before: int, s: np.ndarray, e: np.ndarray, at: np.ndarray, last: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(d1, d2, place) of the bytes from chunk at to chunk last (its successor or itself); s and e count from byte before on.

    d1 and the upper 22 bits of d2 are digests of the bytes; below stand the lengths (11 bits each) and words (10 each) of both
    chunks, all told by the bytes alone. place is twice the start, and one more if a word starts there (which the byte before
    tells); that word is not among the others. rows are the bytes at which rows start.
    """
    space = SPACE[body]
    head = ~space
    head[1:] &= space[:-1]
    head[rows] = ~space[rows]
    seen = np.concatenate([[0], np.cumsum(head)])
    size, words = e - s, seen[before + e] - seen[before + s]
    lo, hi = before + s[at], before + e[last]
    d1 = K.span_hash(K.prefix_hash(body), lo, hi)
    p2 = _prefix2(body)
    with np.errstate(over="ignore"):
        d2 = K.mix64((p2[hi] - p2[lo]) * K._pow_table(_BASE2_INV, len(p2))[lo])
    two = last > at
    sizes = (size[at] << 31) | (np.where(two, size[last], 0) << 20) | ((words[at] - head[before + s[at]]) << 10) | np.where(two, words[last], 0)
    return d1, (d2 >> np.uint64(42) << np.uint64(42)) | sizes.astype(np.uint64), (s[at] << 1) | head[before + s[at]]


def _row_digests(body: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """_digests() of one long row, in pieces that each start at a chunk's start."""
    at, within, n = 0, False, len(body)
    while True:
        before, end = min(at, WINDOW), min(n, at + K.SLICE_BYTES)
        part = body[at - before : end]
        s, e, _, first = chunk_spans(part, np.array([0, end - at]), bits, before, within)
        m = len(s) if end == n else len(s) - 1  # the last chunk may go on
        d1, d2, place = _digests(part, before, s[:m], e[:m], np.arange(m - 1), np.arange(1, m), np.zeros(0, np.int64))
        yield d1, d2, (at << 1) + place
        if end == n:
            return
        within = not first[m - 1]
        at += int(s[m - 1])


def chunks(docs: DataFrame, bits: int, id_col: str, text_col: str, hot: np.ndarray | None = None, salts: int = 1) -> DataFrame:
    """(d1, d2, id, pos, salt) of every chunk with its successor in the text (a text's only chunk stands alone).

    d1 and d2 are 86 bits of digest, and lengths and words; pos is the place (_digests()). salt is 0 but for digests in hot.
    """
    hot = np.zeros(0, np.int64) if hot is None else np.sort(hot)

    def out(ids: np.ndarray, d1: np.ndarray, d2: np.ndarray, pos: np.ndarray) -> pa.RecordBatch:
        d = d1.view(np.int64)
        salt = np.zeros(len(d), np.int32)
        if len(hot):
            at = np.flatnonzero(np.isin(d, hot))
            salt[at] = 1 + (K.mix64(ids[at].astype(np.int64).view(np.uint64)) % np.uint64(salts)).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(d), pa.array(d2.view(np.int64)), pa.array(ids), pa.array(pos), pa.array(salt)], ["d1", "d2", "id", "pos", "salt"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            for i, j, body, offsets in K.slices(b.column(1), lower=False):
                if j - i == 1 and len(body) > 2 * K.SLICE_BYTES:
                    for d1, d2, pos in _row_digests(body, bits):
                        yield out(np.repeat(ids[i : i + 1], len(pos)), d1, d2, pos)
                    continue
                s, e, row, _ = chunk_spans(body, offsets, bits)
                if len(s):
                    followed = np.append(row[1:] == row[:-1], False)
                    at = np.flatnonzero(followed | (np.bincount(row)[row] == 1))
                    d1, d2, place = _digests(body, 0, s, e, at, at + followed[at], offsets[:-1][np.diff(offsets) > 0])
                    yield out(ids[i + row[at]], d1, d2, place - (offsets[row[at]] << 1))

    picked = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null and text is not null")
    return picked.mapInArrow(run, "d1 bigint, d2 bigint, id bigint, pos bigint, salt int")


def hot_digests(docs: DataFrame, bits: int, id_col: str, text_col: str, sample_docs: int, share: float) -> np.ndarray:
    """Digests that have more than share of all rows in a sample of about sample_docs documents, 1 / share at most.

    They decide how rows are spread over tasks, never what the result is.
    """
    part = min(1.0, sample_docs / max(1, docs.count()))
    sample = chunks(docs.where(F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 30)) < int(part * (1 << 30)) + 1), bits, id_col, text_col).groupBy("d1").agg(F.count("*").alias("n"))
    found = sample.orderBy(F.desc("n")).limit(int(1 / share)).collect()
    least = share * (sample.agg(F.sum("n")).first()[0] or 0) if found and found[0]["n"] > 1 else float("inf")
    return np.array([r["d1"] for r in found if r["n"] > max(1, least)], np.int64)


def repeated_spans(docs: DataFrame, bits: int = 2, min_words: int = 20, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = 10_000, hot_share: float | None = None) -> DataFrame:
    """(doc_id, start, length, words, kept_doc_ids) of each passage that stands earlier in the corpus.

    Texts are cut into content-defined chunks. A chunk is so short that it may repeat by chance, so the unit of which one
    occurrence is kept is a chunk with its successor: of equal digest, the one of the least (id, start) is kept. Those that are
    not kept and touch or overlap form a span, told if it has min_words words or more, or (text without white space) min_words
    times 16 bytes or more. start and length are UTF-8 bytes. kept_doc_ids lists, in order, the documents that hold the kept
    occurrences, which may be the document itself where a passage repeats within one.

    A digest of more than hot_share of all rows (a quarter of a partition, if not given) is spread over tasks by a salt; the
    least of each salt, a row for each, are then compared.

    Null ids and null or empty texts have no spans. Rows that repeat an id are one document: an occurrence at the same place
    of the same id is never a repeat. Ids are whole numbers. Long texts are worked on in pieces of about 1 MB. Other columns are
    not looked at. An empty table gives no rows.
    """
    parts = partitions(docs.sparkSession)
    hot = hot_digests(docs, bits, id_col, text_col, sample_docs, hot_share or 1 / (4 * parts))
    w = Window.partitionBy("d1", "d2", *(["salt"] if len(hot) else [])).orderBy("id", "pos")
    cut = chunks(docs, bits, id_col, text_col, hot, parts)
    seen = (cut if len(hot) else cut.drop("salt")).withColumn("kept", F.first(F.struct("id", "pos", *(["salt"] if len(hot) else []))).over(w))
    kept = F.col("kept")
    if len(hot):
        # 1 / hot_share rows at most; the filter looks at kept alone, so that both sides read one exchange.
        least = seen.where("kept.salt > 0 and id = kept.id and pos = kept.pos").groupBy(F.col("d1").alias("h1"), F.col("d2").alias("h2")).agg(F.min(F.struct("id", "pos", F.lit(0).alias("salt"))).alias("least"))
        seen = seen.join(F.broadcast(least), (F.col("d1") == F.col("h1")) & (F.col("d2") == F.col("h2")), "left")
        kept = F.coalesce("least", "kept")
    again = (
        seen.withColumn("kept_one", kept)
        .where("id <> kept_one.id or pos <> kept_one.pos")
        .select("id", "pos", F.col("d2").bitwiseAND(F.lit((1 << 42) - 1)).alias("sizes"), F.col("kept_one.id").alias("kept"))
    )
    size_of = lambda at, n: F.shiftright("sizes", at).bitwiseAND(F.lit((1 << n) - 1))
    by_doc = Window.partitionBy("id").orderBy("start")
    # One exchange by id serves the distinct, both windows and the grouping.
    here = again.repartition(parts, "id").distinct().select("id", F.shiftright("pos", 1).alias("start"), size_of(31, 11).alias("l1"), size_of(20, 11).alias("l2"), (size_of(10, 10) + F.col("pos").bitwiseAND(F.lit(1))).alias("w1"), size_of(0, 10).alias("w2"), "kept")
    end = F.col("start") + F.col("l1") + F.col("l2")
    goes_on = F.coalesce(F.lead("start").over(by_doc) == F.col("start") + F.col("l1"), F.lit(False))
    runs = here.withColumn("fresh", F.when(F.col("start") <= F.lag(end).over(by_doc), 0).otherwise(1)).withColumn("own", F.col("w1") + F.when(goes_on, 0).otherwise(F.col("w2")))
    runs = runs.withColumn("run", F.sum("fresh").over(by_doc))
    spans = runs.groupBy("id", "run").agg(F.min("start").alias("start"), (F.max(end) - F.min("start")).alias("length"), F.sum("own").alias("words"), F.array_sort(F.collect_set("kept")).alias("kept_doc_ids"))
    return spans.where((F.col("words") >= min_words) | (F.col("length") >= 16 * min_words)).select(F.col("id").alias("doc_id"), "start", "length", "words", "kept_doc_ids")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs without the passages of repeated_spans(); a document of which no word stays goes, n_chars (if there) is counted anew.

    Other rows and columns are as they were, also those of null ids and of null, empty and blank texts. Each row of a repeated id
    loses the spans of that id.
    """
    spans = repeated_spans(docs, id_col=id_col, text_col=text_col, **options)
    key, cuts = fresh(docs, "span_id"), fresh(docs, "span_cuts")
    gone = spans.groupBy(F.col("doc_id").alias(key)).agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias(cuts))
    joined = docs.join(gone, docs[id_col] == gone[key], "left")
    # The text is encoded once and each kept stretch copied once: linear in the text however many cuts there are.
    kept = F.expr(
        f"""transform(array(encode(`{text_col}`, 'UTF-8')), e -> array_join(transform(sequence(0, size({cuts})), k -> decode(substring(e,
            cast(if(k = 0, 0, {cuts}[k - 1].start + {cuts}[k - 1].length) + 1 as int),
            cast(if(k = size({cuts}), octet_length(e), {cuts}[k].start) - if(k = 0, 0, {cuts}[k - 1].start + {cuts}[k - 1].length) as int)), 'UTF-8')), ''))[0]"""
    )
    text = F.when(F.col(cuts).isNull(), F.col(text_col)).otherwise(kept)
    out = joined.withColumn(text_col, text).where(F.col(cuts).isNull() | F.col(text_col).rlike(r"\S"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(cuts).isNull(), F.col("n_chars")).otherwise(F.length(text_col)).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(table(spark, sf_dir, "documents"))


QUERIES = {"op2_substring_dedup": op2_substring_dedup}
ORACLE_SQL: dict[str, str] = {}
