"""Bulk-synchronous best-fit packing of documents into fixed-length training sequences."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .common import materialize, partitions, table
from .substring_dedup import SPACE

SHIFT = 40


def _word_heads(body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    head = ~SPACE[body]
    if len(body):
        inner = head.copy()
        head[1:] &= SPACE[body[:-1]]
        first = offsets[:-1][np.diff(offsets) > 0]
        head[first] = inner[first]
    return head


_STATE = "kind int, value bigint, first bigint, n bigint"
_SWEPT = f"{_STATE}, rank bigint, per bigint, gap bigint, part int, open boolean"
DOCS, GAPS, MATCH, LEFT = 0, 1, 2, 3


def _sweep(runs: list[tuple[int, int, int, int]]) -> Iterator[tuple]:
    """One upward sweep over runs (kind, value, first, n) of documents of one size and of sequences of one gap; _SWEPT rows without part.

    Documents not yet matched lie on a stack, the greatest on top. A gap takes from the top, which is the document of which it is
    the successor among the gaps: as many of that size as it holds, the lesser ranks first. What a gap becomes is not matched
    again in this sweep. open marks what found no partner here.
    """
    stack: list[list[int]] = []
    for kind, value, first, n in sorted(runs, key=lambda r: (r[1], r[0], r[2])):
        if kind == DOCS:
            stack.append([value, first, n])
            continue
        while n and stack:
            size, rank, left = stack[-1]
            per = value // size
            use = min(n, -(-left // per))
            placed = min(left, use * per)
            yield MATCH, size, first, placed, rank, per, value, False
            full, rest = divmod(placed, per)
            if full and value > per * size:
                yield GAPS, value - per * size, first, full, None, None, None, False
            if rest:
                yield GAPS, value - rest * size, first + full, 1, None, None, None, False
            first, n = first + use, n - use
            if placed == left:
                stack.pop()
            else:
                stack[-1] = [size, rank + placed, left - placed]
        if n:
            yield GAPS, value, first, n, None, None, None, True
    for size, rank, left in stack:
        yield DOCS, size, rank, left, None, None, None, True


def _left(runs: list[tuple[int, int, int]], capacity: int) -> tuple[int | None, int, int, int, int]:
    """(least size, greatest gap, runs, words of the documents that no gap holds, how many of these are greater than half of capacity)."""
    docs = [(value, n) for kind, value, n in runs if kind == DOCS]
    most = max((value for kind, value, _ in runs if kind == GAPS), default=0)
    stuck = [(value, n) for value, n in docs if value > most]
    return min((v for v, _ in docs), default=None), most, len(runs), sum(v * n for v, n in stuck), sum(n for v, n in stuck if 2 * v > capacity)


def _sweeper(capacity: int | None):
    """A task that sweeps what its partition holds: runs, which its range bounds. With a capacity (that is, where one task has come to
    hold everything) a row of kind LEFT tells _left() of the outcome too."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, part = [], None
        for b in batches:
            runs += zip(*(b.column(c).to_pylist() for c in ("kind", "value", "first", "n")), strict=True)
            part = b.column("part")[0].as_py() if b.num_rows else part
        out = list(_sweep(runs))
        if out and capacity:
            least, most, n, words, great = _left([(r[0], r[1], r[3]) for r in out if r[0] != MATCH], capacity)
            out.append((LEFT, least, most, n, words, great, None, False))
        if out:
            kinds = (pa.int32(), *[pa.int64()] * 6)
            cols = [pa.array(c, k) for c, k in zip(zip(*(r[:7] for r in out), strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([part] * len(out), pa.int32()), pa.array([r[7] for r in out])], ["kind", "value", "first", "n", "rank", "per", "gap", "part", "open"])

    return task


def _sweep_round(state: DataFrame, runs: int, task_runs: int, capacity: int) -> DataFrame:
    """A sweep over all runs by range partitions. What found no partner in its range is swept again with that of the ranges next to
    it, by eights, until one range is left: the matches are those of one sweep over everything."""
    parts = max(1, -(-runs // task_runs))
    if parts == 1:
        return materialize(state.repartition(1).withColumn("part", F.lit(0)).mapInArrow(_sweeper(capacity), _SWEPT))
    ranged = state.repartitionByRange(parts, "value", "kind", "first").withColumn("part", F.spark_partition_id())
    swept = materialize(ranged.mapInArrow(_sweeper(None), _SWEPT))
    done = swept.where("not open")
    while parts > 1:
        parts = -(-parts // 8)
        left = swept.where("open").select("kind", "value", "first", "n", F.floor(F.col("part") / 8).cast("int").alias("part"))
        swept = materialize(left.repartitionById(parts, F.col("part")).mapInArrow(_sweeper(None), _SWEPT))
        done = done.unionByName(swept if parts == 1 else swept.where("not open"))
    return done


def _rounds_task(capacity: int):
    """All rounds of plan_bins() over what one partition holds: MATCH rows, and a LEFT row with the sequences opened and the rounds."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = [r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("kind", "value", "first", "n")), strict=True)]
        out, bins, rounds = [], 0, 0
        while True:
            least, _, _, words, great = _left([(kind, value, n) for kind, value, _, n in state], capacity)
            if least is None:
                break
            state = [r for r in state if r[0] == DOCS or r[1] >= least]
            if words:
                opened = great or -(-words // capacity)
                state.append((GAPS, capacity, bins, opened))
                bins += opened
            swept = list(_sweep(state))
            out += [r for r in swept if r[0] == MATCH]
            state = [r[:4] for r in swept if r[0] != MATCH]
            rounds += 1
        out.append((LEFT, None, bins, rounds, None, None, None, False))
        kinds = (pa.int32(), *[pa.int64()] * 6)
        cols = [pa.array(c, k) for c, k in zip(zip(*(r[:7] for r in out), strict=True), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays([*cols, pa.array([0] * len(out), pa.int32()), pa.array([False] * len(out))], ["kind", "value", "first", "n", "rank", "per", "gap", "part", "open"])

    return task


def _left_of(state: DataFrame, capacity: int) -> tuple[int | None, int, int, int, int]:
    """_left() of a state of any size."""
    size = F.when(F.col("kind") == DOCS, F.col("value"))
    least, most, runs = state.agg(F.min(size), F.coalesce(F.max(F.when(F.col("kind") == GAPS, F.col("value"))), F.lit(0)), F.count("*")).first()
    words, great = state.where(size > most).agg(F.coalesce(F.sum(size * F.col("n")), F.lit(0)), F.coalesce(F.sum(F.when(2 * size > capacity, F.col("n"))), F.lit(0))).first()
    return least, most, runs, words, great


def plan_bins(sizes: DataFrame, capacity: int, task_runs: int = 1 << 16) -> tuple[np.ndarray, int, int]:
    """Bulk-synchronous best fit over (size, n); (rows of (size, first rank, bin, per bin, position), bins, rounds).

    Documents of one size are alike but for their rank, so the sweeps go over runs of them, and of sequences (of consecutive
    numbers) with equal gaps. A round sorts both by size, matches documents with their successors among the gaps by a sweep, where
    documents that want one gap go by size and rank, updates the gaps and repeats. Before a round, documents that no gap holds
    open sequences: one for each that is greater than half of one, else as many as their words fill.

    While all runs fit one range partition (task_runs), its task goes through the rounds without waiting for others; beyond that a
    round is a job over range partitions, written to the shared folder. Both give the same rows.
    """
    spark = sizes.sparkSession
    state = sizes.select(F.lit(DOCS).alias("kind"), F.col("size").alias("value"), F.lit(0).cast("bigint").alias("first"), "n")
    least, _, runs, words, great = _left_of(state, capacity)
    if runs <= task_runs:
        swept = state.repartition(1).mapInArrow(_rounds_task(capacity), _SWEPT).select("kind", "value", "rank", "first", "per", "gap", "n").collect()
        rows = [(r["value"], r["rank"], r["first"], r["per"], capacity - r["gap"]) for r in swept if r["kind"] == MATCH]
        told = next((r for r in swept if r["kind"] == LEFT), None)
        return np.array(rows, np.int64).reshape(-1, 5), *((told["first"], told["n"]) if told else (0, 0))
    matches, bins, rounds = [], 0, 0
    while least is not None:
        state = state.where((F.col("kind") == DOCS) | (F.col("value") >= least))
        if words:
            opened = great or -(-words // capacity)
            state = state.unionByName(spark.createDataFrame([(GAPS, capacity, bins, opened)], _STATE))
            bins += opened
        swept = _sweep_round(state, runs + 1, task_runs, capacity)
        matches.append(swept.where(F.col("kind") == MATCH).select(F.col("value").alias("size"), "rank", F.col("first").alias("bin"), "per", (capacity - F.col("gap")).alias("position")))
        state = swept.where(F.col("kind") < MATCH).select("kind", "value", "first", "n")
        told = swept.where(F.col("kind") == LEFT).select("value", "first", "n", "rank", "per").first()
        least, _, runs, words, great = told or _left_of(state, capacity)
        rounds += 1
    rows = [tuple(r) for r in reduce(DataFrame.unionByName, matches).collect()] if matches else []
    return np.array(rows, np.int64).reshape(-1, 5), bins, rounds


def _small(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """b in slices of about K.SLICE_BYTES of text; as it is where it has no text."""
    if "text" not in b.schema.names:
        yield b
    else:
        for i, j, _, _ in K.slices(b.column("text"), lower=False):
            yield b.slice(i, j - i)


def _split(text: str, capacity: int) -> list[str]:
    """text cut before every capacity-th word; together the pieces are the text."""
    raw = text.encode()
    heads = np.flatnonzero(_word_heads(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])))
    cuts = [0, *heads[capacity::capacity].tolist(), len(raw)]
    return [raw[x:y].decode() for x, y in zip(cuts[:-1], cuts[1:], strict=True)]


def pack(docs: DataFrame, capacity: int = 2048, with_text: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(bin_id, position, doc_id, piece, start, n_tokens[, text]): every word of docs in a sequence of capacity words at most.

    Tokens are words between white space. A document of capacity words or more gives full pieces, each a sequence of its
    own, and its rest is packed like a short document, by bulk best fit over the whole table: documents are range-sorted by
    (size, id) and ranked, plan_bins() matches sizes with gaps in rounds of distributed sweeps, and every document finds its
    sequence by its rank. start is the piece's first word in the document, position its first word in the sequence.
    Sequences are numbered from 0, those of full pieces after the others. The driver gets a row for each pair of a range partition
    and a size, and one for each match of a size with a run of gaps, which both grow with the capacity, not with the documents.

    Null, empty and blank texts have no pieces. Rows that repeat an id are documents of their own; rows of a null id too
    (they rank first among equal sizes). Documents of equal size and id are packed in no particular order. Ids are whole numbers.
    Words are counted in pieces of about 1 MB of a long text. Other columns are not looked at. An empty table gives no rows.
    """
    spark = docs.sparkSession
    fields = "id bigint, size bigint, full bigint" + (", text string" if with_text else "")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = np.zeros(b.num_rows, np.int64)
            for i, j, body, offsets, _ in K.pieces(b.column(1), lower=False, marks=~SPACE):
                seen = np.concatenate([[0], np.cumsum(_word_heads(body, offsets))])
                n[i:j] += seen[offsets[1:]] - seen[offsets[:-1]]
            some = pa.array(n > 0)
            cols = [b.column(0), pa.array(n % capacity), pa.array(n // capacity), b.column(1)][: 4 if with_text else 3]
            yield pa.RecordBatch.from_arrays([c.filter(some) for c in cols], ["id", "size", "full", "text"][: len(cols)])

    picked = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    sized = picked.mapInArrow(measure, fields)
    ranged = sized.repartitionByRange(partitions(spark), "size", "id").sortWithinPartitions("size", "id").withColumn("part", F.spark_partition_id())

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, seen, full = -1, 0, 0
        for b in batches:
            if not b.num_rows:
                continue
            s = b.column("size").to_numpy()
            head = np.flatnonzero(np.diff(s, prepend=-1))
            run = np.arange(len(s)) - np.repeat(head, np.diff([*head, len(s)]))
            if s[0] == size:
                run[: head[1] if len(head) > 1 else len(s)] += seen
            size, seen = int(s[-1]), int(run[-1]) + 1
            f = b.column("full").to_numpy()
            before = full + np.cumsum(f) - f
            full += int(f.sum())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(run), pa.array(before)], [*b.schema.names, "run", "before"])

    ranked = materialize(ranged.mapInArrow(rank, fields + ", part int, run bigint, before bigint"))
    parts = sorted((r["part"], r["size"], r["n"], r["full"]) for r in ranked.groupBy("part", "size").agg(F.count("*").alias("n"), F.sum("full").alias("full")).toLocalIterator())
    count: dict[int, int] = {}
    run_at: dict[tuple[int, int], int] = {}
    full_at: dict[int, int] = {}
    fulls = 0
    for part, size, n, full in parts:
        run_at[part, size] = count.get(size, 0)
        count[size] = count.get(size, 0) + n
        full_at.setdefault(part, fulls)
        fulls += full
    sizes = ranked.where("size > 0").groupBy("size").agg(F.count("*").alias("n"))
    plan, bins, _ = plan_bins(materialize(sizes), capacity)
    plan_key = (plan[:, 0] << SHIFT) + plan[:, 1]
    by = np.argsort(plan_key)
    plan, plan_key = plan[by], plan_key[by]
    shared = spark.sparkContext.broadcast((plan, plan_key, run_at, full_at))
    out_fields = "bin_id bigint, position bigint, doc_id bigint, piece bigint, start bigint, n_tokens bigint" + (", text string" if with_text else "")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, plan_key, run_at, full_at = shared.value
        for b in chain.from_iterable(_small(b) for b in batches):
            if not b.num_rows:
                continue
            size, full, part, run, before = (b.column(c).to_numpy() for c in ("size", "full", "part", "run", "before"))
            pair = (part.astype(np.int64) << SHIFT) + size
            keys, inverse = np.unique(pair, return_inverse=True)
            base = np.array([run_at[int(k >> SHIFT), int(k & ((1 << SHIFT) - 1))] for k in keys], np.int64)[inverse]
            start_full = np.array([full_at[int(k >> SHIFT)] for k in keys], np.int64)[inverse]
            pieces = full + (size > 0)
            doc = np.repeat(np.arange(len(size)), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            rest = piece == full[doc]
            bin_id = bins + start_full[doc] + before[doc] + piece
            position = np.zeros(len(doc), np.int64)
            n = np.where(rest, size[doc], capacity)
            r = (base + run)[doc[rest]]
            s = size[doc[rest]]
            if len(r):
                at = np.searchsorted(plan_key, (s << SHIFT) + r, side="right") - 1
                step = plan[at]
                k = r - step[:, 1]
                bin_id[rest] = step[:, 2] + k // step[:, 3]
                position[rest] = step[:, 4] + (k % step[:, 3]) * s
            cols = [pa.array(bin_id), pa.array(position), b.column("id").take(pa.array(doc)), pa.array(piece), pa.array(piece * capacity), pa.array(n)]
            names = ["bin_id", "position", "doc_id", "piece", "start", "n_tokens"]
            if with_text:
                values: list[str] = []
                for raw, parts in zip(b.column("text").to_pylist(), pieces.tolist(), strict=True):
                    values += [raw] if parts == 1 else _split(raw, capacity)
                text = pa.array(values, pa.string())
                cols.append(text)
                names.append("text")
            yield pa.RecordBatch.from_arrays(cols, names)

    return ranked.mapInArrow(place, out_fields)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


QUERIES = {"op8_best_fit_packing": op8_best_fit_packing}
ORACLE_SQL: dict[str, str] = {}
