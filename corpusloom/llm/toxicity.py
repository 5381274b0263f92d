"""Toxicity: logistic regression on word features, regularised by counterfactual swaps of identity terms."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .common import materialize, table

BITS = 20
PREFIXES = (4, 5)
#: Terms of a group are swapped for the next of the group, and for a neutral word.
IDENTITY_GROUPS: tuple[tuple[str, ...], ...] = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"), ("female", "male"), ("transgender", "cisgender"),
    ("gay", "lesbian", "bisexual", "straight"), ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab"), ("african", "american", "european", "mexican", "chinese", "indian", "russian"),
    ("immigrant", "refugee", "native"), ("immigrants", "refugees", "natives"), ("blind", "deaf", "disabled", "autistic"), ("old", "young", "elderly", "teenage"),
    ("mujeres", "hombres"), ("femmes", "hommes"), ("frauen", "männer"), ("musulmanes", "cristianos", "judíos"), ("musulmans", "chrétiens", "juifs"), ("muslime", "christen", "juden"),
)
NEUTRAL = "person"


def _columns(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def word_features(body: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(columns of each word: the word and its prefixes, the words' row, the words' hash)."""
    s, e, row = K.words(body, offsets)
    p = K.prefix_hash(body)
    h = K.span_hash(p, s, e)
    out = [_columns(h)]
    for n in PREFIXES:
        with np.errstate(over="ignore"):
            out.append(_columns(K.mix64(K.span_hash(p, s, np.minimum(e, s + n)) + np.uint64(n))))
    return out, row, h


def _term_columns(term: str) -> np.ndarray:
    body, offsets = K.raw_text(pa.array([term], pa.string()))
    return np.concatenate(word_features(body, offsets)[0])


def presences(text, known: np.ndarray | None = None, used: np.ndarray | None = None) -> Iterator[tuple[int, int, np.ndarray, list[tuple[int, int]]]]:
    """(first row, row after the last, sorted keys row << BITS | column, (row, hash) of known words) of rows; rows count from the first.

    used, if given, tells which columns are wanted. A long text is gone through in pieces.
    """
    held = None
    for i, j, body, offsets, at in K.pieces(text):
        features, row, h = word_features(body, offsets)
        key = []
        for c in features:
            at_used = slice(None) if used is None else np.flatnonzero(used[c])
            key.append((row[at_used] << BITS) | c[at_used])
        key = np.unique(np.concatenate(key))
        term = np.flatnonzero(np.isin(h, known)) if known is not None else np.zeros(0, np.int64)
        terms = set(zip(row[term].tolist(), h[term].tolist(), strict=True))
        if held is not None and at:
            key, terms = np.union1d(held[2], key), terms | set(held[3])
        elif held is not None:
            yield held
        held = (i, j, key, sorted(terms))
    if held is not None:
        yield held


class _Swaps:
    """Counterfactual partners of identity terms, by word hash."""

    def __init__(self, groups: tuple[tuple[str, ...], ...]):
        neutral = _term_columns(NEUTRAL)
        self.by: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for g in groups:
            for k, term in enumerate(g):
                own = _term_columns(term)
                partners = [_term_columns(g[(k + 1) % len(g)]), neutral]
                self.by[int(K.word_hashes(term)[0])] = [(own, p) for p in partners]
        self.known = np.array(sorted(self.by), np.uint64)


@dataclass
class ToxicityModel:
    columns: np.ndarray
    values: np.ndarray
    bias: float
    threshold: float

    def logits(self, text) -> np.ndarray:
        w = np.zeros(1 << BITS, np.float64)
        w[self.columns] = self.values
        used = w != 0
        out = []
        for i, j, key, _ in presences(text, used=used):
            out.append(self.bias + np.bincount(key >> BITS, weights=w[key & ((1 << BITS) - 1)], minlength=j - i))
        return np.concatenate(out) if out else np.zeros(0)


def fit(keep: np.ndarray, rows: list[tuple[int, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]], swap_weight: float = 4.0, ridge: float = 1e-3, rounds: int = 200) -> ToxicityModel | None:
    """Logistic regression on the columns keep (sorted).

    rows: (label, the indices in keep of the columns present, the counterfactual swaps as (columns lost, columns won)). The loss is
    the class-balanced log-loss, plus ridge, plus swap_weight times the mean squared change of score over all swaps of labelled
    rows. Every fifth row is held out; the threshold is the one of the best F1 there. None if only one label is there.
    """
    y = np.array([r[0] for r in rows], np.float64)
    if not len(y) or y.min() == y.max():
        return None
    swapped = [s for r in rows for s in r[2]]
    kept = [r[1] for r in rows]
    row = np.repeat(np.arange(len(rows)), [len(c) for c in kept])
    cols = np.concatenate(kept)
    d_row = np.concatenate([np.zeros(0, np.int64), *(np.full(len(a) + len(b), k) for k, (a, b) in enumerate(swapped))])
    d_col = np.concatenate([np.zeros(0, np.int64), *(np.concatenate([a, b]) for a, b in swapped)])
    d_val = np.concatenate([np.zeros(0), *(np.concatenate([-np.ones(len(a)), np.ones(len(b))]) for a, b in swapped)])
    at = np.minimum(np.searchsorted(keep, d_col), max(0, len(keep) - 1))
    ok = keep[at] == d_col if len(keep) else np.zeros(len(d_col), np.bool_)
    d_row, d_col, d_val = d_row[ok], at[ok], d_val[ok]

    fold = np.arange(len(y)) % 5 == 4
    if not (y[fold].any() and y[~fold].any() and (1 - y[fold]).any() and (1 - y[~fold]).any()):
        fold[:] = False
    weight = np.where(y > 0, 0.5 / max(1.0, y[~fold].sum()), 0.5 / max(1.0, (1 - y[~fold]).sum())) * ~fold
    w = np.zeros(len(keep) + 1)
    m1 = np.zeros_like(w)
    m2 = np.zeros_like(w)
    for t in range(1, rounds + 1):
        logit = np.bincount(row, weights=w[cols], minlength=len(y)) + w[-1]
        r = weight * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y)
        g = np.append(np.bincount(cols, weights=r[row], minlength=len(keep)), r.sum())
        g[:-1] += ridge * w[:-1]
        if len(d_row):
            delta = np.bincount(d_row, weights=d_val * w[d_col], minlength=len(swapped))
            g[:-1] += swap_weight * np.bincount(d_col, weights=d_val * delta[d_row], minlength=len(keep)) / len(swapped)
        m1 = 0.9 * m1 + 0.1 * g
        m2 = 0.99 * m2 + 0.01 * g * g
        w -= 0.1 * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.99**t)) + 1e-8)
    logit = np.bincount(row, weights=w[cols], minlength=len(y)) + w[-1]
    judge = fold if fold.any() else ~fold
    order = np.argsort(-logit[judge], kind="stable")
    s, hit = logit[judge][order], y[judge][order]
    tp = np.cumsum(hit)
    f1 = 2 * tp / (np.arange(1, len(s) + 1) + hit.sum())
    f1[:-1][s[1:] == s[:-1]] = -1
    best = int(np.argmax(f1))
    threshold = float(s[best] + s[best + 1]) / 2 if best + 1 < len(s) else float(s[best])
    return ToxicityModel(keep, w[:-1], float(w[-1]), threshold)


def train(
    docs: DataFrame,
    labels: DataFrame,
    max_train_rows: int = 10000,
    min_z: float = 3.0,
    groups: tuple[tuple[str, ...], ...] = IDENTITY_GROUPS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    **options,
) -> ToxicityModel | None:
    """A model from the labelled rows, or from a sample of about max_train_rows of them, by a hash of the id.

    Rows with a null id, label or text are left out. An id labelled twice counts as toxic if one of its labels is; of documents
    that repeat an id the least text is learnt from. Columns are screened on the cluster by the z-score of their rate among
    toxic and other rows (min_z), so the driver gets those alone, of the sampled rows alone. None if only one label is there.
    """
    known = labels.select(F.col(id_col).cast("bigint").alias("key"), F.col(label_col).cast("int").alias("y")).where("key is not null and y is not null").groupBy("key").agg((F.max("y") > 0).cast("int").alias("y"))
    share = min(1.0, max_train_rows / max(1, known.count()))
    sample = known.where(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    picked = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null and text is not null")
    # max_train_rows bounds the sample, so it may go to every task whatever the corpus.
    joined = picked.join(F.broadcast(sample), F.col("id") == F.col("key")).groupBy("id").agg(F.max("y").alias("y"), F.min("text").alias("text"))

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        swaps = _Swaps(groups)
        for b in batches:
            for i, j, key, terms in presences(b.column(2), swaps.known):
                cuts = np.searchsorted(key, np.arange(j - i + 1) << BITS)
                own: dict[int, list[int]] = {}
                for r, h in terms:
                    own.setdefault(r, []).append(h)
                columns = [(key[cuts[k] : cuts[k + 1]] & ((1 << BITS) - 1)).astype(np.int32).tobytes() for k in range(j - i)]
                found = [np.array(own.get(k, []), np.uint64).tobytes() for k in range(j - i)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), pa.array(columns, pa.binary()), pa.array(found, pa.binary())], ["id", "y", "columns", "terms"])

    features = materialize(joined.mapInArrow(featurise, "id bigint, y int, columns binary, terms binary"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, toxic = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
        for b in batches:
            for y, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):  # a row has each of its columns once
                c = np.frombuffer(raw, np.int32)
                total[c] += 1
                toxic[c] += y
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at]), pa.array(toxic[at])], ["c", "total", "toxic"])

    n, n1 = features.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not 0 < n1 < n:
        return None
    rate = F.col("total") / n
    z = (F.col("toxic") / n1 - (F.col("total") - F.col("toxic")) / (n - n1)) / F.sqrt(F.greatest(rate * (1 - rate), F.lit(1e-12)) * (1 / n1 + 1 / (n - n1)))
    counts = features.select("y", "columns").mapInArrow(count, "c bigint, total bigint, toxic bigint").groupBy("c").agg(F.sum("total").alias("total"), F.sum("toxic").alias("toxic"))
    keep = np.sort(np.array([r[0] for r in counts.where((F.col("total") >= 2) & (F.abs(z) >= min_z)).select("c").collect()], np.int64))

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = np.full(1 << BITS, -1, np.int32)
        at[keep] = np.arange(len(keep))
        for b in batches:
            kept = [at[np.frombuffer(raw, np.int32)] for raw in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([c[c >= 0].tobytes() for c in kept], pa.binary()), b.column(3)], ["id", "y", "columns", "terms"])

    swaps = _Swaps(groups)
    rows = [(r[1], np.frombuffer(r[2], np.int32).astype(np.int64), [s for t in np.frombuffer(r[3], np.uint64) for s in swaps.by[int(t)]]) for r in sorted(features.mapInArrow(screen, features.schema).collect())]
    return fit(keep, rows, **options)


def score(docs: DataFrame, model: ToxicityModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, toxic) of every row: score is the probability, toxic whether it passes the model's threshold.

    A null or wordless text is scored by the bias alone and never toxic; without a model scores are null. Null ids and rows
    that repeat an id are scored like any other. Ids are whole numbers. Texts are worked on in pieces of about 1 MB. Other columns
    are not looked at. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            if m is None:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.nulls(b.num_rows, pa.float64()), pa.array([False] * b.num_rows)], ["doc_id", "score", "toxic"])
                continue
            x = m.logits(b.column(1))
            toxic = (x >= m.threshold) & (x > m.bias)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(1 / (1 + np.exp(-np.clip(x, -500, 500)))), pa.array(toxic)], ["doc_id", "score", "toxic"])

    picked = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id bigint, score double, toxic boolean")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxic documents and their scores."""
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels"))).where("toxic").select("doc_id", "score")


QUERIES = {"op3_toxicity": op3_toxicity}
ORACLE_SQL: dict[str, str] = {}
