"""Language identification by blended-spectrum string kernels and Nyström kernel ridge regression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K
from .common import fresh, table

BITS = 15
DIM = 1 << BITS
UNKNOWN = "und"
CUTS = (4, 8, 16, 32, 64, 128, 256, 512)
_LETTER = np.full(256, 32, np.uint8)
for _c in [*range(ord("a"), ord("z") + 1), *range(128, 256)]:
    _LETTER[_c] = _c


def presence(body: np.ndarray, offsets: np.ndarray, orders: tuple[int, ...], lo: int, hi: int) -> np.ndarray:
    """0/1 matrix (rows lo..hi, DIM): which byte n-grams of the given orders a row has, after all but letters become blanks.

    An n-gram's column is a hash of its bytes. Blanks alone are no n-gram, and none crosses rows.
    """
    out = np.zeros((hi - lo, DIM), np.float32)
    a, b = int(offsets[lo]), int(offsets[hi])
    x = _LETTER[body[a:b]].astype(np.uint32)
    row = np.repeat(np.arange(hi - lo), np.diff(offsets[lo : hi + 1]))
    for n in orders:
        m = len(x) - n + 1
        if m < 1:
            continue
        g = x[:m].copy()
        blank = x[:m] == 32
        for k in range(1, n):
            g = g * np.uint32(0x01000193) + x[k : k + m]
            blank &= x[k : k + m] == 32
        g = (g + np.uint32(n)) * np.uint32(0x9E3779B1)
        ok = row[:m] == row[n - 1 :]
        ok &= ~blank
        out[row[:m][ok], (g[ok] >> np.uint32(32 - BITS)).astype(np.int64)] = 1
    return out


def presences(text, orders: tuple[int, ...]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, row after the last, presence()) of lower-case rows, up to 256 at a time; a long one is gone through by parts."""
    for i, j, body, offsets in K.slices(text):
        n = len(body)
        if j - i == 1 and n > 2 * K.SLICE_BYTES:
            p = np.zeros((1, DIM), np.float32)
            for lo in range(0, n, K.SLICE_BYTES):
                part = body[lo : lo + K.SLICE_BYTES + max(orders) - 1]
                np.maximum(p, presence(part, np.array([0, len(part)]), orders, 0, 1), out=p)
            yield i, j, p
            continue
        for lo in range(0, j - i, 256):
            hi = min(lo + 256, j - i)
            yield i + lo, i + hi, presence(body, offsets, orders, lo, hi)


def pack(p: np.ndarray) -> list[bytes]:
    """Rows of presence() as bytes: the numbers of their columns, or where that is longer a bitmap of DIM / 8 bytes."""
    return [c.astype(np.uint16).tobytes() if 2 * len(c := np.flatnonzero(r)) < DIM // 8 else np.packbits(r > 0).tobytes() for r in p]


def unpack(packed: list[bytes]) -> np.ndarray:
    p = np.zeros((len(packed), DIM), np.float32)
    for k, raw in enumerate(packed):
        if len(raw) == DIM // 8:
            p[k] = np.unpackbits(np.frombuffer(raw, np.uint8))
        else:
            p[k, np.frombuffer(raw, np.uint16)] = 1
    return p


@dataclass
class LanguageModel:
    """classes, the landmarks' n-gram columns (DIM, m) in unit length, and the dual weights (m, classes).

    A row is rejected below the bounds of its length: bounds[k] holds the least score of the best class, the least lead over the
    second and the least mean kernel value with the landmarks for rows of sizes[k] n-grams or more (and under sizes[k + 1]).
    """

    classes: list[str]
    landmarks: np.ndarray
    weights: np.ndarray
    orders: tuple[int, ...]
    sizes: np.ndarray
    bounds: np.ndarray

    def __post_init__(self):
        # P (L A) = (P L) A: kernel values and scores in one product; the last column is the mean kernel value
        self.folded = np.concatenate([self.landmarks @ self.weights, self.landmarks.mean(axis=1, keepdims=True)], axis=1)

    def score(self, p: np.ndarray) -> np.ndarray:
        """(rows, classes + 2), the mean kernel value and the number of n-grams last; a row without letters has -inf scores."""
        size = p.sum(axis=1)
        s = (p @ self.folded) / np.sqrt(np.maximum(size, 1))[:, None]
        s[size == 0] = -np.inf
        return np.concatenate([s, size[:, None]], axis=1)

    def scores(self, text) -> np.ndarray:
        """score() of texts."""
        return np.concatenate([np.zeros((0, len(self.classes) + 2), np.float32), *(self.score(p) for _, _, p in presences(text, self.orders))])

    def judge(self, text) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(best class, its score, accepted) of each row."""
        s = self.scores(text)
        which = s[:, :-2].argmax(axis=1)
        best, lead, similar, size = measures(s)
        low = self.bounds[np.maximum(np.searchsorted(self.sizes, size, "right") - 1, 0)]
        return which, best.astype(np.float64), (size > 0) & (best >= low[:, 0]) & (lead >= low[:, 1]) & (similar >= low[:, 2])


def measures(s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(score of the best class, lead over the second, mean kernel value, number of n-grams) of rows of LanguageModel.scores."""
    top = np.sort(s[:, :-2], axis=1)
    with np.errstate(invalid="ignore"):
        lead = top[:, -1] - top[:, -2] if top.shape[1] > 1 else np.full(len(s), np.inf, np.float32)
    return top[:, -1], lead, s[:, -2], s[:, -1]


def fit(
    packed: list[bytes],
    langs: list[str],
    windows: list[list[bytes]],
    landmarks: int = 128,
    ridge: float = 1e-2,
    orders: tuple[int, ...] = (1, 2, 3),
    reject: float = 5e-4,
    folds: int = 5,
    groups: int = 16,
    seed: int = 3,
) -> LanguageModel:
    """One-versus-rest kernel ridge regression on Nyström features of normalised presence kernels, from pack()ed rows.

    The bounds of rejection are ``reject`` quantiles over held-out rows: each fold's rows, and windows of each of their texts, are
    scored by a model of the other folds, and taken in about ``groups`` groups (of 250 rows or more) by the number of their n-grams.
    Where no fold can be held out without losing a class, all rows with letters are accepted.
    """
    model = _regress(packed, langs, landmarks, ridge, orders, seed)
    fold = np.random.default_rng(seed).permutation(len(packed)) % folds
    found = [np.zeros((0, 4), np.float32)]
    for f in range(folds):
        rest = np.flatnonzero(fold != f).tolist()
        held = [x for i in np.flatnonzero(fold == f) for x in (packed[i], *windows[i])]
        if not rest or not held:
            continue
        other = _regress([packed[i] for i in rest], [langs[i] for i in rest], landmarks, ridge, orders, seed)
        if len(other.classes) == len(model.classes):
            found += [np.stack(measures(other.score(unpack(held[k : k + 256]))), axis=1) for k in range(0, len(held), 256)]
    rows = np.concatenate(found)
    rows = rows[rows[:, 3] > 0]
    if len(rows):
        rows = rows[np.argsort(rows[:, 3], kind="stable")]
        group = max(250, len(rows) // groups)
        model.sizes = np.unique(rows[::group, 3][: max(1, len(rows) // group)])  # the last group takes the rest
        of = np.maximum(np.searchsorted(model.sizes, rows[:, 3], "right") - 1, 0)
        model.bounds = np.stack([_low(rows[of == k, :3], len(packed), reject) for k in range(len(model.sizes))])
    return model


def _low(values: np.ndarray, texts: int, reject: float) -> np.ndarray:
    """The reject quantile of each column. Fewer rows than tell it have their least value moved out along an exponential tail."""
    low, n = np.quantile(values, reject, axis=0, method="lower"), min(len(values), texts)
    if n * reject >= 1:
        return low
    if n < 4:
        return np.full(values.shape[1], -np.inf)
    middle = np.median(values, axis=0)
    with np.errstate(invalid="ignore"):
        return np.nan_to_num(middle - (middle - low) * max(1.0, np.log(0.5 / reject) / np.log(n / 2)), nan=-np.inf)


def _windows(key: str, text: str) -> Iterator[str]:
    """A window of each of CUTS characters out of a longer text, from the start of a word where one starts in its reach; key tells where."""
    for n in CUTS:
        if len(text) > n:
            at = int.from_bytes(md5(f"{key}:{n}".encode()).digest()[:8], "big") % (len(text) - n + 1)
            blank = text.rfind(" ", max(0, at - 40), at + 1) if at else -1
            yield text[blank + 1 : blank + 1 + n] if blank >= 0 or at <= 40 else text[at : at + n]


def _regress(packed: list[bytes], langs: list[str], landmarks: int, ridge: float, orders: tuple[int, ...], seed: int) -> LanguageModel:
    """The model without bounds."""
    classes = sorted(set(langs))
    y = np.array([classes.index(c) for c in langs])
    rng = np.random.default_rng(seed)
    picked: list[int] = []
    for c in range(len(classes)):  # landmarks are spread evenly over the classes
        own = np.flatnonzero(y == c)
        picked += rng.permutation(own)[: max(1, landmarks // len(classes))].tolist()

    def unit(rows: list[bytes]) -> Iterator[np.ndarray]:
        for k in range(0, len(rows), 256):
            p = unpack(rows[k : k + 256])
            yield p / np.sqrt(np.maximum(p.sum(axis=1, keepdims=True), 1))

    marks = np.concatenate(list(unit([packed[i] for i in picked]))).T
    kernel = (marks.T @ marks).astype(np.float64)
    values, vectors = np.linalg.eigh(kernel)
    keep = values > values[-1] * 1e-6
    root = vectors[:, keep] / np.sqrt(values[keep])
    values_of = np.concatenate([u @ marks for u in unit(packed)]).astype(np.float64)
    phi = values_of @ root
    target = np.where(y[:, None] == np.arange(len(classes))[None, :], 1.0, -1.0)
    weight = 1 / np.bincount(y, minlength=len(classes))[y]  # classes count alike
    weight *= len(y) / weight.sum()
    gram = (phi * weight[:, None]).T @ phi + ridge * len(y) / 100 * np.eye(phi.shape[1])
    dual = root @ np.linalg.solve(gram, (phi * weight[:, None]).T @ target)
    return LanguageModel(classes, marks, dual.astype(np.float32), orders, np.zeros(1, np.float32), np.full((1, 3), -np.inf, np.float32))


def train(docs: DataFrame, max_train_rows: int = 2000, orders: tuple[int, ...] = (1, 2, 3), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> LanguageModel | None:
    """A model from the rows that have a language, or from a sample of about max_train_rows of them, by a hash of id and text.

    Rows of equal id, text and language count once. Texts are turned into n-gram presences where they are: the driver gets
    DIM / 8 = 4096 bytes at most for a text and for each of its len(CUTS) = 8 windows.
    None if no row has both a language and a text that is not blank.
    """
    known = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null")
    share = min(1.0, max_train_rows / max(1, known.count()))
    sample = known.where(F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1) if share < 1 else known

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                keys, langs = (b.column(c).slice(lo, 64).to_pylist() for c in (0, 2))
                texts = b.column(1).slice(lo, 64)
                whole = [x for _, _, p in presences(texts, orders) for x in pack(p)]
                out = []
                for key, lang, text, bits in zip(keys, langs, texts.to_pylist(), whole, strict=True):
                    if text.strip():
                        cut = list(_windows(key or "", text))
                        windows = [x for _, _, p in presences(pa.array(cut, pa.string()), orders) for x in pack(p)]
                        out.append((key or "", lang, bits, windows))
                if out:
                    kinds = (pa.string(), pa.string(), pa.binary(), pa.list_(pa.binary()))
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["id", "lang", "bits", "windows"])

    rows = sorted(sample.distinct().mapInArrow(featurise, "id string, lang string, bits binary, windows array<binary>").collect())
    if not rows:
        return None
    return fit([bytes(r.bits) for r in rows], [r.lang for r in rows], [[bytes(w) for w in r.windows] for r in rows], orders=orders, **options)


def identify(docs: DataFrame, model: LanguageModel | None, only_accepted: bool = False, text_col: str = "text") -> DataFrame:
    """docs with language, language_score and accepted (names get underscores where docs has them), or just its accepted rows.

    A row is rejected, with language 'und', if its text is null or holds no letter, or if its best one-versus-rest score, the lead
    of that over the second or its likeness to the landmarks is below what all but about 0.05 % of held-out labelled rows of its
    length reach. Ties go to the class first in the alphabet. Without a model all rows are rejected. All rows and columns of docs
    pass, in no order.
    """
    names = [fresh(docs, c) for c in ("language", "language_score", "accepted")]
    columns = docs.columns
    at = [c.lower() for c in columns].index(text_col.lower())
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            if m is None:
                which, best, ok = np.zeros(b.num_rows, np.int64), np.full(b.num_rows, -np.inf), np.zeros(b.num_rows, bool)
            else:
                which, best, ok = m.judge(pc.cast(b.column(at), pa.string()))
            if only_accepted:
                yield b.filter(pa.array(ok))
                continue
            label = pa.array(np.where(ok, np.array([*(m.classes if m else []), UNKNOWN], object)[which], UNKNOWN), pa.string())
            score = pa.array(np.where(np.isfinite(best), best, np.nan), pa.float64(), from_pandas=True)
            yield pa.RecordBatch.from_arrays([*b.columns, label, score, pa.array(ok)], [*columns, *names])

    added = [T.StructField(n, t) for n, t in zip(names, (T.StringType(), T.DoubleType(), T.BooleanType()), strict=True)]
    schema = docs.schema if only_accepted else T.StructType([*docs.schema.fields, *added])
    return docs.mapInArrow(run, schema)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs.select("doc_id", "text"), train(docs)).drop("text")


QUERIES = {"op4_language_id": op4_language_id}
ORACLE_SQL: dict[str, str] = {}
