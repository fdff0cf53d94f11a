"""Quality classifier: Bradley-Terry scores from preference pairs, thresholded by quantile.

A document of label 1 is preferred to one of label 0: P(i over j) = sigmoid(w (x_i - x_j)).
w is fitted by Newton steps on the regularised logistic loss of feature differences. Only
texts give features; labels, language, source and id never do.

The weights are fitted on a sample of at most ``max_labels`` labelled rows (those with the smallest hash of
their id, so the bound is the only thing that depends on the corpus size); ``pairs_each``
pairs per sampled row. Everything else covers all documents.

The decision threshold is the score quantile at label 0's share over all labelled training rows, found by
two counts in ``BINS`` equal bins (the second inside the bin of the first); the score is
a sigmoid of the distance to it that is ``cut`` (0.3) there.

Defined cases: null text is empty (its features are 0 and it gets a score); null labels and
labels without a document are left out; without both labels all scores are ``cut``; a document
with several labels is several rows; of an id with several texts the sample takes the one of the smallest
hash, the threshold all of them; repeated rows are scored alike; other
columns pass through, one named as the result column is replaced; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
from operator import eq, itemgetter

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaptally.llm import arrow as A
from snaptally.llm import base as B
from snaptally.llm import features as X

KIND = T.StructType([T.StructField("raw", T.DoubleType()), T.StructField("score", T.DoubleType()),
                     T.StructField("predicted", T.IntegerType())])
RAW = T.StructType([T.StructField("raw", T.DoubleType())])
BINS = 4096
UPPER = bytes(range(ord("A"), ord("Z") + 1))
# what is no ASCII sign: letters, digits and bytes of longer characters
BARE = bytes(c for c in range(256) if c >= 0x80 or chr(c).isalnum())
VECTOR = T.StructType([T.StructField("x", T.ArrayType(T.DoubleType()))])


def vector(raw: bytes) -> list[float]:
    """Features of one text: shares and logarithms, and their squares."""
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * SIZE
    c = X.base_counts(raw, words)
    chars = X.char_histogram(raw)
    all_chars = max(int(chars.sum()), 1)
    common = X.word_histogram(raw)
    lines = [x for x in raw.split(b"\n") if x.strip(X.SPACES)]
    lengths = np.fromiter(map(len, words), np.int64, n)
    firsts, lasts = bytes(map(itemgetter(0), words)), bytes(map(itemgetter(-1), words))
    ends = n - len(lasts.translate(None, b".!?"))
    same = sum(map(eq, words, words[1:]))
    line_words = n / max(len(lines), 1)
    x = [math.log1p(n), math.log1p(line_words), float(lengths.mean()), float(lengths.std()),
         *(chars / all_chars).tolist(), c["n_symbols"] / all_chars, c["n_dup_lines"] / max(len(lines), 1),
         c["n_repeat_words"] / n, len(set(words)) / n, 1 - common[-1] / max(common.sum(), 1), ends / n, same / n,
         sum(map(bytes.isupper, words)) / n, (n - len(firsts.translate(None, UPPER))) / n,
         len(firsts.translate(None, BARE)) / n, raw.count(b"!") / n, raw.count(b"|") / n,
         raw.count(b",") / n, raw.count(b"http") / n, float(lengths.max()) / all_chars]
    return [*x, *(v * v for v in x), *(math.sqrt(abs(v)) for v in x)]


SIZE = 3 * (4 + len(X.CLASSES) - 1 + 15)


def train_rows(id_col: str = "doc_id", parts: int = 5, held: int = 0) -> Column:
    """True for rows that may be learned from: crc32(id as text) mod ``parts`` is not ``held``."""
    return F.crc32(F.col(id_col).cast("string")) % parts != held


def labelled(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """``__id, __y``: each label of the rows that may be learned from, once."""
    return labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__y")).where(
        F.col("__y").isin(0, 1) & F.col("__id").isNotNull() & train_rows("__id")).distinct()


def sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           label_col: str = "quality", max_labels: int = 10_000) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of a bounded sample of the labelled training rows, one text per id."""
    own = labelled(labels, id_col, label_col).orderBy(F.xxhash64("__id"), "__id", "__y").limit(max_labels)
    # the sample is the bounded side
    d = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(F.broadcast(own), "__id")
    rows = (A.with_result(d, "__text", "v", VECTOR, lambda ts: [{"x": vector(t)} for t in ts])
            .groupBy("__id", "__y").agg(F.min(F.struct(F.xxhash64("__text").alias("h"), "v.x")).alias("v"))
            .select("__id", "__y", "v.x").collect())  # max_labels rows at most
    rows.sort(key=lambda r: (r["__id"], r["__y"]))
    return np.array([r["x"] for r in rows], dtype=float).reshape(-1, SIZE), np.array([r["__y"] for r in rows], dtype=int)


class Model:
    """score(x) = sigmoid(scale * (w z(x) - threshold) + logit(cut)), z: standardised features."""

    def __init__(self, mean, spread, w, threshold, scale, cut):
        self.mean, self.spread, self.w = mean, spread, w
        self.threshold, self.scale, self.cut = threshold, scale, cut

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -6, 6) @ self.w

    def score(self, raw: np.ndarray) -> np.ndarray:
        z = self.scale * (raw - self.threshold) + math.log(self.cut / (1 - self.cut))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, pairs_each: int = 8, ridge: float = 1.0, cut: float = 0.3, seed: int = 5,
        steps: int = 30) -> Model:
    """Bradley-Terry weights by Newton steps; threshold at these rows' quantile of label 0's share."""
    mean = x.mean(axis=0) if len(x) else np.zeros(SIZE)
    spread = np.where((s := x.std(axis=0) if len(x) else np.ones(SIZE)) > 1e-9, s, 1.0)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return Model(mean, spread, np.zeros(x.shape[1] if len(x) else SIZE), 0.0, 1.0, cut)
    z = np.clip((x - mean) / spread, -6, 6)
    rng = np.random.default_rng(seed)
    winners = np.concatenate([np.repeat(good, pairs_each), rng.choice(good, len(bad) * pairs_each)])
    losers = np.concatenate([rng.choice(bad, len(good) * pairs_each), np.repeat(bad, pairs_each)])
    d = z[winners] - z[losers]
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(d @ w, -40, 40)))  # chance of the wrong order
        step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d + ridge * np.eye(len(w)), d.T @ p - ridge * w)
        size = np.abs(step).max()
        w = w + step * min(1.0, 2.0 / size if size else 1.0)
        if size < 1e-6:
            break
    raw = z @ w
    threshold = float(np.quantile(raw, len(bad) / len(y)))
    return Model(mean, spread, w, threshold, 1.0, cut)


def quantile(values: DataFrame, share: float, rounds: int = 2) -> float | None:
    """The value of column ``raw`` that ``share`` of the rows do not pass, to a bin's width of the last
    round. Each round is one aggregate of ``BINS`` rows, the same however the rows are parted."""
    ends = values.agg(F.min("raw").alias("a"), F.max("raw").alias("b"), F.count("raw").alias("n")).first()
    low, high, need = ends["a"], ends["b"], share * (ends["n"] or 0)
    if not ends["n"]:
        return None
    for _ in range(rounds):
        width = (high - low) / BINS
        if width <= 0:
            break
        place = F.least(F.floor((F.col("raw") - F.lit(low)) / F.lit(width)), F.lit(BINS - 1)).alias("bin")
        bins = sorted(values.where(F.col("raw").between(low, high)).groupBy(place).count().collect())
        for at, n in bins:
            if n >= need:
                break
            need -= n
        low, high = low + at * width, min(low + (at + 1) * width, high)
    return high


def threshold(docs: DataFrame, labels: DataFrame, model: Model, id_col: str, text_col: str, label_col: str) -> float:
    """The score quantile at label 0's share over all labelled training rows of ``docs``.

    Texts become scores where they are read, so that no text is shuffled to its label."""
    own = labelled(labels, id_col, label_col)
    d = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).where(train_rows("__id"))

    def per_text(texts):
        return [{"raw": r} for r in model.raw(np.array([vector(t) for t in texts], dtype=float).reshape(-1, SIZE)).tolist()]
    scored = A.with_result(d, "__text", "v", RAW, per_text).select("__id", "v.raw")
    rows = B.materialise(scored.join(own, "__id").select("__y", "raw"), "classifier-raw")
    bad = rows.agg(F.avg(1 - F.col("__y"))).first()[0]
    at = None if bad is None or bad in (0.0, 1.0) else quantile(rows, bad)
    return model.threshold if at is None else at


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", out: str = "quality",
          cut: float = 0.3, max_labels: int = 10_000, label_col: str = "quality", **params) -> DataFrame:
    """docs with ``out``: struct<raw, score, predicted>."""
    model = fit(*sample(docs, labels, id_col, text_col, label_col, max_labels), cut=cut, **params)
    model.threshold = threshold(docs, labels, model, id_col, text_col, label_col)

    def per_text(texts):
        raw = model.raw(np.array([vector(t) for t in texts], dtype=float).reshape(-1, SIZE))
        got = model.score(raw)
        return [{"raw": r, "score": s, "predicted": int(s >= cut)} for r, s in zip(raw.tolist(), got.tolist(), strict=True)]
    return A.with_result(docs, text_col, out, KIND, per_text)


def digest(scored: DataFrame, id_col: str = "doc_id", out: str = "quality") -> DataFrame:
    """The query's columns from score()."""
    return scored.select(F.col(id_col).alias("doc_id"), F.coalesce(~train_rows(id_col), F.lit(False)).alias("held_out"),
                         F.col(f"{out}.score"), F.col(f"{out}.predicted"))
