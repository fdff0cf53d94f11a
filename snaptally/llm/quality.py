"""Quality rules: counting rules, then distribution divergence from language references.

A document's character-class histogram and its common-word histogram (fixed values in
``features``) are compared to each language's reference by Jensen-Shannon distance (base 2,
0 to 1). The divergence that a sample of the document's length has from its own source,
(bins - 1) / (8 ln 2 n), is taken off first, so short documents are not judged by noise, and
documents with fewer than ``min_words`` words are not judged by the divergence at all. A
document is compared to its own language's reference and those of the languages with common
words (``features.COMMON``); it passes if, for some
reference, the two distances as shares of ``max_char`` and ``max_word`` add up to 1 at most. A
document without a language is compared to all references of its script (most letters inside or
outside ASCII). One whose language has no reference is compared to them by its characters alone, as
words of another language prove nothing. Where no reference has its script, it is not judged.

A language value with ``min_texts`` different texts that pass the counting rules and the length guard has a
reference: the mean of their normalised histograms, each different text once, so copies have one vote.
References are one row of about a hundred numbers per language value.

Defined cases: null text is empty; a text under 20 words fails the counting rules; without
a reference the divergence judges nothing; a null language, or one of fewer than ``min_texts`` texts, gives no reference;
repeated rows are judged alike; other columns pass through, one named as the result column
is replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaptally.llm import arrow as A
from snaptally.llm import features as X

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
KIND = T.StructType([*[T.StructField(c, T.LongType()) for c in COUNTS], T.StructField("base_failed", T.BooleanType()),
                     T.StructField("char_distance", T.DoubleType()), T.StructField("word_distance", T.DoubleType()),
                     T.StructField("nearest", T.StringType()), T.StructField("kept", T.BooleanType())])
PROFILE = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("base_failed", T.BooleanType()),
                        T.StructField("chars", T.ArrayType(T.DoubleType())),
                        T.StructField("words", T.ArrayType(T.DoubleType()))])


def base_failed(c: dict) -> bool:
    return c["n_words"] < 20 or 100 * c["n_repeat_words"] > 30 * c["n_words"]


def share(h: np.ndarray) -> np.ndarray:
    return h / max(h.sum(), 1)


def js_distance(p: np.ndarray, q: np.ndarray, n: float = np.inf) -> float:
    """Jensen-Shannon distance (base 2) of p to the reference q, less what a sample of n items is off by."""
    m = (p + q) / 2

    def part(x):
        at = x > 0
        return float((x[at] * np.log2(x[at] / m[at])).sum())
    noise = (np.count_nonzero(q > 1e-3) - 1) / (8 * math.log(2) * n)
    return math.sqrt(max(0.0, (part(p) + part(q)) / 2 - noise))


def profiles(texts: list[bytes]) -> list[dict]:
    out = []
    for raw in texts:
        words = raw.split()
        failed = base_failed({"n_words": len(words), "n_repeat_words": X.repeated_words(words)})
        out.append({"n_words": len(words), "base_failed": failed,
                    "chars": [] if failed else share(X.char_histogram(raw)).tolist(),
                    "words": [] if failed else share(X.word_histogram(raw)).tolist()})
    return out


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
               min_words: int = 60, min_texts: int = 5) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """language -> (character-class reference, common-word reference)."""
    if lang_col not in docs.columns:
        return {}
    d = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).where(
        F.col("lang").isNotNull())
    p = A.with_result(d, "text", "p", PROFILE, profiles).select("lang", F.xxhash64("text").alias("text_hash"), "p.*")
    p = p.where(~F.col("base_failed") & (F.col("n_words") >= min_words)).dropDuplicates(["lang", "text_hash"])
    n_chars, n_words = len(X.CLASSES) - 1, len(X.WORDS) + 1
    means = p.groupBy("lang").agg(F.count(F.lit(1)).alias("__n"), *[F.avg(F.get("chars", F.lit(i))).alias(f"c{i}") for i in range(n_chars)],
                                  *[F.avg(F.get("words", F.lit(i))).alias(f"w{i}") for i in range(n_words)])
    means = means.where(F.col("__n") >= min_texts)
    return {r["lang"]: (np.array([r[f"c{i}"] for i in range(n_chars)]), np.array([r[f"w{i}"] for i in range(n_words)]))
            for r in means.collect()}  # one row per language value


def wide_script(chars: np.ndarray) -> bool:
    """Whether most letters are outside ASCII."""
    letters = {k: chars[X.CLASSES.index(k)] for k in ("lower", "upper", "wide")}
    return letters["wide"] > letters["lower"] + letters["upper"]


def assess(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", out: str = "quality", min_words: int = 60,
           min_texts: int = 5, max_char: float = 0.33, max_word: float = 0.55) -> DataFrame:
    """docs with ``out``: struct of the counts, base_failed, the nearest reference's distances, kept."""
    refs = references(docs, text_col, lang_col, min_words, min_texts)

    def per_text(texts, langs):
        rows = []
        for raw, lang in zip(texts, langs, strict=True):
            words = raw.split()
            c = X.base_counts(raw, words)
            failed = base_failed(c)
            r = {**c, "base_failed": failed, "kept": not failed, "nearest": None,
                 "char_distance": None, "word_distance": None}
            if refs and c["n_words"] >= min_words:
                chars, common = X.char_histogram(raw), X.word_histogram(raw)
                known = str(lang) in refs if lang is not None else False
                by_words = known or lang is None
                near_refs = {k: v for k, v in refs.items() if k == str(lang) or k in X.COMMON} if known else {
                    k: v for k, v in refs.items() if wide_script(v[0]) == wide_script(chars)}
                far = {k: (js_distance(share(chars), a, chars.sum()), js_distance(share(common), b, max(common.sum(), 1)))
                       for k, (a, b) in near_refs.items()}
                total = {k: c / max_char + (w / max_word if by_words else 0) for k, (c, w) in far.items()}
                if total:
                    near = min(total, key=lambda k: (total[k], k))
                    r["nearest"], (r["char_distance"], r["word_distance"]) = near, far[near]
                    r["kept"] = not failed and total[near] <= 1
            rows.append(r)
        return rows
    if not refs:  # nothing to compare to, with or without a language column
        return A.with_result(docs, text_col, out, KIND, lambda texts: per_text(texts, [None] * len(texts)))
    return A.with_result(docs, text_col, out, KIND, per_text, also=lang_col)


def keep(docs: DataFrame, **params) -> DataFrame:
    """The documents that pass, with their own columns."""
    return assess(docs, out="__quality", **params).where("__quality.kept").select(*docs.columns)


def digest(judged: DataFrame, id_col: str = "doc_id", out: str = "quality") -> DataFrame:
    """The query's columns from assess()."""
    return judged.select(F.col(id_col).alias("doc_id"), *[F.col(f"{out}.{f.name}") for f in KIND.fields])


