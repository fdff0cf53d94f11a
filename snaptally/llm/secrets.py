"""Secret scan: fixed patterns, then sliding-window Shannon entropy of candidate strings.

A candidate is a maximal run of 20 or more of ``A-Za-z0-9+/=_-`` (trailing ``=`` are
padding). It is measured whole, without padding, by its parts between ``=/+_-``, and, where these are
groups of a key, with the groups put together; a run with a part that is a secret is one span. The character class of what is measured decides the least entropy of a window of 20 characters that
makes it a secret. The window's entropy is kept by incremental counts: with
S = sum of n log2 n over the counts, H = log2(20) - S / 20, and one step forward changes
two counts. UUIDs and words joined by separators are suppressed; placeholders,
sequences and repeated characters are masked, and what is beside them is measured. Also
suppressed are candidates inside a span found before.

Everything is one projection of Spark expressions: no shuffle, no Python.

Defined cases: null text is empty; an empty text has no span; repeated rows and null ids
are separate rows of the result; other columns pass through, one named as the result
column is replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaptally.llm import base as B

# The base patterns (look-behinds only start a run once).
ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
KINDS = [
    ("assign", ASSIGN, lambda v: F.length(F.regexp_extract(v, ASSIGN, 1)) >= 6),
    ("access", ACCESS, lambda v: F.lit(True)),
    ("hex", HEX, lambda v: F.lit(True)),
]

WINDOW = 20
CANDIDATE = r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]{20,}+"
# class of a candidate or part (the first that fits), least entropy in bits of a window.
# Words and numbers alone, and runs with separators, need nearly as many bits as 20 characters can have.
CLASSES = [
    ("hex", r"^(?=.*[0-9])(?=.*[A-Fa-f])[0-9A-Fa-f]+$", 3.0),
    ("upper", r"^(?=.*[0-9])(?=.*[A-Z])[0-9A-Z]+$", 3.4),
    ("lower", r"^(?=.*[0-9])(?=.*[a-z])[0-9a-z]+$", 3.4),
    ("alnum", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[0-9A-Za-z]+$", 3.5),
    ("base64", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[0-9A-Za-z+/_=-]+$", 3.7),
    ("mixed", r"^(?=.*[0-9])(?=.*[A-Za-z])[0-9A-Za-z+/_=-]+$", 4.0),
    ("digits", r"^[0-9]+$", 3.3),
    # letters alone are words but for changes of case that no camel has, or five consonants in a row
    # and four letters that are rare in most languages
    ("cased", r"^(?=(?:.*?(?:[A-Z][a-z][A-Z]|[a-z][A-Z]{2,4}[a-z])){2})[A-Za-z]+$", 3.6),
    ("harsh", r"^(?=.*(?i:[b-df-hj-np-tv-xz]{5}))(?=(?:.*?(?i:[jkqvwxyz])){4})[A-Za-z]+$", 3.6),
    ("other", r"^.+$", 4.1),
]
# What is known to be no secret. Masked stretches are left out and what is
# beside them is measured; whole patterns hold for all of a run or piece.
MASKED = [
    r"(?i)example|placeholder|changeme|x{6,}+|(?:^|[-_/=+])(?:sample|dummy|test|todo|your)(?=$|[-_/=+])",
    r"(?i)0123456789|1234567890|abcdefgh|qwertyui",
    r"(.)\1{5,}+",
]
WHOLE = [
    r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
    r"^(?=.*[-_/=+])(?!.*[A-Za-z]{20})[A-Za-z]++(?:[-_/=+][A-Za-z]++)*+(?:[-_/][0-9]{1,4}+)*+$",
]
# a key in groups, two of them at least of letters and digits: measured without its separators. The shape
# comes first: it bounds the groups, so the second look stays linear on long runs.
GROUPED = (r"^(?=[A-Za-z0-9]{3,8}+(?:[-_][A-Za-z0-9]{3,8}+){2,30}+$)"
           r"(?=(?:.*?(?:[A-Za-z][0-9]|[0-9][A-Za-z])[A-Za-z0-9]*+(?:[-_]|$)){2})")
# the symbols that counts are kept for, by place
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-"


def window_entropy(value: Column, width: int = WINDOW) -> Column:
    """The greatest Shannon entropy (bits) of any window of ``width`` characters.

    ``aggregate`` carries the counts and S; a step adds the entering character
    and, once the window is full, takes out the leaving one."""
    f = lambda n: F.when(n > 0, n * F.log2(F.greatest(n, F.lit(1)))).otherwise(0.0)
    zero = F.struct(F.array_repeat(F.lit(0), len(SYMBOLS)).alias("n"), F.lit(0.0).alias("s"), F.lit(0.0).alias("best"))

    def change(state, at, by):
        return B.let(F.get(state["n"], at), lambda n: F.struct(
            F.transform(state["n"], lambda x, j: F.when(j == at, x + by).otherwise(x)).alias("n"),
            (state["s"] + f(n + by) - f(n)).alias("s"), state["best"].alias("best")))

    def entered(state, i, place):
        return B.let(change(state, place(i), F.lit(1)), lambda now: F.struct(
            now["n"].alias("n"), now["s"].alias("s"), F.when(i >= width, F.greatest(
                now["best"], F.lit(math.log2(width)) - now["s"] / width)).otherwise(now["best"]).alias("best")))

    def walk(chars):  # an array of characters: a place in a string takes a scan
        place = lambda i: F.instr(F.lit(SYMBOLS), F.get(chars, i - 1)) - 1

        def step(state, i):
            return F.when(i > width, B.let(change(state, place(i - width), F.lit(-1)), lambda s: entered(s, i, place))
                          ).otherwise(entered(state, i, place))
        return F.aggregate(F.sequence(F.lit(1), F.size(chars)), zero, step, lambda s: s["best"])
    return B.let(F.split(value, ""), walk)


def _allowed(value: Column) -> Column:
    hit = F.lit(False)
    for p in WHOLE:
        hit = hit | F.rlike(value, F.lit(p))
    return hit


def _pieces(value: Column) -> Column:
    """What is measured of a candidate, from a window's length on: the stretches beside masked
    ones, without padding, and their parts."""
    masked = value
    for p in MASKED:
        masked = F.regexp_replace(masked, p, " ")
    whole = F.transform(F.split(masked, " +"), lambda s: F.regexp_replace(s, "=+$", ""))
    parts = F.split(masked, "[ =/+_-]+")
    grouped = F.transform(F.filter(F.split(masked, "[ =/+]+"), lambda s: F.rlike(s, F.lit(GROUPED))),
                          lambda s: F.regexp_replace(s, "[-_]", ""))
    return F.filter(F.array_distinct(F.concat(whole, parts, grouped)), lambda p: (F.length(p) >= WINDOW) & ~_allowed(p))


def _reaches(piece: Column) -> Column:
    """True if a window of ``piece`` has the least entropy of its class."""
    least = F.lit(None).cast("double")
    for _, p, bits in reversed(CLASSES):
        least = F.when(F.rlike(piece, F.lit(p)), F.lit(bits)).otherwise(least)
    return window_entropy(piece) >= least


def is_secret(value: Column) -> Column:
    """The verdict on one candidate: a piece that is not allow-listed reaches its class's threshold."""
    return F.when(_allowed(value), False).otherwise(F.exists(_pieces(value), _reaches))


def scan(docs: DataFrame, text_col: str = "text", out: str = "secrets") -> DataFrame:
    """docs with ``out``: struct<base, spans>, arrays of struct<start, rank, kind, end, value>."""
    tmp, cand, base = "__text", "__candidates", "__base"
    d = docs.withColumn(tmp, B.text_of(text_col))
    d = B.base_spans(d, tmp, KINDS, base).withColumn(
        cand, F.regexp_extract_all(F.col(tmp), F.lit(CANDIDATE), F.lit(0)))
    tried = F.filter(B.match_spans(F.col(tmp), F.col(cand), CANDIDATE), lambda c: ~F.exists(
        F.col(base), lambda s: (s["start"] <= c["start"]) & (c["end"] <= s["end"])) & is_secret(c["value"]))
    added = F.transform(tried, lambda c: F.struct(c["start"], F.lit(len(KINDS)).alias("rank"),
                                                  F.lit("entropy").alias("kind"), c["end"], c["value"]))
    return d.withColumn(out, F.struct(F.col(base).alias("base"), F.array_sort(
        F.concat(F.col(base), added)).alias("spans"))).drop(tmp, cand, base)


def redact(docs: DataFrame, text_col: str = "text", by: str = "[SECRET]") -> DataFrame:
    """docs with every found span of ``text_col`` replaced; a null text stays null."""
    out = "__secrets"
    d = scan(docs, text_col, out)
    clean = B.replace_spans(F.col(text_col), F.col(f"{out}.spans"), lambda s, n: F.lit(by))
    return d.withColumn(text_col, clean).select(*docs.columns)


def digest(scanned: DataFrame, id_col: str = "doc_id", out: str = "secrets") -> DataFrame:
    """The query's columns from scan()."""
    n = lambda k: F.size(F.filter(f"{out}.base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return scanned.select(F.col(id_col).alias("doc_id"), *[n(k) for k, _, _ in KINDS],
                          F.sha2(B.spans_text(F.col(f"{out}.base")), 256).alias("base_sha256"),
                          B.spans_text(F.col(f"{out}.spans")).alias("spans"))
