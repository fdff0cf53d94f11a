"""Source divergence against plain Python."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
from text_fixtures import edge, none, small  # noqa: F401

from snaptally.llm import divergence as D

NOT_TERM = re.compile("[\x00-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [t for t in NOT_TERM.split(low) if t]


def brute(rows, min_docs=3, top=200):
    """The audit of (text, lang, source) rows."""
    count, docs = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        count[lang, source].update(terms(text))
        docs[lang].update(set(terms(text)))
    out = []
    for lang in {g for g, _ in count}:
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        whole = collections.Counter()
        for (g, _), c in count.items():
            if g == lang:
                whole.update(c)
        total = lambda c: sum(c[t] for t in kept)
        weight = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (total(c) + len(kept)) for t in kept}
        f = lambda p, q: (p - q) ** 2 // q
        groups = {s: weight(c) for (g, s), c in count.items() if g == lang}
        q = weight(whole)
        for s, p in groups.items():
            pairs = sorted((-sum(f(p[t], groups[x][t]) for t in kept), x.encode(), x) for x in groups if x != s)
            own = sorted((-f(p[t], q[t]), t.encode(), t) for t in kept if count[lang, s][t] and p[t] > q[t])[:top]
            for part, ranked in (("pair", pairs), ("term", own)):
                out += [(lang, s, part, x, -v, i + 1) for i, (v, _, x) in enumerate(ranked)]
    return sorted(out)


def got(df, **params):
    return sorted(tuple(r) for r in D.audit(df, **params).collect())


def given(df):
    return [tuple(r) for r in df.select("text", "lang", "source").collect()]


def test_audit_against_plain_python(edge, small):
    assert got(edge) == brute(given(edge))
    assert got(small) == brute(given(small))


def test_few_terms_and_ranks(spark):
    rng, rows = random.Random(2), []
    for i in range(120):
        words = [rng.choice(["Straße", "ΑΣ", "a", "A", "b'c", "naïve", "x1y", "née", "\U0001f600", "z" * 40]) for _ in range(rng.randrange(9))]
        rows.append((" ".join(words) if i % 9 else None, rng.choice(["en", None, "", "de"]), rng.choice(["s", "t", "u", None, "É"])))
    rows += [("only one here", "xx", "p"), ("", "xx", "q"), (None, "xx", "r"), ("lone", "yy", "s")]
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(4)
    assert got(df) == brute(rows)
    assert got(df, min_docs=9, top=2) == brute(rows, 9, 2)
    # without kept terms the pairs are there, with value 0
    assert [r for r in got(df) if r[0] == "xx"] == [("xx", s, "pair", x, 0, i + 1) for s in "pqr" for i, x in enumerate(
        y for y in "pqr" if y != s)]


def test_empty_table_and_extra_columns(none, spark):
    assert got(none) == []
    df = spark.createDataFrame([("a a b", "en", "s", 1, 2, "p"), ("a b", "en", "t", 1, 2, "p"), ("a b", "en", "t", 1, 2, "p")],
                               "text string, lang string, source string, n int, docs int, part string")
    assert got(df) == brute(given(df))


def test_blocks_and_tiles(monkeypatch):
    """Whatever the sizes of blocks, tiles and held tables, the joint tables are the same."""
    rng = random.Random(4)
    held = [[{"source": s, "n": rng.randrange(1, 6)} for s in rng.sample("abcdef", rng.randrange(1, 7))] for _ in range(300)]
    langs = ["en"] * 200 + ["de"] * 100
    want = collections.Counter()
    for lang, groups in zip(langs, held, strict=True):
        at = sorted((g["source"], g["n"]) for g in groups)
        want.update((lang, *x, *y) for i, x in enumerate(at) for y in at[i:])
    batches = [pa.RecordBatch.from_pydict({"lang": langs[i:i + 70], "groups": held[i:i + 70]}) for i in range(0, 300, 70)]
    for block, tile, cells in ((1024, 2048, 10**6), (7, 3, 40), (300, 5, 1)):
        monkeypatch.setattr(D, "BLOCK", block)
        monkeypatch.setattr(D, "TILE", tile)
        monkeypatch.setattr(D, "CELLS", cells)
        out = collections.Counter()
        for b in D._joint(iter(batches)):
            for lang, s1, n1, s2, n2, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                out[lang, s1, n1, s2, n2] += n
        assert out == want


def test_counts_in_parts(monkeypatch):
    """Long texts are split in slices and full tables given out; the sums stay."""
    texts = ["Ab cd-é " * 50, None, "x" * 999 + " ab", "ab\x00ab"]
    want = collections.Counter(t for x in texts for t in terms(x))
    docs = collections.Counter(t for x in texts for t in set(terms(x)))
    for size, held in ((1 << 20, 10**6), (5, 1)):
        monkeypatch.setattr(D, "SLICE", size)
        monkeypatch.setattr(D, "HELD", held)
        rows = [pa.RecordBatch.from_pydict({"lang": ["en"], "source": ["s"], "text": pa.array([x or ""], pa.string())}) for x in texts]
        n, d = collections.Counter(), collections.Counter()
        for b in D._count(iter(rows)):
            for _, _, t, x, y in zip(*(c.to_pylist() for c in b.columns), strict=True):
                n[t] += x
                d[t] += y
        assert n == want and d == docs


def test_weight_of_great_counts(spark):
    """10^9 times a count passes a bigint."""
    rows = [(0, 0, 1), (10**12, 10**13, 10**7), (9 * 10**9, 9 * 10**9, 1)]
    df = spark.createDataFrame(rows, "n long, total long, v long")
    assert [r.p for r in df.select(D.weight(df.n, df.total, df.v).alias("p")).collect()] == [
        1 + 10**9 * (n + 1) // (t + v) for n, t, v in rows]
    assert np.float32(D.BLOCK) < 2**24


