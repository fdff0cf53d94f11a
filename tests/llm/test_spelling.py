"""Spelling variants against plain Python."""

import collections
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from text_fixtures import edge, none, small  # noqa: F401

from snaptally.llm import spelling as S


def word_counts(rows):
    """Counts of the kept words of (doc_id, text)."""
    out = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out[run] += len(run) >= 7
    return {w: n for w, n in out.items() if n >= 2}


def edits(word, letters):
    for i in range(len(word) + 1):
        for c in letters:
            yield word[:i] + c + word[i:]
        if i < len(word):
            yield word[:i] + word[i + 1:]
            for c in letters:
                yield word[:i] + c + word[i + 1:]


def brute(n, factor=10):
    letters = {c for w in n for c in w}
    form, near = {}, {}
    for w in n:
        if len(w) > 60:  # too many edits to list
            near[w] = {x for x in n if x != w and abs(len(x) - len(w)) < 2 and len(x) > 50 and bool(
                S.one_edit(*(np.frombuffer(y.encode("latin-1"), np.uint8)[None] for y in sorted((w, x), key=len)))[0])}
        else:
            near[w] = {x for x in edits(w, letters) if x in n and x != w}
        best = min(((-n[x], x) for x in near[w]), default=None)
        form[w] = best[1] if best and -best[0] >= factor * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=str)


def got(df, **params):
    return sorted((tuple(r) for r in S.variants(df, **params).collect()), key=str)


def test_variants_against_plain_python(edge, small):
    for df in (edge, small):
        want = brute(word_counts([tuple(r) for r in df.select("doc_id", "text").collect()]))
        assert got(df) == want
    assert any(r[1] for r in want) and any(r[4] > 1 for r in want)


def made(rng, n, alphabet="abcé×ÿ", length=(6, 12)):
    base = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(*length))) for _ in range(n)]
    for _ in range(3 * n):
        w = list(rng.choice(base))
        k = rng.randrange(len(w))
        w[k:k + rng.randrange(2)] = rng.choice(["", *alphabet])
        base.append("".join(w))
    return base


def test_chains_ties_and_counts(spark):
    rng = random.Random(9)
    some = sorted(set(made(rng, 60)))
    text = [(w, 2 * 10 ** rng.randrange(4)) for w in some]
    rows = [(i % 7 if i % 5 else None, " ".join([w] * min(n, 500))) for i, (w, k) in enumerate(text) for n in [k] * -(-k // 500)]
    rows += [(1, None), (2, ""), (3, "Straßen STRASSEN straßen ÉCLAIRS éclairs ÉCLAIRS"), (4, "xy" * 9000 + " " + "xy" * 9000 + " " + "xy" * 8999 + "x 7")]
    rows += [(5, "xy" * 8999 + "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute(word_counts(rows))
    assert got(df) == want
    assert any(r[1] and r[2] != r[1] for r in want)  # a chain
    assert got(df, factor=3) == brute(word_counts(rows), 3)


@pytest.mark.parametrize("leaf", [5, 40])
def test_leaves_lose_no_pair(spark, monkeypatch, leaf):
    """Small leaves and nodes: many cells, every pair met once (the tasks' functions run here in one process)."""
    rng = random.Random(leaf)
    some = sorted({w for w in made(rng, 250) if len(w) >= 5})
    n = {w: rng.randrange(1, 30) for w in some}
    monkeypatch.setattr(S, "LEAF", leaf)
    monkeypatch.setattr(S, "NODE", 3)
    monkeypatch.setattr(S, "CHECKS", 50)
    known = spark.createDataFrame(list(n.items()), "word string, n long")
    trees = S.top_trees(known)
    assert sum(t.n for t in trees.values()) > 10
    routed = pa.Table.from_batches(list(S.router(trees)(iter(pa.RecordBatch.from_pydict(
        {"word": some[i:i + 64], "n": [n[w] for w in some[i:i + 64]]}) for i in range(0, len(some), 64)))))
    near, best = collections.Counter(), {}
    for cell in set(routed.column("cell").to_pylist()):
        part = routed.filter(pc.equal(routed.column("cell"), cell))
        for r in S.answer(part).to_pylist():
            near[r["word"]] += r["near"]
            if r["near"]:
                best[r["word"]] = min(best.get(r["word"], (0, "")), (-r["best_n"], r["best"]))
    for w, form, _, _, k, _ in brute(n, 2):
        assert near[w] == k
        assert form is None or best[w] == (-n[form], form)


def test_vectors_never_pass_the_edits():
    rng = random.Random(1)
    for w in made(rng, 100, "abcdeéÿàzz", (3, 9)):
        for x in list(edits(w, "aéz"))[:80]:
            if x and x != w:
                a, b = (S.vectors(S.letters([y], len(y))) for y in (w, x))
                assert np.bitwise_count(a ^ b).sum() <= (2 if len(x) == len(w) else 1)


def test_empty_table(none):
    assert got(none) == []
