"""Personal data, secrets, mixing and chat formatting: Spark expressions against plain Python."""

import collections
import math
import random
import time

import brute as X
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from text_fixtures import edge, none, small  # noqa: F401

from snaptally.llm import base as B
from snaptally.llm import chat, mixing, pii, secrets


def by_row(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def check_spans(df, got, kinds):
    want = by_row((r.doc_id, *(sum(s[2] == k for s in X.spans(r.text or "", kinds)) for k, _, _ in kinds),
                   X.sha(X.spans_text(X.spans(r.text or "", kinds)))) for r in df.collect())
    rows = got.collect()
    assert by_row(tuple(r)[:len(kinds) + 2] for r in rows) == want
    return rows


def test_pii_base_spans(edge, small):
    for df in (edge, small):
        check_spans(df, pii.digest(pii.detect(df)), X.PII)


def test_secret_base_spans(edge, small):
    for df in (edge, small):
        rows = check_spans(df, secrets.digest(secrets.scan(df)), X.SECRETS)
        text = {r.doc_id: r.text or "" for r in df.collect()}
        for r in rows:
            base = X.spans_text(X.spans(text[r.doc_id], X.SECRETS))
            assert {s for s in base.split(",") if s} <= set(r.spans.split(","))


def test_span_operators_on_empty_tables(none):
    assert pii.digest(pii.detect(none)).count() == 0
    assert pii.sanitise(none).columns == none.columns
    assert secrets.digest(secrets.scan(none)).count() == 0


def test_extra_columns_stay(edge):
    out = secrets.scan(edge)
    assert out.columns == [*edge.columns, "secrets"] and out.count() == edge.count()
    clean = secrets.redact(edge)
    assert clean.columns == edge.columns
    assert clean.where("text is null").count() == 1
    assert pii.sanitise(edge).columns == edge.columns and pii.sanitise(edge).count() == edge.count()


def test_many_matches_in_one_text(spark):
    text = " ".join(f"u{i}@h{i}.org" for i in range(3000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    d = B.base_spans(df, "text", pii.KINDS, "s").first()["s"]
    assert [(s.start, s.end) for s in d] == [(a, z) for a, _, _, z in X.spans(text, X.PII)]


def test_long_texts_take_linear_time(spark):
    """Quadratic steps would take minutes here."""
    began = time.time()
    mails = spark.createDataFrame([(1, " ".join(f"u{i}@h{i}.org" for i in range(32_000)))], "doc_id long, text string")
    d = B.base_spans(mails, "text", pii.KINDS, "s")
    assert d.select(F.size("s"), F.length(B.replace_spans(F.col("text"), F.col("s"), lambda s, n: F.lit("[X]")))
                    ).first()[:] == (32_000, 32_000 * 4 - 1)
    many = spark.createDataFrame([(1, "a@b.cc " + " ".join(f"w{i}" for i in range(40_000)))], "doc_id long, text string")
    d = B.base_spans(many, "text", pii.KINDS, "s")
    assert d.select(F.size(pii._terms(F.col("text"), F.col("s")))).first()[0] == 40_000
    turns = spark.range(40_000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(
        F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.lit("ok </s>").alias("text"))
    assert chat.digest(chat.format_conversations(turns)).first()["n_turns"] == 40_000
    assert time.time() - began < 60


def test_replaced_spans_against_plain_python(spark):
    rng, rows = random.Random(8), []
    for i in range(200):
        text = "".join(rng.choice("abc\U0001f600é ") for _ in range(rng.randrange(0, 900)))
        n = rng.choice([0, 1, 5, 300]) if text else 0
        spans = sorted({(a, min(len(text), a + rng.randrange(1, 9))) for a in (rng.randrange(len(text)) for _ in range(n))})
        rows.append((i, text, spans))
    df = spark.createDataFrame(rows, "i int, text string, spans array<struct<start:bigint,end:bigint>>")
    got = {r.i: r.t for r in df.select("i", B.replace_spans(F.col("text"), F.col("spans"), lambda s, n: F.concat(
        F.lit("<"), n.cast("string"), F.lit(">"))).alias("t")).collect()}
    for i, text, spans in rows:
        out, at, k = "", 0, 0
        while k < len(spans):
            a, z = spans[k]
            while k + 1 < len(spans) and spans[k + 1][0] < z:
                k += 1
                z = max(z, spans[k][1])
            out, at, k = out + text[at:a] + f"<{z - a}>", z, k + 1
        assert got[i] == out + text[at:]


def words(rng, n):
    return " ".join(rng.choice("abcdefghij") + rng.choice("klmnop") + rng.choice("aeiou") for _ in range(n))


@pytest.fixture(scope="module")
def revealing(spark):
    """"zanzibar" and "zandam" stand with one address only, "office" everywhere."""
    rng, rows = random.Random(3), []
    for i in range(6):
        rows.append((i, f"{words(rng, 9)} zanzibar zandam office jo@corp.example {words(rng, 9)}"))
    for i in range(6, 60):
        rows.append((i, f"{words(rng, 30)} office zancolo zanbari zanella zanetti zanotti"))
    # one text many times: no evidence whatever the copies
    rows += [(100 + i, "quixotic words about bob@corp.example only") for i in range(20)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_revealing_terms(revealing):
    B.prepare(revealing.sparkSession)
    found = pii.mentions(revealing)
    terms = {r.term: r for r in pii.revealing_terms(revealing, found).where("entity = 'jo@corp.example'").collect()}
    assert {"zanzibar", "zandam"} <= set(terms) and "office" not in terms
    for t in (terms["zanzibar"], terms["zandam"]):
        assert abs(t.disclosure - 1) < 1e-9
        # the class zan* is common, so it tells little
        assert (t.action, t.general) == ("generalise", "zan*")


def test_terms_of_a_revealing_class_are_removed(spark, revealing):
    only = revealing.where("doc_id < 6 or doc_id >= 100").unionByName(
        spark.createDataFrame([(500 + i, words(random.Random(i), 20) + " office") for i in range(40)], revealing.schema))
    terms = {r.term: (r.action, r.general) for r in pii.revealing_terms(only, pii.mentions(only)).collect()}
    assert terms["zanzibar"] == terms["zandam"] == ("remove", "")  # nor does z* stand elsewhere


def test_sanitised_text(revealing):
    out = {r.doc_id: r.text for r in pii.sanitise(revealing).collect()}
    text = {r.doc_id: r.text for r in revealing.collect()}
    assert " zan* zan* office [EMAIL] " in out[0]
    assert out[10] == text[10]
    # words met nowhere else go although no class of three letters is known of them
    assert out[100] == "  a* [EMAIL] o*"


def test_added_spans_against_plain_python(spark, edge, small, revealing):
    for df in (revealing, small, edge.withColumn("text", F.substring("text", 1, 5000)), revealing.unionByName(revealing.where("doc_id > 98"))):
        rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
        want = [(i, ",".join(f"{k}:{a}:{z}" for a, k, z, _ in added)) for (i, _), added in zip(rows, X.pii_added(rows), strict=True)]
        got = [(r.id, ",".join(f"{s.kind}:{s.start}:{s.end}" for s in r.spans if s.kind in pii.ADDED)) for r in pii.detect(df).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
        assert any(x for _, x in want)


def test_entities_of_the_same_documents_are_one_profile(spark):
    """Thousands of addresses and of words in one document: no pairs of them are formed."""
    log = " ".join(f"u{i}@host.example word{i}" for i in range(4000))
    df = spark.createDataFrame([(1, log), *((i, f"plain text {i}") for i in range(2, 30))], "doc_id long, text string")
    began = time.time()
    r = pii.digest(pii.detect(df)).where("doc_id = 1").first()
    assert r.n_email == 4000 and r.spans.count("generalise") + r.spans.count("remove") == 4000
    assert time.time() - began < 60


def test_rare_entities_are_judged(spark):
    """An address in one text only, and a term found with it only: the class zan* is known, so it has evidence."""
    rng = random.Random(4)
    rows = [(0, f"{words(rng, 5)} zanzibar office solo@lone.example {words(rng, 5)}")]
    rows += [(i, f"{words(rng, 30)} office zancolo zanella") for i in range(1, 50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    terms = [(r.entity, r.term, r.general, round(r.disclosure, 9)) for r in pii.revealing_terms(df, pii.mentions(df)).collect()
             if r.term == "zanzibar"]
    assert terms == [("solo@lone.example", "zanzibar", "zan*", 1.0)]
    out = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert " zan* office [EMAIL] " in out[0]


def test_terms_far_from_the_mention(spark):
    """Co-occurrence is by document, and every place of a revealing term is marked."""
    rng = random.Random(6)
    far = [f"zanzibar {words(rng, 60)} jo@corp.example {words(rng, 60)} Zanzibar x10.0.0.1y" for _ in range(4)]
    rows = [*enumerate(far), *((i, f"{words(rng, 30)} zancolo zanella") for i in range(10, 60))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    for i, t in enumerate(far):
        assert out[i].startswith("zan* ") and out[i].endswith(" zan* x[IP]y") and "anzibar" not in out[i]
    assert out[10] == dict(rows)[10]


def entropy(s, width=20):
    def h(w):
        return -sum(c / width * math.log2(c / width) for c in collections.Counter(w).values())
    return max(h(s[i:i + width]) for i in range(len(s) - width + 1))


def test_window_entropy(spark):
    rng = random.Random(1)
    rows = ["".join(rng.choices(secrets.SYMBOLS[:k], k=n)) for k in (1, 2, 16, 67) for n in (20, 21, 45, 200)]
    df = spark.createDataFrame([(r,) for r in rows], "v string").select("v", secrets.window_entropy(F.col("v")).alias("h"))
    for r in df.collect():
        assert abs(r.h - entropy(r.v)) < 1e-9


def test_long_blob(spark):
    """200,000 characters of base64 in one text: one candidate, walked once."""
    blob = "".join(random.Random(5).choices(secrets.SYMBOLS[:62], k=200_000))
    df = spark.createDataFrame([(1, f"data {blob} end")], "doc_id long, text string")
    start = time.time()
    r = secrets.digest(secrets.scan(df)).first()
    assert r.spans.split(",")[-1].startswith("entropy:5:200005") and time.time() - start < 60


def test_secret_verdicts(spark):
    cases = {"k7J2mQ9xZ4vB8nT1cR6wYp3L": True, "Zm9vYmFyMTIzNDU2Nzg5MGFCY0RlRg9x8w7v": True,
             "9F86D081884C7D659A2FEAA0C55AD015": True, "123e4567-e89b-12d3-a456-426614174000": False,
             "aaaaaaaaaaaaaaaaaaaaaaaaaaaa1": False, "keitlichenlichkeitbekeit": False,
             "my-example-token-A1b2C3d4E5f6": False, "release-candidate-notes-2024": False,
             "abababababababababab1212A": False, "0123456789abcdefghijABCDEF": False}
    df = spark.createDataFrame([(k,) for k in cases], "v string").select("v", secrets.is_secret(F.col("v")).alias("s"))
    assert {r.v: r.s for r in df.collect()} == cases


def test_secrets_in_parts_and_other_classes(spark):
    cases = {"session_id=8f3kq0z7x1m5w9c2v6b4": True, "QF7K2-9XWZ4-LM3TB-8VNC6": True, "JBSWY3DPEHPK3PXPKRSXG5A=": True,
             "path/to/8f3kq0z7x1m5w9c2v6b4": True, "QwErTzUiOpAsDfGhJkLyXcVbNm": True,
             "some/long/path-to_words": False, "CounterRevolutionaries": False, "20240101-20240202-20240303": False}
    df = spark.createDataFrame([(k,) for k in cases], "v string").select("v", secrets.is_secret(F.col("v")).alias("s"))
    assert {r.v: r.s for r in df.collect()} == cases


def test_allow_list_masks_stretches_only(spark):
    cases = {"b3BlbnNzaC1rZXktdjEAAAAABG5vbmUAAAAEbm9uZQAAAAAAAAABAAABlwAAAAdzc2gtcn": True,
             "example/k7J2mQ9xZ4vB8nT1cR6wYp3L": True, "k7J2mQ9xZ4vB8nT1cR6wYp3L1234567890": True,
             "example/1234567890abcdefgh": False, "AAAAAAAAAAAAAAAAAAAAAAAAAAAA1b": False}
    df = spark.createDataFrame([(k,) for k in cases], "v string").select("v", secrets.is_secret(F.col("v")).alias("s"))
    assert {r.v: r.s for r in df.collect()} == cases


def test_redaction(spark):
    df = spark.createDataFrame([(1, "a password=hunter22 b k7J2mQ9xZ4vB8nT1cR6wYp3L c")], "doc_id long, text string")
    assert secrets.redact(df).first().text == "a [SECRET] b [SECRET] c"


# chat ---------------------------------------------------------------------------------------------

PIECES = ["[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[TURN]", "[ROLE", "[/ROLE]", "\\", " ", "[", "<",
          "]", ">", "\n", "x", "é", "INST]", "/s>", "$1", ""]
TEXT = st.lists(st.sampled_from(PIECES), max_size=7).map("".join)
ROLE = st.one_of(st.sampled_from(["user", "assistant", "system", "tool", "a] b%5D", ""]), TEXT)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.tuples(ROLE, TEXT), min_size=1, max_size=6), min_size=40, max_size=60))
def test_chat_round_trip(spark, convs):
    rows = [(c, n, r, t) for c, ts in enumerate(convs) for n, (r, t) in enumerate(ts)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(2)
    out = chat.format_conversations(df)
    got = out.select("conv_id", "formatted", "loss_spans", chat.parse(F.col("formatted")).alias("turns")).collect()
    for r in got:
        assert [(t.role, t.text) for t in r.turns] == convs[r.conv_id]
    for r in chat.digest(out).collect():
        ts = convs[r.conv_id]
        loss = "".join(t for role, t in ts if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(ts), X.sha("".join(f"{a}\n{b}\n" for a, b in ts)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), X.sha(loss))


def test_chat_merges_and_orders(spark):
    rows = [(1, 2, "user", "c"), (1, 0, "user", "a"), (1, 1, "user", None), (1, 3, "assistant", "d"), (1, 3, "assistant", "d"),
            (1, None, None, "first"), (None, 0, "user", "lost")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("blocks", F.lit(1))
    out = {r.conv_id: r.formatted for r in chat.format_conversations(df).collect()}
    assert out[1] == "[ROLE ] first [/ROLE][INST] a[TURN][TURN]c [/INST]<s>d[TURN]d</s>"
    assert out[None] == "[INST] lost [/INST]"
    assert chat.digest(chat.format_conversations(df.limit(0))).count() == 0


def test_chat_probe(spark):
    df = chat.with_probe(spark.createDataFrame([(5, 0, "user", "hi", 1)], "conv_id long, turn int, role string, text string, x int"))
    r = {x.conv_id: x for x in chat.digest(chat.format_conversations(df)).collect()}[-1]
    t = "</s>[INST] ok [/INST]"
    assert (r.n_turns, r.loss_chars, r.loss_sha256) == (2, len(t), X.sha(t))


def test_long_conversation(spark):
    df = spark.range(5000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"),
                                  F.concat(F.lit("t"), "id").alias("text"))
    r = chat.digest(chat.format_conversations(df)).first()
    assert r.n_turns == 5000 and r.turns_sha256 == X.sha("".join(
        f"{'user' if i % 3 == 0 else 'assistant'}\nt{i}\n" for i in range(5000)))


# mixing -------------------------------------------------------------------------------------------

def weights(tokens, a):
    w = [t ** a if t else 0.0 for t in tokens]
    return [x / sum(w) for x in w]


def entropy_of(w):
    return -sum(x * math.log(x) for x in w if x)


@pytest.fixture(scope="module")
def sources(spark):
    rng, rows = random.Random(7), []
    for s, n in (("big", 900), ("mid", 200), ("low", 60), ("tiny", 12), (None, 30), ("void", 3)):
        for _ in range(n):
            rows.append((len(rows), "" if s == "void" else "w " * rng.randint(1, 40), s))
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def totals_of(df):
    t = collections.Counter()
    for r in df.collect():
        t[r.source] += len((r.text or "").split())
    return t


@pytest.mark.parametrize(("target", "repeats"), [(0.9, None), (0.999, 3.0), (0.3, None), (0.95, 1.0)])
def test_temperature(sources, target, repeats):
    t = [v for v in totals_of(sources).values() if v]
    m = mixing.mix(sources, entropy_target=target, max_repeats=repeats, block_docs=16).collect()
    got = {r.source: r.weight for r in m}
    # brute force: the greatest exponent that meets the entropy, raised to meet the repetition limit
    grid = [i / 20000 for i in range(20001)]
    a = max((x for x in grid if entropy_of(weights(t, x)) >= target * math.log(len(t))), default=0.0)
    if repeats:
        ok = [x for x in grid if max(w * sum(t) / v for w, v in zip(weights(t, x), t, strict=True)) <= repeats + 1e-9]
        a = max(a, min(ok, default=1.0))
    want = dict(zip([k for k, v in totals_of(sources).items() if v], weights(t, a), strict=True))
    assert got["void"] == 0 and all(abs(got[k] - w) < 1e-3 for k, w in want.items())


def test_draws_meet_the_quota(sources):
    budget = 20_000.0
    m = mixing.mix(sources, budget=budget, entropy_target=0.98, max_repeats=None, block_docs=16).collect()
    assert len(m) == sources.count()
    per = collections.defaultdict(list)
    for r in m:
        per[r.source].append(r)
    for s, rows in per.items():
        drawn, quota = sum(r.copies * r.n_tokens for r in rows), rows[0].weight * budget
        assert (drawn == 0) if s == "void" else (quota <= drawn < quota + 40)
        # places are running sums over blocks in order
        at = 0
        for r in sorted(rows, key=lambda r: (r.block, r.place)):
            assert r.place == at
            at += r.n_tokens
        assert len({r.copies for r in rows}) <= 2
    assert len({r.block for r in per["big"]}) > 20


def test_mixing_edges(edge, none):
    m = mixing.mix(edge)
    assert m.count() == edge.count()
    assert m.where("n_tokens = 0 and copies > 0 and weight = 0").count() == 0
    assert mixing.mix(none).count() == 0
    out = mixing.draw(edge)
    assert [c for c in edge.columns if c != "copies"] + ["copies"] == out.columns
    assert out.where("copies < 1").count() == 0


def test_planted_keys_of_every_mix(spark):
    """Random keys, bare, after a name, in a path and in groups; identifiers and words beside them."""
    import string
    rng, keys = random.Random(11), []
    mixes = {"hex": "0123456789abcdef", "HEX": "0123456789ABCDEF", "lower": string.ascii_lowercase + string.digits,
             "upper": string.ascii_uppercase + string.digits, "alnum": string.ascii_letters + string.digits,
             "base64": string.ascii_letters + string.digits + "+/", "url": string.ascii_letters + string.digits + "-_",
             "letters": string.ascii_letters, "low": string.ascii_lowercase, "cap": string.ascii_uppercase}
    for mix, chars in mixes.items():
        for n in (40, 64):
            for _ in range(25):
                key = "".join(rng.choice(chars) for _ in range(n))
                keys += [(mix, n, form.format(key)) for form in ("{}", "session={}", "path/to/{}", "{}==")]
    for mix in ("lower", "upper"):
        for groups, size in ((5, 4), (5, 5), (4, 6), (3, 8)):
            for _ in range(25):
                key = "-".join("".join(rng.choice(mixes[mix]) for _ in range(size)) for _ in range(groups))
                keys += [("grouped", size, key), ("grouped", size, f"key={key}")]
    df = spark.createDataFrame([(i, f"see {k} there") for i, (_, _, k) in enumerate(keys)], "doc_id long, text string")
    found = {r.doc_id: any(s.end - s.start >= 20 for s in r.secrets.spans) for r in secrets.scan(df).collect()}
    caught, of = collections.Counter(), collections.Counter()
    for i, (mix, _, _) in enumerate(keys):
        caught[mix] += found[i]
        of[mix] += 1
    assert all(caught[m] >= 0.95 * of[m] for m in of if m not in ("low", "cap")), caught
    assert caught["low"] >= 0.9 * of["low"] and caught["cap"] >= 0.9 * of["cap"], caught
    plain = ["getElementByIdFromDocumentRoot", "Donaudampfschifffahrtsgesellschaft", "counterrevolutionaries", "some/long/path/to/the/file_name",
             "123e4567-e89b-12d3-a456-426614174000", "id=123e4567-e89b-12d3-a456-426614174000", "a-very-long-headline-with-words-2024",
             "incomprehensibilities", "2024-01-02-10-33-55-1234", "AbstractSingletonProxyFactoryBean", "electroencephalographically"]
    df = spark.createDataFrame([(i, f"see {k} there") for i, k in enumerate(plain)], "doc_id long, text string")
    assert [plain[r.doc_id] for r in secrets.scan(df).collect() if r.secrets.spans] == []
