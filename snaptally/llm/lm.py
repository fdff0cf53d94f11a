"""Language-model scoring: a weighted backoff automaton over smoothed bigrams.

States are the empty context, the text start and every known word. A state w has an arc for
each word that follows it in training; where the arc is missing, the failure arc leads to the
empty state, which has an arc for every known word and one for any unknown word. Weights:

    P1(v)    = (c(v) + 1) / (N + V + 1)
    P2(v|w)  = (c(w v) + mu P1(v)) / (c(w) + mu)      arc w -> v
    bow(w)   = mu / (c(w) + mu)                       failure arc of w

(Dirichlet smoothing.) A missing arc costs bow(w) P1(v), which is P2 at count 0, so the
probabilities of a state sum to 1. A text is read once from the start state to its end token.

The model is as large as the corpus and is never in one place. Texts are cut into token
blocks (``block_bytes`` of text; one pass). Each block asks for the counts of its own
different words and word pairs with its own training counts: sorted hashes, dealt to
buckets by their leading bits. A bucket adds up the counts of each n-gram and answers every
block in the order asked. Then each block, with just the arcs of its own words, reads its
texts. What is moved is one number per different n-gram of a block in each direction.

N-grams are known by 64-bit hashes (of the words' bytes).

Defined cases: null text is empty: one end token; a null id is learned from; a text longer
than a block is a block of its own; repeated rows are learned and scored each; without
training rows N = V = 0 and every probability is that of an unknown word; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaptally.llm import base as B

END = b"\n"  # no word holds white space
START = np.uint64(0x51A7E5BA11C0FFEE)
MIX = np.uint64(0x9E3779B97F4A7C15)
BLOCK = ("block string, ids array<{id}>, held array<boolean>, ends array<bigint>, "
         "words binary, tokens binary, n_tokens bigint")
ASK = "bucket int, block string, grams int, n bigint, keys binary, counts binary"
ANSWER = "block string, grams int, bucket int, counts binary, n_train bigint, n_known bigint"


def train_rows(id_col: str, parts: int = 7, held: int = 2) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % parts != held, F.lit(True))


def pack(a: np.ndarray) -> bytes:
    """Non-negative integers in the fewest bytes each, byte plane by byte plane, deflated."""
    top = int(a.max()) if len(a) else 0
    size = next(k for k in range(1, 9) if top < 1 << (8 * k))
    planes = a.astype("<u8").view(np.uint8).reshape(-1, 8).T[:size]
    return bytes([size]) + zlib.compress(np.ascontiguousarray(planes).tobytes(), 1)


def unpack(raw: bytes) -> np.ndarray:
    flat = np.frombuffer(zlib.decompress(raw[1:]), dtype=np.uint8).reshape(raw[0], -1)
    planes = np.zeros((flat.shape[1], 8), dtype=np.uint8)
    planes[:, :raw[0]] = flat.T
    return planes.view("<i8").ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted hashes as differences, byte plane by byte plane (the leading planes are near 0)."""
    gaps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    planes = gaps.view(np.uint8).reshape(-1, 8).T
    top = max((i + 1 for i in range(8) if planes[i].any()), default=0)
    return bytes([top]) + planes[:top].tobytes()


def unpack_keys(raw: bytes, n: int) -> np.ndarray:
    planes = np.zeros((8, n), dtype=np.uint8)
    planes[:raw[0]] = np.frombuffer(raw, np.uint8, offset=1).reshape(raw[0], n)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def id_kind(docs: DataFrame, id_col: str) -> str:
    """bigint for integer ids, string for any other."""
    return "bigint" if isinstance(docs.schema[id_col].dataType, T.IntegralType) else "string"


def token_blocks(docs: DataFrame, id_col: str, text_col: str, train: Column, block_bytes: int) -> DataFrame:
    """One row per block: its documents' ids (long, or text if they are no integers), which are held out, where their tokens end, the
    different words' hashes, and the tokens as places in those."""
    kind = id_kind(docs, id_col)
    block = BLOCK.format(id=kind)
    id_type = pa.int64() if kind == "bigint" else pa.string()
    d = docs.select(F.col(id_col).cast(kind).alias("id"), (~train).alias("held"), B.text_of(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]):
        import os
        name = f"{os.urandom(12).hex()}"
        number = 0

        def flush():
            nonlocal number
            number += 1
            hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64)
            # frequent words get small numbers, which pack well
            seen = np.array(codes, dtype=np.int64)
            order = np.argsort(-np.bincount(seen, minlength=len(hashes)), kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            row = [[f"{name}-{number}"], [list(ids)], [list(held)], [list(ends)], [hashes[order].tobytes()],
                   [pack(rank[seen])], [len(seen)]]
            return pa.RecordBatch.from_arrays(
                [pa.array(row[0]), pa.array(row[1], pa.list_(id_type)), pa.array(row[2], pa.list_(pa.bool_())),
                 pa.array(row[3], pa.list_(pa.int64())), pa.array(row[4], pa.binary()), pa.array(row[5], pa.binary()),
                 pa.array(row[6], pa.int64())], names=[x.split()[0] for x in block.split(", ")])
        words: dict[bytes, int] = {}
        ids, held, ends, codes, size = [], [], [], [], 0
        for b in batches:
            for i, h, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                 b.column(2).cast(pa.binary()).to_pylist(), strict=True):
                if ids and size + len(raw) > block_bytes:
                    yield flush()
                    words, ids, held, ends, codes, size = {}, [], [], [], [], 0
                for w in raw.lower().split():
                    codes.append(words.setdefault(w, len(words)))
                codes.append(words.setdefault(END, len(words)))
                ids.append(i)
                held.append(h)
                ends.append(len(codes))
                size += len(raw)
        if ids:
            yield flush()
    return d.mapInArrow(run, block)


class Block:
    """The n-grams of one token block, the same whenever they are made."""

    def __init__(self, words: bytes, tokens: bytes, ends: list[int], held: list[bool]):
        given = np.frombuffer(words, np.uint64)
        order = np.argsort(given, kind="stable")
        self.words = given[order]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.tokens = rank[unpack(tokens)]
        self.ends = np.asarray(ends, dtype=np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        self.train = np.repeat(~np.asarray(held, dtype=bool), self.ends - self.starts)
        # state before each token: the word before it, or the start (one more than the words)
        self.state = np.empty(len(self.tokens), np.int64)
        self.state[1:] = self.tokens[:-1]
        self.state[self.starts] = len(self.words)
        pair, self.pair_at = np.unique(self.state * np.int64(len(self.words) + 1) + self.tokens, return_inverse=True)
        left, right = np.divmod(pair, len(self.words) + 1)
        hashes = np.append(self.words, START)
        h = (hashes[left] * MIX) ^ (hashes[left] >> np.uint64(31))
        h = (h + hashes[right]) * MIX
        h ^= h >> np.uint64(32)
        self.order = np.argsort(h, kind="stable")
        self.pairs = h[self.order]

    def asked(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(grams, sorted hashes, training counts) for words and for pairs."""
        weight = self.train.astype(np.float64)
        yield 1, self.words, np.bincount(self.tokens, weight, len(self.words)).astype(np.int64)
        yield 2, self.pairs, np.bincount(self.pair_at, weight, len(self.pairs)).astype(np.int64)[self.order]

    def log10(self, words: np.ndarray, pairs: np.ndarray, n: int, v: int, n_texts: int, mu: float):
        """Per text: tokens, known tokens, log10 by words alone, log10 by the automaton.

        One pass from left to right over all texts: at each token the state's arc, or
        its failure arc and the empty state's arc, in arrays over the tokens."""
        one = (words + 1.0) / (n + v + 1.0)
        state_count = np.append(words, n_texts).astype(float)[self.state]
        pair_count = np.empty(len(pairs), np.int64)
        pair_count[self.order] = pairs
        arc = pair_count[self.pair_at]
        p1 = one[self.tokens]
        failure = np.log10(mu / (state_count + mu)) + np.log10(p1)
        p = np.where(arc > 0, np.log10((arc + mu * p1) / (state_count + mu)), failure)
        total = lambda x: np.add.reduceat(x, self.starts)  # noqa: E731  every text has its end token
        return (self.ends - self.starts, total((words[self.tokens] > 0).astype(np.int64)), total(np.log10(p1)), total(p))


def buckets_for(spark, n_tokens: int, per_bucket: int = 2_000_000) -> int:
    """Buckets so that one holds about ``per_bucket`` of the asked n-grams."""
    return max(spark.sparkContext.defaultParallelism, -(-2 * n_tokens // per_bucket))


def _cuts(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """Where the sorted hashes are cut into buckets of equal hash ranges."""
    step = (1 << 64) // n_buckets + 1
    marks = np.array([min(i * step, (1 << 64) - 1) for i in range(1, n_buckets)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, marks), [len(keys)]])


def ask(blocks: DataFrame, n_buckets: int) -> DataFrame:
    """Rows (bucket, block, grams): sorted hashes and the block's training counts."""
    d = blocks.select("block", "words", "tokens", "ends", "held")

    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                name, words, tokens, ends, held = (b.column(i)[r].as_py() for i in range(5))
                for grams, keys, counts in Block(words, tokens, ends, held).asked():
                    cut = _cuts(keys, n_buckets)
                    full = [i for i in range(n_buckets) if cut[i] < cut[i + 1]]
                    out = [(i, name, grams, int(cut[i + 1] - cut[i]), pack_keys(keys[cut[i]:cut[i + 1]]),
                            pack(counts[cut[i]:cut[i + 1]])) for i in full]
                    cols = list(zip(*out, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.string(), pa.int32(), pa.int64(),
                                                               pa.binary(), pa.binary()), strict=True)],
                        names=[x.split()[0] for x in ASK.split(", ")])
    return d.mapInArrow(run, ASK)


def answer(asked: DataFrame) -> DataFrame:
    """Sums of each n-gram's training counts in its bucket, in the order each block asked."""
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        del table
        out = []
        for grams in (1, 2):
            own = [r for r in rows if r["grams"] == grams]
            if not own:
                continue
            keys = np.concatenate([unpack_keys(r["keys"], r["n"]) for r in own])
            counts = np.concatenate([unpack(r["counts"]) for r in own])
            known, at = np.unique(keys, return_inverse=True)
            sums = np.bincount(at, counts, len(known)).astype(np.int64)  # exact below 2^53
            got, place = sums[at], 0
            for k, r in enumerate(own):
                # the bucket's totals go with one of its answers only
                out.append({"block": r["block"], "grams": grams, "bucket": r["bucket"],
                            "counts": pack(got[place:place + r["n"]]),
                            "n_train": int(sums.sum()) if k == 0 else 0,
                            "n_known": int((sums > 0).sum()) if k == 0 else 0})
                place += r["n"]
        return pa.Table.from_pylist(out, schema=pa.schema([
            ("block", pa.string()), ("grams", pa.int32()), ("bucket", pa.int32()), ("counts", pa.binary()),
            ("n_train", pa.int64()), ("n_known", pa.int64())]))
    return asked.groupBy("bucket").applyInArrow(run, ANSWER)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train: Column | None = None,
          mu: float = 100.0, block_bytes: int = 8_000_000, n_buckets: int | None = None) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    train = train_rows(id_col) if train is None else train
    blocks = B.materialise(token_blocks(docs, id_col, text_col, train, block_bytes), "lm-blocks")
    sums = blocks.agg(F.sum("n_tokens").alias("t"), F.sum(F.size(F.filter("held", lambda h: ~h))).alias("d")).first()
    n_texts = int(sums["d"] or 0)
    n_buckets = n_buckets or buckets_for(docs.sparkSession, int(sums["t"] or 0))
    answers = B.materialise(answer(ask(blocks, n_buckets)), "lm-answers")
    own = answers.where("grams = 1").agg(F.sum("n_train").alias("n"), F.sum("n_known").alias("v")).first()
    n, v = int(own["n"] or 0), int(own["v"] or 0)
    gathered = answers.groupBy("block").agg(F.array_sort(F.collect_list(F.struct(
        "grams", "bucket", "counts"))).alias("answers"))
    d = blocks.select("block", "ids", "held", "ends", "words", "tokens").join(gathered, "block")
    d = d.select("ids", "held", "ends", "words", "tokens", "answers")

    kind = id_kind(docs, id_col)
    id_type = pa.int64() if kind == "bigint" else pa.string()

    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                ids, held, ends, words, tokens, got = (b.column(i)[r].as_py() for i in range(6))
                x = Block(words, tokens, ends, held)
                one, two = (np.concatenate([unpack(a["counts"]) for a in got if a["grams"] == g]) for g in (1, 2))
                k, known, base, p = x.log10(one, two, n, v, n_texts, mu)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, id_type), pa.array(held, pa.bool_()), pa.array(k, pa.int64()),
                     pa.array(known, pa.int64()), pa.array(np.full(len(k), n), pa.int64()), pa.array(base), pa.array(p)],
                    names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return d.mapInArrow(run, f"id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
                             "base_score double, score double")


def digest(scored: DataFrame) -> DataFrame:
    """The query's columns from score()."""
    return scored.withColumnRenamed("id", "doc_id")
