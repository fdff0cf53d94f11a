"""Token counts with a public tokenizer; huge documents by overlap resynchronisation.

A document over ``huge_chars`` is encoded in chunks of ``chunk_chars`` that overlap, with
offsets. Two neighbouring encodings are spliced at a boundary in their overlap that is
proven stable: a token starts there in both, the character before it is white space (the
tokenizer never joins across white space), and the next ``agree`` tokens have the same ids
and offsets. If the overlap holds no such place (a long run without white space, say), it is
widened four times and tried again, in the end to the rest of the document. Memory follows
the chunk, not the document.

Shorter documents are encoded at once. With a tokenizer that drops white space (checked on
its file), words are independent, so the counts of words met before are looked up; the sums
are those of encoding the whole text.

Special strings inside texts are handled as the library does by default; no begin, end or
added special tokens, no truncation or padding.

Defined cases: null or empty text has 0 tokens and 0 bytes; repeated rows are counted each;
other columns pass through, one named as the result column is replaced; an empty table
gives an empty result.
"""

from __future__ import annotations

import json
import os
from bisect import bisect_left

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaptally.llm import arrow as A

KIND = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
                     T.StructField("chunks", T.LongType())])
MEMO = 500_000  # words remembered by a task; the memory starts anew beyond


def drops_space(spec: dict) -> bool:
    """True if the tokenizer's file says that no piece spans white space and white space gives no token."""
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    first = steps[0] if steps else {}
    pattern = (first.get("pattern") or {}).get("Regex", "")
    return (first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
            and r"[^\s\p{L}\p{N}]+" in pattern and "\\s|" not in pattern and "|\\s" not in pattern
            and not any(set(" \t\n") & set(t["content"]) for t in spec.get("added_tokens", [])))


class Counter:
    """Counts tokens; one per task, made from the tokenizer's file."""

    def __init__(self, spec: str, huge_chars: int, chunk_chars: int, overlap: int, agree: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_word = drops_space(json.loads(spec))
        self.huge, self.chunk, self.overlap, self.agree = huge_chars, chunk_chars, overlap, agree
        self.memo: dict[bytes, int] = {}
        self.seen: set[bytes] = set()

    def __call__(self, texts: list[bytes]) -> list[dict]:
        out = []
        for raw in texts:
            # a character is at most 4 bytes
            text = raw.decode() if len(raw) > self.huge or not self.by_word else None
            if text is not None and len(text) > self.huge:
                n, chunks = self.spliced(text)
            elif self.by_word:
                n, chunks = self.words(raw), 1
            else:
                n, chunks = len(self.tokenizer.encode(text, add_special_tokens=False)), 1
            out.append({"n_bytes": len(raw), "n_tokens": n, "chunks": chunks})
        return out

    def words(self, raw: bytes) -> int:
        """Tokens of a text as the sum over its words: remembered words are looked up, words met
        for the first time are encoded together, and a word met again is remembered."""
        total, new, again = 0, [], []
        memo, seen = self.memo, self.seen
        for w in raw.split():
            n = memo.get(w)
            if n is not None:
                total += n
            elif w in seen:
                again.append(w)
            else:
                new.append(w)
        if new:
            seen.update(new)
            total += len(self.tokenizer.encode_batch_fast([b" ".join(new).decode()], add_special_tokens=False)[0])
        if again:
            kinds = list(set(again))
            got = self.tokenizer.encode_batch_fast([w.decode() for w in kinds], add_special_tokens=False)
            memo.update((w, len(e)) for w, e in zip(kinds, got, strict=True))
            total += sum(map(memo.__getitem__, again))
        if len(memo) > MEMO:
            memo.clear()
        if len(seen) > MEMO:
            seen.clear()
        return total

    def encode(self, text: str, start: int, end: int) -> tuple[int, list, list]:
        """start, then the (start, end) offsets from there and the ids of text[start:end]'s tokens."""
        e = self.tokenizer.encode(text[start:end], add_special_tokens=False)
        return start, e.offsets, e.ids

    @staticmethod
    def before(piece: tuple, at: int) -> int:
        """Tokens of a piece that start before ``at``."""
        return bisect_left(piece[1], at - piece[0], key=lambda o: o[0])

    def spliced(self, text: str) -> tuple[int, int]:
        """Tokens of a huge text, and the chunks it took."""
        n, total, chunks, at = len(text), 0, 1, 0  # tokens from ``at`` on are not counted yet
        start, width = 0, self.overlap
        left = self.encode(text, 0, min(n, self.chunk + width))
        while True:
            cut = start + self.chunk
            if cut + width >= n:
                return total + len(left[1]) - self.before(left, at), chunks
            right = self.encode(text, cut, min(n, cut + max(self.chunk, width) + self.overlap))
            p = self.boundary(text, left, right, cut, cut + width)
            if p is None:  # widen: the left piece reaches further
                width *= 4
                left = self.encode(text, start, min(n, cut + width))
                continue
            total += self.before(left, p) - self.before(left, at)
            at, start, width, chunks, left = p, cut, self.overlap, chunks + 1, right

    def boundary(self, text: str, left: tuple, right: tuple, low: int, high: int) -> int | None:
        """A place in (low, high) where both encodings start a token after white space and agree from there on."""
        def zone(piece):
            i, j = self.before(piece, low), self.before(piece, high)
            return [(a + piece[0], z + piece[0], t) for (a, z), t in zip(piece[1][i:j], piece[2][i:j], strict=True)]
        ours, theirs = zone(left), zone(right)
        place = {t: i for i, t in enumerate(theirs)}
        for i in range(len(ours) - self.agree + 1):
            p = ours[i][0]
            if p > low and text[p - 1] in " \t\n\r\v\f":
                j = place.get(ours[i])
                if j is not None and ours[i:i + self.agree] == theirs[j:j + self.agree]:
                    return p
        return None


def count_tokens(docs: DataFrame, tokenizer_path: str, text_col: str = "text", out: str = "tokens",
                 huge_chars: int = 32_768, chunk_chars: int = 16_384, overlap: int = 512, agree: int = 8) -> DataFrame:
    """docs with ``out``: struct<n_bytes, n_tokens, chunks>.

    The tokenizer's file (a few MB, read on the driver) goes to the tasks as a broadcast."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    made: list[Counter] = []

    def per_text(texts):
        if not made:
            made.append(Counter(spec.value, huge_chars, chunk_chars, overlap, agree))
        return made[0](texts)
    return A.with_result(docs, text_col, out, KIND, per_text)


def digest(counted: DataFrame, id_col: str = "doc_id", out: str = "tokens", limit: int = 2048) -> DataFrame:
    """The query's columns from count_tokens()."""
    return counted.select(F.col(id_col).alias("doc_id"), F.col(f"{out}.n_bytes"), F.col(f"{out}.n_tokens"),
                          (F.col(f"{out}.n_tokens") > limit).alias("over_limit"), F.col(f"{out}.chunks"))
