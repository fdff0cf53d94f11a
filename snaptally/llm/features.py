"""Counts of one text that the quality rules and the quality classifier share (bytes and numpy)."""

from __future__ import annotations

from collections import Counter

import numpy as np

# Frequent words of each reference language.
COMMON = {
    "en": "the of and to in a is that it was for on are with as be this have from by".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au avec".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al".split(),
}
WORDS = sorted({w for words in COMMON.values() for w in words})
INDEX = {w.encode(): i for i, w in enumerate(WORDS)}

# Character classes by byte: a character outside ASCII counts once, at its first byte.
CLASSES = ["lower", "upper", "digit", "space", "point", "symbol", "wide", "tail"]
_TABLE = np.full(256, CLASSES.index("symbol"), dtype=np.uint8)
_TABLE[ord("a"):ord("z") + 1] = CLASSES.index("lower")
_TABLE[ord("A"):ord("Z") + 1] = CLASSES.index("upper")
_TABLE[ord("0"):ord("9") + 1] = CLASSES.index("digit")
_TABLE[list(b" \t\n\r\v\f")] = CLASSES.index("space")
_TABLE[list(b".,;:!?'\"()-")] = CLASSES.index("point")
_TABLE[0x80:0xC0] = CLASSES.index("tail")
_TABLE[0xC0:] = CLASSES.index("wide")
# everything in ASCII that is no letter parts words when common words are counted
_LETTERS = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256))
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\v\f\r"


def char_histogram(raw: bytes) -> np.ndarray:
    """Characters per class (without ``tail``)."""
    return np.bincount(_TABLE[np.frombuffer(raw, np.uint8)], minlength=len(CLASSES))[:-1]


def word_histogram(raw: bytes) -> np.ndarray:
    """Occurrences of each common word, then of all other words."""
    counts = Counter(raw.lower().translate(_LETTERS).split())
    out = np.zeros(len(WORDS) + 1, dtype=np.int64)
    for w, i in INDEX.items():
        out[i] = counts.get(w, 0)
    out[-1] = sum(counts.values()) - out[:-1].sum()
    return out


def repeated_words(words: list[bytes], window: int = 8) -> int:
    """Words covered by windows of ``window`` words that occur twice or more.

    Windows get exact numbers by doubling: numbers of two adjacent windows of
    half the length make the number of the longer one."""
    n = len(words)
    if n <= window:
        return 0
    ids = dict.fromkeys(words)
    if len(ids) == n:
        return 0
    ids = dict(zip(ids, range(len(ids)), strict=True))
    code = np.fromiter(map(ids.__getitem__, words), np.int64, n)
    length = 1
    while length < window:
        pair = code[:-length] * (int(code.max()) + 1) + code[length:]
        code = np.unique(pair, return_inverse=True)[1]
        length *= 2
    twice = np.flatnonzero(np.bincount(code)[code] >= 2)
    edge = np.zeros(n + 1, dtype=np.int64)
    edge[twice] += 1  # windows start at different places
    edge[twice + window] -= 1
    return int((np.cumsum(edge[:n]) > 0).sum())


def base_counts(raw: bytes, words: list[bytes]) -> dict:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    chars = len(raw) - len(raw.translate(None, bytes(range(0x80, 0xC0))))
    spaces = len(raw) - len(raw.translate(None, SPACES))
    lines = [x for x in raw.split(b"\n") if x.strip(SPACES)]
    return {"n_words": len(words), "word_chars": len(raw) - chars - spaces,
            "n_symbols": len(raw) - len(raw.translate(None, SYMBOLS)),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": repeated_words(words)}
