"""Counts and ratios of one text, shared by the quality classifier and the quality rules."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

WINDOW = 8
SPACE_BYTES = [0x20, *range(0x09, 0x0E)]
SYMBOL_BYTES = list(b"#*$%&|<>")
PUNCTUATION_BYTES = list(b".,;:?'\"()-")

#: Exact counts, in the order that ``measure`` gives them.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Ratios that do not depend on the language or, above a few words, on the length.
RATIOS = (
    "word_length",
    "symbol_share",
    "upper_share",
    "exclamations",
    "digit_share",
    "bars",
    "dup_line_share",
    "repeat_share",
    "distinct_share",
    "top_share",
    "twin_share",
    "words_per_line",
    "punctuation",
    "other_bytes",
    "longest_word",
)

_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1B54A32D192ED03)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread integers over 64 bits."""
    x = values.astype(np.uint64) * _ODD + _STEP
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that occur twice or more, the first included."""
    n = len(ids)
    last = n - window + 1
    if last < 2:
        return 0
    spread = mix(ids)
    rolled = np.zeros(last, np.uint64)
    for k in range(window):
        rolled = rolled * _STEP + spread[k : k + last]
    ordered = np.sort(rolled)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    starts = np.isin(rolled, twice).astype(np.int32)
    edges = np.zeros(n + 1, np.int32)
    edges[:last] += starts
    edges[window : window + last] -= starts
    return int(np.count_nonzero(np.cumsum(edges)[:n]))


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def measure(text: bytes) -> tuple[list[int], list[float]]:
    """The counts and the ratios of one text; an empty text has zeros."""
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words = text.split()
    n = len(words)
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    chars = int(len(text) - seen[0x80:0xC0].sum() - seen[SPACE_BYTES].sum())
    symbols = int(seen[SYMBOL_BYTES].sum())
    dup_lines, repeats = repeated_lines(text), repeated_words(ids)
    counts = [n, chars, symbols, dup_lines, repeats]
    if not n:
        return counts, [0.0] * len(RATIOS)
    upper, lower = int(seen[65:91].sum()), int(seen[97:123].sum())
    lines = int(seen[10]) + 1
    ratios = [
        chars / n,
        symbols / chars,
        upper / max(1, upper + lower),
        seen[33] / n,
        seen[48:58].sum() / chars,
        seen[124] / n,
        dup_lines / lines,
        repeats / n,
        len(number) / n**0.8,
        np.bincount(ids).max() / n**0.9,
        np.count_nonzero(ids[1:] == ids[:-1]) / n,
        np.log1p(n / lines),
        seen[PUNCTUATION_BYTES].sum() / n,
        seen[0xC0:].sum() / chars,
        np.log1p(max(map(len, words))),
    ]
    return counts, [float(r) for r in ratios]


def measure_all(texts: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Counts and ratios of many texts, one row each."""
    found = [measure(t) for t in texts]
    counts = np.array([c for c, _ in found], np.int64).reshape(-1, len(COUNTS))
    return counts, np.array([r for _, r in found], float).reshape(-1, len(RATIOS))
