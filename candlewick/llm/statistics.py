"""Statistics of a text's words, lines and characters, used by the quality operators."""

from __future__ import annotations

import sys

import numpy as np

SPACES = " \t\n\r\x0b\x0c"  # what separates words: [\x20\x09-\x0D]
SYMBOLS = "#*$%&|<>"
#: Whether lower() changes a code point.
_IS_UPPER = np.fromiter((c.lower() != c for c in map(chr, range(sys.maxunicode + 1))), bool, sys.maxunicode + 1)

FEATURES = (
    "log_chars log_words word_length symbols_per_word pipes_per_word bangs_per_word digits_per_char upper_per_char "
    "stops_per_word commas_per_word distinct_words repeated_words repeated_lines words_per_line longest_word"
).split()


def repeated_words(words: list[bytes]) -> int:
    """Words in 3-word windows that occur twice or more, the first occurrence included."""
    n = len(words)
    if n < 4:
        return 0
    h = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    with np.errstate(over="ignore"):
        windows = (h[:-2] * np.uint64(0x9E3779B97F4A7C15) + h[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + h[2:]
        windows ^= windows >> np.uint64(29)
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= twice
    return int(covered.sum())


def duplicate_lines(text: str) -> tuple[int, int]:
    """(lines with a word that equal an earlier line, lines with a word)."""
    if "\n" not in text:
        return 0, int(bool(text.strip(SPACES)))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines)), len(lines)


def base(text: str) -> dict[str, int]:
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split at SPACES alone
    return {
        "n_words": len(words),
        "word_chars": len(text) - sum(map(text.count, SPACES)),
        "n_symbols": sum(map(text.count, SYMBOLS)),
        "n_dup_lines": duplicate_lines(text)[0],
        "n_repeat_words": repeated_words(words),
    }


def features(text: str) -> list[float]:
    """FEATURES of a whole text; all 0 where there is no word."""
    words = text.encode("utf-8", "surrogatepass").split()
    n, chars = len(words), len(text)
    if not n:
        return [0.0] * len(FEATURES)
    doubled, lines = duplicate_lines(text)
    digits = sum(map(text.count, "0123456789"))
    upper = int(_IS_UPPER[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)].sum())
    return [
        np.log1p(chars), np.log1p(n), sum(map(len, words)) / n, sum(map(text.count, SYMBOLS)) / n, text.count("|") / n,
        text.count("!") / n, digits / chars, upper / chars, text.count(".") / n, text.count(",") / n,
        len(set(words)) / n, repeated_words(words) / n, doubled / max(1, lines), n / max(1, lines), float(max(map(len, words))),
    ]
