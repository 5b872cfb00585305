"""Statistics of whole texts that quality rules and classifiers are built on."""

from __future__ import annotations

import numpy as np

from stayrate.llm.text import WordHashes, gram_hashes

BLANKS = np.array([9, 10, 11, 12, 13, 32])
SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
MARKS = np.frombuffer(b".,;:!?", np.uint8)
ENDS = np.frombuffer(b".!?", np.uint8)
REPEAT_WORDS = 8

#: Counts that the quality rules return.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Rates between texts of any length; none tells language, source or id.
RATES = (
    "word_length", "symbols", "dup_lines", "repeats", "upper", "digits", "marks", "ends", "distinct", "same_next",
    "line_words", "shouted", "bars",
)


def repeated_words(hashes: np.ndarray, size: int = REPEAT_WORDS) -> int:
    """Words in windows of ``size`` that are found twice or more in the text."""
    grams = gram_hashes(hashes, size)
    if len(grams) < 2:
        return 0
    order = np.argsort(grams)
    same = grams[order][1:] == grams[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(grams), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    change = np.zeros(len(hashes) + 1, np.int32)
    change[: len(grams)] += twice
    change[size : size + len(grams)] -= twice
    return int((np.cumsum(change) > 0).sum())


def measure(body: bytes, hashes: WordHashes) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """(counts, rates) of one text; all zero where it has no words."""
    words = body.split()
    n = len(words)
    if not n:
        return (0,) * len(COUNTS), (0.0,) * len(RATES)
    seen = np.bincount(np.frombuffer(body, np.uint8), minlength=256)
    word_chars = int(len(body) - seen[0x80:0xC0].sum() - seen[BLANKS].sum())
    lines = [x for x in body.split(b"\n") if x.strip()]
    dup_lines = len(lines) - len(set(lines))
    repeats = repeated_words(hashes.of(words))
    symbols = int(seen[SYMBOLS].sum())
    rates = (
        word_chars / n,
        symbols / n,
        dup_lines / len(lines),
        repeats / n,
        float(seen[65:91].sum()) / word_chars,
        float(seen[48:58].sum()) / word_chars,
        float(seen[MARKS].sum()) / n,
        float(seen[ENDS].sum()) / n,
        len(set(words)) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        n / len(lines),
        sum(map(bytes.isupper, words)) / n,
        words.count(b"|") / n,
    )
    return (n, word_chars, symbols, dup_lines, repeats), rates
