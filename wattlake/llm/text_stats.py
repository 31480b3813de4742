"""Counts that describe a text: words, symbols, capitals, repeated lines and repeated phrases."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from wattlake.llm.words import (
    Words,
    covered,
    find_words,
    per_text,
    runs,
    scrambled,
    span_hashes,
    text_bytes,
    window_hashes,
)

SYMBOLS = b"#*$%&|<>"
PHRASE = 5


def _again(keys: np.ndarray) -> np.ndarray:
    """Which entries equal another one."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    result = np.zeros(len(keys), bool)
    result[order[1:]] |= same
    result[order[:-1]] |= same
    return result


def _later(keys: np.ndarray) -> np.ndarray:
    """Which entries equal one that comes before them."""
    order = np.argsort(keys, kind="stable")
    result = np.zeros(len(keys), bool)
    result[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    return result


def _keyed(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Hashes that also tell texts apart."""
    return scrambled(hashes + scrambled(text.astype(np.uint64) + np.uint64(1)))


def duplicate_lines(words: Words) -> np.ndarray:
    """Per text, the lines with a word that equal an earlier line."""
    starts, ends = runs(words.data != 10, words.offsets)
    bounds = np.searchsorted(starts, words.offsets)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    worded = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    hashes = _keyed(span_hashes(words.data, starts, ends), text)
    later = np.zeros(len(starts), bool)
    later[worded] = _later(hashes[worded])
    return per_text(later, bounds)


def repeated_phrase_words(words: Words, hashes: np.ndarray) -> np.ndarray:
    """Per text, the words in phrases of five words that the text has twice or more."""
    windows = window_hashes(hashes, words.bounds, PHRASE)
    twice = _again(_keyed(windows.hashes, windows.text))
    return per_text(covered(windows.first[twice], PHRASE, len(words.starts)), words.bounds)


def text_stats(column: pa.Array, hashed: bool = False) -> dict:
    """Arrays with one count per text; ``hashed`` also gives the words and their hashes."""
    words = find_words(*text_bytes(column))
    data = words.data
    hashes = span_hashes(data, words.starts, words.ends)
    leads = (data & 0xC0) != 0x80
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    count = lambda flags: per_text(flags, words.offsets)
    stats = {
        "n_words": np.diff(words.bounds),
        "word_chars": count(leads & ~blank),
        "n_symbols": count(symbol[data]),
        "n_dup_lines": duplicate_lines(words),
        "n_repeat_words": repeated_phrase_words(words, hashes),
        "n_capitals": count((data >= 65) & (data <= 90)),
        "n_small": count((data >= 97) & (data <= 122)),
        "n_digits": count((data >= 48) & (data <= 57)),
        "n_marks": count((data >= 33) & (data <= 126) & ~_letter_or_digit(data)),
        "n_lines": count(data == 10) + 1,
    }
    return stats | ({"words": words, "hashes": hashes} if hashed else {})


def _letter_or_digit(data: np.ndarray) -> np.ndarray:
    small = data | 32
    return ((small >= 97) & (small <= 122)) | ((data >= 48) & (data <= 57))
