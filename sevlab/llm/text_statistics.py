"""Counts of each text that the quality rules judge (numpy over Arrow batches)."""

from __future__ import annotations

import numpy as np

from sevlab.llm import bytescan as scan

#: Symbols that prose has few of.
SYMBOLS = scan.byte_set(b"#*$%&|<>")
PUNCTUATION = scan.byte_set(bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in "#*$%&|<>"))
UPPER = scan.byte_set(bytes(range(65, 91)))
DIGITS = scan.byte_set(bytes(range(48, 58)))
REPEAT_WINDOW = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_punct", "n_echoes")


def repeated_words(hashes: np.ndarray, first: np.ndarray, n: int = REPEAT_WINDOW) -> np.ndarray:
    """For each row: its words that lie in an n-word window found at least twice in the row."""
    found, begin = scan.windows(hashes, first, n)
    if not len(found):
        return np.zeros(len(first) - 1, np.int64)
    row = np.repeat(np.arange(len(first) - 1), np.diff(begin))
    key = scan.mix(found + row.astype(np.uint64) * scan.WINDOW_FACTOR[-1])
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    again = np.zeros(len(key), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    word = (np.arange(len(key)) - begin[row] + first[row])[again]  # each repeated window's first word
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, word, 1)
    np.add.at(cover, word + n, -1)
    return scan.per_row(np.cumsum(cover)[:-1] > 0, first)


def duplicate_lines(data: np.ndarray, offsets: np.ndarray, total: np.ndarray, word_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row: lines with a word that equal an earlier line of the row; all its lines."""
    spans = scan.lines(data, offsets)
    with_word = np.searchsorted(word_starts, spans.ends) > np.searchsorted(word_starts, spans.starts)
    row = spans.rows()[with_word]
    key = scan.span_hash(total, spans.starts[with_word], spans.ends[with_word])
    key = scan.mix(key + row.astype(np.uint64) * scan.WINDOW_FACTOR[-1])
    order = np.argsort(key, kind="stable")
    later = order[1:][key[order[1:]] == key[order[:-1]]]
    return np.bincount(row[later], minlength=len(offsets) - 1).astype(np.int64), spans.counts


def count(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """COUNTS of each row of a chunk."""
    spans = scan.words(data, offsets)
    total = scan.running_hash(data)
    dup, n_lines = duplicate_lines(data, offsets, total, spans.starts)
    hashes = scan.span_hash(total, spans.starts, spans.ends)
    echo = np.zeros(len(hashes), bool)  # words equal to the one before
    echo[1:] = hashes[1:] == hashes[:-1]
    echo[spans.first[:-1][spans.counts > 0]] = False
    return {
        "n_words": spans.counts.astype(np.int64),
        "word_chars": scan.per_row(~scan.SPACE[data] & ~scan.CONTINUES[data], offsets),
        "n_symbols": scan.per_row(SYMBOLS[data], offsets),
        "n_dup_lines": dup,
        "n_repeat_words": repeated_words(hashes, spans.first),
        "n_lines": n_lines.astype(np.int64),
        "n_upper": scan.per_row(UPPER[data], offsets),
        "n_digits": scan.per_row(DIGITS[data], offsets),
        "n_punct": scan.per_row(PUNCTUATION[data], offsets),
        "n_echoes": scan.per_row(echo, spans.first),
    }
