"""Counts of a text, for all rows of a text column at once (numpy).

``document_stats`` is used by the quality rules and by the quality
classifier. Null and empty texts have zero for every count. Every count is of
the whole text.
"""

from __future__ import annotations

import numpy as np

from medallion.llm.words import mix, runs, span_hashes, windows, words

WINDOW = 5
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".,;:")] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"!?")] = True
_ROW = np.uint64(0x9E3779B97F4A7C15)

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_distinct_words",
    "n_same_as_before", "n_upper", "n_letters", "n_digits", "n_stops", "n_marks", "n_wide", "n_short_words",
    "n_marked_words", "n_bytes",
)


def _per_row(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def _repeated(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For (row, value) pairs: whether the pair occurs more than once, and
    whether it is one beyond the first of its kind."""
    key = mix(value + row.astype(np.uint64) * _ROW)
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    many, beyond = np.zeros(len(key), bool), np.zeros(len(key), bool)
    many[order[1:]] |= same
    beyond[order[1:]] |= same
    many[order[:-1]] |= same
    return many, beyond


def document_stats(data: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """The :data:`COUNTS` of each row of (bytes, offsets)."""
    n = len(at) - 1
    w = words(data, at)
    starts_char = (data & 0xC0) != 0x80
    chars = np.zeros(len(data) + 1, np.int64)
    np.cumsum(starts_char, out=chars[1:])
    length = chars[w.ends] - chars[w.starts]
    first = w.first

    line_start, line_end = runs(data != 10, at)
    words_before = np.zeros(len(data) + 1, np.int64)
    words_before[1:] = np.cumsum(np.bincount(w.starts, minlength=len(data))) if len(data) else 0
    full = words_before[line_end] > words_before[line_start]
    line_start, line_end = line_start[full], line_end[full]
    line_row = np.searchsorted(at, line_start, side="right") - 1
    _, dup_line = _repeated(line_row, span_hashes(data, line_start, line_end))

    row, start, gram = windows(w, WINDOW, whole_if_short=False)
    many, _ = _repeated(row, gram)
    cover = np.zeros(len(w.starts) + WINDOW + 1, np.int64)
    np.add.at(cover, start[many], 1)
    np.add.at(cover, start[many] + WINDOW, -1)
    covered = np.cumsum(cover)[: len(w.starts)] > 0

    word_row = w.rows()
    _, again = _repeated(word_row, w.hashes)
    as_before = np.zeros(len(w.starts), bool)
    if len(w.starts) > 1:
        as_before[1:] = (w.hashes[1:] == w.hashes[:-1]) & (word_row[1:] == word_row[:-1])
    marked = _SYMBOLS[data[w.ends - 1]] | _MARK[data[w.ends - 1]] if len(w.starts) else np.zeros(0, bool)

    def by_row(rows: np.ndarray) -> np.ndarray:
        return np.bincount(rows, minlength=n).astype(np.int64)

    return {
        "n_words": w.counts.astype(np.int64),
        "word_chars": _sums(length, first),
        "n_symbols": _per_row(_SYMBOLS[data], at),
        "n_lines": by_row(line_row),
        "n_dup_lines": by_row(line_row[dup_line]),
        "n_repeat_words": _per_row(covered, first),
        "n_distinct_words": w.counts - _per_row(again, first),
        "n_same_as_before": _per_row(as_before, first),
        "n_upper": _per_row(_UPPER[data], at),
        "n_letters": _per_row(_LETTER[data], at),
        "n_digits": _per_row(_DIGIT[data], at),
        "n_stops": _per_row(_STOP[data], at),
        "n_marks": _per_row(_MARK[data], at),
        "n_wide": _per_row(starts_char & (data >= 0x80), at),
        "n_short_words": _per_row(length <= 3, first),
        "n_marked_words": _per_row(marked, first),
        "n_bytes": np.diff(at).astype(np.int64),
    }


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]
