"""Counts over whole texts, in numpy over Arrow batches: the base of quality rules and of the quality features."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import _BLANK, Spans, hash_spans, lines_of, slices, windows_of, words_of

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
#: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def per_doc(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    out, full = np.zeros(len(offs) - 1, dtype=np.int64), np.flatnonzero(offs[1:] > offs[:-1])
    if len(full):
        out[full] = np.add.reduceat(flags, offs[:-1][full], dtype=np.int64)
    return out


def repeats(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry: how many of its row have its value, and whether it is the first of them."""
    order = np.lexsort((np.arange(len(doc)), value, doc))
    d, v = doc[order], value[order]
    new = np.ones(len(d), dtype=bool)
    new[1:] = (d[1:] != d[:-1]) | (v[1:] != v[:-1])
    group = np.cumsum(new) - 1
    count, first = np.empty(len(d), dtype=np.int64), np.empty(len(d), dtype=bool)
    count[order] = np.bincount(group, minlength=1)[group] if len(d) else 0
    first[order] = new
    return count, first


def same_doc_windows(words: Spans, width: int) -> np.ndarray:
    """Indices of the words at which `width` words of one row start."""
    n = len(words.doc) - width + 1
    return np.flatnonzero(words.doc[:n] == words.doc[width - 1 :]) if n > 0 else np.zeros(0, dtype=np.int64)


def counts_of(buf: np.ndarray, offs: np.ndarray) -> tuple[dict[str, np.ndarray], Spans, np.ndarray]:
    """The five base counts for each row, its words, and their hashes. It takes about 25 bytes of memory for each byte
    of text, so a text of 20 MB half a GB."""
    rows = len(offs) - 1
    words, lines = words_of(buf, offs), lines_of(buf, offs)
    whash = hash_spans(buf, words.start, words.end)
    chars = (buf & 0xC0) != 0x80
    worded = np.flatnonzero(np.searchsorted(words.start, lines.end) > np.searchsorted(words.start, lines.start))
    line_doc = lines.doc[worded]
    _, first = repeats(line_doc, hash_spans(buf, lines.start[worded], lines.end[worded]))
    at = same_doc_windows(words, 5)
    seen, _ = repeats(words.doc[at], windows_of(whash, 5)[at]) if len(at) else (np.zeros(0, dtype=np.int64), None)
    cover = np.zeros(len(words.doc) + 1, dtype=np.int64)
    again = at[seen > 1]
    np.add.at(cover, again, 1)
    np.add.at(cover, again + 5, -1)
    covered = np.cumsum(cover[:-1]) > 0
    out = {
        "n_words": np.diff(words.first),
        "word_chars": per_doc(chars & ~_BLANK[buf], offs),
        "n_symbols": per_doc(_SYMBOL[buf], offs),
        "n_dup_lines": np.bincount(line_doc[~first], minlength=rows),
        "n_repeat_words": np.bincount(words.doc[covered], minlength=rows),
    }
    return out, words, whash


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All columns but text, followed by the five counts."""
    for batch in batches:
        text = batch.column("text")
        parts = [counts_of(buf, offs)[0] for _, _, buf, offs in slices(text)]
        keep = [i for i, n in enumerate(batch.schema.names) if n != "text"]
        columns = [batch.column(i) for i in keep] + [
            pa.array(np.concatenate([p[c] for p in parts]) if parts else np.zeros(0, dtype=np.int64), pa.int64()) for c in COUNTS
        ]
        yield pa.RecordBatch.from_arrays(columns, names=[batch.schema.names[i] for i in keep] + COUNTS)
