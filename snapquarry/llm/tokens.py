"""Token ids by the tokenizers library, with a bounded store of words already met."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import hash_spans, slices

#: Words kept by one Python worker (about 40 bytes each), words encoded as one text, bytes of text in one go.
KEPT, RUN, SLICE = 800_000, 256, 1 << 20
_open: dict[tuple, "Encoder"] = {}
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[10, 32]] = True
#: Bytes that end a quick reading: white space other than blank and line feed, controls, and a zero.
_RARE = np.zeros(256, dtype=bool)
_RARE[[0, 9, 11, 12, 13, 28, 29, 30, 31]] = True
#: First bytes of white space beyond ASCII, and the bytes that follow (fixed values of UTF-8).
_WIDE = {0xC2: (b"\x85", b"\xa0"), 0xE1: (b"\x9a\x80",), 0xE3: (b"\x80\x80",), 0xE2: (*(b"\x80" + bytes([k]) for k in (*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF)), b"\x81\x9f")}


class Encoder:
    """Ids of whole texts, equal to encoding each text at once.

    Both tokenizers that this is used with split a text before they merge, and never join the two sides of a blank
    that stands between two other characters, so a text is encoded blank by blank and each different word once, many
    in one call. Words are told apart by 64-bit hashes. A text in which white space precedes white space, with uncommon
    white space or a zero character, or that holds a special token, is encoded whole. `ordinary`: the strings of
    special tokens are text like any other (the end id can't occur in a text then).
    """

    def __init__(self, path: str, ordinary: bool = False):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = ordinary
        self.special = [] if ordinary else [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        blank = [i for token, i in vocabulary.items() if token.startswith("Ġ")]
        kept = any(i in blank for i in self.tokenizer.encode(" a", add_special_tokens=False).ids)
        #: set behind a word where the tokenizer drops blanks: one token of its own
        self.mark = "" if kept else " \0"
        self.opens[blank if kept else self.tokenizer.encode("a \0 a", add_special_tokens=False).ids[1]] = True
        self.keys, self.begin, self.count = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32)
        self.met, self.pool = np.zeros(0, dtype=bool), np.zeros(0, dtype="<u4")

    def _batch(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words, and how many each has. Words behind a blank are encoded many at a time, and cut where a
        token opens with a blank (or at the lone mark between words, where the tokenizer drops blanks)."""
        counts = np.zeros(len(words), dtype=np.int64)
        out: list[np.ndarray] = []
        first = [i for i, w in enumerate(words) if w[0] != " "]
        later = [i for i, w in enumerate(words) if w[0] == " "]
        for i, ids in zip(first, self._batch([words[i] for i in first])):
            counts[i] = len(ids)
            out.append(ids)
        runs = [later[i : i + RUN] for i in range(0, len(later), RUN)]
        for run, ids in zip(runs, self._batch([self.mark.join([words[i] for i in r]) for r in runs])):
            at = np.flatnonzero(self.opens[ids])
            each = np.diff(np.concatenate([[-1], at, [len(ids)]])) - 1 if self.mark else np.diff(np.append(at, len(ids)))
            if len(each) != len(run) or (not self.mark and at[0] != 0):
                raise ValueError("joined words can't be told apart")
            counts[run] = each
            out.append(ids[~self.opens[ids]] if self.mark else ids)
        order = np.argsort(np.array(first + later, dtype=np.int64), kind="stable")
        ids = np.concatenate(out) if out else self.pool[:0]
        listed = counts[first + later]
        begin = np.cumsum(listed) - listed
        return ids[_ranges(begin[order], counts)], counts

    def _add(self, keys: np.ndarray, words: list[str]) -> None:
        if len(self.keys) + len(keys) > KEPT:  # what has been met since the last time stays, if that leaves room
            stay = self.met & (np.count_nonzero(self.met) < KEPT // 2)
            begin, count = self.begin[stay], self.count[stay]
            self.pool = self.pool[_ranges(begin, count)]
            self.keys, self.count, self.begin = self.keys[stay], count, np.cumsum(count, dtype=np.int64) - count
            self.met = np.zeros(len(self.keys), dtype=bool)
        ids, counts = self._words(words)
        begin = np.cumsum(counts) - counts + len(self.pool)
        self.pool = np.concatenate([self.pool, ids])
        at = np.searchsorted(self.keys, keys)
        self.keys, self.begin = np.insert(self.keys, at, keys), np.insert(self.begin, at, begin)
        self.count, self.met = np.insert(self.count, at, counts), np.insert(self.met, at, False)

    def _odd(self, buf: np.ndarray, offs: np.ndarray, raw: bytes) -> np.ndarray:
        """Rows that are encoded whole."""
        rows = len(offs) - 1
        out = np.zeros(rows, dtype=bool)
        full = offs[1:] > offs[:-1]
        row_of = lambda at: np.searchsorted(offs, at, side="right") - 1
        out[row_of(np.flatnonzero(_RARE[buf]))] = True
        white = _WHITE[buf]
        pair = np.flatnonzero(white[1:] & white[:-1])
        pair = pair[row_of(pair) == row_of(pair + 1)]
        out[row_of(pair)] = True
        out[np.flatnonzero(full)] |= (buf[offs[:-1][full]] == 32) | (buf[offs[1:][full] - 1] == 32)
        for lead, tails in _WIDE.items():
            if (at := np.flatnonzero(buf == lead)).size:
                two = buf[np.minimum(at + 1, len(buf) - 1)].astype(np.int64)
                three = buf[np.minimum(at + 2, len(buf) - 1)]
                for tail in tails:
                    out[row_of(at[(two == tail[0]) & ((three == tail[1]) if len(tail) > 1 else True)])] = True
        for token in self.special:
            at = raw.find(token)
            while at >= 0:
                out[row_of(at)] = True
                at = raw.find(token, at + 1)
        return out

    def encode(self, buf: np.ndarray, offs: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, one behind the other with `end_id` after each, and where each row begins (and the last ends)."""
        rows, raw = len(offs) - 1, buf.tobytes()
        if not len(buf):
            return np.full(rows, end_id, dtype="<u4"), np.arange(rows + 1)
        odd = self._odd(buf, offs, raw)
        opens = buf == 32
        opens[offs[:-1][offs[1:] > offs[:-1]]] = True
        start = np.flatnonzero(opens)
        end = np.append(start[1:], len(buf))
        row = np.searchsorted(offs, start, side="right") - 1
        keep = ~odd[row]
        start, end, row = start[keep], end[keep], row[keep]
        names, first, which = np.unique(hash_spans(buf, start, end), return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, names), max(len(self.keys) - 1, 0))
        new = self.keys[at] != names if len(self.keys) else np.ones(len(names), dtype=bool)
        self.met[at[~new]] = True
        begin, count = np.empty(len(names), dtype=np.int64), np.empty(len(names), dtype=np.int64)
        begin[~new], count[~new] = self.begin[at[~new]], self.count[at[~new]]
        own = self.pool[_ranges(begin[~new], count[~new])]  # taken before the store is cleared
        begin[~new] = np.cumsum(count[~new]) - count[~new]
        if new.any():
            self._add(names[new], [raw[x:y].decode() for x, y in zip(start[first[new]].tolist(), end[first[new]].tolist())])
            at = np.searchsorted(self.keys, names[new])
            count[new] = self.count[at]
            begin[new] = np.cumsum(count[new]) - count[new] + len(own)
            own = np.concatenate([own, self.pool[_ranges(self.begin[at], self.count[at])]])
        # behind the words stand the end id and the rows that are encoded whole
        whole = np.flatnonzero(odd)
        made = [np.array(self.tokenizer.encode(raw[offs[i] : offs[i + 1]].decode(), add_special_tokens=False).ids, dtype="<u4") for i in whole.tolist()]
        sizes = np.array([len(m) for m in made], dtype=np.int64)
        pool = np.concatenate([own, np.array([end_id], dtype="<u4"), *made])
        part_row = np.concatenate([row, whole, np.arange(rows)])
        part_begin = np.concatenate([begin[which], len(own) + 1 + np.cumsum(sizes) - sizes, np.full(rows, len(own))])
        part_count = np.concatenate([count[which], sizes, np.ones(rows, dtype=np.int64)])
        order = np.argsort(part_row, kind="stable")
        bounds = np.zeros(rows + 1, dtype=np.int64)
        np.cumsum(np.bincount(part_row, weights=part_count, minlength=rows).astype(np.int64), out=bounds[1:])
        return pool[_ranges(part_begin[order], part_count[order])], bounds


def _ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... (count[0] of them), begin[1], ..."""
    count = count.astype(np.int64)
    return np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())


def encoder(path: str, ordinary: bool = False) -> Encoder:
    """The worker's encoder; a Python worker keeps it from task to task."""
    if (path, ordinary) not in _open:
        _open[path, ordinary] = Encoder(path, ordinary)
    return _open[path, ordinary]


def encoded(column: pa.Array, path: str, end_id: int, ordinary: bool = False) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, ids, bounds) of consecutive rows, see Encoder.encode; nulls are empty."""
    enc = encoder(path, ordinary)
    for a, b, buf, offs in slices(column, SLICE):
        yield a, b, *enc.encode(buf, offs, end_id)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
