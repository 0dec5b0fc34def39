"""Suffix arrays of byte strings by recursive induced sorting, in stretches of whole arrays, and their permuted common
prefixes."""

from __future__ import annotations

import numpy as np

from .common import prefix_hash, span_hash


def types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one behind it; the last, an end mark below all else, is too."""
    n = len(text)
    out = np.ones(n, dtype=bool)
    differ = np.flatnonzero(text[:-1] != text[1:])
    smaller = text[differ] < text[differ + 1]
    upto = np.searchsorted(differ, np.arange(n - 1))
    out[: n - 1] = smaller[np.minimum(upto, len(differ) - 1)] if len(differ) else False
    return out


def _by_char(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stable order by character, and each one's number within its character in that order."""
    order = np.argsort(chars, kind="stable")
    ordered = chars[order]
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    return order, np.arange(len(chars)) - np.repeat(first, np.diff(np.append(first, len(chars))))


def induce(text: np.ndarray, small: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Suffix order induced from leftmost-smaller suffixes given in their order (or sorted by first character only, to
    get their substrings sorted). The array is read once from the left for larger and once from the right for smaller
    suffixes, in stretches as long as nothing that a stretch induces falls into itself."""
    n, width = len(text), int(text.max()) + 1
    end = np.cumsum(np.bincount(text, minlength=width))
    seeds = np.bincount(text[lms], minlength=width)
    out = np.full(n, -1, dtype=np.int64)
    order, rank = _by_char(text[lms])
    chosen = lms[order]
    out[(end - seeds)[text[chosen]] + rank] = chosen
    head = np.append(0, end[:-1])
    at, step = 0, max(256, n >> 6)
    while at < n:
        stop = min(at + step, n)
        place = np.flatnonzero(out[at:stop] > 0)
        j = out[at + place] - 1
        larger = ~small[j]
        place, j = place[larger], j[larger]
        step *= 2
        if len(j):
            order, rank = _by_char(text[j])
            target = head[text[j[order]]] + rank
            if (least := int(target.min())) < stop:
                stop = least
                inside = place[order] < stop - at
                order, target = order[inside], target[inside]
                step = max(256, 2 * (stop - at))
            out[target] = j[order]
            np.maximum.at(head, text[j[order]], target + 1)
        at = stop
    first = end - seeds
    out[np.repeat(first - (np.cumsum(seeds) - seeds), seeds) + np.arange(seeds.sum())] = -1
    tail = end.copy()
    at, step = n, max(256, n >> 6)
    while at > 0:
        stop = max(at - step, 0)
        place = np.flatnonzero(out[stop:at] > 0)[::-1] + stop
        j = out[place] - 1
        smaller = small[j]
        place, j = place[smaller], j[smaller]
        step *= 2
        if len(j):
            order, rank = _by_char(text[j])
            target = tail[text[j[order]]] - 1 - rank
            if (most := int(target.max())) >= stop:
                stop = most + 1
                inside = place[order] >= stop
                order, target = order[inside], target[inside]
                step = max(256, 2 * (at - stop))
            out[target] = j[order]
            np.minimum.at(tail, text[j[order]], target)
        at = stop
    out[0] = n - 1
    return out


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array of a text of whole numbers whose last one is its only smallest: leftmost-smaller substrings are sorted
    and named, the string of their names is sorted in the same way unless all differ, and all else is induced."""
    if len(text) < 2:
        return np.arange(len(text))
    small = types(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    first = induce(text, small, lms)
    is_lms = np.zeros(len(text), dtype=bool)
    is_lms[lms] = True
    sorted_lms = first[is_lms[first]]
    number = np.empty(len(text), dtype=np.int64)
    number[lms] = np.arange(len(lms))
    stop = np.append(lms[1:] + 1, len(text))
    value = span_hash(prefix_hash(text), lms, stop)[number[sorted_lms]]
    names = np.empty(len(lms), dtype=np.int64)
    names[number[sorted_lms]] = np.cumsum(np.append(False, value[1:] != value[:-1]))
    order = np.argsort(names) if names.max() + 1 == len(names) else suffix_array(names)
    return induce(text, small, lms[order])


def permuted_prefixes(text: np.ndarray, order: np.ndarray, begins: np.ndarray, most: int = 128) -> np.ndarray:
    """For each position, the common prefix (up to `most`, or beyond) of its suffix with the one before it in order.
    It is compared only where the characters in front differ, and at `begins`; elsewhere it is one less than at the
    position before."""
    n = len(text)
    before = np.empty(n, dtype=np.int64)
    before[order[0]] = -1
    before[order[1:]] = order[:-1]
    own = np.ones(n, dtype=bool)
    q = before[1:]
    own[1:] = (q <= 0) | (text[:-1] != text[np.maximum(q, 1) - 1])
    own[begins] = True
    at = np.flatnonzero(own & (before >= 0))
    padded = np.zeros(n + most + 8, dtype=np.uint8)
    padded[:n] = text
    words = np.ndarray(shape=(n + most,), dtype="<u8", buffer=padded, strides=(1,))
    value = np.zeros(n, dtype=np.int64)
    left, other = at, before[at]
    for k in range(0, most, 8):
        differ = words[left + k] ^ words[other + k]
        stop = differ != 0
        low = differ[stop] & (~differ[stop] + np.uint64(1))
        value[left[stop]] = k + (np.log2(low.astype(np.float64)).astype(np.int64) >> 3)
        left, other = left[~stop], other[~stop]
        if not len(left):
            break
    value[left] = most
    last = np.maximum.accumulate(np.where(own, np.arange(n), 0))
    return value[last] - (np.arange(n) - last)


def shared_windows(strings: list[bytes], width: int) -> np.ndarray:
    """For all strings joined, each followed by one mark: the number of the group of equal `width`-byte windows that
    starts at each place, -1 where none fits. Strings are at most twice `width` long or so (see `most`)."""
    sizes = np.array([len(s) for s in strings], dtype=np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    text = np.frombuffer(b"\0".join(strings) + b"\0\0", dtype=np.uint8).copy()
    mark = np.zeros(len(text), dtype=bool)
    mark[begins + sizes] = True
    text += 2  # bytes of UTF-8 stay below 250
    text[mark] = 1
    text[-1] = 0
    order = suffix_array(text)
    common = permuted_prefixes(text, order, begins)
    room = np.zeros(len(text), dtype=np.int64)
    stops = np.repeat(begins + sizes, sizes + 1)
    room[: len(stops)] = stops - np.arange(len(stops))
    fits = room[order] >= width
    new = np.ones(len(order), dtype=bool)
    new[1:] = ~((common[order[1:]] >= width) & fits[1:] & fits[:-1])
    out = np.empty(len(text), dtype=np.int64)
    out[order] = np.where(fits, np.cumsum(new) - 1, -1)
    return out
