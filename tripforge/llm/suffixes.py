"""Suffix sorting in two stages, and runs of equal prefixes, for byte blocks of bounded size."""

from __future__ import annotations

import numpy as np

from tripforge.llm.flat import U64

_WORD = 8


def _big_endian_words(text: np.ndarray, pad: int) -> np.ndarray:
    """The eight bytes from each position on as one number that orders as they do; zeros follow the text."""
    longer = np.concatenate((text, np.zeros(pad + _WORD, np.uint8))).astype(U64)
    size = len(text) + pad
    out = np.zeros(size, U64)
    for at in range(_WORD):
        out |= longer[at : at + size] << U64(56 - 8 * at)
    return out


def smaller_than_successor(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one. Within a run of one byte all answers are the run's last."""
    if not len(text):
        return np.zeros(0, bool)
    rising = np.zeros(len(text), bool)
    rising[:-1] = text[:-1] < text[1:]
    ends = np.append(np.flatnonzero(text[:-1] != text[1:]), len(text) - 1)
    return rising[ends[np.searchsorted(ends, np.arange(len(text)))]]


def _sorted_directly(words: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """``places`` in the order of their first ``depth`` bytes, ties by place: eight bytes at a time, only ties going on."""
    order = places[np.argsort(words[places], kind="stable")]
    tied = np.zeros(len(order), np.int64)
    tied[1:] = np.cumsum(words[order[1:]] != words[order[:-1]])
    at = _WORD
    while at < depth and len(order):
        sizes = np.bincount(tied)
        open_ = np.flatnonzero(sizes[tied] > 1)
        if not len(open_):
            break
        own, keys = order[open_], words[order[open_] + at]
        again = np.lexsort((own, keys, tied[open_]))
        order[open_] = own[again]
        keys = keys[again]
        cut = np.zeros(len(order), bool)
        cut[1:] = tied[1:] != tied[:-1]
        inner = np.zeros(len(open_), bool)
        inner[1:] = keys[1:] != keys[:-1]
        cut[open_] |= inner
        cut[:1] = False
        tied = np.cumsum(cut)
        at += _WORD
    return order


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes, ordered by at least their first ``depth`` bytes.

    Only suffixes smaller than their successors are sorted directly. The others
    follow by one scan over the buckets of first bytes, from the smallest: when
    a suffix takes its place, its predecessor, if larger than it, goes next to
    the front part of its own bucket. The scan handles a bucket's entries
    together; within a bucket it goes round once per step of a run of that byte.
    """
    size = len(text)
    if not size:
        return np.zeros(0, np.int64)
    small = smaller_than_successor(text)
    direct = _sorted_directly(_big_endian_words(text, depth + _WORD), np.flatnonzero(small), depth)
    direct_ends = np.concatenate(([0], np.cumsum(np.bincount(text[direct], minlength=256))))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[-1]].append(np.array([size - 1]))
    out = []

    def induce(entries: np.ndarray, bucket: int) -> np.ndarray:
        """Send predecessors to their buckets; those of this same bucket are returned."""
        before = entries[entries > 0] - 1
        before = before[~small[before]]
        heads = text[before]
        own = before[heads == bucket]
        before, heads = before[heads != bucket], heads[heads != bucket]
        order = np.argsort(heads, kind="stable")
        before, heads = before[order], heads[order]
        cuts = np.flatnonzero(heads[1:] != heads[:-1]) + 1
        if len(before):
            for start, group in zip(np.concatenate(([0], cuts)), np.split(before, cuts), strict=True):
                waiting[heads[start]].append(group)
        return own

    for bucket in range(256):
        front = np.concatenate(waiting[bucket]) if waiting[bucket] else np.zeros(0, np.int64)
        while len(front):
            out.append(front)
            front = induce(front, bucket)
        back = direct[direct_ends[bucket] : direct_ends[bucket + 1]]
        if len(back):
            out.append(back)
            induce(back, bucket)
    return np.concatenate(out)


def equal_runs(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """A number for each entry of a suffix array; neighbours whose common prefix has ``length`` bytes share it.

    Common prefixes are compared eight bytes at a time, by the pairs still equal.
    """
    words = _big_endian_words(text, length + _WORD)
    left = np.arange(1, len(order))
    for at in range(0, length, _WORD):
        a, b = words[order[left - 1] + at], words[order[left] + at]
        rest = length - at
        if rest < _WORD:
            drop = U64(8 * (_WORD - rest))
            a, b = a >> drop, b >> drop
        left = left[a == b]
    fresh = np.ones(len(order), bool)
    fresh[left] = False
    return np.cumsum(fresh) - 1
