"""Merging of Burrows-Wheeler transforms by interleave refinement, in numpy.

A shard is a string of passages, each followed by STEP zeros. Its suffixes are sorted once; of that order its
transform keeps, for every suffix, the STEP bytes before it and the place of the suffix that begins with them.
Merging never sorts suffixes again. It starts from the interleaving by the first few bytes; a round takes the suffixes
in the interleaving so far and deals out their predecessors stably by their STEP bytes, which is the
interleaving at STEP more bytes of depth: shards keep their own order, only the interleaving changes.
Neighbours get a boundary in the first round that tells them apart, so at the end runs without a boundary are
the intervals of suffixes whose common prefix has the wanted length. A suffix alone between two boundaries has no equal at any
greater depth, nor has its predecessor: it is left out from there on, as is one that runs over the end of its passage.
"""

from __future__ import annotations

import numpy as np

STEP = 5
#: Suffixes of one merge: a place and STEP bytes share a number of 64 bits.
MOST = 1 << 24


def lay_out(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shard's string of passages (bytes plus one; no byte of UTF-8 is 0xFF) with STEP zeros after each, and each passage's start."""
    n = len(at) - 1
    starts = at[:-1] + STEP * np.arange(n)
    text = np.zeros(len(data) + STEP * n, np.uint8)
    text[np.arange(len(data)) + STEP * np.repeat(np.arange(n), np.diff(at))] = data + np.uint8(1)
    return text, starts


def _grams(text: np.ndarray) -> np.ndarray:
    """The STEP bytes from each place on as one number; zeros follow the last."""
    wide = np.concatenate([text, np.zeros(STEP - 1, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(text), np.uint64)
    for j in range(STEP):
        out = (out << np.uint64(8)) | wide[j : j + len(text)]
    return out


def sorted_suffixes(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, by doubling the depth of what is still tied."""
    n = len(text)
    grams = _grams(text)
    key = (grams << np.uint64(24)) | (np.concatenate([grams[STEP:], np.zeros(min(STEP, n), np.uint64)]) >> np.uint64(16))
    order = np.argsort(key, kind="stable")
    # A suffix that ends within the depth comes before all that go on: its length stands for what would follow.
    rank, place, depth = np.empty(n, np.int64), np.arange(n), 8
    of, tied = key[order], np.ones(n, bool)
    while True:
        new = np.concatenate([[True], of[1:] != of[:-1]])
        first = np.maximum.accumulate(np.where(new, np.arange(len(of)), 0))
        rank[order[place]] = place[first]
        tied = ~new | ~np.concatenate([new[1:], [True]])
        place = place[tied]
        if not len(place):
            return order
        at = order[place]
        after = at + depth
        second = np.where(after < n, rank[np.minimum(after, n - 1)] + depth + 1, n - at)
        # Equal first ranks stand together already, so sorting by both keeps each tie in its places.
        of = (rank[at].astype(np.uint64) << np.uint64(32)) | second.astype(np.uint64)
        by = np.argsort(of, kind="stable")
        order[place], of = at[by], of[by]
        depth *= 2


def _dealt(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of STEP bytes in order, and the stable order of their places: both fit in one number."""
    both = np.sort((keys << np.uint64(24)) | np.arange(len(keys), dtype=np.uint64))
    return both >> np.uint64(24), (both & np.uint64(MOST - 1)).astype(np.int64)


def _whole(grams: np.ndarray, n: int) -> np.ndarray:
    """Which runs of n bytes have no zero: zeros come STEP at a time, so one stands at an end."""
    return ((grams & np.uint64(0xFF)) > 0) & ((grams >> np.uint64(8 * (n - 1))) > 0)


def intervals(texts: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For shards laid out by `lay_out`: the suffixes that share their first `depth` bytes, all within a passage, with another one, numbered through
    the shards' strings in merged order, and each one's interval."""
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    n = first[-1]
    if n > MOST:
        raise ValueError("shards of one merge have at most 2**24 bytes")
    # Arrays over the shards' suffix orders, one after the other.
    suffix = np.concatenate([np.zeros(0, np.int64), *(sorted_suffixes(t) + a for t, a in zip(texts, first))])
    place = np.empty(n, np.int32)
    place[suffix] = np.arange(n, dtype=np.int32)
    grams = np.concatenate([np.zeros(0, np.uint64), *(_grams(t) for t in texts)])
    before = np.maximum(suffix - STEP, 0)
    preceding, previous = np.where(suffix >= STEP, grams[before], np.uint64(0)), place[before]

    begin = depth % STEP or STEP
    heads = grams[suffix] >> np.uint64(8 * (STEP - begin))
    order = np.flatnonzero(_whole(heads, begin))
    symbols, by = _dealt(heads[order])
    order, held = order[by], np.zeros(len(order), np.int32)
    for done in range(begin, depth + 1, STEP):
        apart = np.ones(len(order) + 1, bool)
        apart[1:-1] = (symbols[1:] != symbols[:-1]) | (held[1:] != held[:-1])
        tied = ~(apart[:-1] & apart[1:])
        order, group = order[tied], np.cumsum(apart[:-1], dtype=np.int32)[tied]
        if done == depth:
            return suffix[order], group
        symbols = preceding[order]
        use = _whole(symbols, STEP)
        symbols, by = _dealt(symbols[use])
        order, held = previous[order[use][by]], group[use][by]
    raise AssertionError
