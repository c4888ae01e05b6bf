"""Burrows-Wheeler transforms of string collections, and merging them.

A shard is a list of strings of symbols 1..65535; each string s is read as
the rotations of s followed by the end mark 0.  ``shard`` sorts the rotations
of one shard; ``merge`` brings the transforms of several shards into one order
by interleave refinement, without sorting suffixes again: an interleave says
which shard each place of the merged order takes its next rotation from.  One
round reads the transforms in the order of the interleave and deals their
symbols stably, which orders rotations by one symbol more.  A place where two
neighbours first come apart in round h separates rotations with a common
prefix of h - 1 symbols, so the rounds also give the common prefixes; after
``depth`` rounds (or when nothing comes apart any more) the runs that never
came apart are the repeated intervals.
"""

from __future__ import annotations

import numpy as np


def shard(strings: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(transform, string number and position of each rotation), rotations in
    order of their first 2 * ``depth`` symbols at least."""
    sizes = np.array([len(s) + 1 for s in strings])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    text = np.zeros(int(ends[-1]), np.int64)
    for s, a in zip(strings, starts):
        text[a:a + len(s)] = s
    number = np.repeat(np.arange(len(strings)), sizes)
    place = np.arange(len(text)) - starts[number]
    rank, step = text, 1
    while step < 2 * depth:  # ranks of prefixes of twice the length
        follow = starts[number] + (place + step) % sizes[number]
        rank = np.unique(rank * (len(text) + 65536) + rank[follow], return_inverse=True)[1]
        step *= 2
    order = np.argsort(rank, kind="stable")
    before = starts[number] + (place - 1) % sizes[number]
    return text[before][order].astype(np.uint16), number[order], place[order]


def merge(transforms: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(interleave, common prefixes): the shard of each place of the merged
    order, and how many symbols (at most ``depth``) each place shares with the
    one before."""
    symbols = np.concatenate(transforms)
    n = len(symbols)
    interleave = np.repeat(np.arange(len(transforms), dtype=np.uint16), [len(t) for t in transforms])
    group = np.zeros(n, np.int64)
    common = np.full(n, depth, np.int64)
    common[:1] = 0
    apart = np.zeros(n, bool)
    apart[:1] = True
    for h in range(1, depth + 1):
        read = np.empty(n, np.uint16)
        read[np.argsort(interleave, kind="stable")] = symbols
        deal = np.argsort(read, kind="stable")
        interleave, read, group = interleave[deal], read[deal], group[deal]
        split = np.ones(n, bool)
        split[1:] = (read[1:] != read[:-1]) | (group[1:] != group[:-1])
        common[split & ~apart] = h - 1
        if np.array_equal(split, apart):
            break
        apart = split
        group = np.cumsum(split)
    return interleave, common


def repeated(strings: list[np.ndarray], weights: np.ndarray, depth: int, shard_strings: int = 256) -> list[np.ndarray]:
    """Per string, whether the ``depth`` symbols from each position on (inside
    the string) occur in all in strings of total weight two or more, or at
    another position."""
    out = [np.zeros(len(s), bool) for s in strings]
    if not strings:
        return out
    shards = [shard(strings[lo:lo + shard_strings], depth) for lo in range(0, len(strings), shard_strings)]
    interleave, common = merge([s[0] for s in shards], depth)
    place = np.argsort(interleave, kind="stable")
    number, position = np.empty(len(place), np.int64), np.empty(len(place), np.int64)
    number[place] = np.concatenate([s[1] + i * shard_strings for i, s in enumerate(shards)])
    position[place] = np.concatenate([s[2] for s in shards])
    interval = np.cumsum(common < depth)
    total = np.bincount(interval, weights[number])
    sizes = np.array([len(s) for s in strings])
    hit = (total[interval] >= 2) & (position + depth <= sizes[number])
    for i, p in zip(number[hit], position[hit]):
        out[i][p] = True
    return out
