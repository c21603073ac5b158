"""Rank-synchronous byte-pair merging over ragged numpy arrays.

Many pre-tokens are held as one flat symbol array with sequence boundaries. In each step every
sequence merges its pair of lowest rank, all sequences at the same time. Where all occurrences of
that pair can go at once without creating a pair of the same or a lower rank, they do; else only the
leftmost does. Both give exactly what a queue ordered by (rank, position) gives.
"""

from __future__ import annotations

import numpy as np

NONE = np.iinfo(np.int64).max


class PairTable:
    """Pairs of symbols to merged symbol and rank; ``left << 20 | right`` sorted for search."""

    def __init__(self, left, right, merged, rank):
        key = (np.asarray(left, np.int64) << 20) | np.asarray(right, np.int64)
        order = np.argsort(key, kind="stable")
        self.key = key[order]
        self.merged = np.asarray(merged, np.int64)[order]
        self.rank = np.asarray(rank, np.int64)[order]

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE if there is no such pair) and merged symbol."""
        key = (left << 20) | right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        hit = (self.key[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.rank[at], NONE), np.where(hit, self.merged[at], -1)


def merge_all(sym: np.ndarray, lengths: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Surviving symbols and their number by sequence; ``sym`` holds all sequences, one after another.

    No sequence may be empty. Negative symbols never merge.
    """
    sym, lengths = np.asarray(sym, np.int64), np.asarray(lengths, np.int64)
    final = lengths.copy()
    ended: list[tuple[np.ndarray, np.ndarray]] = []
    live = np.arange(len(lengths))
    if not len(live):
        return sym, final
    rank, merged = table.find(sym[:-1], sym[1:])
    rank, merged = np.append(rank, NONE), np.append(merged, -1)
    rank[np.cumsum(lengths) - 1] = NONE
    while len(live):
        ends = np.cumsum(lengths)
        starts = ends - lengths
        least = np.minimum.reduceat(rank, starts)
        done = least == NONE
        if done.any():
            stay = np.repeat(~done, lengths)
            final[live[done]] = lengths[done]
            ended.append((np.repeat(live[done], lengths[done]), sym[~stay]))
            sym, rank, merged = sym[stay], rank[stay], merged[stay]
            live, lengths, least = live[~done], lengths[~done], least[~done]
            if not len(live):
                break
            ends = np.cumsum(lengths)
            starts = ends - lengths
        owner = np.repeat(np.arange(len(live)), lengths)
        hit = np.flatnonzero(rank == least[owner])
        first = np.ones(len(hit), bool)
        first[1:] = owner[hit[1:]] != owner[hit[:-1]]
        # runs of overlapping occurrences: every second one, from the left
        fresh = np.ones(len(hit), bool)
        fresh[1:] = (hit[1:] != hit[:-1] + 1) | first[1:]
        run_at = np.maximum.accumulate(np.where(fresh, np.arange(len(hit)), 0))
        several = (np.arange(len(hit)) - run_at) % 2 == 0
        new = _apply(table, sym, rank, merged, lengths, owner, hit[several])
        if len(hit) > len(live):
            _, rank2, _, lengths2, touched = new
            owner2 = np.repeat(np.arange(len(live)), lengths2)
            count = np.bincount(owner[hit[several]], minlength=len(live))
            low = touched & (rank2 <= least[owner2]) & (count[owner2] > 1)
            if low.any():
                single = np.zeros(len(live), bool)
                single[owner2[low]] = True
                chosen = several & (first | ~single[owner[hit]])
                new = _apply(table, sym, rank, merged, lengths, owner, hit[chosen])
        sym, rank, merged, lengths, _ = new
    order = np.argsort(np.concatenate([o for o, _ in ended]), kind="stable")
    return np.concatenate([x for _, x in ended])[order], final


def _apply(table, sym, rank, merged, lengths, owner, at):
    """Merge the pairs that begin at ``at``; the last array tells which pairs of the result are new."""
    sym = sym.copy()
    sym[at] = merged[at]
    keep = np.ones(len(sym), bool)
    keep[at + 1] = False
    touched = np.zeros(len(sym), bool)
    touched[at] = True
    sym, rank, merged, touched = sym[keep], rank[keep], merged[keep], touched[keep]
    touched[:-1] |= touched[1:].copy()
    lengths = lengths - np.bincount(owner[at], minlength=len(lengths))
    touched[np.cumsum(lengths) - 1] = False
    rank[np.cumsum(lengths) - 1], merged[np.cumsum(lengths) - 1] = NONE, -1
    i = np.flatnonzero(touched)
    if len(i):
        rank[i], merged[i] = table.find(sym[i], sym[i + 1])
    return sym, rank, merged, lengths, touched
