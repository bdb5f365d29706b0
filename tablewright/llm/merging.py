"""Byte-pair merging on ragged arrays, many sequences at once.

All sequences lie in one flat array of symbol ids. In a step every sequence takes the lowest rank among its
neighbouring pairs and all its pairs of that rank merge together, leftmost first where they overlap. Sequences with
no pair left are put aside, so later steps touch only what still merges.

A reference encoder merges one pair at a time. Taking several pairs of a rank together differs from that only if a
merge makes a pair whose rank is not above its own. Such sequences are noticed (both new pairs of each merge are looked up)
and done again pair by pair, so the result is exact for any table.
"""

from __future__ import annotations

import heapq

import numpy as np

NONE = np.int32(2**31 - 1)


class PairTable:
    """Rank and product of each pair of symbols that may merge. ``width`` is above every symbol id."""

    def __init__(self, left, right, rank, product, width: int):
        keys = np.asarray(left, dtype=np.int64) * width + np.asarray(right, dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.width = width
        # one more key than any real one, so that a search never ends behind the table
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.rank = np.append(np.asarray(rank, dtype=np.int32)[order], NONE)
        self.product = np.append(np.asarray(product, dtype=np.int32)[order], np.int32(-1))

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks (NONE for no pair) and places in the table."""
        keys = left.astype(np.int64) * self.width + right
        at = np.searchsorted(self.keys, keys)
        return np.where(self.keys[at] == keys, self.rank[at], NONE), at

    def one_by_one(self, symbols: list[int]) -> list[int]:
        """Merge one sequence pair by pair: lowest rank first, leftmost of equal ranks."""
        n = len(symbols)
        if n < 2:
            return list(symbols)
        ids, after, before, alive = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        ranks, at = self.find(np.array(ids[:-1]), np.array(ids[1:]))
        heap = [(int(ranks[i]), i, ids[i], ids[i + 1], int(self.product[at[i]])) for i in range(n - 1) if ranks[i] != NONE]
        heapq.heapify(heap)

        def push(i: int, j: int) -> None:
            rank, place = self.find(np.array([ids[i]]), np.array([ids[j]]))
            if rank[0] != NONE:
                heapq.heappush(heap, (int(rank[0]), i, ids[i], ids[j], int(self.product[place[0]])))

        while heap:
            _, i, a, b, product = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j], after[i] = product, False, after[j]
            if after[i] < n:
                before[after[i]] = i
                push(i, after[i])
            if before[i] >= 0:
                push(before[i], i)
        return [s for s, a in zip(ids, alive) if a]


#: Longer sequences are merged with a heap: their number of steps would hold up all others.
LONG = 512


def merge_all(ids: np.ndarray, lengths: np.ndarray, pairs: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Flat symbol ids of sequences of the given lengths (all at least 1) to the surviving symbols: flat ids and lengths."""
    n = len(lengths)
    starts = np.cumsum(lengths) - lengths
    alone: dict[int, np.ndarray] = {}
    for k in np.flatnonzero(lengths > LONG).tolist():
        alone[k] = np.array(pairs.one_by_one(ids[starts[k]:starts[k] + lengths[k]].tolist()), dtype=np.int32)
    first_ids, first_starts, first_lengths = ids, starts, lengths
    names = np.flatnonzero(lengths <= LONG)
    ids = ids[np.repeat(lengths <= LONG, lengths)].astype(np.int32)
    lengths = lengths[names]
    done_ids, done_names, done_lengths = [], [], []
    # rank and place of the pair each symbol begins; after a merge only the pairs around it are looked up again
    rank = np.full(len(ids), NONE, dtype=np.int32)
    place = np.zeros(len(ids), dtype=np.int64)
    stale = np.arange(len(ids))
    while len(names):
        starts = np.cumsum(lengths) - lengths
        owner = np.repeat(np.arange(len(names)), lengths)
        rank[stale] = NONE
        stale = stale[stale < len(ids) - 1]
        stale = stale[owner[stale] == owner[stale + 1]]
        rank[stale], place[stale] = pairs.find(ids[stale], ids[stale + 1])
        low = np.minimum.reduceat(rank, starts)
        over = low == NONE
        if over.any():
            ended = over[owner]
            done_ids.append(ids[ended]), done_names.append(names[over]), done_lengths.append(lengths[over])
            ids, rank, place = ids[~ended], rank[~ended], place[~ended]
            names, lengths, low = names[~over], lengths[~over], low[~over]
            if not len(names):
                break
            owner = np.repeat(np.arange(len(names)), lengths)
        chosen = rank == low[owner]
        # of overlapping pairs (neighbours in a run of chosen ones) every second merges, from the left
        run_start = chosen & ~np.concatenate(([False], chosen[:-1] & (owner[:-1] == owner[1:])))
        position = np.arange(len(ids))
        begun = np.maximum.accumulate(np.where(run_start, position, -1))
        chosen &= (position - begun) % 2 == 0
        at = np.flatnonzero(chosen)
        product = pairs.product[place[at]]
        several = np.bincount(owner[at], minlength=len(names)) > 1
        odd = np.zeros(len(names), dtype=bool)
        check = np.flatnonzero(several[owner[at]])
        for shift in (-1, 2) if len(check) else ():
            p, made = at[check], product[check]
            fine = (p + shift >= 0) & (p + shift < len(ids))
            p, made = p[fine], made[fine]
            same = owner[p + shift] == owner[p]
            p, made = p[same], made[same]
            other = ids[p + shift]
            new = pairs.find(other, made)[0] if shift < 0 else pairs.find(made, other)[0]
            odd[owner[p][new <= low[owner[p]]]] = True
        ids[at] = product
        keep = np.ones(len(ids), dtype=bool)
        keep[at + 1] = False
        for k in names[odd].tolist():
            alone[k] = np.array(
                pairs.one_by_one(first_ids[first_starts[k]:first_starts[k] + first_lengths[k]].tolist()), dtype=np.int32
            )
        keep &= ~odd[owner]
        lengths = np.bincount(owner[keep], minlength=len(names))[~odd]
        changed = np.zeros(len(ids), dtype=bool)
        changed[at] = True
        # the symbol before a product, which may itself have been a product
        before = at - 1
        before = before[before >= 0]
        changed[np.where(keep[before], before, np.maximum(before - 1, 0))] = True
        stale = np.flatnonzero(changed[keep])
        ids, rank, place, names = ids[keep], rank[keep], place[keep], names[~odd]
    for k, own in alone.items():
        done_ids.append(own), done_names.append(np.array([k])), done_lengths.append(np.array([len(own)]))
    # back to the order of the sequences
    names, lengths = np.concatenate([np.empty(0, np.int64), *done_names]), np.concatenate([np.empty(0, np.int64), *done_lengths])
    flat = np.concatenate([np.empty(0, np.int32), *done_ids])
    order = np.argsort(names, kind="stable")
    begins = (np.cumsum(lengths) - lengths)[order]
    out = lengths[order]
    take = np.repeat(begins - (np.cumsum(out) - out), out) + np.arange(out.sum())
    assert len(out) == n
    return flat[take], out
