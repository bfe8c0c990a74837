"""T-occurrence search within a block of documents, after DivideSkip.

A block has an inverted list for each shingle: the members whose sets hold it, ascending. For a query with lists of its own, a member that reaches the threshold occurs in at least T of them. The L longest lists are left aside; the short ones, each sorted, are merged (a merge sort of sorted runs), and members that occur in at least T - L of them are candidates. Each candidate is then looked up in the long lists by binary search, which makes its count the exact overlap, and dropped as soon as the lists that are left can't bring it to what its own size asks for.
"""

from __future__ import annotations

import numpy as np

MU = 0.0085  # cost of a probe of a long list against a step of the merge
PROBES = 1 << 20  # at once


class Block:
    """The inverted lists of some sets, each a sorted array of distinct 64-bit shingles."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        self.sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(sets), dtype=np.int64), self.sizes)
        order = np.argsort(flat, kind="stable")  # members ascend within a list
        flat = flat[order]
        self.member = owner[order]
        new = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])) if len(flat) else np.zeros(0, np.int64)
        self.shingle = flat[new]
        self.bounds = np.append(new, len(flat))
        #: list number and member as one ascending key, so that all lists are probed by one binary search
        self.key = np.repeat(np.arange(len(new), dtype=np.int64), np.diff(self.bounds)) * max(1, len(sets)) + self.member

    def search(self, q: np.ndarray, allowed: np.ndarray, percent: int) -> np.ndarray:
        """The allowed members (a mask) whose overlap with the set q is at least the percentage of the union."""
        n = len(q)
        least = -(-percent * n // 100)  # of any partner
        at = np.minimum(np.searchsorted(self.shingle, q), max(0, len(self.shingle) - 1))
        at = at[self.shingle[at] == q] if len(self.shingle) else at[:0]
        if n == 0 or len(at) < least:
            return np.zeros(0, np.int64)
        starts, many = self.bounds[at], self.bounds[at + 1] - self.bounds[at]
        by_length = np.argsort(many, kind="stable")
        aside = min(least - 1, int(least / (MU * np.log2(max(2, int(many.max()))) + 1)))
        short, long = by_length[: len(at) - aside], by_length[len(at) - aside :]
        sizes = many[short]
        step = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        merged = np.sort(self.member[np.repeat(starts[short], sizes) + step], kind="stable")
        heads = np.flatnonzero(np.concatenate([[True], merged[1:] != merged[:-1]]))
        found, count = merged[heads], np.diff(np.append(heads, len(merged)))
        need = -(-percent * (n + self.sizes[found]) // (100 + percent))
        use = (count >= least - aside) & allowed[found] & (np.minimum(n, self.sizes[found]) * 100 >= np.maximum(n, self.sizes[found]) * percent) & (count + aside >= need)
        found, count, need = found[use], count[use], need[use]
        at_once = max(1, PROBES // max(1, len(found)))
        for k in range(0, aside, at_once):
            if not len(found):
                break
            probed = at[long[k : k + at_once]]
            keys = probed[:, None] * max(1, len(self.sets)) + found[None, :]
            place = np.minimum(np.searchsorted(self.key, keys), len(self.key) - 1)
            count = count + (self.key[place] == keys).sum(0)
            use = count + max(0, aside - k - at_once) >= need
            found, count, need = found[use], count[use], need[use]
        return found[count >= need]


def spanning_links(ids: list[int], sides: np.ndarray | None, groups: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that join all members whose groups are joined by any link: fewer than there are groups.

    Members of one group count as joined. With sides, only links between the sides are looked for. Members of the largest group aren't asked, for a link to another group has an end outside of it.
    """
    _, group = np.unique(groups, return_inverse=True)
    many = np.bincount(group)
    if len(many) < 2:
        return []
    root = np.arange(len(many))
    largest = group == int(many.argmax())
    block = Block(sets)
    place = np.arange(len(sets))
    out = []
    for i in np.flatnonzero(~largest).tolist():
        allowed = (root[group] != root[group[i]]) & (largest | (place > i))
        if sides is not None:
            allowed &= sides != sides[i]
        if not allowed.any():
            continue
        for j in block.search(sets[i], allowed, percent).tolist():
            a, b = root[group[i]], root[group[j]]
            if a != b:
                root[root == max(a, b)] = min(a, b)
                out.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
    return out
