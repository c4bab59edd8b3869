"""Links between sets by one walk over a prefix tree."""

from __future__ import annotations

import numpy as np


def links_in_trie(sets: list[np.ndarray], percent: int = 80) -> np.ndarray:
    """The component of each of ``sets`` (distinct integers each, none empty) under links of Jaccard >= ``percent`` / 100; labels are indices.

    ``sets`` hold ranks in one order for all, ascending, common items first, and are stored in a tree whose paths are
    shared beginnings. The walk keeps, at each node, the overlap of the path with every set still in question, so work on a shared
    beginning is done once for all sets below. A set is dropped from a subtree when its overlap and the longest rest
    there, or the rest of the set itself, cannot reach what the shortest set there needs. At a leaf, where most of a tree of loosely
    connected sets lies, only the holders of the leaf's rarest items are asked: a link needs one of them.
    """
    count = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    label = np.arange(count)
    if count < 2:
        return label
    # Sets in the order of a walk over the tree: as sequences. A node is a stretch of them with an equal beginning.
    order = sorted(range(count), key=lambda i: sets[i].astype(">u4").tobytes())
    ordered = [sets[i] for i in order]
    shared = np.array([0] + [_common(a, b) for a, b in zip(ordered, ordered[1:], strict=False)], np.int64)
    lengths = sizes[order]
    # Who holds an item: concatenated lists; an item of one set adds nothing to any overlap but its own.
    items = np.concatenate(sets)
    owner = np.repeat(np.arange(count), sizes)
    by_item = np.argsort(items, kind="stable")
    holders, starts = owner[by_item], np.searchsorted(items[by_item], np.arange(int(items.max()) + 2))

    def holding(path: np.ndarray) -> np.ndarray:
        """The sets that hold the items of the path, once for each item."""
        a, n = starts[path], starts[path + 1] - starts[path]
        return holders[np.repeat(a - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())]

    def held(path: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """How many items of the path each set in question (ascending) holds."""
        found = holding(path)
        if len(found) >= count:
            return np.bincount(found, minlength=count)[asked]
        at = np.minimum(np.searchsorted(asked, found), len(asked) - 1)
        return np.bincount(at[asked[at] == found], minlength=len(asked))

    def rarest(own: np.ndarray) -> np.ndarray:
        """The items of a set that a linked set must have one of, those with the fewest holders here."""
        n = starts[own + 1] - starts[own]
        return own[np.argsort(n, kind="stable")[: len(own) - -(-percent * len(own) // 100) + 1]]

    def enough(mine: np.ndarray, other: np.ndarray | int) -> np.ndarray:
        """The least overlap that links sets of these sizes."""
        return -(-percent * (mine + other) // (100 + percent))

    # (first, after the last, depth reached, overlaps, sets in question)
    stack = [(0, count, 0, np.zeros(count, np.int64), np.arange(count))]
    while stack:
        lo, hi, depth, overlap, asked = stack.pop()
        # The beginning that all of the stretch share.
        reach = int(shared[lo + 1 : hi].min()) if hi - lo > 1 else int(lengths[lo])
        reach = min(reach, int(lengths[lo]))
        if hi - lo == 1 and len(asked):
            rare = rarest(ordered[lo])
            if int((starts[rare + 1] - starts[rare]).sum()) < len(asked):
                near = np.unique(holding(rare))
                at = np.minimum(np.searchsorted(asked, near), len(asked) - 1)
                at = at[asked[at] == near]
                overlap, asked = overlap[at], asked[at]
        while depth < reach:
            step = ordered[lo][depth : min(reach, depth + 64)]
            depth += len(step)
            if not len(asked):
                depth = reach
                break
            overlap = overlap + held(step, asked)
            shortest, longest = int(lengths[lo:hi].min()), int(lengths[lo:hi].max())
            most = overlap + np.minimum(longest - depth, sizes[asked] - overlap)
            stay = most >= np.maximum(enough(sizes[asked], shortest), 1)
            if not stay.all():
                overlap, asked = overlap[stay], asked[stay]
        done = np.flatnonzero(lengths[lo:hi] == depth) + lo
        if len(done):  # a set ends here; sets are distinct, so it is one
            own = order[int(done[0])]
            linked = asked[overlap >= enough(sizes[asked], sizes[own])]
            found = np.unique(np.r_[label[linked], label[own]])
            if len(found) > 1:
                label[np.isin(label, found)] = found[0]
            if hi - lo == 1:
                continue
        if len(asked) < 2 and len(done) == 0 and hi - lo == 1:
            continue
        # Children: stretches of the sets that go on, cut where the next item differs.
        go = lo + int(len(done) > 0)
        cuts = [go, *(np.flatnonzero(shared[go + 1 : hi] <= depth) + go + 1).tolist(), hi]
        stack += [(a, b, depth, overlap, asked) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]
    return label


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the shared beginning."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n
