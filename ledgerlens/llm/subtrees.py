"""Subtrees of the context trees, in one task each.

A gram is the bytes of a context, oldest first, and the byte after it. A byte is eight bits; for each number ``b`` of bits
before one of them there is a tree of its own, whose nodes at depth ``d`` are told by the newest ``d`` bytes of the
context and those ``b`` bits. Sorted grams have the grams of a node side by side, so a level is sums over runs.
"""

from __future__ import annotations

import math

import numpy as np

#: Grams that are taken together, but for those of one root.
TOGETHER = 400_000


def firsts(sorted_keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]])


def newest(keys: np.ndarray, bits: int) -> np.ndarray:
    return keys & np.uint64((1 << bits) - 1)


def merged(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of ``n``."""
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    at = firsts(keys)
    return keys[at], np.add.reduceat(n, at) if len(at) else n


def ln_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series at x + 7, brought back by the recurrence."""
    y, product = x + 7, x.copy()
    for i in range(1, 7):
        product *= x + i
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y) - np.log(product)


def estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov estimate of a node's bits."""
    return ln_gamma(zeros + 0.5) + ln_gamma(ones + 0.5) - ln_gamma(zeros + ones + 1.0) - math.log(math.pi)


def mixture(own: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(weight of a node's own estimate, logarithm of half its own and half its children's probability)."""
    more = np.clip(below - own, -700, 700)
    return 1 / (1 + np.exp(more)), np.maximum(own, below) + np.log1p(np.exp(-np.abs(more))) - math.log(2)


class Level:
    """The nodes of one depth and one number of bits, from the sorted grams of that depth."""

    def __init__(self, keys: np.ndarray, n: np.ndarray, b: int):
        node = keys >> np.uint64(8 - b)
        at = firsts(node)
        self.node = node[at]
        ones = np.add.reduceat(n * ((keys >> np.uint64(7 - b)) & np.uint64(1)).astype(np.int64), at)
        total = np.add.reduceat(n, at)
        self.zeros, self.ones = (total - ones).astype(np.float64), ones.astype(np.float64)

    def find(self, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of nodes, and whether they are there."""
        if not len(self.node):
            return np.zeros(len(node), np.int64), np.zeros(len(node), bool)
        at = np.minimum(np.searchsorted(self.node, node), len(self.node) - 1)
        return at, self.node[at] == node


class Subtrees:
    """All nodes below the roots of depth ``root`` that some grams have."""

    def __init__(self, keys: np.ndarray, n: np.ndarray, depth: int, root: int):
        self.depth, self.root = depth, root
        self.grams = {depth: merged(keys, n)}
        for d in range(depth - 1, root - 1, -1):
            self.grams[d] = merged(newest(self.grams[d + 1][0], 8 * (d + 1)), self.grams[d + 1][1])

    def weighed(self, b: int) -> dict[int, Level]:
        """The levels of one number of bits, from the deepest up, with ``stop``, ``weighted`` and the place of each
        node's parent, ``up``."""
        out, below = {}, None
        for d in range(self.depth, self.root - 1, -1):
            level = out[d] = Level(*self.grams[d], b)
            own = estimate(level.zeros, level.ones)
            if below is None:
                level.stop, level.weighted = np.ones(len(own)), own
            else:
                child = out[d + 1]
                child.up, _ = level.find(newest(child.node, 8 * d + b))
                level.stop, level.weighted = mixture(own, np.bincount(child.up, child.weighted, len(level.node)))
            below = level
        return out

    def roots(self):
        """(key, zeros, ones, stop, weighted) of the root nodes; a key is the context's bytes and the bits after
        a leading one."""
        for b in range(8):
            level = self.weighed(b)[self.root]
            yield node_keys(level.node, b), level.zeros, level.ones, level.stop, level.weighted

    def values(self, tops, queries: np.ndarray):
        """(values of the own grams in their order, values of ``queries``, their open bits). ``tops`` are the roots' sorted
        keys with ``p``, ``added`` and ``left``; a bit is open (1 << b) where not even its root is known."""
        keys, _ = self.grams[self.depth]
        own, asked, still_open = np.zeros(len(keys)), np.zeros(len(queries)), np.zeros(len(queries), np.int64)
        for b in range(8):
            levels = self.weighed(b)
            top = levels[self.root]
            at = np.searchsorted(tops[0], node_keys(top.node, b))
            top.p, top.added, top.left = (t[at] for t in tops[1:])
            for d in range(self.root + 1, self.depth + 1):
                level, above = levels[d], levels[d - 1]
                one = (level.ones + 0.5) / (level.zeros + level.ones + 1)
                added, left = above.added[level.up], above.left[level.up]
                level.p = added + left * one
                level.added, level.left = added + left * level.stop * one, left * (1 - level.stop)
            deepest = levels[self.depth]
            at, _ = deepest.find(keys >> np.uint64(8 - b))
            own += bit_log(deepest.p[at], keys, b)
            rest = np.arange(len(queries))
            for d in range(self.depth, self.root - 1, -1):
                at, there = levels[d].find(newest(queries[rest], 8 * (d + 1)) >> np.uint64(8 - b))
                asked[rest[there]] += bit_log(levels[d].p[at[there]], queries[rest[there]], b)
                rest = rest[~there]
            still_open[rest] |= 1 << b
        return own, asked, still_open


def node_keys(node: np.ndarray, b: int) -> np.ndarray:
    return ((node >> np.uint64(b)) << np.uint64(8)) | np.uint64(1 << b) | newest(node, b)


def bit_log(p: np.ndarray, keys: np.ndarray, b: int) -> np.ndarray:
    return np.log10(np.where((keys >> np.uint64(7 - b)) & np.uint64(1), p, 1 - p))


def by_root(keys: np.ndarray, root: int) -> np.ndarray:
    return newest(keys >> np.uint64(8), 8 * root)


def parts(keys: np.ndarray, n: np.ndarray, root: int):
    """(first root, past the last root, keys, n) of about TOGETHER grams, roots kept whole and in order; the first range
    begins at 0, the last ends past all roots."""
    of = by_root(keys, root)
    order = np.argsort(of, kind="stable")
    of, keys, n = of[order], keys[order], n[order]
    begin = firsts(of)
    low, start = 0, 0
    for i, a in enumerate(begin):
        end = begin[i + 1] if i + 1 < len(begin) else len(of)
        last = i + 1 == len(begin)
        if last or end - start >= TOGETHER:
            high = 1 << 62 if last else int(of[end])
            yield low, high, keys[start:end], n[start:end]
            low, start = high, end


def up(depth: int, root: int):
    """applyInPandas over the grams (key, n) of some roots: their nodes."""

    def run(group):
        import pandas as pd

        out = []
        for _, _, keys, n in parts(group["key"].to_numpy().view(np.uint64), group["n"].to_numpy(), root):
            out += Subtrees(keys, n, depth, root).roots()
        key, zeros, ones, stop, weighted = (np.concatenate(c) for c in zip(*out))
        return pd.DataFrame({"key": key.view(np.int64), "zeros": zeros.astype(np.int64), "ones": ones.astype(np.int64), "stop": stop, "weighted": weighted})

    return run


def down(depth: int, root: int, least: int):
    """cogrouped applyInPandas over grams (key, n; 0 for those only asked for) of some roots, and these roots' (key, p, added, left):
    the values of grams asked for with their open bits, or, where none are, of those that occur more than ``least`` times."""

    def run(grams, tops):
        import pandas as pd

        key, n = grams["key"].to_numpy().view(np.uint64), grams["n"].to_numpy()
        asked = key[n == 0]
        asked = asked[np.argsort(by_root(asked, root), kind="stable")]
        asked_root = by_root(asked, root)
        order = np.argsort(tops["key"].to_numpy())
        tops = [tops["key"].to_numpy()[order].view(np.uint64), *(tops[c].to_numpy()[order] for c in ("p", "added", "left"))]
        out = []
        for low, high, keys, m in parts(key[n > 0], n[n > 0], root):
            a, b = np.searchsorted(asked_root, [np.uint64(low), np.uint64(high)])
            tree = Subtrees(keys, m, depth, root)
            own, value, still_open = tree.values(tops, asked[a:b])
            if len(asked):
                out.append((asked[a:b], np.zeros(b - a, np.int64), value, still_open))
            else:
                keys, m = tree.grams[depth]
                often = m > least
                out.append((keys[often], m[often], own[often], np.zeros(often.sum(), np.int64)))
        if not out:
            out.append((asked, np.zeros(len(asked), np.int64), np.zeros(len(asked)), np.full(len(asked), 255)))
        key, n, value, still_open = (np.concatenate(c) for c in zip(*out))
        return pd.DataFrame({"key": key.view(np.int64), "n": n, "value": value, "open": still_open})

    return run
