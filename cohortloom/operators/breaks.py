"""Removing the weakest breaks of one arm's segmentation, by a queue of breaks over mergeable segment summaries.

A segment keeps its values in order, so that its median is at hand; of two merged segments the smaller one's values go into
the larger one's.  A removal scores again only the breaks on both sides of the merged segment.
"""

from __future__ import annotations

import heapq
from bisect import insort
from collections.abc import Callable, Mapping, Sequence

import numpy as np

Rule = Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]


def _merged(a: list, b: list) -> list:
    """The ordered values of both."""
    small, large = (a, b) if len(a) < len(b) else (b, a)
    if len(small) * 16 > len(large):
        return sorted(large + small)  # two ordered runs: one linear merge
    for v in small:
        insort(large, v)
    return large


def _middle(values: list) -> float:
    n = len(values)
    return float("nan") if not n else (values[(n - 1) // 2] + values[n // 2]) / 2


class Segments:
    """Segments between ``cuts`` (first rows of all but the first); a break is named by the segment on its right."""

    def __init__(self, columns: Mapping[str, np.ndarray], cuts: Sequence[int]):
        edge = [0, *cuts, len(columns["lr"])]
        spans = list(zip(edge, edge[1:]))
        ordered = lambda x: [np.sort(x[a:b][~np.isnan(x[a:b])]).tolist() for a, b in spans]
        self.first = edge[:-1]
        self.values = {c: ordered(columns[c]) for c in ("lr", "baf")}
        self.sums = {c: [float(columns[c][a:b].sum()) for a, b in spans] for c in ("baf_n", "nvar", "hq")}
        self.size = [b - a for a, b in spans]
        self.left, self.right = [*range(-1, len(spans) - 1)], [*range(1, len(spans)), -1]
        self.alive = [True] * len(spans)

    def step(self, column: str, s: int) -> float:
        """Difference of the medians on both sides of break s; 0 where a side has no values."""
        d = abs(_middle(self.values[column][s]) - _middle(self.values[column][self.left[s]]))
        return 0.0 if np.isnan(d) else d

    def mean(self, column: str, s: int) -> float:
        return self.sums[column][s] / self.size[s]

    def remove(self, s: int) -> list[int]:
        """Merge segment s into its left neighbour; the breaks to score again."""
        l, r = self.left[s], self.right[s]
        for v in self.values.values():
            v[l], v[s] = _merged(v[l], v[s]), []
        for v in self.sums.values():
            v[l] += v[s]
        self.size[l] += self.size[s]
        self.alive[s], self.right[l] = False, r
        if r >= 0:
            self.left[r] = l
        return [b for b in (l, r) if b > 0]

    def cuts(self) -> list[int]:
        return [self.first[s] for s in range(1, len(self.first)) if self.alive[s]]


def _length(segs: Segments, s: int) -> tuple[float, float]:
    l = segs.left[s]
    return min(segs.size[l], segs.size[s]), min(segs.sums["baf_n"][l], segs.sums["baf_n"][s])


def _noise(segs: Segments, s: int) -> tuple[float, float]:
    x = max(segs.mean("nvar", segs.left[s]), segs.mean("nvar", s))
    return (0.0, 0.0) if np.isnan(x) else (x, x)


def _quality(segs: Segments, s: int) -> tuple[float, float]:
    x = min(segs.mean("hq", segs.left[s]), segs.mean("hq", s))
    return x, x


#: What a rule looks at on both sides of a break, and whether it judges each break alone.
MEASURES = {"length": (_length, True), "noise": (_noise, False), "quality": (_quality, True)}


def prune(columns: Mapping[str, np.ndarray], cuts: Sequence[int], sd_lr: float, sd_baf: float, kind: str, need: Rule) -> list[int]:
    """Remove the weakest break (least lr step, then baf step, then first) that fails its rule, until none does.

    ``need`` maps the measures of breaks (n x 2) to the steps they need, in standard deviations; a break fails if neither step
    is larger.  Breaks judged alone wait in a queue; the noise rule's limits depend on all breaks, so it judges them all after each removal
    in one array operation, without looking at a value again.
    """
    measure, alone = MEASURES[kind]
    segs = Segments(columns, cuts)
    n = len(segs.first)
    steps, seen, turn = np.zeros((n, 2)), np.zeros((n, 2)), [0] * n

    def score(s: int) -> None:
        steps[s], seen[s] = (segs.step("lr", s), segs.step("baf", s)), measure(segs, s)
        turn[s] += 1

    def fails(at) -> np.ndarray:
        need_lr, need_baf = need(seen[at])
        return (steps[at, 0] <= sd_lr * need_lr) & (steps[at, 1] <= sd_baf * need_baf)

    entry = lambda s: (steps[s, 0], steps[s, 1], s, turn[s])
    for s in range(1, n):
        score(s)
    if alone:
        queue = [entry(s) for s in np.arange(1, n)[fails(np.arange(1, n))].tolist()] if n > 1 else []
        heapq.heapify(queue)
        while queue:
            *_, s, t = heapq.heappop(queue)
            if not segs.alive[s] or t != turn[s]:
                continue
            for b in segs.remove(s):
                score(b)
                if fails(np.array([b]))[0]:
                    heapq.heappush(queue, entry(b))
        return segs.cuts()
    left = np.arange(1, n)
    while left.size:
        bad = left[fails(left)]
        if not bad.size:
            break
        s = int(bad[np.lexsort((bad, steps[bad, 1], steps[bad, 0]))[0]])
        for b in segs.remove(s):
            score(b)
        left = left[left != s]
    return segs.cuts()
