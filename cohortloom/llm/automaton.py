"""Generalised suffix automaton over sequences of small integers, and the holder of broadcast models."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from itertools import count


class SuffixAutomaton:
    """Accepts every substring of the given sequences; ``length`` and ``link`` are the usual arrays."""

    def __init__(self, sequences: Iterable[Sequence[int]] = ()):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for s in sequences:
            self.insert(s)

    def insert(self, sequence: Sequence[int]) -> None:
        last = 0
        for c in sequence:
            last = self._extend(last, c)

    def _state(self, length: int, arcs: dict[int, int], link: int) -> int:
        self.next.append(arcs)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, q: int, c: int) -> int:
        """The state of the longest string of p followed by c, apart from the longer ones of q."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int) -> int:
        if (q := self.next[last].get(c)) is not None:  # an earlier sequence had this string
            return self._split(last, q, c)
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, self.next[p][c], c)
        return new

    def step(self, state: int, matched: int, c: int) -> tuple[int, int]:
        """Longest suffix of the text read so far that occurs in a sequence, after one more symbol."""
        while state and c not in self.next[state]:
            state = self.link[state]
            matched = self.length[state]
        to = self.next[state].get(c)
        return (0, 0) if to is None else (to, matched + 1)

    def holder(self, state: int, n: int) -> int:
        """The state of the suffix of n symbols of a match that ended in this state."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state


_numbers = count(1)


class Shared:
    """A broadcast value with a number, so that a worker builds what depends on it only once."""

    def __init__(self, spark, value):
        self.broadcast, self.number = spark.sparkContext.broadcast(value), next(_numbers)

    @property
    def value(self):
        return self.broadcast.value

    def __hash__(self):
        return self.number

    def __eq__(self, other):
        return isinstance(other, Shared) and (self.number, self.broadcast.id if hasattr(self.broadcast, "id") else 0) == (other.number, other.broadcast.id if hasattr(other.broadcast, "id") else 0)
