"""Generalised suffix automaton over sequences of symbols."""

from __future__ import annotations

from collections.abc import Hashable, Iterable


class SuffixAutomaton:
    """All substrings of the sequences added.  State 0 is the empty match.

    ``step`` holds each state's moves, ``link`` the state of the longest proper
    suffix that occurs in more places, ``length`` the longest match of the state."""

    def __init__(self):
        self.step: list[dict[Hashable, int]] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, symbols: Iterable[Hashable]) -> None:
        last = 0
        for c in symbols:
            last = self._extend(last, c)

    def states(self, symbols: Iterable[Hashable]) -> list[int]:
        """The state of each prefix of a sequence that was added."""
        path, s = [], 0
        for c in symbols:
            s = self.step[s][c]
            path.append(s)
        return path

    def _new(self, length: int) -> int:
        self.step.append({})
        self.link.append(0)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, p: int, q: int, c: Hashable) -> int:
        """A copy of q for the matches of the length that p gives it."""
        copy = self._new(self.length[p] + 1)
        self.step[copy], self.link[copy], self.link[q] = dict(self.step[q]), self.link[q], copy
        while p >= 0 and self.step[p].get(c) == q:
            self.step[p][c] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, c: Hashable) -> int:
        if (q := self.step[last].get(c)) is not None:  # already there, from another item
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, c)
        state, p = self._new(self.length[last] + 1), last
        while p >= 0 and c not in self.step[p]:
            self.step[p][c] = state
            p = self.link[p]
        if p >= 0:
            q = self.step[p][c]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, c)
        return state
