"""A suffix automaton of several word sequences."""

from __future__ import annotations

from collections.abc import Hashable, Sequence


class SuffixAutomaton:
    """Every run of words of the sequences added. State 0 is the empty run."""

    def __init__(self):
        self.next: list[dict[Hashable, int]] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, sequence: Sequence[Hashable]) -> list[int]:
        """Add a sequence; the state of each of its prefixes, from one word on."""
        states, last = [], 0
        for word in sequence:
            last = self._extend(last, word)
            states.append(last)
        return states

    def _new(self, length: int, link: int, following: dict[Hashable, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, word: Hashable, q: int) -> int:
        """The state of just the runs that p and the word make, taken out of q."""
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._new(self.length[p] + 1, self.link[q], dict(self.next[q]))
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def _extend(self, last: int, word: Hashable) -> int:
        if word in self.next[last]:
            return self._split(last, word, self.next[last][word])
        new = self._new(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, word, self.next[p][word])
        return new
