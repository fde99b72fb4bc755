"""A generalised suffix automaton over whole numbers: every run of every sequence it was given, in linear space."""

from __future__ import annotations

from collections.abc import Sequence


class SuffixAutomaton:
    """State 0 is the empty run. Of a state, `length` is that of its longest run; `link` is the state of the longest
    ending of its runs that stands in other places, too.
    """

    def __init__(self):
        self.steps: list[dict[int, int]] = [{}]
        self.link: list[int] = [-1]
        self.length: list[int] = [0]

    def add(self, run: Sequence[int]) -> list[int]:
        """Take in a sequence; the state after each of its elements, as of now."""
        states, last = [], 0
        for word in run:
            last = self._extend(last, word)
            states.append(last)
        return states

    def _new(self, length: int, steps: dict[int, int], link: int) -> int:
        self.length.append(length)
        self.steps.append(steps)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, state: int, target: int, word: int) -> int:
        """The state for the runs of `target` no longer than those of `state` and one word."""
        copy = self._new(self.length[state] + 1, dict(self.steps[target]), self.link[target])
        self.link[target] = copy
        while state >= 0 and self.steps[state].get(word) == target:
            self.steps[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        known = self.steps[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, known, word)
        new = self._new(self.length[last] + 1, {}, -1)
        while last >= 0 and word not in self.steps[last]:
            self.steps[last][word] = new
            last = self.link[last]
        if last < 0:
            self.link[new] = 0
        else:
            target = self.steps[last][word]
            self.link[new] = target if self.length[target] == self.length[last] + 1 else self._split(last, target, word)
        return new

    def cut(self, state: int, size: int) -> int:
        """The state of the last `size` words of a run that is at least so long."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def by_length(self) -> list[int]:
        """All states but the first, shorter ones first: links point backwards in this order."""
        return sorted(range(1, len(self.length)), key=self.length.__getitem__)
