"""A generalised suffix automaton over token sequences."""

from __future__ import annotations

from collections.abc import Iterator, Sequence


class SuffixAutomaton:
    """All factors of some token sequences.

    ``ends[state]`` maps a sequence's number to the first place where the
    state's factors end in it (exclusive).
    """

    def __init__(self, sequences: Sequence[Sequence]):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.ends: list[dict[int, int]] = [{}]
        for number, sequence in enumerate(sequences):
            last = 0
            for place, token in enumerate(sequence, 1):
                last = self._extend(last, token)
                self.ends[last].setdefault(number, place)
        # A factor also ends wherever a longer one that it closes ends.
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            into = self.ends[self.link[state]]
            for number, place in self.ends[state].items():
                into[number] = min(place, into.get(number, place))
        self.ends[0] = {}

    def _new(self, length: int, next_: dict, link: int) -> int:
        self.length.append(length)
        self.next.append(next_)
        self.link.append(link)
        self.ends.append({})
        return len(self.link) - 1

    def _split(self, state: int, token, child: int) -> int:
        """A copy of ``child`` for the factors that ``state`` reaches by ``token``."""
        if self.length[child] == self.length[state] + 1:
            return child
        copy = self._new(self.length[state] + 1, dict(self.next[child]), self.link[child])
        self.link[child] = copy
        while state >= 0 and self.next[state].get(token) == child:
            self.next[state][token] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, token) -> int:
        known = self.next[last].get(token)
        if known is not None:
            return self._split(last, token, known)
        new, state = self._new(self.length[last] + 1, {}, 0), last
        while state >= 0 and token not in self.next[state]:
            self.next[state][token] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, token, self.next[state][token])
        return new

    def statistics(self, tokens: Sequence, places: Sequence[int]) -> Iterator[tuple[int, int, int]]:
        """(place, state, length of the longest factor that ends there).

        ``places`` are the places of ``tokens`` that occur in some sequence, in
        order; at all others the statistic is zero.
        """
        state = length = 0
        before = -2
        for place in places:
            if place != before + 1:
                state = length = 0
            token = tokens[place]
            while state and token not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            state = self.next[state][token]  # the root knows every token of the sequences
            length += 1
            before = place
            yield place, state, length

    def suffix_states(self, state: int) -> Iterator[int]:
        while state > 0:
            yield state
            state = self.link[state]

    def state_of(self, sequence: Sequence) -> int:
        state = 0
        for token in sequence:
            state = self.next[state][token]
        return state
