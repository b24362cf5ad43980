"""A suffix automaton over sequences of numbers, each from a document, for matching statistics."""

from __future__ import annotations

import numpy as np


class SuffixAutomaton:
    """All substrings of some sequences. Every state knows the smallest document that holds its substrings."""

    def __init__(self, sequences: list[tuple[object, list[int]]]):
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [None]
        last = 0
        for i, (doc, words) in enumerate(sequences):
            last = self._extend(last, -1 - i, doc)  # a mark that no text holds keeps sequences apart
            for word in words:
                last = self._extend(last, word, doc)
        # A state's substrings also end wherever those of the states that link to it do.
        for state in np.argsort(self.length, kind="stable")[:0:-1].tolist():
            up, own = self.link[state], self.first[state]
            if self.first[up] is None or own < self.first[up]:
                self.first[up] = own

    def _extend(self, last: int, word: int, doc: object) -> int:
        step, link, length, first = self.step, self.link, self.length, self.first
        new = len(length)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        first.append(doc)
        at = last
        while at >= 0 and word not in step[at]:
            step[at][word] = new
            at = link[at]
        if at >= 0:
            to = step[at][word]
            if length[to] == length[at] + 1:
                link[new] = to
            else:
                copy = len(length)
                step.append(step[to].copy())
                length.append(length[at] + 1)
                link.append(link[to])
                first.append(first[to])
                while at >= 0 and step[at].get(word) == to:
                    step[at][word] = copy
                    at = link[at]
                link[to] = link[new] = copy
        return new

    def spans(self, doc: object, words: list[int], least: int) -> list[tuple[int, int]]:
        """Maximal stretches of ``words`` made of windows of ``least`` words that a smaller document holds."""
        step, link, length, first = self.step, self.link, self.length, self.first
        out, at, matched = [], 0, 0
        for i, word in enumerate(words):
            while at and word not in step[at]:
                at = link[at]
                matched = length[at]
            at = step[at].get(word, 0)
            matched = matched + 1 if at else 0
            if matched >= least:
                while length[link[at]] >= least:
                    at = link[at]
                matched = least
                if first[at] < doc:
                    begin = i + 1 - least
                    if out and begin <= out[-1][1]:
                        out[-1] = out[-1][0], i + 1
                    else:
                        out.append((begin, i + 1))
        return out
