"""A breaker of words by patterns with levels: letters, with a digit between two where a word may (odd) or may not (even) be broken."""

from __future__ import annotations

import re

import ahocorasick

_DIGITS = re.compile("[0-9]")


class Breaker:
    """Places where a word may be broken, by a table of patterns; ``.`` in a pattern is a word's edge.

    All patterns are in one automaton.  Each that occurs in the word raises the
    levels between its letters to its own; a word breaks where the highest level
    is odd.  ``words`` are broken as they are given, at their hyphens.
    """

    def __init__(self, patterns: list[str], words: list[str] = ()):
        self.given = {w.replace("-", "").lower(): [i - k for k, i in enumerate(m.start() for m in re.finditer("-", w))] for w in words}
        self.automaton = ahocorasick.Automaton()
        for pattern in patterns:
            letters, levels = _DIGITS.sub("", pattern), []
            for piece in re.finditer("([0-9]?)(.?)", pattern):
                if piece[0]:
                    levels.append(int(piece[1] or 0))
            levels += [0] * (len(letters) + 1 - len(levels))
            if letters:
                had = self.automaton.get(letters, (0, [0] * len(levels)))[1]
                self.automaton.add_word(letters, (len(letters), [max(a, b) for a, b in zip(had, levels)]))
        if len(self.automaton):
            self.automaton.make_automaton()

    def __call__(self, word: str) -> list[int]:
        lowered = word.lower()
        if lowered in self.given:
            return self.given[lowered]
        edged, highest = f".{lowered}.", [0] * (len(word) + 3)
        for end, (size, levels) in self.automaton.iter(edged) if len(self.automaton) else ():
            for k, level in enumerate(levels, end + 1 - size):
                highest[k] = max(highest[k], level)
        return [i for i in range(1, len(word)) if highest[i + 1] % 2]
