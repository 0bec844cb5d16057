"""Text with character ranges that follow every rewrite. Ranges are half-open and count code points."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Span:
    """A range of a text and who proposed it."""

    start: int
    end: int
    sources: tuple[str, ...] = ()


@dataclass(frozen=True)
class Marked:
    """A text with ranges."""

    text: str
    spans: tuple[Span, ...] = ()

    def sub(self, pattern: re.Pattern[str], repl: str | Callable[[re.Match[str]], str]) -> Marked:
        """Replace all matches; ranges move along, and those cut by a rewrite go."""
        make = repl if callable(repl) else (lambda m: m.expand(repl))
        edits = [(m.start(), m.end(), new) for m in pattern.finditer(self.text) if (new := make(m)) != m.group()]
        return self.apply(edits) if edits else self

    def apply(self, edits: list[tuple[int, int, str]]) -> Marked:
        """Ordered, disjoint replacements of (start, end) by new text."""
        out, at = [], 0
        for start, end, new in edits:
            out += [self.text[at:start], new]
            at = end
        moved = (replace(s, start=a, end=b) for s in self.spans if (a := shift(edits, s.start)) is not None and (b := shift(edits, s.end)) is not None and a < b)
        return Marked("".join(out) + self.text[at:], tuple(moved))

    def cut(self, start: int, end: int) -> Marked:
        """A part of the text with the ranges that lie in it."""
        inside = (replace(s, start=s.start - start, end=s.end - start) for s in self.spans if start <= s.start and s.end <= end)
        return Marked(self.text[start:end], tuple(inside))

    def strip(self) -> Marked:
        if not self.spans and self.text and not self.text[0].isspace() and not self.text[-1].isspace():
            return self
        left = len(self.text) - len(self.text.lstrip())
        return self.apply([e for e in ((0, left, ""), (max(len(self.text.rstrip()), left), len(self.text), "")) if e[0] < e[1]])


def shift(edits: Iterable[tuple[int, int, str]], place: int) -> int | None:
    """Where a boundary goes: None inside a rewrite, to the start of a deletion that swallows it."""
    by = 0
    for start, end, new in edits:
        if start >= place:
            break
        if place < end:
            return None if new else start + by
        by += len(new) - (end - start)
    return place + by
