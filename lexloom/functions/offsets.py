"""Finding headwords in sentences, and checking and comparing the ranges found."""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterable

from .edits import Span

SOURCES = ("lemmatizer", "bold")


@functools.lru_cache(maxsize=64)
def form_pattern(forms: frozenset[str]) -> re.Pattern[str] | None:
    """One pattern for all forms: longest first, whole words, any case."""
    every = sorted(filter(None, forms), key=lambda f: (-len(f), f))
    return re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, every)) + r")(?!\w)", re.IGNORECASE) if every else None


def match_forms(text: str, forms: Iterable[str]) -> list[tuple[int, int]]:
    pattern = form_pattern(frozenset(forms))
    return [m.span() for m in pattern.finditer(text)] if pattern else []


def merge(*groups: Iterable[Span]) -> list[Span]:
    """Ranges by place, each with all its sources in their fixed order."""
    found: dict[tuple[int, int], set[str]] = {}
    for span in (s for g in groups for s in g):
        found.setdefault((span.start, span.end), set()).update(span.sources)
    return [Span(a, b, tuple(s for s in SOURCES if s in by)) for (a, b), by in sorted(found.items())]


def folded(text: str) -> str:
    """Comparable letters: compatibility form without marks, any case."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).casefold()


def contains_headword(text: str, headword: str) -> bool:
    return bool(headword) and re.search(r"(?<!\w)" + re.escape(folded(headword)) + r"(?!\w)", folded(text)) is not None


def headword_shape(headword: str) -> str:
    if " " in headword:
        return "Multiword"
    if "'" in headword or "’" in headword:
        return "Apostrophe"
    if "-" in headword:
        return "Hyphenated"
    return "Plain" if headword.isascii() else "Non-ASCII"


def violations(text: str, spans: Iterable[Span]) -> list[str]:
    """What is wrong with the ranges of each source; a range outside the text doesn't count as the one before."""
    found = []
    for source in SOURCES:
        end = 0
        for s in (s for s in spans if source in s.sources):
            if not 0 <= s.start < s.end <= len(text):
                found.append(f"Out of range ({source})")
                continue
            if s.start < end:
                found.append(f"Overlapping or unordered ({source})")
            end = s.end
            surface = text[s.start : s.end]
            if surface != surface.strip():
                found.append(f"Padded with space ({source})")
            elif (s.start and text[s.start - 1].isalnum() and surface[0].isalnum()) or (text[s.end : s.end + 1].isalnum() and surface[-1].isalnum()):
                found.append(f"Inside a longer word ({source})")
    return found


def relation(spans: Iterable[Span]) -> str | None:
    """How the proposals of the two sources relate; None if there are none."""
    a, b = ({(s.start, s.end) for s in spans if source in s.sources} for source in SOURCES)
    if not a and not b:
        return None
    if not b:
        return "Lemmatizer only"
    if not a:
        return "Bold only"
    if a == b:
        return "Exact agreement"
    if a & b:
        return "Partial agreement"
    return "Overlapping proposals" if any(x[0] < y[1] and y[0] < x[1] for x in a for y in b) else "Disagreement"
