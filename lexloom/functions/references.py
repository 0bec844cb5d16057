"""Pointers to other pages and sources, in definitions, tables and examples.

A text is read clause by clause: brackets are matched, a clause begins behind a mark, and a small reader looks at its
first words for a cue ("see", "cf.", "compare" and what may stand around them). A clause with a cue goes up to the end of
its sentence or bracket, unless what follows the cue shows that it is no pointer.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

from .edits import Marked

# The words by which a clause points elsewhere, and what it may point to.
BEFORE_SEE = ({"also"}, {"but"}, {"but", "also"})
PLACES = {"citations", "thesaurus", "appendix", "wikipedia"}
SECTIONS = {"quotation", "quotations", "usage", "translation", "translations"}
LABELS = {"near synonym", "meronym", "holonym", "usage note"}
OBJECTS = {"it", "them", "him", "her", "us", "me", "you", "what", "how", "whether", "if", "that"}
LISTED = "*•#-"

_WORD = re.compile(r"\s*([^\W_]+)")
_HTTP = re.compile(r"https?://", re.IGNORECASE)
#: The first word of every clause that has a cue.
_LEADS = re.compile(r"\s*(?:cf|compare|but|also|see|for|more)(?![^\W_])", re.IGNORECASE)
_MARKS = re.compile("[(.;:,—–\n-]")
_ENDS = re.compile("[(.\n)]")
_STOP = re.compile("[();\n]")
_PURPOSE_END = re.compile(r",|\bforms\b")


@dataclass(frozen=True)
class Cue:
    """A cue of a kind ("see", "cf" or "compare"), where what it points to begins, and whether it can mean nothing else."""

    kind: str
    target: int
    explicit: bool = False


def word_at(text: str, at: int) -> tuple[str, int]:
    """The next word in lower case and its end; "" if a mark comes first."""
    m = _WORD.match(text, at)
    return (m[1].lower(), m.end()) if m else ("", at)


def points_to(text: str, at: int) -> tuple[bool, bool]:
    """Whether something follows at all, and whether it is a named place of a dictionary."""
    word, end = word_at(text, at)
    after, _ = word_at(text, end)
    named = (word in PLACES and text[end : end + 1] == ":") or (word == "usage" and after.startswith("note"))
    return bool(word) or text[at:].lstrip()[:1] in ("'", '"', "“", "[", "("), named


def simple_cue(text: str, at: int) -> Cue | None:
    """The cue that begins here, without a purpose before it."""
    word, end = word_at(text, at)
    if word == "cf" and text[end : end + 2] in (". ", ".\t"):
        return Cue("cf", end + 1) if points_to(text, end + 1)[0] else None
    if word == "compare" and text[end : end + 1].isspace():
        follow, past = word_at(text, end)
        target = past if follow == "with" else end
        return Cue("compare", target, True) if points_to(text, target)[0] else None
    lead = set()
    while word in ("but", "also") and word not in lead and text[end : end + 1].isspace():
        lead.add(word)
        word, end = word_at(text, end)
    if word != "see" or (lead and lead not in BEFORE_SEE):
        return None
    explicit = False
    follow, past = word_at(text, end)
    if follow == "also" and text[end : end + 1].isspace():
        end, explicit = past, True
    rest = text[end:]
    if rest.lstrip().startswith(":"):
        end, explicit = end + rest.index(":") + 1, True
    elif rest.lower().startswith(", for example,"):
        end += len(", for example,")
    elif not rest[:1].isspace():
        return None
    there, named = points_to(text, end)
    return Cue("see", end, explicit or named) if there else None


def purpose(text: str, at: int) -> int | None:
    """Where a purpose that begins here ("for details, ", "more formally, ") ends, if one does."""
    word, end = word_at(text, at)
    if word == "more":
        word, end = word_at(text, end)
        return end + 1 if word == "formally" and text[end : end + 1] == "," else None
    if word != "for":
        return None
    m = _STOP.search(text, end)
    stop = m.start() if m else len(text)
    ends = (m.end() for m in _PURPOSE_END.finditer(text, end, stop) if m[0] == "," or m.start() > end)
    return next((k for k in ends if _LEADS.match(text, k) and (cue := simple_cue(text, k)) and cue.kind == "see"), None)


def cue_at(text: str, at: int) -> Cue | None:
    """The cue of the clause that begins here."""
    if not _LEADS.match(text, at):
        return None
    end = purpose(text, at)
    return simple_cue(text, at) or (simple_cue(text, end) if end is not None else None)


def brackets(text: str) -> dict[int, int]:
    """Each round bracket that opens, and where it closes; one that doesn't ends with the text."""
    held, out = [], {}
    if "(" not in text:
        return out
    for m in re.finditer("[()]", text):
        if m[0] == "(":
            held.append(m.start())
        elif held:
            out[held.pop()] = m.start()
    return out | dict.fromkeys(held, len(text))


def clause_end(text: str, at: int, closes: dict[int, int]) -> int:
    """The end of the sentence that goes on here: behind its full stop, or before a line's end or a closing bracket."""
    while m := _ENDS.search(text, at):
        c, at = m[0], m.start()
        if c in "\n)":
            return at
        if c == "." and (at + 1 == len(text) or text[at + 1].isspace()):
            return at + 1
        at = closes[at] + 1 if c == "(" else at + 1
    return len(text)


def openers(text: str, first: int, last: int, closes: dict[int, int]) -> Iterator[tuple[int, int]]:
    """(start, where its words begin) of each clause behind a mark, outside inner brackets."""
    at = first
    while m := _MARKS.search(text, at, last):
        c, at = m[0], m.start()
        if c == "(":
            at = closes[at]
        elif c != "-" or text[at - 1 : at].isspace():
            start = at
            while c in "—–-" and start > first and text[start - 1] in " \t":
                start -= 1
            yield start, at + 1
        at += 1


def bracket_edits(text: str, opening: int, closing: int, closes: dict[int, int], explicit: bool) -> Iterator[tuple[int, int, str]]:
    """A note that is a pointer goes as a whole, one that ends in a pointer loses it."""
    if cue := cue_at(text, opening + 1):
        if cue.explicit or not explicit:
            start = opening
            while start and text[start - 1] in " \t":
                start -= 1
            yield start, min(closing + 1, len(text)), ""
        return
    yield from clause_edits(text, opening + 1, closing, closes, explicit)


def clause_edits(text: str, first: int, last: int, closes: dict[int, int], explicit: bool) -> Iterator[tuple[int, int, str]]:
    past = first
    for start, begin in openers(text, first, last, closes):
        if start < past or not (cue := cue_at(text, begin)) or (explicit and not cue.explicit):
            continue
        mark, (word, _) = text[begin - 1], word_at(text, cue.target)
        if mark == "," and cue.kind == "see" and (word in OBJECTS or word_at(text, begin)[0] == "see" and text[word_at(text, begin)[1] :][:1] == ","):
            continue
        past = min(clause_end(text, cue.target, closes), last)
        yield start, past, "." if mark == "." or text[past - 1] == "." else ""


def tidy(value: Marked) -> Marked:
    """Empty brackets and blanks before marks, which edits leave behind."""
    return value.sub(re.compile(r"[ \t]*\([ \t.,;]*\)|[ \t]+(?=[.,;:])"), "")


def drop_references(value: Marked, explicit: bool = False) -> Marked:
    """Notes and clauses that send the reader elsewhere; with explicit, only those with an unmistakable cue."""
    text = value.text
    low = text.lower()
    if not any(cue in low for cue in ("see", "cf", "compare")):
        return value
    closes = brackets(text)
    edits = list(clause_edits(text, 0, len(text), closes, explicit))
    for opening in sorted(closes):
        if not any(a <= opening < b for a, b, _ in edits):
            edits += bracket_edits(text, opening, closes[opening], closes, explicit)
    edits = [e for e in sorted(set(edits)) if e[0] < e[1]]
    apart = [e for k, e in enumerate(edits) if not any(a <= e[0] and e[1] <= b and (a, b) != e[:2] for a, b, _ in edits)]
    return tidy(value.apply(apart)) if apart else value


def body_of(text: str) -> int:
    """Where a text begins behind blanks and the mark of a list item."""
    at = len(text) - len(text.lstrip())
    if text[at : at + 1] in LISTED and text[at : at + 1]:
        at += 1
    return at + len(text[at:]) - len(text[at:].lstrip())


def is_pointer(text: str) -> bool:
    """Whether a definition is a pointer from its first word on."""
    cue = cue_at(text, body_of(text))
    return cue is not None and cue.kind == "see"


def is_navigation(text: str) -> bool:
    """Whether an example or a heading sends the reader elsewhere and says nothing else."""
    at = body_of(text)
    if text[at : at + 1] in (".", ";"):
        cue = simple_cue(text, at + 1)
        return cue is not None and cue.kind != "see"
    first, end = word_at(text, at)
    if first == "for":
        about, _ = word_at(text, end)
        return about in ("example", "examples", "quotation", "quotations") and purpose(text, at) is not None
    cue = simple_cue(text, at)
    if cue is None or cue.kind != "see":
        return False
    word, end = word_at(text, cue.target)
    if word == "the":
        word, end = word_at(text, end)
    section = word in SECTIONS and (word != "usage" or word_at(text, end)[0].startswith("note"))
    return cue.explicit or first in ("but", "also") or section


def is_metadata(text: str) -> bool:
    """Whether a text lists related words under a label, or is a usage note."""
    label, colon, _ = text.partition(":")
    return bool(colon) and " ".join(label.lower().replace("-", " ").split()).removesuffix("s") in LABELS


def is_dated(text: str) -> bool:
    """Whether a text begins like a source: a year, perhaps with a second one or a day, then a mark and a name."""
    head, mark, rest = re.match(r"([^,:]*)([,:]?)(.*)", text, re.DOTALL).groups()
    words = re.sub(r"\s*[-–—]\s*", "-", head).split()
    if words and words[0].lower() in ("c.", "ca.", "circa"):
        words = words[1:]
    elif words and re.match(r"c\.?[0-9]", words[0]):
        words[0] = words[0].lstrip("c.")
    if not mark or not words or len(words) > 3:
        return False
    years = words[0].split("-")
    dated = len(years[0]) == 4 and years[0][0] in "12" and len(years) < 3 and all(y.isascii() and y.isdecimal() for y in years)
    month = all(w[0].isupper() and w.rstrip(".").isalpha() for w in words[1:2])
    day = all(w.isdecimal() for w in words[2:])
    name = rest.lstrip().lstrip("\"'“‘(")
    return dated and month and day and name[:1].isupper()


def drop_addresses(value: Marked) -> Marked:
    """Web addresses, with a bracket or a lead-in that is there for them alone."""
    text = value.text
    if "://" not in text or not _HTTP.search(text):
        return value
    closes = brackets(text)
    edits: list[tuple[int, int, str]] = []
    for m in re.finditer(r"\S+", text):
        if not (found := _HTTP.search(m[0])):
            continue
        start, end = m.start() + found.start(), m.end()
        inside = next((o for o in sorted(closes, reverse=True) if o < start < closes[o]), None)
        stop = min(end, closes[inside]) if inside is not None else end
        before = text[inside + 1 : start] if inside is not None else text[:start]
        if inside is not None and (not before.strip() or before.lower().lstrip().startswith("source:")):
            start, stop = inside, closes[inside] + 1
        elif lead := re.search(r"\bfor (?:more|details|examples|video)\b[^()\n]*?(?:\bsee|:)\s*$", before, re.IGNORECASE):
            start -= len(before) - lead.start()
        elif m.start() < start and found.start():
            continue  # an address within a longer word
        while start and text[start - 1].isspace() and text[start - 1] != "\n":
            start -= 1
        start = max(start, edits[-1][1] if edits else 0)
        if start < stop:
            edits.append((start, min(stop, len(text)), ""))
    return tidy(value.apply(edits)).strip() if edits else value


def clean_definition(value: Marked) -> Marked:
    """A definition without references; "" where there is nothing else."""
    text = value.text
    if text.lower().startswith(("see;", "see.")):
        return value
    if is_pointer(text):
        reason = text.lower().find(", for: ")
        if reason < 0 or "\n" in text[:reason]:
            return Marked("")
        value = value.apply([(0, reason + len(", for: "), "")])
    value = drop_references(value, explicit=text.lower().startswith("to see "))
    bare = re.search(r"[ \t]cf\.[ \t]", value.text) if "cf." in value.text else None
    if bare and simple_cue(value.text, bare.start()):
        end = clause_end(value.text, bare.end(), brackets(value.text))
        value = value.apply([(bare.start(), end, "." if value.text[end - 1] == "." else "")])
    value = drop_addresses(value)
    return value.sub(re.compile(r"\.[ \t]*(?:\.[ \t]*)*\.$"), lambda m: m[0] if set(m[0]) == {"."} and len(m[0]) > 2 else ".")
