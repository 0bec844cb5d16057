"""Translated words and headings of translation tables."""

from __future__ import annotations

import itertools
import re

from .edits import Marked
from .formatting import is_damaged, plain, statement
from .references import drop_references, is_dated, is_metadata, is_navigation
from .wikitext import WORD_TEMPLATES, read_template

# Headings that name no sense, and languages in which "See" is a word.
PLACEHOLDERS = frozenset({"translation", "translations", "translations to be checked", "translations to be specified", "translation gloss", "sense"})
SEA_LANGUAGES = frozenset({"de", "af", "fy", "sco"})

I = re.IGNORECASE  # noqa: E741
_CODE = re.compile(r"[a-z]{2,3}(?:-[A-Za-z0-9]+)*")
_EDITORIAL = re.compile(r"^(?:often|sometimes)\b.*\bcalled\b|^(?:thesaurus|wikipedia|appendix|citations):|\bother compounds\b|^compounds? with\b|^(?:not used|no equivalent|please add)\b", I)
_ROUND = re.compile(r"\s*\([^()]*\)")
_SQUARE_NOTE = re.compile(r"(?:^|\s)\[[^\[\]]*\](?=\s|$)")
_OPEN_SQUARE = re.compile(r"\s\[[^\[\]]*$")
_CLASS = re.compile(r"\s+(?:class(?:es)?\s+[0-9/]+|c[0-9]+(?:/[0-9]+)?)(?=$|[,;/])", I)
GENDER = r"(?:m|f|n|c)(?:[.’'](?:\s?(?:pl|sg))?)?"
_GRAMMAR = rf"(?:{GENDER}|pl|sg|plural|singular|impf|pf|uncountable|gender-neutral|gender (?:unattested|unknown)|dual|inan|anim)"
_TAIL = re.compile(rf"(?<=\S)(?:\s+{_GRAMMAR})+(?:\s+(?:and|or))?$")
_BETWEEN = re.compile(rf"\s+{GENDER}(?:\s+(?:pl|sg))?\s+")
_ETC = re.compile(r"[,\s]*\betc\.?$", I)


def language_and_word(language: str, word: str) -> tuple[str, str]:
    """A whole translation template names its own language and word."""
    word = word.strip()
    t = read_template(word) if word.startswith("{{") else None
    if t and t.name in WORD_TEMPLATES and len(t.positional) > 1:
        return t.positional[0], t.positional[1]
    return language, word


def _slashes(word: str) -> list[str]:
    tokens = [t.split("/") if "/" in t.strip("/") and all(t.split("/")) else [t] for t in word.split(" ")]
    product = 1
    for t in tokens:
        product *= len(t)
    return [" ".join(p) for p in itertools.product(*tokens)] if product <= 16 else [word]


def _optional(word: str) -> list[str]:
    m = re.search(r"(?<=\w)\[([^\[\]\s]+)\]|\[([^\[\]\s]+)\](?=\w)", word)
    if not m:
        return [word]
    inner = m[1] or m[2]
    return _optional(word[: m.start()] + inner + word[m.end() :]) + _optional(word[: m.start()] + word[m.end() :])


def _commas(word: str, explicit: bool) -> list[str]:
    parts = [p.strip() for p in word.split(",")]
    if len(parts) < 2 or not all(parts):
        return [word]
    single = all(len(p) >= 3 and " " not in p for p in parts)
    shared = len({p.split()[-1] for p in parts}) == 1
    return parts if explicit or single or shared else [word]


def alternatives(word: str, explicit: bool) -> set[str]:
    """All complete forms that a written translation stands for."""
    found: set[str] = set()
    for part in _commas(word, explicit):
        marks = _BETWEEN.findall(part)
        tail = _TAIL.search(part)
        pieces = _BETWEEN.split(part) if marks and (len(marks) > 1 or tail or re.search(r"\s(?:m|f|n)\s", part)) and _genders(part) else [part]
        for piece in pieces:
            for spaced in re.split(r"\s+[/\\]\s*|\s*[/\\]\s+", piece):
                spaced = _TAIL.sub("", spaced).strip()
                found.update(x.strip() for opt in _optional(spaced) for x in _slashes(opt) if x.strip())
    return found


def _genders(part: str) -> bool:
    """Whether gender marks separate forms: the words on both sides begin alike, or several marks stand."""
    pieces = _BETWEEN.split(part)
    heads = [p.split()[0][:1].casefold() for p in pieces if p.split()]
    return len(set(heads)) == 1 and len(pieces) > 1 and len(_common(pieces)) >= 1


def _common(pieces: list[str]) -> str:
    first, *rest = [p.casefold() for p in pieces]
    n = 0
    while n < len(first) and all(len(r) > n and r[n] == first[n] for r in rest):
        n += 1
    return first[:n]


def clean(language: str, word: str) -> tuple[str, frozenset[str]] | None:
    """Language and words of a raw translation, or None if it isn't one."""
    language, word = language_and_word(language, word)
    if not _CODE.fullmatch(language):
        return None
    text = plain(Marked(word)).text
    if not text or is_damaged(text) or re.search(r"[{}<>]|\[\[|\]\]", text) or is_metadata(text) or _EDITORIAL.search(text):
        return None
    if is_navigation(text) or (re.match(r"see\s", text, I) and not (language.split("-")[0] in SEA_LANGUAGES and text[0] == "S")):
        return None
    if re.fullmatch(r"[\[(<].*(?:please|verify|term|word|translation).*[\])>]", text, I):
        return None
    while _ROUND.search(text):
        text = _ROUND.sub("", text)
    text = _OPEN_SQUARE.sub("", _SQUARE_NOTE.sub("", text)).strip()
    if "(" in text or ")" in text:
        return None
    text = _CLASS.sub("", text)
    explicit = bool(_ETC.search(text))
    text = _TAIL.sub("", _ETC.sub("", text)).strip(" ,;")
    words = frozenset(w for w in alternatives(text, explicit) if any(c.isalnum() for c in w))
    return (language, words) if words else None


def heading(text: str) -> str:
    """A table's heading as a statement; "" if it names no sense."""
    value = drop_references(plain(Marked(text)))
    if is_damaged(value.text) or re.search(r"\[\[|\]\]", value.text) or is_dated(value.text) or value.text.strip(" .:").casefold() in PLACEHOLDERS:
        return ""
    if is_navigation(value.text) or re.match(r"see\s+\S", value.text, I):
        return ""
    return statement(plain(value, keep_markup=True)).text


def key(text: str) -> str:
    """Comparison key of a heading."""
    folded = " ".join(text.split()).casefold()
    return folded[:-1] if folded.endswith(".") and not folded.endswith("..") else folded
