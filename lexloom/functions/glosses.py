"""Glosses: cleaning, classification by prefix, and the entries that they refer to."""

from __future__ import annotations

import re

from .edits import Marked
from .formatting import is_damaged, is_literal, plain, statement
from .references import clean_definition, is_dated

# Beginnings of glosses that describe a form of another entry.
FORM_PREFIXES = """
accusative of|accusative singular of|alternative plural of|animate accusative plural|animate accusative singular|a plural of|attributive form|comparative degree of|comparative form of
dative of|dative plural|dative/prepositional singular of|dative singular of|definite nominative/accusative singular|feminine plural|feminine singular|first-person plural
first-person singular future|first-person singular non-past|first-person singular past|first-person singular present|genitive/accusative plural of|genitive/accusative/prepositional plural of
genitive/accusative singular of|genitive/dative/prepositional singular|genitive/dative/prepositional singular of|genitive of|genitive plural|genitive/prepositional plural of|genitive singular of
imperfective and stem (or continuative) forms of|inanimate accusative plural|inflection of|instrumental plural of|instrumental singular|locative singular of|masculine plural|masculine singular past
neuter singular past|nominative/accusative plural|nominative plural|past of|past participle|past tense of|plural of|plural past|prepositional plural of|prepositional singular of
present participle of|present participle and|second-person|second-person feminine|second-person masculine|second-person plural|second-person singular simple|second-person singular simple past
second-person singular simple present|short feminine singular|short masculine singular|short neuter singular|short plural of|short plural past|simple past of|simple past and|simple past tense
simple past tense and|simple past tense of|stem or continuative form of|superlative form|third-person feminine|third-person masculine|third-person plural|third-person singular
third-person singular simple|third-person singular simple present
"""
SYNONYM_PREFIXES = "synonym|synonym of"
VARIANT_PREFIXES = """
abbreviation|abbreviation of|active participle of|a diminutive of|alternative form|alternative form of|alternative letter-case|alternative letter-case form|alternative letter-case form of
alternative spelling of|an aphetic form of|anglicized form of|aphetic form of|archaic|archaic form|archaic form of|archaic spelling|archaic spelling of|a transliteration|dated form|dated form of
elative degree of|elongated form of|eye dialect|eye dialect spelling|eye dialect spelling of|informal form of|initialism of|misspelling|misspelling of|non-oxford|non-oxford british
non-oxford british english|non-oxford british english standard|nonstandard form of|nonstandard spelling of|obsolete|obsolete spelling|obsolete spelling of|passive participle of
pronunciation spelling of|rare form of|rare spelling|rare spelling of|reduced form of|representing a pronunciation of|shortened form of|short form of|singulative of|the condition
this term needs a definition. please help out and|this term needs a translation to english|uncommon form of|unstressed form of|used other|used other than|used other than with|verbal noun of
"""


def _matcher(prefixes: str) -> re.Pattern[str]:
    every = sorted(filter(None, re.split(r"[|\n]", prefixes)), key=len, reverse=True)
    return re.compile("(?:" + "|".join(map(re.escape, every)) + r")(?: |$)")


_FORM, _SYNONYM, _VARIANT = map(_matcher, (FORM_PREFIXES, SYNONYM_PREFIXES, VARIANT_PREFIXES))


def _folded(gloss: str) -> str:
    return " ".join(gloss.split()).casefold()


def is_form(gloss: str) -> bool:
    return bool(_FORM.match(_folded(gloss)))


def is_synonym(gloss: str) -> bool:
    return bool(_SYNONYM.match(_folded(gloss)))


def is_variant(gloss: str) -> bool:
    return bool(_VARIANT.match(_folded(gloss)))


def is_redirect(glosses: list[str]) -> bool:
    """Whether any level of a chain describes a form, a synonym or a variant."""
    return any(is_form(g) or is_synonym(g) or is_variant(g) for g in glosses)


def referred(gloss: str) -> str | None:
    """The entry that a variant's gloss names."""
    m = re.search(r"\b(?:used other than(?: with)?|of)\s+([^;,(]+)", gloss, re.IGNORECASE)
    return (m[1].strip().rstrip(".:").strip() or None) if m else None


def clean(gloss: str) -> str | None:
    """A gloss as a statement; "" if it only points elsewhere, None if it is damaged."""
    literal = is_literal(gloss)
    value = plain(Marked(gloss), keep_markup=literal)
    if (not literal and is_damaged(value.text)) or is_dated(value.text):
        return None
    if not literal:
        value = clean_definition(value)
    return statement(plain(value, keep_markup=True)).text


def clean_chain(glosses: list[str]) -> list[str] | None:
    """The levels of a sense; None if one is damaged or none is left."""
    cleaned = [clean(g) for g in glosses]
    if None in cleaned:
        return None
    return [g for g in cleaned if g] or None
