"""Row filters of the collection dataflow; each is a plain expression that Catalyst can push down."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Parts of speech that are kept, in report order; a proper name is read as "name".
POS = ("noun", "propn", "verb", "adj", "adv")


def unicode_trim(col: Column) -> Column:
    """Trim all white space that Unicode knows; SQL's trim knows the blank alone."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def in_language(df: DataFrame, language: str, column: str = "lang_code") -> DataFrame:
    return df.where(F.col(column) == language)


def has_headword(df: DataFrame, column: str = "word") -> DataFrame:
    return df.where(unicode_trim(F.col(column)) != "")


def map_pos(pos: Column) -> Column:
    """The part of speech of a raw entry, or null if it isn't kept."""
    known = F.when(pos == "name", "propn").otherwise(pos)
    return F.when(known.isin(*POS), known)


def _quoted(text: str) -> str:
    """A text as a pattern of Java for itself."""
    return re.sub(r"([^\w\s])", r"\\\1", text)


def starts_with_any(gloss: Column, prefixes: list[str]) -> Column:
    """Whether a gloss begins with one of the prefixes, whole words only, whatever the case and spacing."""
    # One word more than the longest prefix has decides; each pass over a gloss is made once, not for each prefix.
    words = max((len(p.split(" ")) for p in prefixes), default=0)
    head = F.regexp_extract(gloss, rf"(?U)^\s*((?:\S+\s+){{0,{words}}}\S*)", 1)
    plain = F.lower(unicode_trim(F.regexp_replace(head, r"(?U)\s+", " ")))
    return plain.rlike(r"\A(?:" + "|".join(map(_quoted, prefixes)) + r")(?: |\z)") if prefixes else F.lit(False)


def is_form(tags: Column) -> Column:
    return F.arrays_overlap(tags, F.array(F.lit("form-of"), F.lit("alt-of")))


def year_within(reference: Column, year: Column, least: int | None, most: int | None) -> Column:
    """Quotations outside the bounds go, undated ones with them if there is a bound; examples always stay."""
    if least is None and most is None:
        return F.lit(True)
    inside = year.isNotNull()
    if least is not None:
        inside &= year >= least
    if most is not None:
        inside &= year <= most
    return reference.isNull() | inside


def page_may_hold(markup: Column, *needles: str) -> Column:
    """A cheap test before the parser: Catalyst can't derive it from an opaque function."""
    found = F.lit(False)
    for needle in needles:
        found |= F.contains(F.lower(markup), F.lit(needle))
    return found


def service_forms(forms: Column, headword: Column) -> Column:
    """Distinct forms with the headword; table furniture and blank forms are left out."""
    tags = F.array(F.lit("inflection-template"), F.lit("romanization"), F.lit("table-tags"))
    kept = F.filter(forms, lambda f: (F.trim(f["form"]) != "") & (f["form"] != "-") & ~F.coalesce(F.arrays_overlap(f["tags"], tags), F.lit(False)))
    return F.array_distinct(F.array_append(F.transform(kept, lambda f: f["form"]), headword))
