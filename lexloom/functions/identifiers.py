"""Stable identifiers of entries, senses, tables and queries."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable


def digest(*parts: str) -> str:
    """Four bytes of BLAKE2b over the parts, a line each, in hex."""
    return hashlib.blake2b("\n".join(parts).encode(), digest_size=4).hexdigest()


def lemma_id(lemma: str, pos: str) -> str:
    return f"{lemma.replace(' ', '_')}.{pos}"


def sense_id(lemma: str, pos: str, etymology: str | None, glosses: Iterable[str]) -> str:
    return f"{lemma_id(lemma, pos)}.{digest(etymology or '', *glosses)}"


def table_id(lemma: str, pos: str, gloss: str) -> str:
    return f"{lemma_id(lemma, pos)}.tr.{digest(gloss)}"


def query_id(task: str, lemma: str, stage: str | None = None) -> str:
    return ":".join(x for x in (task, stage, lemma) if x is not None)
