"""Matching definitions of a page to senses of an entry by words."""

from __future__ import annotations

import difflib
import re
from collections.abc import Sequence

from .wikitext import read_template, templates

LEAST = 0.7
# A definition of so many words, covered to this part by a longer sense of which it is this share at least,
# scores the least similarity and so much more for its share.
WORDS, COVERED, SHARE, STEP = 2, 0.85, 0.3, 0.2


def tokens(text: str) -> list[str]:
    """Comparable words of markup: innermost templates by their last argument, links by their text."""
    for _ in range(8):
        inner = re.search(r"\{\{[^{}]*\}\}", text)
        if not inner:
            break
        t = read_template(inner[0])
        keep = "" if t is None or t.name in ("senseid", "lb", "label", "lbl", "anchor", "defdate") or not t.positional else t.positional[-1]
        text = text[: inner.start()] + keep + text[inner.end() :]
    text = re.sub(r"\[\[(?:[^\[\]|]*\|)?([^\[\]]*)\]\]", r"\1", re.sub(r"<[^>]*>", " ", text))
    return re.findall(r"\w+", text.casefold())


def similarity(written: Sequence[str], parsed: Sequence[str]) -> float:
    """Ratcliff-Obershelp ratio of word sequences, raised where one nearly covers the other."""
    matcher = difflib.SequenceMatcher(None, written, parsed, autojunk=False)
    ratio = matcher.ratio()
    same = sum(b.size for b in matcher.get_matching_blocks())
    if parsed and len(written) >= WORDS and same >= COVERED * len(written) and same >= SHARE * len(parsed):
        ratio = max(ratio, LEAST + STEP * same / len(parsed))
    return ratio


def best(text: str, depth: int, ids: Sequence[str], senses: Sequence[dict]) -> tuple[int, int] | None:
    """(sense, depth) that a definition describes. Senses: {glosses: list, ids: list}."""
    if any((t := read_template(raw)) and t.name == "non-gloss" for raw in templates(text)):
        return None
    supported = [k for k, s in enumerate(senses) if ids and set(ids) <= set(s.get("ids") or ())]
    level = [k for k in supported if len(senses[k]["glosses"]) == depth]
    if len(level) == 1:
        return level[0], depth
    written = tokens(text)
    if not written:
        return None
    pool = level or [k for k, s in enumerate(senses) if len(s["glosses"]) == depth]
    if len(supported) == 1 and not level:
        deeper = senses[supported[0]]["glosses"]
        if len(deeper) > depth and similarity(written, tokens(deeper[depth - 1])) >= LEAST:
            pool = []
    scored = sorted(((similarity(written, tokens(senses[k]["glosses"][-1])), k) for k in pool), key=lambda x: (-x[0], x[1]))
    if scored and scored[0][0] >= LEAST:
        ties = {tuple(senses[k]["glosses"]) for score, k in scored if score == scored[0][0]}
        return (scored[0][1], depth) if len(ties) == 1 else None
    prefixes: dict[tuple[str, ...], int] = {}
    for k, s in enumerate(senses):
        if len(s["glosses"]) > depth and similarity(written, tokens(s["glosses"][depth - 1])) >= LEAST:
            prefixes.setdefault(tuple(s["glosses"][:depth]), k)
    return (next(iter(prefixes.values())), depth) if len(prefixes) == 1 else None
