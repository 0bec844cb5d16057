"""Reading wiki markup: balanced templates, headings, and the tables and pointers of a page."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

# Names of parts of speech in headings, and of templates.
POS_HEADINGS = {"Noun": "noun", "Proper noun": "propn", "Verb": "verb", "Adjective": "adj", "Adverb": "adv"}
WORD_TEMPLATES = frozenset("t t+ tt tt+ t-check t+check t-simple".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<nowiki>.*?(?:</nowiki>|$)|\{\{\{|\{\{|\[\[|\}\}\}|\}\}|\]\]|\|", re.DOTALL | re.IGNORECASE)
_HEADING = re.compile(r"^(={2,6})\s*(.*?)\s*\1\s*$")
_PAIRS = {"{{{": "}}}", "{{": "}}", "[[": "]]"}


@dataclass(frozen=True)
class Template:
    name: str
    positional: tuple[str, ...] = ()
    named: dict[str, str] = field(default_factory=dict)


def templates(text: str) -> Iterator[str]:
    """The outermost templates of a text, braces included; comments and nowiki are opaque."""
    stack: list[tuple[str, int]] = []
    for m in _TOKEN.finditer(text):
        t = m[0]
        if t in _PAIRS:
            stack.append((t, m.start()))
        elif t in ("}}}", "}}", "]]"):
            while stack and _PAIRS[stack[-1][0]] != t and t == "}}}" and stack[-1][0] == "{{":
                t = "}}"
            if stack and _PAIRS[stack[-1][0]] == t:
                opened, start = stack.pop()
                if opened == "{{" and not any(o == "{{" for o, _ in stack):
                    yield text[start : m.start() + len(t)]


def read_template(text: str) -> Template | None:
    """Name and arguments of a template; of an argument given twice the last counts."""
    if not (text.startswith("{{") and text.endswith("}}")):
        return None
    inner, depth, parts, at = text[2:-2], 0, [], 0
    for m in _TOKEN.finditer(inner):
        if m[0] in _PAIRS:
            depth += 1
        elif m[0] in ("}}}", "}}", "]]"):
            depth = max(depth - 1, 0)
        elif m[0] == "|" and not depth:
            parts.append(inner[at : m.start()])
            at = m.end()
    parts.append(inner[at:])
    name, *arguments = (re.sub(r"<!--.*?-->", "", p, flags=re.DOTALL) for p in parts)
    numbered: dict[int, str] = {}
    named: dict[str, str] = {}
    position = 0
    for argument in arguments:
        key, equals, value = argument.partition("=")
        if equals and re.fullmatch(r"\s*[\w -]+\s*", key):
            if key.strip().isdigit() and int(key) > 0:
                numbered[int(key)] = value.strip()
            else:
                named[key.strip()] = value.strip()
        else:
            position += 1
            numbered[position] = argument.strip()
    return Template(name.strip(), tuple(numbered.get(k, "") for k in range(1, max(numbered, default=0) + 1)), named)


def heading(line: str) -> tuple[int, str] | None:
    m = _HEADING.match(line)
    return (len(m[1]), m[2]) if m else None


def plain_markup(text: str) -> str:
    return re.sub(r"''+", "", re.sub(r"\[\[(?:[^\[\]|]*\|)?([^\[\]]*)\]\]", r"\1", text)).strip()


def sections(markup: str, language: str = "English") -> Iterator[tuple[str, str]]:
    """(part of speech, text) of each section of a language; adjoining lines are one section."""
    inside, pos, level, held = False, None, 0, []
    for line in markup.split("\n"):
        if found := heading(line):
            if pos and held:
                yield pos, "\n".join(held)
            held = []
            depth, title = found
            if depth == 2:
                inside, pos = title == language, None
            elif pos and depth <= level:
                pos = None
            if inside and title in POS_HEADINGS:
                pos, level = POS_HEADINGS[title], depth
        elif inside and pos:
            held.append(line)
    if pos and held:
        yield pos, "\n".join(held)


def page_translations(title: str, markup: str) -> Iterator[tuple[str, str, str, str, str]]:
    """(kind, pos, gloss, language or "", word or target) of a page: kind is "word" or "pointer"."""
    for pos, text in sections(markup):
        gloss: str | None = None
        for raw in templates(text):
            t = read_template(raw)
            if t is None:
                continue
            first = t.positional[0] if t.positional else ""
            if t.name in ("trans-top", "trans-top-also"):
                gloss = first
            elif t.name == "trans-bottom":
                gloss = None
            elif t.name in ("trans-see", "trans-top-see"):
                for target in t.positional[1:] or (first,):
                    yield "pointer", pos, first, "", plain_markup(target)
            elif t.name in WORD_TEMPLATES and gloss is not None and len(t.positional) > 1:
                yield "word", pos, gloss, first, t.positional[1]


def wikidata_definitions(markup: str) -> Iterator[tuple[str, int, int, str, tuple[str, ...]]]:
    """(pos, etymology number or 0, depth, text, ids) of definition lines that carry Wikidata ids."""
    inside, pos, level, etymology = False, None, 0, 0
    for line in markup.split("\n"):
        if found := heading(line):
            depth, title = found
            if depth == 2:
                inside, pos, etymology = title == "English", None, 0
            elif pos and depth <= level:
                pos = None
            if inside and (m := re.fullmatch(r"Etymology (\d+)", title)):
                etymology = int(m[1])
            elif inside and title in POS_HEADINGS:
                pos, level = POS_HEADINGS[title], depth
        elif inside and pos and (m := re.match(r"(#+)\s*([^#*:].*)", line)):
            ids = []
            for raw in templates(re.sub(r"<!--.*?-->", "", m[2])):
                t = read_template(raw)
                if t and t.name == "senseid" and t.positional[:1] == ("en",):
                    ids += [x for x in t.positional[1:] if re.fullmatch(r"Q[1-9]\d*", x)]
            if ids:
                yield pos, etymology, len(m[1]), m[2], tuple(dict.fromkeys(ids))


@dataclass(frozen=True)
class Formula:
    """A formula of the markup with what stands around it in its line."""

    rendered: str
    source: str
    prefix: str
    suffix: str


def formulas(markup: str, render=lambda source: source) -> list[Formula]:
    """The <math> elements of a page; render gives what a parser shows for one."""
    out = []
    for line in markup.split("\n"):
        for m in re.finditer(r"<math\b[^>]*>(.*?)</math>", line):
            out.append(Formula(render(m[1].strip()), m[1].strip(), plain_markup(line[: m.start()])[-20:], plain_markup(line[m.end() :])[:20]))
    return out


def restore_formulas(text: str, found: list[Formula]) -> str:
    """Rendered formulas replaced by their source, longest first, only where the text around them names one formula."""
    for f in sorted(found, key=lambda f: -len(f.rendered)):
        context = f.prefix + f.rendered + f.suffix
        same = {g.source for g in found if g.rendered == f.rendered and g.prefix == f.prefix and g.suffix == f.suffix}
        if f.rendered and len(same) == 1 and text.count(context) == 1:
            text = text.replace(context, f.prefix + f.source + f.suffix)
    return text
