"""Visible markup to plain text, damage tests and the form of a statement.

One scanner (TOKENS) finds every piece of markup, and RESOLVERS says what each kind stands for. Scans are repeated until
nothing changes, since markup may be nested or be escaped.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable
from html import unescape

from .edits import Marked
from .mathematics import COMMANDS, GROUPED, latexize, script

# Three encoding errors and what they stand for.
MOJIBAKE = {"Ã©": "é", "â€¢": "•", "â€“": "–"}
# Inline tags that only set type.
STYLE_TAGS = frozenset({"b", "em", "i", "small", "span", "strong"})
# Words of a text that is about code, and commands whose backslash gets lost.
CODE_WORDS = frozenset({"code", "filter", "html", "javascript", "python", "tag", "tags", "template", "templates"})
BARE_COMMANDS = ("dfrac", "displaystyle", "mathbb", "mathbf", "mathcal", "mathfrak", "operatorname", "tfrac")

TOKENS = {
    "invisible": "[\u00ad\u200b\u2060\ufeff]",
    "mojibake": "|".join(map(re.escape, MOJIBAKE)),
    "footnote": r"[ \t]*\^\(\[(?i:sic|wikipedia)\]\)",
    "citation": r"<(?i:ref)\b(?:[^>]*/>|[^>]*>(?s:.*?)</(?i:ref)>)",
    "raised": r"<(?i:sup)\b[^>]*>[^<>]*</(?i:sup)>",
    "lowered": r"<(?i:sub)\b[^>]*>[^<>]*</(?i:sub)>",
    "tag": r"</?[A-Za-z]+\b[^<>]*>",
    "entity": r"&(?:[A-Za-z][A-Za-z0-9]*|#[0-9]+|#[xX][0-9a-fA-F]+);",
    "number": r"(?<!&)#(?:[0-9]{2,7}|[xX][0-9a-fA-F]{2,6});",
    "link": r"\[{2,3}[^\[\]]+\]{2,3}",
    "quotes": "''+",
    "blanks": r"[ \t]{2,}",
}


def scanner(kinds: list[str]) -> re.Pattern[str]:
    return re.compile("|".join(f"(?P<{k}>{TOKENS[k]})" for k in kinds))


def inner(element: str) -> str:
    """What stands between an element's tags."""
    return element[element.index(">") + 1 : element.rindex("<")]


def from_tag(tag: str) -> str:
    name = re.match(r"</?([A-Za-z]+)", tag)[1].lower()
    return "\n" if name == "br" and tag[1] != "/" else "" if name in STYLE_TAGS else tag


def from_number(token: str) -> str:
    digits = token[1:-1]
    code = int(digits[1:], 16) if digits[0] in "xX" else int(digits)
    return chr(code) if 0 < code <= 0x10FFFF and not 0xD800 <= code <= 0xDFFF else token


def from_link(link: str) -> str:
    """The label of a link, else its page; three brackets are one visible pair around a link."""
    opening, closing = len(link) - len(link.lstrip("[")), len(link) - len(link.rstrip("]"))
    if opening != closing:
        return link
    if opening == 3:
        return link[2:-2]
    page, bar, label = link[2:-2].partition("|")
    return label if bar else page.split("#")[0] or page


RESOLVERS: dict[str, Callable[[str], str]] = {
    "invisible": lambda t: "",
    "mojibake": MOJIBAKE.__getitem__,
    "footnote": lambda t: "",
    "citation": lambda t: "",
    "raised": lambda t: script(inner(t), True),
    "lowered": lambda t: script(inner(t), False),
    "tag": from_tag,
    "entity": unescape,
    "number": from_number,
    "link": from_link,
    "quotes": lambda t: "",
    "blanks": lambda t: " ",
}
LETTERS = ["invisible", "mojibake"]
MARKUP = [k for k in TOKENS if k not in LETTERS]
#: What a text holds if it holds a token of the kind, so that a scan looks for no other kinds than may be there.
NEEDLES = {
    "invisible": {"\u00ad", "\u200b", "\u2060", "\ufeff"}, "mojibake": set(MOJIBAKE), "footnote": {"^(["}, "citation": {"<"}, "raised": {"<"}, "lowered": {"<"}, "tag": {"<"},
    "entity": {"&"}, "number": {"#"}, "link": {"[["}, "quotes": {"''"}, "blanks": {"  ", "\t"},
}
_ALL_NEEDLES = sorted(set().union(*NEEDLES.values()))
_ASCII_NEEDLES = [n for n in _ALL_NEEDLES if n.isascii()]


@functools.cache
def _scanner(kinds: tuple[str, ...]) -> re.Pattern[str]:
    return scanner(list(kinds))


def _tokens(text: str, kinds: list[str]) -> re.Pattern[str] | None:
    """The scanner of those kinds that the text may hold, if any."""
    held = [n for n in (_ASCII_NEEDLES if text.isascii() else _ALL_NEEDLES) if n in text]
    if not held:
        return None
    there = tuple(k for k in kinds if not NEEDLES[k].isdisjoint(held))
    return _scanner(there) if there else None


def plain(value: Marked, keep_joiners: bool = False, keep_markup: bool = False) -> Marked:
    """Markup resolved until nothing changes; lines stay."""
    kinds = ([] if keep_joiners else LETTERS) + ([] if keep_markup else MARKUP)
    for _ in range(8):
        before = value.text
        if tokens := _tokens(before, kinds):
            value = value.sub(tokens, lambda m: RESOLVERS[m.lastgroup](m[0]))
        if not keep_markup:
            value = mathematics(value)
        value = value.strip()
        if value.text == before:
            break
    return value


def mathematics(value: Marked) -> Marked:
    """TeX for mathematical characters; words between blanks are rewritten one by one, so that ranges survive."""
    if value.text.isascii():
        return value
    whole = latexize(value.text)
    if whole == value.text:
        return value
    words = re.compile(r"\S+")
    changed = value.sub(words, lambda m: latexize(m[0]))
    return changed if changed.text == whole else value.apply([(0, len(value.text), whole)])


def is_literal(text: str) -> bool:
    """Whether a text is about code or markup, which then is its content."""
    if not any(c in text for c in "`<{\\'"):
        return False
    prose = re.sub(r"https?://\S+|\{\{[^{}]*\}\}|\[\[[^\[\]]*\]\]", "", text) if "http" in text or "{{" in text or "[[" in text else text
    tagged = "<" in prose
    if "`" in prose or (tagged and re.search(r"<(?:div|table)\b", prose)):
        return True
    shown = any(mark in prose for mark in ("{{", "\\", "''")) or (tagged and re.search("<[^<>]+>", prose))
    return bool(shown) and not CODE_WORDS.isdisjoint(re.findall(r"\w+", prose.lower()))


_SUSPECT = re.compile("\ufffd|" r"\{\{|\}\}|(?<!\[)\[\[(?=[A-Za-z])|\\[A-Za-z]+|(?<![\\\w])(?:" + "|".join(BARE_COMMANDS) + r")(?=[({_])|Template:|(?:Lua|Script) error\b")
#: A text with none of these holds nothing suspect.
_SUSPECT_NEEDLES = ("\ufffd", "{{", "}}", "[[", "\\", "frac", "math", "displaystyle", "operatorname", "Template:", " error")


def is_damaged(text: str, formulas: tuple[str, ...] = ()) -> bool:
    """Whether broken templates, links or formulas are left."""
    for formula in formulas:
        text = text.replace(formula, "")
    if not [n for n in _SUSPECT_NEEDLES if n in text]:
        return False
    for m in _SUSPECT.finditer(text):
        token, after = m[0], text[m.end() : m.end() + 1]
        if token[0] == "\\":
            if token[1:] not in COMMANDS or (token[1:] in GROUPED and after != "{"):
                return True
        elif token == "[[":
            line = text[m.end() :].split("\n")[0]
            if "]]" not in line or line.index("]") != line.index("]]") or line[line.index("]]") + 2 :][:1] != "]":
                return True
        elif token == "Template:":
            if m.start() == 0 or text[m.start() - 1].isspace() or text[m.start() - 1] == ":":
                return True
        elif token.endswith("error"):
            if m.start() == 0:
                return True
        else:
            return True
    return False


def _surplus_closers(text: str) -> list[tuple[int, int, str]]:
    depth, out = 0, []
    if ")" not in text:
        return out
    for m in re.finditer("[()]", text):
        k = m.start()
        depth += 1 if m[0] == "(" else -1
        if depth < 0:
            depth = 0
            out.append((k, k + 1, ""))
    return out


#: Marks that close a sentence, and those that may stand behind one.
CLOSING, TRAILING = ".?!…‽", "\"'”’»)]"


def begins_formula(text: str) -> bool:
    """Whether a text begins with a variable and a relation, so that its first letter stays small."""
    if not ("a" <= text[:1] <= "z"):
        return False
    rest = text[1:].lstrip()
    relation = re.match(r"\\([a-z]+)", rest)
    return rest[:1] in tuple("=+<>×÷−") or (relation is not None and relation[1] in {"in", "leq", "geq", "times", "approx", "subset", "subseteq"})


def statement(value: Marked) -> Marked:
    """A sentence: balanced, first letter upper case, closed by punctuation; "" without letters and digits."""
    if not any(c.isalnum() for c in value.text):
        return Marked("")
    if extra := _surplus_closers(value.text):
        value = value.apply(extra)
    text = value.text
    if not begins_formula(text):
        at = next((k for k, c in enumerate(text) if c.isalnum()), None)
        if at is not None and text[at].isalpha() and (at == 0 or text[at - 1] != "\\") and len(text[at].upper()) == 1:
            value = Marked(text[:at] + text[at].upper() + text[at + 1 :], value.spans)
    kept = value.text.rstrip()
    loose = kept.rstrip(",;:").rstrip() if kept[-1:] in (",", ";", ":") else None
    if loose is not None:
        value = value.apply([(len(kept[:-1].rstrip()), len(value.text), ".")])
    body = value.text.rstrip(TRAILING)
    if value.text.endswith(tuple(CLOSING)) or (body != value.text and body.endswith(tuple(CLOSING))):
        return value
    return Marked(value.text + ".", value.spans)
