"""Unicode mathematics as TeX commands. Tables are derived from Unicode names, not listed."""

from __future__ import annotations

import functools
import re
import unicodedata

# Symbols and their TeX commands.
SYMBOLS = {
    "∈": "in", "∉": "notin", "≤": "leq", "≥": "geq", "≠": "neq", "≈": "approx", "≡": "equiv", "⊂": "subset", "⊆": "subseteq", "⊃": "supset", "⊇": "supseteq",
    "∪": "cup", "∩": "cap", "∅": "emptyset", "∀": "forall", "∃": "exists", "∞": "infty", "∂": "partial", "∇": "nabla", "∑": "sum", "∏": "prod", "∫": "int",
    "→": "to", "⇒": "Rightarrow", "⇔": "Leftrightarrow", "↦": "mapsto", "∧": "wedge", "∨": "vee", "¬": "neg", "⊕": "oplus", "⊗": "otimes", "⋅": "cdot",
    "∼": "sim", "≅": "cong", "∝": "propto", "±": "pm", "∓": "mp", "∘": "circ", "⊢": "vdash", "⊨": "models",
}
ALPHABETS = {"DOUBLE-STRUCK": "mathbb", "SCRIPT": "mathcal", "FRAKTUR": "mathfrak", "BLACK-LETTER": "mathfrak", "BOLD": "mathbf", "ITALIC": "mathit"}
GREEK = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega"
# Commands that take an argument in braces.
GROUPED = frozenset({"dfrac", "frac", "mathbb", "mathbf", "mathcal", "mathfrak", "mathit", "operatorname", "sqrt", "text", "tfrac"})
COMMANDS = frozenset(SYMBOLS.values()) | GROUPED | frozenset(GREEK.split()) | frozenset(
    "times div surd ldots cdots le ge ne log ln sin cos tan lim max min sup inf det dim ker left right quad vec hat bar overline underline prime ell Gamma Delta Theta Lambda Xi Pi Sigma Phi Psi Omega".split()
)

#: All letters of mathematical alphabets stand in these two blocks.
_LETTERS = re.compile("[\u2100-\u214f\U0001d400-\U0001d7ff" + "".join(SYMBOLS) + "]")
#: A text with none of these stays as it is.
_ACTIVE = re.compile("[\u2100-\u214f\U0001d400-\U0001d7ff⁰-⁾²³¹₀-₎√−" + "".join(SYMBOLS) + "]")
_SCRIPTS = re.compile("[⁰-⁾²³¹]+|[₀-₎]+")
_OPERATOR = re.compile(r"[=<>+×÷]|\\(?:in|notin|leq|geq|neq|approx|equiv|subseteq?|cup|cap|to|forall|exists)\b")
_SPACED_COMMAND = re.compile(r"(\\[A-Za-z]+)(?=[A-Za-z])")


@functools.cache
def letter(char: str) -> str | None:
    """A letter of a mathematical alphabet as a command with its plain letter."""
    name = unicodedata.name(char, "")
    if not (name.startswith("MATHEMATICAL ") or re.match(r"(?:DOUBLE-STRUCK|SCRIPT|BLACK-LETTER) (?:CAPITAL|SMALL)", name)):
        return None
    plain = unicodedata.normalize("NFKC", char)
    command = next((c for k, c in ALPHABETS.items() if k in name), None)
    return f"\\{command}{{{plain}}}" if command and len(plain) == 1 and plain.isascii() and plain.isalnum() else None


def script(text: str, raised: bool) -> str:
    """Text as raised or lowered characters where each has such a form, else in TeX."""
    table = {unicodedata.normalize("NFKC", c): c for c in map(chr, [*range(0x2070, 0x207F), 0xB2, 0xB3, 0xB9] if raised else range(0x2080, 0x208F)) if unicodedata.name(c, "")}
    made = [table.get("−" if c == "-" else c) for c in text]
    return "".join(made) if text and all(made) else ("^{" if raised else "_{") + text + "}"


def _command(m: re.Match[str]) -> str:
    c = m[0]
    if c not in SYMBOLS:
        return letter(c) or c
    after = m.string[m.end() : m.end() + 1]
    return f"\\{SYMBOLS[c]}" + (" " if after.isalpha() and after.isascii() else "")


def latexize(text: str) -> str:
    """Mathematical characters as TeX; Greek letters and minus signs only beside other mathematics."""
    if text.isascii() or not _ACTIVE.search(text):
        return text
    text = _LETTERS.sub(_command, text)
    text = _SCRIPTS.sub(lambda m: ("_{" if "₀" <= m[0][0] <= "₎" else "^{") + unicodedata.normalize("NFKC", m[0]).replace("−", "-") + "}", text)
    text = re.sub(r"√(?:\(([^()]*)\)|(\w))", lambda m: f"\\sqrt{{{m[1] or m[2]}}}", text)
    if _OPERATOR.search(text) or re.search(r"[\^_]\{", text):
        text = text.replace("−", "-")
    return text
