"""The Markdown report of a collection, and the manifests."""

from __future__ import annotations

import datetime
import platform
from collections.abc import Iterable, Mapping

from ..operators.filters import POS

DASH = "—"
TOP = 10


def share(part: float, whole: float) -> str:
    return f"{100 * part / whole:.1f}%" if whole else DASH


def average(total: float, n: float) -> str:
    return f"{total / n:.2f}" if n else DASH


def escape(cell: object) -> str:
    text = str(cell)
    for c in "\\|`*_[]<>":
        text = text.replace(c, "\\" + c)
    return " ".join(text.split())


def table(head: Iterable[str], rows: Iterable[Iterable[object]]) -> str:
    head = list(head)
    line = lambda cells: "| " + " | ".join(map(escape, cells)) + " |"
    return "\n".join([line(head), "|" + " --- |" * len(head), *map(line, rows)])


def shares(label: str, found: Mapping[str, int], most: int | None = None) -> str:
    rows = sorted(found.items(), key=lambda x: -x[1]) if most else list(found.items())
    whole = sum(found.values())
    return table((label, "Count", "Share"), ((k, n, share(n, whole)) for k, n in rows[:most]))


def render(s: Mapping) -> str:
    """The six sections, in order."""
    t = s["totals"]
    pos = table(("Part of speech", "Entries", "Senses", "Sentences"), ((p, s["entries"].get(p, 0), s["senses"].get(p, 0), s["sentences"].get(p, 0)) for p in POS if p in s["entries"]))
    parts = [
        ("Records", [pos, f"Senses an entry: {average(t['senses'], t['entries'])}, median {s['medians']['senses_per_entry']}", shares("Senses", s["senses_per_entry"]), shares("Gloss depth", s["gloss_depths"])]),
        ("Variants and synonyms", [f"Entries with variants: {s['variant_entries']} ({share(s['variant_entries'], t['entries'])})", f"Senses with synonyms: {s['synonym_senses']} ({share(s['synonym_senses'], t['senses'])})"]),
        ("Translations", [f"Translated entries: {s['translated_entries']} ({share(s['translated_entries'], t['entries'])})", shares("Language", s["translation_languages"], TOP)]),
        ("Sentences and quotations", [shares("Kind", s["sentence_kinds"]), f"Senses without sentence: {s['unattested_senses']} ({share(s['unattested_senses'], t['senses'])})", f"Undated quotations: {s['undated_quotations']}"]),
        ("Word offsets", [shares("Agreement", s["source_relations"]), f"Unlocated sentences: {s['unlocated_sentences']} ({share(s['unlocated_sentences'], t['sentences'])})", shares("Violation", s["offset_violations"])]),
        ("Tags and topics", [shares("Tag", s["tags"], TOP), shares("Topic", s["topics"], TOP)]),
    ]
    return "\n\n".join(["# Collection", *(f"## {title}\n\n" + "\n\n".join(blocks) for title, blocks in parts)]) + "\n"


def now() -> str:
    return datetime.datetime.now(datetime.UTC).isoformat(timespec="seconds")


def collection_manifest(date: str, sources: Mapping[str, str | None], settings: Mapping, files: Iterable[str]) -> dict:
    return {"created": now(), "dump_date": date, "sources": dict(sources), "settings": dict(settings), "runtime": {"python": platform.python_version()}, "files": sorted(files)}


def alignment_manifest(source: str, tasks: Iterable[str], settings: Mapping, prompts: str, stages: list[str] | None, files: Iterable[str]) -> dict:
    made = {"created": now(), "source": source, "tasks": list(tasks), "settings": dict(settings), "prompts": prompts, "files": sorted(files)}
    return made | ({"stages": stages} if stages else {})
