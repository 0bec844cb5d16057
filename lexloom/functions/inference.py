"""Models behind the alignment: loading one by name, prompting it, and keeping one request's failure from the others."""

from __future__ import annotations

import importlib
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from . import alignment

#: A model's answers to requests {task, lemma, pos, sources, targets}: response texts, None where there is none.
Model = Callable[[list[dict]], list[str | None]]

SYSTEM = "You link the senses of a dictionary entry to other resources. Answer with one JSON object and nothing else."
TEMPLATES = {
    "translations": "Entry: $lemma ($pos)\nSenses:\n$sources\nTranslation tables:\n$targets\nGive each sense the table that translates it, or null.",
    "synsets": "Entry: $lemma ($pos)\nSenses:\n$sources\nSynsets:\n$targets\nGive each sense its synsets with the relation of each, or null.",
}


@dataclass
class Prompted:
    """A backend that is asked by prompts: it takes [{system, prompt, schema}] and options, and gives texts.

    The backend is imported in the worker by its name, module:function.
    """

    backend: str
    system: str = SYSTEM
    templates: Mapping[str, str] = field(default_factory=lambda: dict(TEMPLATES))
    gloss_mode: str = "full"
    options: Mapping[str, object] = field(default_factory=dict)

    def request(self, query: Mapping) -> dict:
        task = query["task"]
        schema = alignment.response_schema(task, [s["id"] for s in query["sources"]], [t["id"] for t in query["targets"]])
        return {"system": self.system, "prompt": alignment.prompt(self.templates[task], query, self.gloss_mode), "schema": schema}

    def __call__(self, requests: list[dict]) -> list[str | None]:
        return imported(self.backend)([self.request(r) for r in requests], **self.options)


def imported(name: str) -> Callable:
    """The callable that module:function names."""
    module, colon, attribute = name.partition(":")
    if not colon or not module or not attribute:
        raise ValueError(f"{name}: not module:function")
    return getattr(importlib.import_module(module), attribute)


def load(name: str, prompts: Mapping | None = None, gloss_mode: str = "full", options: Mapping | None = None) -> Model:
    """The stub, or a prompted backend; prompts: {system, tasks} as read from a file."""
    if name == "stub":
        return alignment.stub_model
    imported(name)
    prompts = prompts or {}
    return Prompted(name, prompts.get("system", SYSTEM), {**TEMPLATES, **prompts.get("tasks", {})}, gloss_mode, dict(options or {}))


def answer(model: Model, requests: list[dict]) -> list[str | None]:
    """Answers to a batch; if the batch fails each request is asked by itself, and one that fails has no answer."""
    if not requests:
        return []
    try:
        found = list(model(requests))
        if len(found) == len(requests):
            return found
    except Exception:  # noqa: BLE001 - a plug-in may raise anything
        pass
    return [_alone(model, r) for r in requests]


def _alone(model: Model, request: dict) -> str | None:
    try:
        (found,) = model([request])
    except Exception:  # noqa: BLE001
        return None
    return found


def decide_one(query: Mapping, task: str, model: Model = alignment.stub_model, cached: Mapping | None = None) -> dict[str, list[dict]]:
    """Decisions of a single query {lemma, pos, sources, targets}, cached ones that hold included; invalid answers raise."""
    kept, sources, targets = alignment.remaining(task, cached or {}, list(query["sources"]), list(query["targets"]))
    if sources and not targets:
        return {**kept, **{s["id"]: [] for s in sources}}
    if not sources:
        return dict(kept)
    (text,) = model([{"task": task, "lemma": query["lemma"], "pos": query["pos"], "sources": sources, "targets": targets}])
    made = {**kept, **alignment.parse_response(text or "", [s["id"] for s in sources])}
    alignment.validate(task, made, [s["id"] for s in query["sources"]], [t["id"] for t in query["targets"]])
    return made
