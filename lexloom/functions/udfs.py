"""Arrow UDFs over the text kernels: one thin wrapper each."""

from __future__ import annotations

import collections
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from ..schema import SENSE, SENTENCE
from . import alignment, glosses, identifiers, matching, offsets, sentences, translations, wikitext
from .edits import Marked, Span
from .formatting import is_damaged, is_literal, plain, statement
from .mathematics import latexize
from .references import clean_definition


def arrow(kind: str) -> Callable:
    """A Python function as a UDF that takes Arrow batches; null in, null out."""
    def wrap(fn: Callable) -> Callable:
        # Made when called: workers import this module too, and have no session.
        def call(*columns):
            return F.udf(fn, kind, useArrow=True)(*columns)

        return call

    return wrap


def nullable(fn: Callable) -> Callable:
    return lambda x, *more: None if x is None else fn(x, *more)


clean_gloss = arrow("string")(nullable(glosses.clean))
referred = arrow("string")(nullable(glosses.referred))
is_redirect = arrow("boolean")(nullable(lambda g: glosses.is_redirect(list(g))))
plain_text = arrow("string")(nullable(lambda t: plain(Marked(t)).text))
as_statement = arrow("string")(nullable(lambda t: statement(Marked(t)).text))
definition = arrow("string")(nullable(lambda t: clean_definition(Marked(t)).text))
damaged = arrow("boolean")(nullable(is_damaged))
literal = arrow("boolean")(nullable(is_literal))
tex = arrow("string")(nullable(latexize))
reference = arrow("string")(nullable(sentences.clean_reference))
heading = arrow("string")(nullable(translations.heading))
heading_key = arrow("string")(nullable(translations.key))
sense_id = arrow("string")(lambda lemma, pos, etymology, g: identifiers.sense_id(lemma, pos, etymology, list(g)))
table_id = arrow("string")(identifiers.table_id)
similarity = arrow("double")(lambda a, b: None if a is None or b is None else matching.similarity(a.casefold().split(), b.casefold().split()))
has_headword = arrow("boolean")(lambda text, word: None if text is None or word is None else offsets.contains_headword(text, word))
headword_shape = arrow("string")(nullable(offsets.headword_shape))
year_of = arrow("int")(nullable(sentences.year_of))
balanced = arrow("boolean")(nullable(lambda t: nested(t)))
kept_synonyms = arrow("array<string>")(lambda words, headword: synonyms(list(words), headword))
form_counts = arrow("map<string,int>")(lambda text, forms: dict(collections.Counter(text[a:b].casefold() for a, b in offsets.match_forms(text or "", list(forms)))))
valid_decisions = arrow("boolean")(lambda task, links, sources, targets: alignment.is_valid(task, {x["source_id"]: [{k: y[k] for k in ("target_id", "relation", "reason")} for y in x["links"]] for x in links}, list(sources), list(targets)))
similar_words = arrow("double")(lambda a, b: matching.similarity(list(a or ()), list(b or ())))
template_names = arrow("array<string>")(nullable(lambda t: [found.name for raw in wikitext.templates(t) if (found := wikitext.read_template(raw))]))


@arrow("struct<code:string,words:array<string>>")
def clean_translation(language: str | None, word: str | None):
    found = translations.clean(language or "", word or "")
    return None if found is None else {"code": found[0], "words": sorted(found[1])}


@arrow("array<struct<kind:string,pos:string,gloss:string,language:string,word:string>>")
def page_translations(title: str, markup: str):
    return [dict(zip(("kind", "pos", "gloss", "language", "word"), x, strict=True)) for x in wikitext.page_translations(title, markup)]


@arrow("array<struct<pos:string,etymology:string,depth:int,text:string,ids:array<string>>>")
def wikidata_definitions(markup: str):
    return [{"pos": p, "etymology": str(e) if e else "", "depth": d, "text": t, "ids": list(i)} for p, e, d, t, i in wikitext.wikidata_definitions(markup)]


@arrow("array<struct<rendered:string,source:string,prefix:string,suffix:string>>")
def page_formulas(markup: str):
    return [{"rendered": f.rendered, "source": f.source, "prefix": f.prefix, "suffix": f.suffix} for f in wikitext.formulas(markup)]


def arrow_type(kind: str) -> pa.DataType:
    """The Arrow type of a Spark type; called where there is a session."""
    return to_arrow_type(StructType.fromDDL(f"x {kind}")["x"].dataType)


def items(column: pa.Array) -> list:
    """A column as Python values; one of nulls alone costs nothing."""
    return [None] * len(column) if column.null_count == len(column) else column.to_pylist()


def builder(least: int | None, most: int | None):
    """The UDF that builds the senses of a raw entry. Examples are many, so they are read column by column."""
    made = f"array<{SENSE}>"
    kind = arrow_type(made)

    def build(lemma: pa.Array, pos: pa.Array, etymology: pa.Array, raw: pa.Array, formulas: pa.Array) -> pa.Array:
        senses, bounds = raw.values, raw.offsets.to_pylist()
        fields = {name: items(senses.field(name)) for name in ("glosses", "tags", "topics", "wikidata", "synonyms")}
        present = senses.is_valid().to_pylist()
        examples = senses.field("examples")
        lists, given = examples.offsets.to_pylist(), examples.values.is_valid().to_pylist()
        shown = {name: items(examples.values.field(name)) for name in ("text", "ref", "type", "bold_text_offsets")}
        rows = []
        for k, (word, tag, origin, replaced) in enumerate(zip(lemma.to_pylist(), pos.to_pylist(), etymology.to_pylist(), items(formulas), strict=True)):
            out = []
            known = [wikitext.Formula(f["rendered"], f["source"], f["prefix"], f["suffix"]) for f in replaced or ()]
            for i in range(bounds[k], bounds[k + 1]):
                if not present[i]:
                    continue
                tags = fields["tags"][i] or []
                chain = [wikitext.restore_formulas(g, known) if known else g for g in fields["glosses"][i] or () if g is not None]
                if {"form-of", "alt-of"} & set(tags) or not chain or glosses.is_redirect(chain):
                    continue
                cleaned = glosses.clean_chain(chain)
                if cleaned is None:
                    continue
                found = [s for e in range(lists[i], lists[i + 1]) if given[e] for s in sentences.parse({name: values[e] for name, values in shown.items()}, least, most)]
                out.append({
                    "id": identifiers.sense_id(word, tag, origin, cleaned), "glosses": cleaned, "etymology": origin or "",
                    "synonyms": synonyms([s["word"] for s in fields["synonyms"][i] or () if s is not None], word), "tags": tags, "topics": fields["topics"][i] or [],
                    "sentences": [sentence_row(s) for s in found], "wikidata_ids": fields["wikidata"][i] or [],
                })
            rows.append(out)
        return pa.array(rows, kind)

    return F.arrow_udf(build, made)


def sentence_row(s: sentences.Sentence) -> dict:
    return {"text": s.text, "word_offsets": [span_row(x) for x in s.spans], "reference": s.reference, "year": s.year}


def span_row(s: Span) -> dict:
    return {"start": s.start, "end": s.end, "sources": list(s.sources)}


def nested(word: str) -> bool:
    """Whether round and square brackets close in the order in which they open."""
    held = []
    for c in word:
        if c in "([":
            held.append(c)
        elif c in ")]" and (not held or held.pop() + c not in ("()", "[]")):
            return False
    return not held


def synonyms(words: list[str | None], headword: str) -> list[str]:
    """Distinct synonyms, without notes; those that are broken, unbalanced or the headword itself go."""
    import re

    out = []
    for word in words:
        word = re.sub(r"\s*[\[(](?:⇒\s*)?(?:thesaurus|slang)[\])]", "", word or "", flags=re.IGNORECASE).strip()
        if any(c.isalnum() for c in word) and word != headword and word[-1] not in ":,;" and not re.search(r"\{\{|\}\}|\[\[|\]\]", word) and nested(word):
            out.append(word)
    return list(dict.fromkeys(out))


RANGE = "struct<start:int,end:int,sources:array<string>>"


@arrow(f"struct<ranges:array<{RANGE}>,relation:string>")
def merged_ranges(spans: list):
    """Ranges by place with all their sources, and how the sources relate."""
    found = offsets.merge([Span(o["start"], o["end"], tuple(o["sources"])) for o in spans or ()])
    return {"ranges": [span_row(x) for x in found], "relation": offsets.relation(found)}


def locator(locate: Callable[[str, list[str]], list[tuple[int, int]]] = offsets.match_forms):
    """The UDF that finds the forms of an entry in the sentences of its senses; locate is the plug-in, by default a pattern.

    Only texts become Python values; all but the ranges is handed back as it came.
    """
    kind = arrow_type(f"array<{SENSE}>")

    def run(senses: pa.Array, forms: pa.Array) -> pa.Array:
        rows, lists = senses.offsets.to_pylist(), senses.values.field("sentences")
        bounds, values = lists.offsets.to_pylist(), lists.values
        texts, held = values.field("text"), values.field("word_offsets")
        bold = held.to_pylist() if len(held.values) else [None] * len(held)
        ranges: list[list[dict]] = [[]] * len(values)
        for k, own in enumerate(forms.to_pylist()):
            for i in range(bounds[rows[k]], bounds[rows[k + 1]]):
                places = [Span(a, b, ("lemmatizer",)) for a, b in locate(texts[i].as_py(), own)]
                if places or bold[i]:
                    ranges[i] = [span_row(x) for x in offsets.merge(places, [Span(o["start"], o["end"], tuple(o["sources"])) for o in bold[i] or ()])]
        inner = kind.value_type.field("sentences").type
        sentences_ = pa.ListArray.from_arrays(lists.offsets, replaced(values, inner.value_type, "word_offsets", ranges), type=inner)
        return pa.ListArray.from_arrays(senses.offsets, replaced(senses.values, kind.value_type, "sentences", sentences_), type=kind)

    return F.arrow_udf(run, f"array<{SENSE}>")


def replaced(rows: pa.StructArray, kind: pa.StructType, name: str, column: pa.Array | list) -> pa.StructArray:
    """Rows of a kind with one column anew."""
    new = column if isinstance(column, pa.Array) else pa.array(column, kind.field(name).type)
    return pa.StructArray.from_arrays([new if f.name == name else rows.field(f.name).cast(f.type) for f in kind], fields=list(kind))


CHECK = "struct<located:boolean,relation:string,violations:array<string>,shape:string,literal:boolean,offsets:int,surfaces:int>"


@arrow(CHECK)
def check_sentence(text: str, spans: list, headword: str):
    """Everything that the report counts about the ranges of a sentence."""
    own = [Span(o["start"], o["end"], tuple(o["sources"])) for o in spans or ()]
    return {
        "located": bool(own), "relation": offsets.relation(own), "violations": offsets.violations(text, own), "shape": offsets.headword_shape(headword),
        "literal": offsets.contains_headword(text, headword), "offsets": len(own),
        "surfaces": sum(text[s.start : s.end].casefold() != headword.casefold() for s in own),
    }


