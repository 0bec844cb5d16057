"""Text kernels: inline examples and properties."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexloom.functions import alignment, formatting, glosses, identifiers, matching, mathematics, offsets, references, sentences, translations, wikitext
from lexloom.functions.edits import Marked, Span, shift

settings.register_profile("quick", deadline=None, max_examples=150)
settings.load_profile("quick")


@pytest.mark.parametrize(
    ("written", "expected"),
    [
        ("a stone used in [[curling|the game]]", "A stone used in the game."),
        ("A bird (see also [[swift]]).", "A bird."),
        ("A kind of boat. Compare punt (vessel).", "A kind of boat."),
        ("A town (cf. Appendix:Towns), in ruins:", "A town, in ruins."),
        ("To visit a friend, see them and leave again.", "To visit a friend, see them and leave again."),
        ("A dye H<sub>2</sub>O.", "A dye H_{2}O."),
        ("A ring ℤ.", r"A ring \mathbb{Z}."),
        ("A page https://a.example/b", "A page."),
        ("See also: the other page", ""),
        ("…", ""),
        ("A {{broken|thing", None),
        ("An [[open link", None),
        ("1987, John Doe, Some Book", None),
        ("A \\nosuchcommand here", None),
        ("A file marked by the <b> tag in HTML", "A file marked by the <b> tag in HTML."),
    ],
)
def test_glosses(written, expected):
    assert glosses.clean(written) == expected


def test_gloss_chains_keep_damage_apart_from_emptiness():
    assert glosses.clean_chain(["a thing", "See other."]) == ["A thing."]
    assert glosses.clean_chain(["a thing", "{{damaged"]) is None
    assert glosses.clean_chain(["."]) is None


def test_prefixes_need_whole_words():
    assert glosses.is_form("Plural  of dog") and not glosses.is_form("plurality of things")
    assert glosses.is_variant("obsolete") and not glosses.is_variant("obsoletely made")
    assert glosses.referred("Alternative form of grey; a colour") == "grey"


@given(st.text(max_size=120))
def test_cleaning_is_idempotent(text):
    found = glosses.clean(text)
    if found:
        assert glosses.clean(found) in (found, None) or formatting.statement(Marked(found)).text == found


@given(st.text(max_size=80), st.lists(st.tuples(st.integers(0, 80), st.integers(0, 80)), max_size=4))
def test_ranges_stay_inside(text, places):
    spans = tuple(Span(min(a, b), max(a, b)) for a, b in places if a != b and max(a, b) <= len(text))
    found = formatting.plain(Marked(text, spans))
    assert all(0 <= s.start < s.end <= len(found.text) for s in found.spans)


def test_edits_move_ranges():
    value = Marked("the '''cat''' sat", (Span(7, 10), Span(4, 10), Span(14, 17)))
    found = value.sub(re.compile("'+"), "")
    assert found.text == "the cat sat" and [found.text[s.start : s.end] for s in found.spans] == ["cat", "cat", "sat"]
    assert Marked("abcd", (Span(1, 3),)).sub(re.compile("bcd"), "X").spans == ()
    assert shift([(2, 4, "")], 3) == 2 and shift([(2, 4, "x")], 3) is None


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ({"text": "The cat purrs.", "type": "example"}, ["The cat purrs."]),
        ({"text": "The cat purrs. https://a.example/x"}, ["The cat purrs."]),
        ({"text": "Usage note: none", "type": "example"}, []),
        ({"text": "12, 13", "type": "example"}, []),
        ({"text": "one cat;\u2003two cats.", "type": "example"}, ["one cat", "two cats."]),
        ({"text": "p.m. In HTML, <i>x</i> tags slant.", "type": "example"}, ["p.m. In HTML, <i>x</i> tags slant."]),
        ({"text": "A {{bad}} cat", "type": "example"}, []),
    ],
)
def test_sentences(raw, expected):
    assert [s.text for s in sentences.parse(raw)] == expected


def test_quotations_have_sources_and_years():
    (found,) = sentences.parse({"text": "1851, Herman Melville, Moby-Dick\nCall me Ishmael.", "bold_text_offsets": [[41, 48]]})
    assert (found.text, found.year) == ("Call me Ishmael.", 1851) and found.reference.startswith("1851")
    assert [found.text[s.start : s.end] for s in found.spans] == ["Ishmael"]
    assert sentences.parse({"text": "x y z", "ref": "undated book"}, least=1900) == []
    assert len(sentences.parse({"text": "x y z", "ref": "a book of 1950"}, least=1900, most=1950)) == 1


@pytest.mark.parametrize(
    ("language", "word", "expected"),
    [
        ("fr", "chat m", {"chat"}), ("de", "Katze f / Kater", {"Katze", "Kater"}), ("it", "gatto, gatta", {"gatto", "gatta"}), ("pl", "tak, że", {"tak, że"}),
        ("en", "colo[u]r", {"color", "colour"}), ("xx", "{{t|es|gato|m}}", {"gato"}), ("fr", "see chat", None), ("de", "See m", {"See"}), ("fr", "Thesaurus:chat", None), ("!", "x", None),
    ],
)
def test_translations(language, word, expected):
    found = translations.clean(language, word)
    assert (set(found[1]) if found else None) == expected


def test_headings():
    assert translations.heading("a small [[house]] (see other)") == "A small house."
    assert translations.heading("Translations to be checked") == ""
    assert translations.key("A  Small House.") == translations.key("a small house")
    assert translations.key("and so on..") == "and so on.."


def test_templates_are_balanced_and_the_last_argument_counts():
    text = "x {{a|{{b|1}}|k=v|k=w|2=z}} <!-- {{no}} --> <nowiki>{{no}}</nowiki> {{c}}"
    first, second = wikitext.templates(text)
    assert second == "{{c}}"
    found = wikitext.read_template(first)
    assert found.positional == ("{{b|1}}", "z") and found.named == {"k": "w"}


def test_pages():
    page = "==French==\n===Noun===\n{{trans-top|no}}{{t|de|x}}\n==English==\n===Verb===\n{{trans-top|to go}}\n{{t|fr|aller}}\n{{trans-bottom}}\n{{t|fr|lost}}\n===Pronunciation===\n{{trans-see|a|b}}"
    assert list(wikitext.page_translations("go", page)) == [("word", "verb", "to go", "fr", "aller")]
    ids = "==English==\n===Etymology 2===\n====Noun====\n# {{senseid|en|Q5|Q05}} a man<!-- {{senseid|en|Q7}} -->\n## {{senseid|fr|Q6}} no"
    assert list(wikitext.wikidata_definitions(ids)) == [("noun", 2, 1, "{{senseid|en|Q5|Q05}} a man<!-- {{senseid|en|Q7}} -->", ("Q5",))]


def test_matching():
    senses = [{"glosses": ["A large cat of Africa."], "ids": []}, {"glosses": ["A famous person."], "ids": []}, {"glosses": ["A large cat of Africa.", "A male one."], "ids": ["Q9"]}]
    assert matching.best("a [[large]] [[cat]] of Africa", 1, ["Q1"], senses) == (0, 1)
    assert matching.best("{{non-gloss|a large cat of Africa}}", 1, ["Q1"], senses) is None
    assert matching.best("something else entirely", 1, ["Q1"], senses) is None
    assert matching.best("x", 2, ["Q9"], senses) == (2, 2)


def test_offsets():
    assert offsets.match_forms("A cat, cats and concat; CAT", ["cat", "cats"]) == [(2, 5), (7, 11), (24, 27)]
    spans = offsets.merge([Span(2, 5, ("lemmatizer",))], [Span(2, 5, ("bold",)), Span(0, 9, ("bold",))])
    assert [(s.start, s.end, s.sources) for s in spans] == [(0, 9, ("bold",)), (2, 5, ("lemmatizer", "bold"))]
    assert offsets.relation(spans) == "Partial agreement"
    assert offsets.violations("concat", [Span(3, 6, ("bold",)), Span(4, 9, ("bold",))]) == ["Inside a longer word (bold)", "Out of range (bold)"]
    assert offsets.contains_headword("Un CAFÉ noir", "cafe") and not offsets.contains_headword("cafeteria", "cafe")


def test_identifiers():
    assert identifiers.lemma_id("hot dog", "noun") == "hot_dog.noun"
    assert re.fullmatch(r"a\.noun\.[0-9a-f]{8}", identifiers.sense_id("a", "noun", "1", ["g"]))
    assert identifiers.sense_id("a", "noun", None, ["g"]) == identifiers.sense_id("a", "noun", "", ["g"])
    assert identifiers.query_id("synsets", "a.noun", "wn") == "synsets:wn:a.noun"


def test_mathematics():
    assert mathematics.latexize("x² ≤ 𝔸") == r"x^{2} \leq \mathbb{A}"
    assert mathematics.latexize("plain − text") == "plain − text"


def test_responses():
    good = '{"s1": [{"target_id": "t1", "relation": "equivalent", "reason": "r"}], "s2": null}'
    made = alignment.parse_response(good, ["s1", "s2"])
    alignment.validate("synsets", made, ["s1", "s2"], ["t1"])
    for bad in ("[]", "{", '{"s1": null}', '{"s1": [], "s2": null}', '{"s1": null, "s1": null, "s2": null}', '{"s1": [{"target_id": "t1"}], "s2": null}'):
        with pytest.raises(alignment.InvalidResult):
            alignment.parse_response(bad, ["s1", "s2"])
    link = {"target_id": "t1", "relation": "equivalent", "reason": "r"}
    for wrong in ({"s1": [link], "s2": [link]}, {"s1": [link, link], "s2": []}, {"s1": [{**link, "target_id": "t9"}], "s2": []}, {"s1": [{**link, "reason": " "}], "s2": []}):
        with pytest.raises(alignment.InvalidResult):
            alignment.validate("synsets", wrong, ["s1", "s2"], ["t1"])
    narrower = {**link, "relation": "wiktionary_narrower"}
    alignment.validate("synsets", {"s1": [narrower], "s2": [narrower]}, ["s1", "s2"], ["t1"])
    kept, sources, targets = alignment.remaining("translations", {"s1": [{**link, "relation": "translation"}]}, [{"id": "s1"}, {"id": "s2"}], [{"id": "t1"}, {"id": "t2"}])
    assert list(kept) == ["s1"] and sources == [{"id": "s2"}] and targets == [{"id": "t2"}]
    assert alignment.remaining("translations", {"s9": []}, [{"id": "s1"}], [])[0] == {}
    with pytest.raises(ValueError):
        alignment.select_stages(["remaining", "a"], ["a"])


@pytest.mark.parametrize(
    ("written", "expected"),
    [
        ("A tool (large; see Usage notes).", "A tool (large)."), ("See shut, for: Closed by force.", "Closed by force."), ("See. vide(te)", "See. vide(te)."),
        ("A bird (but see also its kin), small.", "A bird, small."), ("A rule (for more on this, see the table).", "A rule."), ("A cloth cf. felt.", "A cloth."),
        ("Real Town CF.", "Real Town CF."), ("A bishop's see: a title.", "A bishop's see: a title."), ("A sense (see, hear, feel).", "A sense (see, hear, feel)."),
        ("A plant (see Moss Day (Town), etc.", "A plant."), ("A word https://a.example/b, https://c.example/d.", "A word."), ("A fly. Compare gnat (bug (small)) and midge.", "A fly."),
        ("To see ahead; see clearly; know.", "To see ahead; see clearly; know."), ("For other uses, see the list.", ""), ("A page (https://a.example/b) here.", "A page here."),
    ],
)
def test_pointers_go_and_meanings_stay(written, expected):
    assert glosses.clean(written) == expected


@pytest.mark.parametrize(
    ("text", "navigation", "metadata", "dated"),
    [
        ("See also quotes under x", True, False, False), ("See you at five.", False, False, False), (". Compare rain.", True, False, False), ("For examples, see Citations:x", True, False, False),
        ("Near-synonyms: a, b", False, True, False), ("Usage note: x", False, True, False), ("Synonymy: x", False, False, False),
        ("1987, Jane Roe, Title", False, False, True), ("c. 1605-06: A Play", False, False, True), ("2013 May 4, A Paper", False, False, True), ("1987 was a year, Jane said", False, False, False), ("987, Jane", False, False, False),
    ],
)
def test_kinds_of_lines(text, navigation, metadata, dated):
    assert (references.is_navigation(text), references.is_metadata(text), references.is_dated(text)) == (navigation, metadata, dated)


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("[[a#b]] [[c|d]] [[[e]]]", "a d [e]"), ("x<sup>2</sup><sub>n</sub>", "x^{2}_{n}"), ("a<br/>b", "a\nb"), ("<b>a</b> <u>b</u>", "a <u>b</u>"), ("&amp;lt; #x41;", "< A"), ("a^([sic]) b", "a b"),
        ("'''''a''''' isn't", "a isn't"), ("a<ref name=x>y</ref>b<ref name=z/>", "ab"), ("a​b­c", "abc"), ("[[a]", "[[a]"),
    ],
)
def test_markup(text, expected):
    assert formatting.plain(Marked(text)).text == expected


def test_models_are_prompted_and_fail_alone(monkeypatch):
    import json
    import sys
    import types

    from lexloom.functions import inference

    seen = []

    def backend(requests, temperature=None):
        seen.append((len(requests), temperature))
        if any("bad" in r["prompt"] for r in requests):
            raise RuntimeError("cannot")
        return [json.dumps({s: None for s in r["schema"]["required"]}) for r in requests]

    module = types.ModuleType("backends")
    module.backend = backend
    monkeypatch.setitem(sys.modules, "backends", module)
    model = inference.load("backends:backend", {"system": "s", "tasks": {"translations": "$lemma: $sources"}}, "leaf", {"temperature": 0.5})
    query = lambda lemma: {"task": "translations", "lemma": lemma, "pos": "noun", "sources": [{"id": "a", "glosses": ["x", "y"]}], "targets": [{"id": "t", "glosses": ["z"]}]}
    assert inference.answer(model, [query("good"), query("bad"), query("fine")]) == ['{"a": null}', None, '{"a": null}']
    assert seen == [(3, 0.5), (1, 0.5), (1, 0.5), (1, 0.5)] and inference.answer(model, []) == []
    assert model.request(query("good"))["prompt"] == 'good: {"id": "a", "gloss": "y"}'
    assert inference.decide_one(query("good"), "translations", model) == {"a": []}
    with pytest.raises(RuntimeError):
        inference.decide_one(query("bad"), "translations", model)
    for name in ("nothing", "no.such.module:f", "json:nothing"):
        with pytest.raises((ValueError, ImportError, AttributeError)):
            inference.load(name)


def test_query_records():
    from lexloom.sources import records

    found = records.parse_query('{"task": "synsets", "lemma": "dog", "pos": "noun", "sources": [{"id": "a", "glosses": ["x"]}], "targets": [{"id": "b"}]}')
    assert found["alignment_id"] == "synsets:dog.noun" and found["targets"] == [{"id": "b", "glosses": [], "synonyms": [], "tags": [], "topics": [], "examples": [], "sources": []}]
    for line in ("[]", "{}", '{"task": "synsets", "lemma": "dog", "pos": "noun", "sources": [{"id": "a"}, {"id": "a"}], "targets": []}'):
        with pytest.raises(ValueError):
            records.parse_query(line)


def test_similarity_needs_words_and_is_bounded():
    assert matching.similarity(["dog"], ["a", "dog"]) == pytest.approx(2 / 3)
    assert matching.similarity(["a", "dog"], ["a", "dog", "that", "barks"]) == pytest.approx(0.8)
    assert matching.similarity([], ["a"]) == 0.0
