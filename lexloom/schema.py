"""Schemas of raw entries, collected lemmas, side tables and alignment records."""

from __future__ import annotations

RAW_ENTRY = """
word string, pos string, lang_code string, etymology_number string,
forms array<struct<form string, tags array<string>>>,
translations array<struct<word string, lang_code string, lang string, sense string>>,
senses array<struct<glosses array<string>, tags array<string>, topics array<string>, wikidata array<string>,
  examples array<struct<text string, ref string, type string, bold_text_offsets array<array<int>>>>,
  alt_of array<struct<word string>>, synonyms array<struct<word string>>>>
"""
SPAN = "struct<start:int,end:int,sources:array<string>>"
SENTENCE = f"struct<text:string,word_offsets:array<{SPAN}>,reference:string,year:int>"
SENSE = (
    "struct<id:string,glosses:array<string>,etymology:string,synonyms:array<string>,tags:array<string>,topics:array<string>,"
    f"sentences:array<{SENTENCE}>,wikidata_ids:array<string>>"
)
TRANSLATION = "struct<language:struct<code:string,label:string>,words:array<string>>"
TABLE = f"struct<id:string,gloss:string,translations:array<{TRANSLATION}>>"
LEMMA = f"id string, lemma string, pos string, variants array<string>, senses array<{SENSE}>, translation_tables array<{TABLE}>"
PAGE = "title string, ns int, revision struct<text:string>"
SYNSET = "id string, pos string, sources map<string, struct<members:array<string>,glosses:array<string>,examples:array<string>>>"
DECISION = "alignment_id string, source_id string, target_id string, relation string, reason string"
