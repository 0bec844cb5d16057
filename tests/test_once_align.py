"""The alignment reads each target once and bounds what a worker holds."""

import json

from lexloom.functions import alignment
from lexloom.plans import align


class Counted(dict):
    reads = 0

    def __getitem__(self, key):
        Counted.reads += key == "glosses"
        return super().__getitem__(key)


def test_stub_reads_each_target_once():
    sources = [{"id": f"s{k}", "glosses": [f"word{k}"]} for k in range(20)]
    targets = [Counted(id=f"t{k}", glosses=[f"word{k + 1}"]) for k in range(10)]
    (answer,) = alignment.stub_model([{"task": "translations", "sources": sources, "targets": targets}])
    linked = {k: v and v[0]["target_id"] for k, v in json.loads(answer).items()}
    assert linked == {f"s{k}": f"t{k - 1}" if 0 < k < 11 else None for k in range(20)}
    assert Counted.reads == len(targets)


def test_workers_hold_few_characters(spark, monkeypatch):
    def sizes(requests):
        return [json.dumps({s["id"]: [{"target_id": r["targets"][0]["id"], "relation": "translation", "reason": str(len(requests))}] for s in r["sources"]}) for r in requests]

    monkeypatch.setattr(align, "HELD_CHARS", 10)
    sense = lambda k, text: {"id": k, "glosses": [text], "synonyms": [], "tags": [], "topics": [], "examples": [text], "sources": []}
    rows = [(f"q{k}", "l", "l", "noun", [sense(f"s{k}", "x" * 9)], [sense(f"t{k}", "y")]) for k in range(6)]
    queries = spark.createDataFrame(rows, align.QUERY).coalesce(1)
    found = align.decide(queries, spark.createDataFrame([], align.DECISION), "translations", sizes).collect()
    assert len(found) == 6 and {r.reason for r in found} == {"1"}
