"""Every catalog query against its SQL on the smallest tables."""

import duckdb
import pyarrow.parquet as pq
import pytest

from lexloom.plans import catalog

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.register(name, pq.read_table(f"{FOLDER}/{name}.parquet"))
    return con


def normal(value):
    return round(value, 6) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_matches_sql(spark, duck, name):
    found = catalog.QUERIES[name](spark, FOLDER)
    wanted = duck.sql(catalog.SQL[name])
    columns = sorted(found.columns)
    assert columns == sorted(wanted.columns)
    rows = sorted(str([normal(r[c]) for c in columns]) for r in found.collect())
    at = [wanted.columns.index(c) for c in columns]
    assert rows == sorted(str([normal(r[k]) for k in at]) for r in wanted.fetchall())


def test_raw_entries_hold_whole_texts(spark):
    texts = {r["doc_id"]: r["text"] for r in pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()}
    rows = catalog.raw_entries(catalog.Tables(spark, FOLDER)).select("ord.place", "senses").collect()
    found = {r.place: (r.senses[0].glosses, [e.text for e in r.senses[0].examples]) for r in rows}
    assert found == {k: ([t], t.split("\n")) for k, t in texts.items()}


def test_entry_and_registry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.QUERIES) <= set(entry.queries())


def test_filter_reaches_the_scan(spark):
    plan = catalog.QUERIES["entries_language"](spark, FOLDER)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "EqualTo(lang,en)" in plan and "text" not in plan.split("ReadSchema")[1].split("\n")[0]
