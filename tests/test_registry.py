"""Every registered query against its SQL, and the entry file without its optional part."""

import sys

import duckdb
import pytest

from foliowright.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_sql(spark, db, name):
    got = registry.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = db.sql(registry.ORACLE[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert sorted(str(tuple(r[c] for c in columns)) for r in got.collect()) == sorted(str(tuple(r[i] for i in at)) for r in want.fetchall())


def test_hybrid_pages_follow_their_lookup(spark):
    import re

    from foliowright.operators import correct

    c = registry.Corpus(spark, SF)
    lookup = {r.word: r.replacement for r in correct.hybrid_replacements(c.hybrid).collect()}
    given = {r.doc_id: r.text or "" for r in c.docs.collect()}
    for r in registry.QUERIES["hybrid_corrected_pages"](spark, SF).collect():
        want, n = re.subn(r"\b[A-Za-z](?:[A-Za-z\-\']*[A-Za-z])?\b", lambda m: lookup.get(m.group(), m.group()), given[r["index"]])
        assert r.markdown == want


def test_entry_without_optional_part(monkeypatch):
    for name in [m for m in sys.modules if m == "__spark_entry__" or m.startswith("foliowright.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "foliowright.llm", None)
    import __spark_entry__

    assert set(__spark_entry__.queries()) == set(registry.QUERIES)
    monkeypatch.delitem(sys.modules, "__spark_entry__")
