"""The trie of conversations against a plain one."""

import hashlib
import random
import zlib

import duckdb
import pytest

from foliowright.llm import prefix_trie
from foliowright.llm.queries import ORACLE, QUERIES

COLUMNS = "conv_id long, turn long, role string, text string, depth string, node string"


def rebuild(rows):
    own = {}
    for c, *_ in rows:
        if c is not None:
            own[c] = [(role, text) for _, _, role, text in sorted((t is not None, t or 0, role or "", text or "") for k, t, role, text in rows if k == c)]
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = own.get(c - int(abs(c) % 100) * (1 if c >= 0 else -1), [])
        out[c] = base[:h] + turns[h:]
    return out


def plain(rows):
    convs, nodes = rebuild(rows), {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    kids = {p: [q for q in nodes if len(q) == len(p) + 1 and q[:-1] == p] for p in nodes}
    out = []
    for p, members in nodes.items():
        under = [q for q in nodes if q[: len(p)] == p]
        saved = sum((len(nodes[q]) - 1) * len(q[-1][1]) for q in under if q)
        ends = ",".join(str(c) for c in sorted(members) if len(convs[c]) == len(p))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(kids[p]), sum(not kids[q] for q in under), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows):
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], COLUMNS).repartition(3)
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(frame).collect()), key=str)


def random_rows(seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-150, 450), 60) + [0, 100, 200, 300]:
        for t in range(rng.randrange(0, 9)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "bb", "", None, "é😀"]) if t > 1 else "first"))
    # copies, repeated turns, null turns, a null conversation
    rows += [(c, t, "user", f"same {t}") for c in (500, 600, 700, 800) for t in range(7)]
    rows += [(900, 0, "user", "x")] * 3 + [(900, None, "user", "n"), (None, 0, "user", "lost"), (1000, None, None, None)]
    rows += [(1100, t, "user", "long" * 200) for t in range(9)] + [(1200, t, "user", "long" * 200) for t in range(8)]
    return rows


@pytest.mark.parametrize("seed", [1])
def test_trie_equals_plain(spark, seed):
    rows = random_rows(seed)
    assert got(spark, rows) == plain(rows)


def test_hot_groups_are_salted(spark, monkeypatch):
    rows = random_rows(3)
    monkeypatch.setattr(prefix_trie, "hot_keys", lambda counts, keys, n: [tuple(r) for r in counts.where(f"{n} > 1").select(*keys).collect()])
    monkeypatch.setattr(prefix_trie, "CHUNK", 1)
    assert got(spark, rows) == plain(rows)


def test_small_tables(spark):
    assert got(spark, []) == []
    assert got(spark, [(None, 0, "user", "x")]) == []
    for rows in ([(300, 1, "user", "x")], [(7, 0, "user", "x")], [(7, 0, "u", "x"), (8, 0, "u", "x")], [(1, 0, "u", "x"), (2, 5, None, None), (3, None, "u", "")]):
        assert got(spark, rows) == plain(rows)


def test_query_equals_sql(spark):
    name, sf = "op12_prefix_trie", "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    rows = QUERIES[name](spark, sf)
    want = con.sql(ORACLE[name])
    at = [want.columns.index(c) for c in rows.columns]
    assert sorted((tuple(r) for r in rows.collect()), key=str) == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=str)
