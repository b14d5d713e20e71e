"""Exact top-k by Hamming distance of binary codes, by incremental multi-index hashing.

A vector's code is the signs of its coordinates. Codes are cut into m segments; each
segment indexes the codes by its value. A query looks up its own segment values, then
all values at one flipped bit, at two, and so on. After radius r every code closer than
m * (r + 1) has been seen in some segment, so the search stops once the kth verified
distance is less than that; codes that are new at a radius are verified at once.

The stated queries meet all codes in blocks: a task indexes one block of codes and
searches one block of queries, both of bounded size, and the blocks' best k are merged.
Equal codes are one entry with their k + 1 least ids, which is all that a result can
show; so copies of a vector, however many, cost one entry.

Neighbours are ordered by distance, then id; a row is not its own neighbour. Null and
empty vectors are left out, rows with a null id too; repeated rows count once; codes of
other lengths are padded by zero bits; extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliowright.llm.common import checkpointed, lean

K, CODES, QUERIES = 10, 1 << 14, 1 << 9


def codes(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, code) with the sign bits of each vector as bytes."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out = [np.packbits(np.array(v, np.float32) > 0).tobytes() for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(out, pa.binary())], ["id", "code"])

    rows = vectors.where(F.col(key).isNotNull() & (F.size(vector) > 0)).select(key, vector)
    return rows.mapInArrow(lean(run), "id long, code binary")


class Index:
    """Multi-index hashing over one block of distinct codes."""

    def __init__(self, data: np.ndarray):
        """data: (code, bit) zeros and ones."""
        self.n, self.bits = data.shape
        width = max(4, min(16, int(np.log2(max(self.n, 2)))))
        self.m = max(1, -(-self.bits // width))
        self.cuts = np.linspace(0, self.bits, self.m + 1).astype(int)
        self.words = self.pack(data)
        self.tables = []
        for a, b in zip(self.cuts, self.cuts[1:]):
            value = self.value(data, a, b)
            order = np.argsort(value, kind="stable")
            self.tables.append((order, np.searchsorted(value[order], np.arange((1 << (b - a)) + 1))))
        self.flips: dict = {}

    @staticmethod
    def value(data: np.ndarray, a: int, b: int) -> np.ndarray:
        return data[:, a:b].astype(np.int64) @ (1 << np.arange(b - a))

    @staticmethod
    def pack(data: np.ndarray) -> np.ndarray:
        wide = np.zeros((len(data), -(-data.shape[1] // 64) * 64), np.uint8)
        wide[:, : data.shape[1]] = data
        return np.packbits(wide, axis=1).view(np.uint64)

    def at_radius(self, width: int, r: int) -> np.ndarray:
        if (width, r) not in self.flips:
            self.flips[width, r] = np.array([sum(1 << b for b in bits) for bits in combinations(range(width), r)], np.int64)
        return self.flips[width, r]

    def search(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Codes and distances such that every code not further than the kth is among them."""
        words = self.pack(query[None, :])[0]
        seen = np.zeros(self.n, bool)
        found, distance = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for r in range(int(np.diff(self.cuts).max()) + 1):
            for (a, b), (order, start) in zip(zip(self.cuts, self.cuts[1:]), self.tables):
                values = int(self.value(query[None, :], a, b)[0]) ^ self.at_radius(int(b - a), r)
                lo, n = start[values], start[values + 1] - start[values]
                got = order[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
                got = got[~seen[got]]
                seen[got] = True
                found = np.append(found, got)
                distance = np.append(distance, np.bitwise_count(self.words[got] ^ words).sum(axis=1))
            # all codes closer than m * (r + 1) are found
            if len(found) >= k and np.partition(distance, k - 1)[k - 1] < self.m * (r + 1):
                break
        if len(found) > k:
            near = distance <= np.partition(distance, k - 1)[k - 1]
            return found[near], distance[near]
        return found, distance


def top_k(vectors: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding", k: int = K, block_codes: int = CODES, block_queries: int = QUERIES) -> DataFrame:
    """(query_id, rank, neighbor_id, distance): the k nearest rows of each row that queries selects."""
    rows = codes(vectors, key, vector).distinct()
    nth = F.row_number().over(W.partitionBy("code").orderBy("id"))
    few = checkpointed(rows.withColumn("nth", nth).where(F.col("nth") <= k + 1).select("id", "code"))
    asked = checkpointed(codes(vectors.where(queries), key, vector).distinct().select("id", "code"))
    distinct = few.select("code").distinct()
    p, q = -(-max(distinct.count(), 1) // block_codes), -(-max(asked.count(), 1) // block_queries)
    # a code's ids share its block
    left = few.select("id", "code", F.pmod(F.xxhash64("code"), F.lit(p).cast("long")).alias("p"))
    left = left.select("id", "code", "p", F.explode(F.sequence(F.lit(0), F.lit(q - 1))).alias("q"))
    right = asked.select("id", "code", F.pmod(F.xxhash64("id"), F.lit(q).cast("long")).cast("int").alias("q"))
    right = right.select("id", "code", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(p - 1).cast("long"))).alias("p"), "q")

    def search(index_rows, query_rows):
        import pandas as pd

        out = ([], [], [])
        if len(index_rows) and len(query_rows):
            both = [*index_rows["code"], *query_rows["code"]]
            size = max(map(len, both))
            bits = lambda xs: np.unpackbits(np.frombuffer(b"".join(x.ljust(size, b"\0") for x in xs), np.uint8).reshape(-1, size), axis=1)
            own = index_rows.sort_values("id").groupby("code", sort=True)["id"].apply(list)
            index = Index(bits(own.index))
            ids = own.tolist()
            for qid, query in zip(query_rows["id"], bits(query_rows["code"])):
                at, distance = index.search(query, k + 1)
                best = sorted((d, i) for a, d in zip(at.tolist(), distance.tolist()) for i in ids[a] if i != qid)[:k]
                for d, i in best:
                    out[0].append(qid)
                    out[1].append(i)
                    out[2].append(d)
        return pd.DataFrame({"query_id": pd.Series(out[0], dtype="int64"), "neighbor_id": pd.Series(out[1], dtype="int64"), "distance": pd.Series(out[2], dtype="int64")})

    found = left.groupBy("p", "q").cogroup(right.groupBy("p", "q")).applyInPandas(search, "query_id long, neighbor_id long, distance long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("distance", "neighbor_id"))
    return found.withColumn("rank", rank.cast("long")).where(F.col("rank") <= k).select("query_id", "rank", "neighbor_id", "distance")


#: op7's result in DuckDB SQL.
SQL = """
WITH rows AS (
  SELECT DISTINCT vec_id AS id, list_transform(embedding, lambda x: x > 0) AS code FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
), pairs AS (
  SELECT q.id AS query_id, r.id AS neighbor_id,
    list_sum(list_transform(range(1, len(q.code) + 1), lambda i: (q.code[i] <> r.code[i])::BIGINT))::BIGINT AS distance
  FROM rows q JOIN rows r ON q.id <> r.id WHERE q.id % 20 = 0
)
SELECT query_id, rank, neighbor_id, distance
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank FROM pairs) WHERE rank <= 10
"""
