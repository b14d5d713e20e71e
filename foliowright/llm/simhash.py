"""SimHash near-duplicates: fingerprints, exact links within a Hamming radius, components.

Fingerprints are cut into 32 segments of two bits. A fingerprint's embedding is the
vector of its segments' bit counts; the Manhattan distance of two embeddings never
exceeds the Hamming distance of the fingerprints. The embedding's coordinates are dealt
to groups and the grid's cells are the coordinates of a choice of groups. A change of r
bits leaves at least (groups - r) groups of coordinates as they are, so every pair
within the radius meets in one of the cells; the fewest choices that guarantee it are
used, and with more fingerprints a finer grid. In a cell, pairs within the radius by
Manhattan distance are verified by Hamming distance.

Equal fingerprints are one vertex. A cell yields a spanning forest of its links, at most
one edge per fingerprint. Cells of more than CELL fingerprints take another exact way:
two words within 2r bits have a common point within r bits of both, and words that share
such a point are within 2r bits of each other; so each fingerprint is emitted with its
neighbourhood of r bits and linked to the least one at each point, in proportion to the
cell's size and not to its square.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliowright.llm.common import apart, checkpointed, lean, slices, text_bytes
from foliowright.llm.components import components

RADIUS = 4
CELL = 4096
_UPPER = bytes(range(0x41, 0x5B))
_LOWER = bytes(range(0x61, 0x7B))


def fingerprint(text: bytes, size: int = 4) -> int:
    """SimHash of a UTF-8 text's word shingles; without words it is zero."""
    import xxhash

    words = text.translate(bytes.maketrans(_UPPER, _LOWER)).split()
    if not words:
        return 0
    if len(words) <= size:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    line = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    first = np.r_[0, ends[:-size] + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], 42) for a, b in zip(first, ends[size - 1 :].tolist())], np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[i : i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, key: str = "doc_id", size: int = 4) -> DataFrame:
    """(key, fp): the fingerprint as a signed long. A null text has no words."""

    def run(batches):
        import pyarrow as pa

        for batch in slices(batches):
            fps = [fingerprint(t, size) for t in text_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], ["k", "fp"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("k"), "text").mapInArrow(lean(run), f"k {kind}, fp long").select(F.col("k").alias(key), "fp")


def grid(n: int, radius: int = RADIUS) -> tuple[int, int]:
    """(groups, groups of a cell) for n fingerprints: finer cells for more of them."""
    return (radius + 2, 2) if n < 1 << 24 else (radius + 3, 3) if n < 1 << 29 else (radius + 4, 4)


def embedding(fp: Column) -> Column:
    """Bit counts of the 32 two-bit segments, two bits each, in one long."""
    odd = fp.bitwiseAND(F.lit(0x5555555555555555))
    even = F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(0x5555555555555555))
    # a sum of two bits has at most the value 2, so nothing carries to the next segment
    return odd.bitwiseXOR(even).bitwiseOR(F.shiftleft(odd.bitwiseAND(even), 1))


def cells(fps: DataFrame, groups: int, chosen: int) -> DataFrame:
    """(cell, part, fp): every fingerprint in each of its cells."""
    edges = [round(i * 32 / groups) * 2 for i in range(groups + 1)]
    masks = [sum(1 << b for b in range(a, z)) for a, z in zip(edges, edges[1:])]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    picks = [signed(sum(masks[g] for g in pick)) for pick in combinations(range(groups), chosen)]
    keys = F.array(*[F.struct(F.lit(i).alias("table"), F.col("e").bitwiseAND(F.lit(m)).alias("cell")) for i, m in enumerate(picks)])
    return fps.select("fp", embedding(F.col("fp")).alias("e")).select("fp", F.inline(keys)).select("table", "cell", "fp")


def _forest(fp: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links among fingerprints of one cell."""
    root = np.arange(len(fp))
    emb = _embed(fp)
    out = []
    for i in range(len(fp) - 1):
        rest = np.flatnonzero(root[i + 1 :] != root[i]) + i + 1
        if not rest.size:
            continue
        # Manhattan distance of embeddings as a lower bound, then the Hamming distance
        near = rest[_manhattan(emb[i], emb[rest]) <= radius]
        near = near[np.bitwise_count(fp[near] ^ fp[i]) <= radius]
        for j in near.tolist():
            if root[j] != root[i]:
                out.append((i, j))
                root[root == root[j]] = root[i]
    return out


_LOW = np.uint64(0x5555555555555555)


def _embed(fp: np.ndarray) -> np.ndarray:
    odd, even = fp & _LOW, (fp >> np.uint64(1)) & _LOW
    return (odd ^ even) | ((odd & even) << np.uint64(1))


def _manhattan(a: np.uint64, b: np.ndarray) -> np.ndarray:
    """Sum of |difference| of two-bit counts 0 to 2: 0 and 2 differ by 2, unequal others by 1."""
    x = a ^ b
    high, low = (x >> np.uint64(1)) & _LOW, x & _LOW
    two = high & ~low & _LOW
    return np.bitwise_count(high | low).astype(np.int64) + np.bitwise_count(two)


def links(fps: DataFrame, radius: int = RADIUS, cell_limit: int = CELL) -> DataFrame:
    """(a, b): edges between distinct fingerprints whose components are those of all links."""
    fps = checkpointed(fps.select("fp").distinct())
    groups, chosen = grid(fps.count(), radius)
    dealt = cells(fps, groups, chosen)
    sizes = dealt.groupBy("table", "cell").agg(F.count("*").alias("n")).where("n > 1")
    sizes = checkpointed(sizes)
    inside = sizes.where(F.col("n") <= cell_limit).select("table", "cell")
    members = dealt.join(inside, ["table", "cell"], "left_semi").groupBy("table", "cell").agg(F.collect_list("fp").alias("fps"))

    def forests(batches):
        import pyarrow as pa

        for batch in batches:
            a, b = [], []
            for members in batch.column(0).to_pylist():
                fp = np.sort(np.array(members, np.int64)).view(np.uint64)
                if len(fp) == 2:
                    if int(fp[0] ^ fp[1]).bit_count() <= radius:
                        a.append(members[0])
                        b.append(members[1])
                    continue
                signed = fp.view(np.int64)
                for i, j in _forest(fp, radius):
                    a.append(int(signed[i]))
                    b.append(int(signed[j]))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    edges = members.select("fps").mapInArrow(lean(forests), "a long, b long")
    crowded = sizes.where(F.col("n") > cell_limit).select("table", "cell")
    if crowded.limit(1).count():
        dense = dealt.join(crowded, ["table", "cell"], "left_semi").select("fp").distinct()
        edges = edges.unionByName(_by_midpoint(dense, radius))
    return checkpointed(edges.distinct())


def _by_midpoint(fps: DataFrame, radius: int) -> DataFrame:
    """Every fingerprint linked to the least one at each point within radius / 2 bits of it."""
    half, odd = divmod(radius, 2)
    if odd:
        raise ValueError("crowded cells need an even radius")
    flips = [0, *(sum(1 << b for b in bits) for n in range(1, half + 1) for bits in combinations(range(64), n))]
    signed = [x - (1 << 64) if x >> 63 else x for x in flips]
    points = fps.select("fp", F.explode(F.lit(signed)).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
    least = points.groupBy("point").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where("a < z").select("point", "a")
    return points.join(least, "point").where("fp <> a").select("a", F.col("fp").alias("b"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", size: int = 4, radius: int = RADIUS, cell_limit: int = CELL) -> DataFrame:
    """(key, fingerprint, component_id), a row for each document.

    component_id is the least key reachable over links; null keys don't name a component,
    so that one of null keys only has a null id. Repeated rows are each returned.
    """
    rows = checkpointed(fingerprints(docs, key, size))
    of = components(links(rows, radius, cell_limit))
    named = rows.groupBy("fp").agg(F.min(key).alias("least"))
    named = named.join(of, named.fp == of.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    named = checkpointed(named)
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component").select("fp", "component_id")
    out = rows.join(named, "fp")
    return out.select(key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", find=near_duplicates, **how) -> DataFrame:
    """Documents without all but one of each component that find names: that of the least key, then of the least hash of the text.

    Rows that share a key are told apart by their texts; rows alike in both are one
    document. Those without a key stay, and no other goes for their sake.
    """
    from pyspark.sql import Window as W

    rows, names = apart(docs, key, "text")
    rows = rows.withColumn("_h1", F.xxhash64("text")).withColumn("_h2", F.xxhash64(F.lit(1), "text"))
    who = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), F.col("_h1").alias("h1"), F.col("_h2").alias("h2"))
    found = find(rows.select(who.alias("who"), "text"), "who", **how).where(~F.col("who.none"))
    # a row for each document that goes or has rows alike; only these few columns are dealt out, and no texts
    told = found.groupBy("who").agg(F.first("component_id").alias("to"), F.count("*").alias("n")).where("n > 1 OR who <> to")
    told = checkpointed(told.select("who.id", "who.h1", "who.h2", (F.col("who") != F.col("to")).alias("goes")))
    same = (F.col(key) == F.col("id")) & (F.col("_h1") == F.col("h1")) & (F.col("_h2") == F.col("h2"))
    single = rows.join(told, same, "left_anti")
    alike = rows.join(told.where("NOT goes"), same, "left_semi")
    order = [f.name for f in rows.schema if f.name != "text" and f.dataType.typeName() in ("string", "long", "integer", "double", "boolean")]
    first = alike.withColumn("_nth", F.row_number().over(W.partitionBy(key, "_h1", "_h2").orderBy(*order))).where("_nth = 1")
    columns = [c for c in rows.columns if c not in ("_h1", "_h2")]
    return single.select(*columns).unionByName(first.select(*columns)).toDF(*names)


__all__ = ["cells", "fingerprint", "fingerprints", "keep_one", "links", "near_duplicates"]
