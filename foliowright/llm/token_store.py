"""Token ids in shards with a minimal perfect hash index for keyed access.

A shard is one row of a Parquet table (so any store that Spark reaches can hold it)
with three binary members:

* payload: the ids of its documents, one after the other, each closed by the end id,
  as little-endian uint16 (vocabularies up to 65,536 ids) or uint32;
* slots: one (fingerprint u32, first id u64, number of ids u32) per document, in the
  order of the hash's values;
* levels: the bit arrays of the minimal perfect hash, with the number of bits set before
  each block of BLOCK bits.

The hash is a cascade of bit arrays. At each level a key sets the bit at its hash; bits
claimed by several keys stay clear and their keys go to the next level. A key's value is
the number of bits set before its own, so n keys take the values 0 to n - 1. One probe a
level (two levels on average), one stored count and the bits of one block give the value,
and one slot the place, whatever the number of documents in the shard. The stored
fingerprint tells keys that were never added.

Shards are of a bounded size and ascend by key, with the first and last key of each in
columns of its own; a keyed read names its key in a filter on them, so that the reader
skips the files and row groups of all other shards by their statistics. A shard is read
whole, since a Parquet cell can't be read in part: access is constant in the number of
documents, and reads one shard's bytes.

Rows: repeated keys are told apart by their occurrence (0, 1, ... in key order, then text
order), and a repeated key may span shards; a null key is a key of its own and sorts first;
a null text is empty and has just the end id; a very long one is one document of a shard.
Keys are exchanged by range together with the start of the text, so that rows of one
repeated or null key are dealt to several tasks. An empty table gives an empty store. Extra columns
are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliowright.llm.common import lean, new_path, remove_path, slices, worker_state
from foliowright.llm.wordscan import mix

SLOT = np.dtype([("print", "<u4"), ("first", "<u8"), ("n", "<u4")])
NULL_KEY = 0x6E756C6C00000000
SHARD = "part int, seq int, start long, n_ids long, n_keys int, nulls int, lo long, hi long, width int, key binary, payload binary, slots binary, levels binary"
#: bits between two stored counts
BLOCK = 512
#: pieces of text whose ids an encoder keeps, about 140 bytes each
PIECES = 300_000


def key_words(keys: np.ndarray, occurrence: np.ndarray) -> np.ndarray:
    """64-bit words of (key, occurrence)."""
    return mix(keys.astype(np.int64).view(np.uint64) + np.uint64(1)) ^ mix(occurrence.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _probe(words: np.ndarray, level: int, size: int) -> np.ndarray:
    return mix(words + np.uint64((level + 1) * 0xC2B2AE3D27D4EB4F & (1 << 64) - 1)) % np.uint64(size)


def fingerprints(words: np.ndarray) -> np.ndarray:
    return (mix(words ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)).astype(np.uint32)


def build_levels(words: np.ndarray, gamma: float = 2.0) -> bytes:
    """Bit arrays of a minimal perfect hash over distinct words, each behind its size and the counts of set bits before its blocks."""
    out, left, level, before = [], np.unique(words), 0, 0
    if len(left) != len(words):
        raise ValueError("keys of an index must be distinct")
    while len(left):
        size = -(-max(8, int(gamma * len(left))) // BLOCK) * BLOCK
        at = _probe(left, level, size).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        each = alone.reshape(-1, BLOCK).sum(axis=1)
        ranks = before + np.cumsum(each) - each
        out.append(struct.pack("<I", size) + ranks.astype("<u4").tobytes() + np.packbits(alone, bitorder="little").tobytes())
        left, level, before = left[~alone[at]], level + 1, before + int(each.sum())
    return b"".join(out)


def read_levels(data: bytes) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Each level's size, counts before its blocks and bits as bytes; nothing is unpacked."""
    out, at = [], 0
    while at < len(data):
        (size,) = struct.unpack_from("<I", data, at)
        blocks = size // BLOCK
        out.append((size, np.frombuffer(data, "<u4", blocks, at + 4), np.frombuffer(data, np.uint8, size // 8, at + 4 + 4 * blocks)))
        at += 4 + 4 * blocks + size // 8
    return out


def slot_of(words: np.ndarray, levels: list[tuple[int, np.ndarray, np.ndarray]]) -> np.ndarray:
    """The hash's values; -1 where no level has the word. One block of bits is counted for each word."""
    out, left = np.full(len(words), -1, np.int64), np.arange(len(words))
    for level, (size, ranks, bits) in enumerate(levels):
        at = _probe(words[left], level, size).astype(np.int64)
        hit = bits[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1
        own, where = left[hit], at[hit]
        for i in range(0, len(own), 1 << 14):
            block, within = np.divmod(where[i : i + (1 << 14)], BLOCK)
            some = np.unpackbits(bits.reshape(-1, BLOCK // 8)[block], axis=1, bitorder="little")
            some[np.arange(BLOCK) >= within[:, None]] = 0
            out[own[i : i + (1 << 14)]] = ranks[block] + some.sum(axis=1)
        left = left[~hit]
    return out


def pack_shard(part: int, seq: int, start: int, keys: list, occurrence: list[int], ids: list[bytes], width: int) -> dict:
    words = key_words(np.array([NULL_KEY if k is None else k for k in keys], np.int64), np.array(occurrence))
    levels = build_levels(words)
    n = np.array([len(x) // width for x in ids], np.int64)
    slots = np.zeros(len(keys), SLOT)
    at = slot_of(words, read_levels(levels))
    slots["print"][at], slots["n"][at] = fingerprints(words), n
    slots["first"][at] = np.cumsum(n) - n
    key = np.array([(k is not None, k or 0, o) for k, o in zip(keys, occurrence)], [("has", "u1"), ("key", "<i8"), ("nth", "<u4")])
    own = [k for k in keys if k is not None]
    return {"part": part, "seq": seq, "start": start, "n_ids": int(n.sum()), "n_keys": len(keys), "nulls": len(keys) - len(own), "lo": min(own, default=None), "hi": max(own, default=None), "width": width, "key": key.tobytes(), "payload": b"".join(ids), "slots": slots.tobytes(), "levels": levels}


class Shard:
    """Keyed access to one shard."""

    def __init__(self, width: int, payload: bytes, slots: bytes, levels: bytes):
        self.ids = np.frombuffer(payload, "<u2" if width == 2 else "<u4")
        self.slots = np.frombuffer(slots, SLOT)
        self.levels = read_levels(levels)

    def find(self, keys, occurrence) -> np.ndarray:
        """Slots of the keys; -1 for keys that the shard doesn't have."""
        words = key_words(np.array([NULL_KEY if k is None else k for k in keys], np.int64), np.asarray(occurrence))
        at = slot_of(words, self.levels)
        if len(self.slots):
            at[(at >= 0) & (self.slots["print"][at] != fingerprints(words))] = -1
        return at

    def get(self, key, occurrence: int = 0) -> np.ndarray | None:
        at = int(self.find([key], [occurrence])[0])
        if at < 0:
            return None
        first = int(self.slots["first"][at])
        return self.ids[first : first + int(self.slots["n"][at])]


class Pieces(dict):
    """The bytes of the ids of pieces of text, encoded when they are first asked for."""

    def __init__(self, path: str, width: int):
        from tokenizers import Tokenizer

        self.tokenizer, self.kind = Tokenizer.from_file(path), "H" if width == 2 else "I"
        self.model = self.tokenizer.model.tokenize
        # one pre-token, which the model takes as it is, spelled in byte-level letters
        self.letters = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ɏ]+").fullmatch
        plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        self.spelled = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in plain)}

    def __missing__(self, piece: str) -> bytes:
        if self.letters(piece):
            if piece.isascii():
                spelled = "\u0120" + piece[1:] if piece[0] == " " else piece
            else:
                spelled = piece.encode().decode("latin-1").translate(self.spelled)
            ids = [x.id for x in self.model(spelled)]
        else:
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        self[piece] = out = array(self.kind, ids).tobytes()
        return out


def encoder(path: str, end_id: int, width: int, most: int = PIECES):
    """A function that gives the bytes of the ids of each text, end id included.

    White space behind other than white space always starts a new pre-token in
    byte-level BPE, and so does one of .,;:!?| behind a letter. Texts are cut at such
    places and equal pieces encoded once. About `most` of them are kept for the worker's life.
    """
    state = worker_state(f"encoder {path} {width}")
    if "kept" not in state:
        state["kept"] = Pieces(path, width)
    kept, end = state["kept"], array("H" if width == 2 else "I", [end_id]).tobytes()
    pieces = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ɏ]+(?=[\s.,;:!?|]|$)|\s*[^\s]+(?:[^\S \n]+[^\s]+)*|\s+").findall

    def encode(texts: list[str]) -> list[bytes]:
        if len(kept) > most:
            kept.clear()
        return [b"".join(map(kept.__getitem__, pieces(t))) + end for t in texts]

    return encode


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, key: str = "doc_id", shard_ids: int = 1 << 20, width: int = 2, pieces: int = PIECES) -> None:
    """Encodes documents and writes them to path in ascending key order.

    One range exchange; each partition encodes its texts in key order and cuts
    shards of about shard_ids ids.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(key).cast("long").alias("k"), F.coalesce("text", F.lit("")).alias("t"))
    first = F.col("k").asc_nulls_first()
    # the start of the text only parts rows of one key; bounds of ranges stay short
    ordered = texts.repartitionByRange(parts, first, F.left("t", F.lit(16))).sortWithinPartitions(first, "t")

    def shards(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, seq, start = TaskContext.get().partitionId(), 0, 0
        keys, nth, ids, size = [], [], [], 0
        last, seen = object(), 0
        encode = encoder(tokenizer, end_id, width, pieces)

        def full():
            nonlocal seq, start, keys, nth, ids, size
            row = pack_shard(part, seq, start, keys, nth, ids, width)
            start, seq = start + row["n_ids"], seq + 1
            keys, nth, ids, size = [], [], [], 0
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()), ("n_keys", pa.int32()), ("nulls", pa.int32()), ("lo", pa.int64()), ("hi", pa.int64()), ("width", pa.int32()), ("key", pa.binary()), ("payload", pa.binary()), ("slots", pa.binary()), ("levels", pa.binary())]))

        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                some = batch.slice(i, 256)
                ks = some.column(0).to_pylist()
                for k, x in zip(ks, encode(some.column(1).to_pylist())):
                    seen = seen + 1 if k == last else 0
                    last = k
                    keys.append(k)
                    nth.append(seen)
                    ids.append(x)
                    size += len(x) // width
                    if size >= shard_ids:
                        yield full()
        if keys:
            yield full()

    ordered.mapInArrow(lean(shards), SHARD).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the store: key, start (ids before it), n_tokens, ids_crc32.

    Ids are looked up by key through each shard's index.
    """
    store = spark.read.schema(SHARD).parquet(path)
    # a row a partition of write(): their number is fixed by the session, not by the data
    parts = store.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    base = parts.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    rows = store.join(F.broadcast(base), "part").select((F.col("base") + F.col("start")).alias("start"), "width", "key", "payload", "slots", "levels")

    def documents(batches):
        import pyarrow as pa

        for batch in slices(batches, 1):
            for x in batch.to_pylist():
                shard = Shard(x["width"], x["payload"], x["slots"], x["levels"])
                key = np.frombuffer(x["key"], [("has", "u1"), ("key", "<i8"), ("nth", "<u4")])
                asked = [k if h else None for h, k in zip(key["has"].tolist(), key["key"].tolist())]
                at = shard.find(asked, key["nth"])
                if len(at) and at.min() < 0:
                    raise ValueError("a shard's index has lost a key")
                slots = shard.slots[at]
                first, n = slots["first"].astype(np.int64), slots["n"].astype(np.int64)
                ids = shard.ids.astype("<u4")
                crc = [zlib.crc32(ids[a : a + b].tobytes()) for a, b in zip(first.tolist(), n.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(asked, pa.int64()), pa.array(first + x["start"]), pa.array(n), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.mapInArrow(lean(documents), "doc_id long, start long, n_tokens long, ids_crc32 long")


def holds(stored: bytes, key) -> np.ndarray:
    """The occurrences of a key among a shard's stored keys, which ascend."""
    own = np.frombuffer(stored, [("has", "u1"), ("key", "<i8"), ("nth", "<u4")])
    nulls = int(np.searchsorted(own["has"], 1))
    if key is None:
        return own["nth"][:nulls]
    a, b = (nulls + int(np.searchsorted(own["key"][nulls:], key, side)) for side in ("left", "right"))
    return own["nth"][a:b]


def shards_of(spark: SparkSession, path: str, keys: list) -> DataFrame:
    """The shards that may hold one of a few keys; the reader skips others by the statistics of lo and hi."""
    wanted = F.lit(False)
    for k in keys:
        wanted = wanted | ((F.col("nulls") > 0) if k is None else (F.col("lo") <= k) & (F.col("hi") >= k))
    return spark.read.schema(SHARD).parquet(path).where(wanted)


def lookup(spark: SparkSession, path: str, keys: list) -> dict:
    """The ids of a few keys, by key; those of all occurrences of a repeated key, in order of shard and occurrence, as a list of arrays."""
    asked = list(dict.fromkeys(keys))

    def find(batches):
        import pyarrow as pa

        for batch in slices(batches, 1):
            for x in batch.to_pylist():
                shard = Shard(x["width"], x["payload"], x["slots"], x["levels"])
                for k in asked:
                    # the stored keys are compared too, since a fingerprint may match by chance
                    for nth in holds(x["key"], k).tolist():
                        ids = shard.get(k, nth)
                        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([x["part"]], pa.int32()), pa.array([x["seq"]], pa.int32()), pa.array([nth], pa.int32()), pa.array([ids.astype("<u4").tobytes()], pa.binary())], ["k", "part", "seq", "nth", "ids"])

    out: dict = {}
    rows = shards_of(spark, path, asked).mapInArrow(lean(find), "k long, part int, seq int, nth int, ids binary").collect()
    for r in sorted(rows, key=lambda r: (r.part, r.seq, r.nth)):
        out.setdefault(r.k, []).append(np.frombuffer(r.ids, "<u4"))
    return out


def store_tokens(docs: DataFrame, tokenizer: str, end_id: int, **how) -> DataFrame:
    """Writes the documents' ids to the shared folder and reads them back from there."""
    path = new_path(docs.sparkSession, "tokens")
    write(docs, path, tokenizer, end_id, **how)
    return read(docs.sparkSession, path)


__all__ = ["Shard", "build_levels", "lookup", "read", "remove_path", "store_tokens", "write"]
