"""Documents in blocks, each with a dictionary of the items (words, segments) that it holds.

A block is a run of consecutive documents of one task, about `size` characters; one longer
text is a block of its own. It is one row of packed arrays: ids, sizes, for every item of its
texts in order the item's number in the block's dictionary, and the dictionary itself, each
item once. What is known of an item is so found once for the whole corpus and told to each
block that has it, and not to each occurrence.

Blocks ask and are answered in packed slices: entries ascend by a 64-bit code (an item's
hash, or a code that is one already) and are cut by ranges of codes. A range is one group of
rows, a slice for each block that has entries in it; answers come in the same order. Codes
are hashes, so ranges hold like numbers of them whatever is frequent, and a frequent item has
one entry for each block. Items themselves are compared as they are; only their ranges go by
hash.
"""

from __future__ import annotations

import struct
from collections import defaultdict
from collections.abc import Callable
from itertools import count

import numpy as np
from pyspark.sql import DataFrame

from foliowright.llm.common import lean, materialised, trim

#: characters of a block's texts
BLOCK = 8_000_000
_STATE = "block long, ids binary, absent binary, flags binary, sizes binary, seq binary, order binary"
_TABLE = f"{_STATE}, hashes binary, items binary, n binary"
#: what is asked of a range of codes or answered to a block
FACT = "block long, kind int, i int, data binary, more binary"


def pack(a: np.ndarray) -> bytes:
    """Numbers by their bytes' weights, so that small and similar ones compress."""
    import pyarrow as pa

    a = np.ascontiguousarray(a)
    raw = a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if len(a) else b""
    return struct.pack("<Q", len(raw)) + (pa.compress(raw, "zstd", asbytes=True) if raw else b"")


def unpack(data: bytes, dtype: str = "<u4") -> np.ndarray:
    import pyarrow as pa

    (size,) = struct.unpack_from("<Q", data)
    if not size:
        return np.zeros(0, dtype)
    raw = np.frombuffer(pa.decompress(memoryview(data)[8:], size, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def pack_codes(codes: np.ndarray) -> bytes:
    """Ascending codes by their differences."""
    return pack(np.diff(codes, prepend=np.zeros(1, np.uint64)))


def unpack_codes(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, "<u8"), dtype=np.uint64)


def pack_list(items: list[bytes]) -> bytes:
    lens, joined = pack(np.fromiter(map(len, items), np.uint32, len(items))), pack(np.frombuffer(b"".join(items), np.uint8))
    return struct.pack("<Q", len(lens)) + lens + joined


def unpack_list(data: bytes) -> list[bytes]:
    (n,) = struct.unpack_from("<Q", data)
    ends, joined = np.cumsum(unpack(data[8 : 8 + n]).astype(np.int64)).tolist(), unpack(data[8 + n :], "u1").tobytes()
    return [joined[a:b] for a, b in zip([0, *ends], ends)]


def arrow_schema(ddl: str):
    """The Arrow schema of "name type, ..." with plain types."""
    import pyarrow as pa

    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(","))])


def _tidy(run: Callable, both: bool = False) -> Callable:
    """run, after which the worker gives the memory that it no longer uses back to the system; both: run takes two tables."""

    def one(table):
        try:
            return run(table)
        finally:
            trim()

    def two(left, right):
        try:
            return run(left, right)
        finally:
            trim()

    # Spark reads off the signature what a function takes
    return two if both else one


def nullable(ids: np.ndarray, absent: np.ndarray):
    """An Arrow column of ids, null where absent."""
    import pyarrow as pa

    return pa.array(ids, pa.int64(), mask=absent)


def cut_codes(codes: np.ndarray, parts: int):
    """(range, first, last + 1) of ascending codes, for the ranges that hold any; parts is a power of two."""
    step = (1 << 64) // parts
    at = np.searchsorted(codes, np.array([i * step for i in range(1, parts)], np.uint64))
    edges = np.r_[0, at, len(codes)]
    for i in np.flatnonzero(np.diff(edges)).tolist():
        yield i, int(edges[i]), int(edges[i + 1])


class Block:
    """A block's arrays."""

    def __init__(self, table):
        row = {c: table.column(c)[0].as_py() for c in table.column_names}
        self.block = row["block"]
        self.ids = unpack(row["ids"], "<i8")
        self.absent, self.flags = unpack(row["absent"], "?"), unpack(row["flags"], "?")
        self.sizes = unpack(row["sizes"]).astype(np.int64)
        self.seq, self.order = unpack(row["seq"]), unpack(row["order"])
        self.hashes = self.by_number(unpack_codes(row["hashes"])) if "hashes" in row else None
        self.doc = np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)

    def by_number(self, answers: np.ndarray) -> np.ndarray:
        """Answers for the dictionary's entries, which ascend by hash, in the order of the entries' numbers."""
        out = np.empty_like(answers)
        out[self.order] = answers
        return out

    def sums(self, values: np.ndarray) -> np.ndarray:
        """values of the items summed for each document."""
        return np.bincount(self.doc, weights=values, minlength=len(self.sizes))


class Facts:
    """What a block was told: (data, more) of each slice by kind, in the order of codes."""

    def __init__(self, table):
        rows = defaultdict(list)
        for kind, i, data, more in zip(*(table.column(c).to_pylist() for c in ("kind", "i", "data", "more"))):
            rows[kind].append((i, data, more))
        self.rows = defaultdict(list, {k: sorted(v, key=lambda r: r[0]) for k, v in rows.items()})

    def array(self, kind: int, dtype: str) -> np.ndarray:
        return np.concatenate([np.zeros(0, dtype), *(unpack(r[1], dtype) for r in self.rows[kind])])


def asked(block: int, kind: int, codes: np.ndarray, values: np.ndarray, parts: int) -> list[dict]:
    """FACT rows that ask for ascending codes, with a value for each."""
    return [{"block": block, "kind": kind, "i": i, "data": pack_codes(codes[a:b]), "more": pack(values[a:b])} for i, a, b in cut_codes(codes, parts)]


class Blocks:
    """The blocks of a corpus and their exchanges."""

    def __init__(self, table: DataFrame, hashes: bool):
        names = [c.split()[0] for c in _STATE.split(", ")] + ["hashes"] * hashes
        self.table, self.rows, n = table, table.select(*names), table.count()
        #: ranges of codes: each about as large as a block, at most 65,536; and tasks that blocks are dealt to
        self.parts = max(16, min(65_536, 1 << max(0, 2 * n - 1).bit_length()))
        self.tasks = max(16, n)

    def dictionary(self, answer: Callable, kind: int) -> DataFrame:
        """FACT rows: to each slice of blocks' dictionaries, what answer says of its items.

        answer(items, totals) gets the distinct items of a range and their flagged occurrences
        in the corpus, once each, and returns a function of entries' places among these that
        gives the bytes of (data, more).
        """
        parts = self.parts

        def slices(batches):
            import pyarrow as pa

            for batch in batches:
                for row in batch.to_pylist():
                    items, n = unpack_list(row["items"]), unpack(row["n"])
                    codes = _hashes(items)
                    out = []
                    for i, a, b in cut_codes(codes, parts):
                        out.append({"block": row["block"], "kind": kind, "i": i, "data": pack_list(items[a:b]), "more": pack(n[a:b])})
                    yield pa.RecordBatch.from_pylist(out, schema=arrow_schema(FACT))

        def merge(table):
            import pyarrow as pa

            number = defaultdict(count().__next__)
            places = []
            for data in table.column("data").to_pylist():
                items = unpack_list(data)
                places.append(np.fromiter(map(number.__getitem__, items), np.int64, len(items)))
            n = np.concatenate([unpack(x) for x in table.column("more").to_pylist()])
            told = answer(list(number), np.bincount(np.concatenate(places), weights=n, minlength=len(number)).astype(np.int64))
            data, more = zip(*map(told, places))
            return pa.table({"block": table.column("block"), "kind": table.column("kind"), "i": table.column("i"), "data": pa.array(data, pa.binary()), "more": pa.array(more, pa.binary())})

        asks = self.table.select("block", "items", "n").mapInArrow(lean(slices), FACT)
        return asks.repartition(self.parts, "i").groupBy("i").applyInArrow(_tidy(merge), FACT)

    def answered(self, requests: DataFrame, answer: Callable, value: str) -> DataFrame:
        """FACT rows: to each slice of codes asked, answer(codes, sums of their values over all blocks), an array.

        requests are FACT rows with ascending codes in data and a value of dtype `value` for each in more.
        """

        def merge(table):
            import pyarrow as pa

            codes = [unpack_codes(x) for x in table.column("data").to_pylist()]
            found, at = np.unique(np.concatenate(codes), return_inverse=True)
            values = np.concatenate([unpack(x, value) for x in table.column("more").to_pylist()])
            out = answer(found, np.bincount(at, weights=values, minlength=len(found)))[at]
            ends = np.cumsum([len(c) for c in codes])
            back = [pack(out[e - len(c) : e]) for e, c in zip(ends.tolist(), codes)]
            return pa.table({"block": table.column("block"), "kind": table.column("kind"), "i": table.column("i"), "data": pa.array(back, pa.binary()), "more": pa.nulls(len(back), pa.binary())})

        return requests.repartition(self.parts, "kind", "i").groupBy("kind", "i").applyInArrow(_tidy(merge), FACT)

    def map(self, facts: DataFrame, run: Callable, schema: str) -> DataFrame:
        """run(Block, Facts), a dict of columns or a list of rows, for each block and what it was told."""

        def one(left, right):
            import pyarrow as pa

            rows = run(Block(left), Facts(right))
            return pa.table(rows, schema=arrow_schema(schema)) if isinstance(rows, dict) else pa.Table.from_pylist(rows, schema=arrow_schema(schema))

        told = facts.select("block", "kind", "i", "data", "more")
        return self.rows.repartition(self.tasks, "block").groupBy("block").cogroup(told.repartition(self.tasks, "block").groupBy("block")).applyInArrow(_tidy(one, both=True), schema)


def _hashes(items: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, items), np.uint64, len(items))


def encode(docs: DataFrame, cut: Callable[[str], list], what: str, size: int = BLOCK, hashes: bool = True) -> Blocks:
    """The blocks of docs (id long, flag boolean, text string), written to the shared folder.

    cut gives the items of a text, as bytes or str. A null text has the items of an empty one.
    hashes: whether blocks keep their items' hashes.
    """

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, done = TaskContext.get().partitionId(), 0
        number, ids, flags, sizes, seqs, chars = defaultdict(count().__next__), [], [], [], [], 0

        def full():
            n = np.array(sizes, np.int64)
            seq, flag = np.concatenate(seqs), np.array(flags, bool)
            items = [x if isinstance(x, bytes) else x.encode() for x in number]
            codes = _hashes(items)
            order = np.argsort(codes, kind="stable")
            seen = np.bincount(seq[np.repeat(flag, n)], minlength=len(items))
            row = {
                "block": part << 32 | done, "ids": pack(np.array([x or 0 for x in ids], np.int64)), "absent": pack(np.array([x is None for x in ids], bool)),
                "flags": pack(flag), "sizes": pack(n.astype(np.uint32)), "seq": pack(seq), "order": pack(order.astype(np.uint32)), "hashes": pack_codes(codes[order]) if hashes else None,
                "items": pack_list([items[k] for k in order.tolist()]), "n": pack(seen[order].astype(np.uint32)),
            }
            return pa.RecordBatch.from_pylist([row], schema=arrow_schema(_TABLE))

        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                some = batch.slice(i, 64)
                for k, flag, text in zip(*(some.column(c).to_pylist() for c in ("id", "flag", "text"))):
                    items = cut(text or "")
                    ids.append(k)
                    flags.append(flag)
                    sizes.append(len(items))
                    seqs.append(np.fromiter(map(number.__getitem__, items), np.uint32, len(items)))
                    chars += len(text or "")
                    if chars >= size:
                        yield full()
                        done += 1
                        number, ids, flags, sizes, seqs, chars = defaultdict(count().__next__), [], [], [], [], 0
        if ids:
            yield full()

    rows = docs.select("id", "flag", "text").mapInArrow(lean(run), _TABLE)
    return Blocks(materialised(rows, what)[0], hashes)
