"""Two tokenizers' tokens of the same texts, aligned by byte ranges.

Tokenizer A is a byte-level BPE (tokenizers library), B a BPE of pieces with byte fallback
(sentencepiece), which writes a space before each text; A is given the text behind one
space, so that both see the same bytes.

Segments: texts are cut before a space or line break that follows anything but white space.
A cut is safe if no entry of either vocabulary holds such a place (then no merge ever
crosses it); cuttable() reads this off both vocabularies, and where it fails for a character,
texts aren't cut before it. A's pre-tokens never cross these places either. So the tokens of
a text are those of its segments, one after the other. Each distinct segment of the corpus is
encoded and aligned once, in the range of hashes that it falls in; alignments go back to the
dictionaries of the blocks of documents that hold it (blocks.py), and documents are composed
from them.

A segment's alignment: byte offsets at which tokens of both end cut its tokens into groups;
tokens of A and B whose byte ranges overlap are linked. A pair of ids counts in how many
documents it is linked; a link is best if its pair's count is the highest of its A id.

Counts of pairs are made in each block (documents that hold a pair, each once), summed by
ranges of codes that keep an A id's pairs together, and told to the blocks that hold them.

Rows: a null or empty text, and one whose bytes A or B doesn't give back whole (B reads
U+2581 as a space), has no tokens, zeros and no links; repeated rows are documents of their
own; equal highest counts are all best; an empty table gives no rows; a text without any
cut is one segment, whole; an id of 2 ** 30 or more isn't expected. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliowright.llm import blocks as bl
from foliowright.llm.common import materialised, release, worker_state

#: characters of a block's texts; larger blocks hold each segment fewer times
BLOCK = 12_000_000
ALIGNED, PAIRS = 1, 2
#: segments of whole documents whose pairs are told apart at a time
STEP = 300_000
_ID, _LOW, _ODD = (1 << 30) - 1, np.uint64((1 << 32) - 1), np.uint64(0x9E3779B1)


def _letters() -> dict[str, int]:
    """The byte that each letter of byte-level entries stands for."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def _pieces_of(path: str):
    """B's processor and the bytes of its ids; no bytes for control ids."""
    import sentencepiece

    b = sentencepiece.SentencePieceProcessor(model_file=path)
    spelled = []
    for i in range(b.vocab_size()):
        if b.is_byte(i):
            spelled.append(bytes([int(b.id_to_piece(i)[3:-1], 16)]))
        else:
            spelled.append(b"" if b.is_control(i) or b.is_unknown(i) else b.id_to_piece(i).replace("▁", " ").encode())
    return b, spelled


def _entries_of(path: str):
    """A's tokenizer and the bytes of its ids."""
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(path)
    a.encode_special_tokens = True
    letters, spelled = _letters(), [b""] * a.get_vocab_size(with_added_tokens=True)
    for entry, i in a.get_vocab(with_added_tokens=True).items():
        spelled[i] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
    return a, spelled


def cuttable(a_path: str, b_path: str, at: str = " \n") -> str:
    """Those of the characters before which, behind anything but white space, no vocabulary has an entry that goes on."""
    out = ""
    texts = [x.decode(errors="replace") for _, spelled in (_entries_of(a_path), _pieces_of(b_path)) for x in spelled if len(x) > 1]
    for c in at:
        if not any(re.search(rf"\S{c}", t) for t in texts):
            out += c
    return out


def cutter(a_path: str, b_path: str):
    """A function that gives the segments of a text behind one space; none for an empty text."""
    other = rf"[^\S{cuttable(a_path, b_path)}]"
    # white space and what follows it, up to a safe place behind anything but white space
    find = re.compile(rf"\s*\S+(?:{other}\s*\S*)*|\s+").findall

    def cut(text: str) -> list[str]:
        return find(" " + text) if text else []

    return cut


class Both:
    """Both tokenizers, and alignments of segments."""

    #: no entry of B crosses it, so that what stands behind is encoded as within a text
    GUARD = "\n"

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a, self.a_bytes = _entries_of(a_path)
        self.b, self.b_bytes = _pieces_of(b_path)
        self.guarded = self.b.encode(self.GUARD)
        self.guard = len(self.guarded) if not any(self.GUARD.encode() in x for x in self.b_bytes if len(x) > 1) else 0
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in spelled], np.int64) for spelled in (self.a_bytes, self.b_bytes))

    def encode(self, segments: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        batch = getattr(self.a, "encode_batch_fast", self.a.encode_batch)
        a = [x.ids for x in batch(segments, add_special_tokens=False)]
        if self.guard:
            b = [x[self.guard :] for x in self.b.encode([self.GUARD + s for s in segments], num_threads=1)]
        else:
            # texts are whole then; B writes the first space itself
            b = self.b.encode([s[1:] for s in segments], num_threads=1)
        return a, b

    def align(self, segments: list[bytes]) -> list[bytes]:
        """The links of each segment; none where a tokenizer doesn't give the segment back.

        All segments' tokens lie one behind the other; each end of a token of A or B closes one
        link, of the tokens around it, and each end of both a group. A link is A's id, B's id
        above it by 30 bits, and above these whether it ends A's token and B's.
        """
        a, b = self.encode([x.decode() for x in segments])
        whole = [b"".join([self.a_bytes[i] for i in x]) == s == b"".join([self.b_bytes[i] for i in y]) for s, x, y in zip(segments, a, b)]
        use = [k for k, ok in enumerate(whole) if ok]
        ids_a, ids_b = (np.fromiter(chain.from_iterable(x[k] for k in use), np.int64) for x in (a, b))
        ends_a, ends_b = np.cumsum(self.a_sizes[ids_a]), np.cumsum(self.b_sizes[ids_b])
        ends = np.union1d(ends_a, ends_b)
        at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        closes_a, closes_b = ends_a[at_a] == ends, ends_b[at_b] == ends
        codes = ids_a[at_a] | ids_b[at_b] << 30 | closes_a.astype(np.int64) << 60 | closes_b.astype(np.int64) << 61
        links, first = [b""] * len(segments), 0
        for k, stop in zip(use, (np.searchsorted(ends, np.cumsum([len(segments[k]) for k in use])) + 1).tolist()):
            links[k] = codes[first:stop].tobytes()
            first = stop
        return links


def group_texts(links: np.ndarray, n: np.ndarray) -> list[bytes]:
    """The groups of segments as text, from their links, which lie one behind the other, n of each."""
    out = []
    stops = np.cumsum(n)
    for k in range(0, len(n), 1 << 16):
        first, stop = int(stops[k] - n[k]), int(stops[min(k + (1 << 16), len(n)) - 1])
        some = links[first:stop]
        closes_a, closes_b = some >> 60 & 1 == 1, some >> 61 & 1 == 1
        both = closes_a & closes_b
        group = np.cumsum(both) - both
        group_a, group_b = group[closes_a], group[closes_b]
        # each group's tokens of A, then those of B, each with what stands behind it
        last_a, last_b = np.r_[group_a[1:] != group_a[:-1], True], np.r_[group_b[1:] != group_b[:-1], True]
        words = [f"{i}|" if last else f"{i}," for i, last in zip((some[closes_a] & _ID).tolist(), last_a.tolist())]
        words += [f"{i};" if last else f"{i}," for i, last in zip((some[closes_b] >> 30 & _ID).tolist(), last_b.tolist())]
        words = [words[x] for x in np.argsort(np.r_[2 * group_a, 2 * group_b + 1], kind="stable").tolist()]
        tokens = np.r_[0, np.cumsum(closes_a.astype(np.int64) + closes_b)]
        bounds = tokens[np.r_[0, stops[k : k + (1 << 16)] - first]].tolist()
        out += ["".join(words[x:y])[:-1].encode() for x, y in zip(bounds, bounds[1:])]
    return out


def _aligned(a_path: str, b_path: str):
    def answer(items: list[bytes], totals: np.ndarray):
        state = worker_state(f"both {a_path} {b_path}")
        if "both" not in state:
            state["both"] = Both(a_path, b_path)
        links = [x for first in range(0, len(items), 4096) for x in state["both"].align(items[first : first + 4096])]

        def to(places: np.ndarray) -> tuple[bytes, bytes]:
            some = [links[k] for k in places.tolist()]
            return bl.pack(np.frombuffer(b"".join(some), "<i8")), bl.pack(np.fromiter(map(len, some), np.uint32, len(some)) >> 3)

        return to

    return answer


def _links_of(block: bl.Block, facts: bl.Facts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(links, first, number of links) by the dictionary's numbers; none for segments that aren't given back whole."""
    n = np.concatenate([np.zeros(0, np.int64), *(bl.unpack(r[2]).astype(np.int64) for r in facts.rows[ALIGNED])])
    return facts.array(ALIGNED, "<i8"), block.by_number(np.cumsum(n) - n), block.by_number(n)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (size of them) for each, one behind the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def _whole(block: bl.Block, ok: np.ndarray) -> np.ndarray:
    """Documents with segments, all of which both tokenizers give back."""
    return (block.sizes > 0) & (block.sums(~ok[block.seq]) == 0)


def _pair_codes(links: np.ndarray) -> np.ndarray:
    """Codes of pairs of ids that spread over all ranges, those of one A id side by side."""
    a, b = (links & _ID).astype(np.uint64), (links >> 30 & _ID).astype(np.uint64)
    return (a * _ODD & _LOW) << np.uint64(32) | b


def _pairs_in(parts: int):
    def run(block, facts):
        """Asks for the pairs of ids linked in the block, with the number of its documents that hold them."""
        links, first, n = _links_of(block, facts)
        codes, number = np.unique(_pair_codes(links), return_inverse=True)
        use, n_codes = _whole(block, n > 0)[block.doc], max(1, len(codes))
        # each segment of a document once, then each pair once; some documents at a time
        own = np.unique(block.doc[use].astype(np.int64) * len(n) + block.seq[use])
        stops = np.searchsorted(own, np.arange(len(block.sizes) + 1) * len(n))
        held, last = np.zeros(len(codes), np.uint32), 0
        for stop in stops[1:].tolist():
            if stop - last < STEP and stop < len(own) or stop == last:
                continue
            doc, segment = np.divmod(own[last:stop], len(n))
            pairs = np.unique(np.repeat(doc, n[segment]) * n_codes + number[_spread(first[segment], n[segment])])
            held += np.bincount(pairs % n_codes, minlength=len(codes)).astype(np.uint32)
            last = stop
        return bl.asked(block.block, PAIRS, codes, held, parts)

    return run


def _ranked(codes: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Twice a pair's count, and one more if none of its A id is higher."""
    own = codes >> np.uint64(32)
    start = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    most = np.repeat(np.maximum.reduceat(held, start), np.diff(np.r_[start, len(own)]))
    return (2 * held + (held == most)).astype("<i8")


def _composed(block: bl.Block, facts: bl.Facts) -> dict:
    links, first, n = _links_of(block, facts)
    number = np.unique(_pair_codes(links), return_inverse=True)[1]
    whole, ranked = _whole(block, n > 0), facts.array(PAIRS, "<i8")[number]
    out = {"id": bl.nullable(block.ids, block.absent)}
    ends_a, ends_b = links >> 60 & 1, links >> 61 & 1
    for c, of in (("n_a", ends_a), ("n_b", ends_b), ("n_groups", ends_a & ends_b), ("n_links", np.ones(len(links), np.int64)), ("n_best", ranked & 1), ("count_sum", ranked >> 1)):
        up_to = np.r_[0, np.cumsum(of)]
        doc_sums = block.sums((up_to[first + n] - up_to[first])[block.seq])
        out[c] = np.where(whole, doc_sums, 0).astype(np.int64)
    groups = group_texts(links, n[block.order])
    at = block.by_number(np.arange(len(groups)))
    digests, last = [], 0
    for use, end in zip(whole.tolist(), np.cumsum(block.sizes).tolist()):
        digests.append(hashlib.sha256(b";".join(map(groups.__getitem__, at[block.seq[last:end]].tolist()))).hexdigest() if use else "")
        last = end
    return out | {"groups_sha256": digests}


def align(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", size: int = BLOCK) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each document."""
    spark = docs.sparkSession
    given = docs.select(F.col(key).cast("long").alias("id"), F.lit(True).alias("flag"), "text")
    blocks = bl.encode(given, cutter(a_path, b_path), "segments", size, hashes=False)
    facts = materialised(blocks.dictionary(_aligned(a_path, b_path), ALIGNED), "alignments")[0]
    release(spark)
    held = blocks.map(facts, _pairs_in(blocks.parts), bl.FACT)
    facts = facts.unionByName(materialised(blocks.answered(held, _ranked, "<u4"), "pairs")[0])
    del held
    release(spark)
    rows = blocks.map(facts, _composed, "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
    return rows.withColumnRenamed("id", key)
