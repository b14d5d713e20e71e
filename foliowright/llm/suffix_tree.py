"""Scores of texts by a probabilistic suffix tree over words.

Symbols are lower-cased words and an end behind each text. A state is a context: the last
word, the last two and so on up to `depth`, seen at least `least` times in the training
documents. Distributions are smoothed from the shortest context to the longest:

    P(w | context) = (c(context w) + alpha * P(w | context without its first word)) / (c(context) + alpha)

down to (c(w) + 1) / (N + V + 1), in which unknown words share one symbol; so each sums to one.

A context is retained if its distribution diverges from that of the context without its
first word: the mean over its training occurrences of log(P / P of the shorter one), each
occurrence left out of its own context's counts, must exceed `divergence`. Left-out counts
keep contexts whose few successors look different by chance from passing. A word is scored
in the state of the longest retained suffix of what precedes it in its text.

On Spark: texts are cut to blocks with dictionaries (blocks.py); word counts are joined back
to dictionaries. Counts of words in contexts go level by level: each block sends the distinct
codes of those words whose context is frequent enough (known from the level before), with
their counts in its training documents, and gets the corpus's counts. Divergences are summed
the same way. All counts cover all training documents and grow with them; nothing is
sampled or dropped, no task holds more than a block or a range of codes, and the driver holds
two sums. Contexts are compared by 64-bit hashes: those that collide (n * n / 2 ** 65 of n
contexts expected) share their counts. A range of codes is about as large as a block; at many
terabytes blocks should be larger, since the slices exchanged are blocks times ranges.

Rows: a null text is empty and has just the end; a null id is text '' for the fold; repeated
rows each have a row and each count; ties can't arise; a table without training rows scores 0
everywhere, as does the base; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliowright.llm import blocks as bl
from foliowright.llm.common import materialised, release
from foliowright.llm.langid import bucket
from foliowright.llm.wordscan import mix

DEPTH, LEAST, ALPHA, DIVERGENCE = 2, 4, 10.0, 0.01
_LOWER = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))
#: the end's place in dictionaries; no word is empty
END = b""
_STEP = np.uint64(0x9E3779B97F4A7C15)
WORDS, KEPT = 0, 100


def symbols(text: str) -> list[bytes]:
    """Lower-cased words and the end."""
    return [*text.encode().translate(_LOWER).split(), END]


def _counts(block: bl.Block, facts: bl.Facts) -> np.ndarray:
    """The training counts of the block's words, by their numbers."""
    return block.by_number(facts.array(WORDS, "<i8"))


def _word_counts(items: list[bytes], totals: np.ndarray):
    """Counts of words, and for each slice the occurrences and the words seen that it is the first to tell of."""
    told = np.zeros(len(items), bool)

    def to(places: np.ndarray) -> tuple[bytes, bytes]:
        new = places[~told[places]]
        told[new] = True
        return bl.pack(totals[places]), np.array([totals[new].sum(), (totals[new] > 0).sum()], "<i8").tobytes()

    return to


class Level:
    """Contexts of one length in a block: where they are candidates, and their words' codes there."""

    def __init__(self, where, codes, at, contexts, seen):
        self.where, self.codes, self.at, self.contexts, self.seen = where, codes, at, contexts, seen


def levels(block: bl.Block, facts: bl.Facts, depth: int, least: int):
    """The levels 1 to depth whose counts are known, and the next one; counts of each as far as known.

    A context's count is that of its last word in the context before, so a level needs the
    counts of the level before at the word before.
    """
    n, h = _counts(block, facts)[block.seq], block.hashes[block.seq]
    nth = np.arange(len(h)) - np.repeat(np.cumsum(block.sizes) - block.sizes, block.sizes)
    context, before = np.zeros(len(h), np.uint64), n
    for length in range(1, depth + 1):
        context[length:] = mix(context[length:] * _STEP + h[:-length])
        seen = np.r_[0, before[:-1]]
        where = np.flatnonzero((nth >= length) & (seen >= least))
        own = context[where]
        codes, at = np.unique(mix(own ^ mix(h[where] + _STEP)), return_inverse=True)
        level = Level(where, codes, at, own, seen[where])
        if length not in facts.rows and len(codes):
            yield level, None
            return
        found = facts.array(length, "<i8")[at]
        before = np.zeros(len(h), np.int64)
        before[where] = found
        yield level, found


def base(block: bl.Block, facts: bl.Facts, total: int, distinct: int) -> np.ndarray:
    return (_counts(block, facts) + 1)[block.seq] / (total + 1.0 * (distinct + 1))


def _ask(length: int, parts: int, least: int):
    def run(block, facts):
        *_, (level, _) = levels(block, facts, length, least)
        training = block.flags[block.doc][level.where]
        n = np.bincount(level.at, weights=training, minlength=len(level.codes)).astype("<u4")
        return bl.asked(block.block, length, level.codes, n, parts)

    return run


def _smoothed(block, facts, p, depth: int, least: int, alpha: float):
    """(level, found, probabilities of the words there, those of the shorter contexts)."""
    for level, found in levels(block, facts, depth, least):
        if found is not None:
            shorter = p[level.where]
            longer = (found + alpha * shorter) / (level.seen + alpha)
            yield level, found, longer, shorter
            p[level.where] = longer


def _diverge(depth: int, parts: int, least: int, alpha: float, total: int, distinct: int, divergence: float):
    def run(block, facts):
        out, training = [], block.flags[block.doc]
        for length, (level, found, _, shorter) in enumerate(_smoothed(block, facts, base(block, facts, total, distinct), depth, least, alpha), 1):
            mine = training[level.where]
            left_out = (found - 1 + alpha * shorter) / (level.seen - 1 + alpha)
            gain = np.log(np.maximum(left_out, 1e-300) / shorter) - divergence
            contexts, at = np.unique(level.contexts, return_inverse=True)
            # a block's share in half the bytes; shares are summed in double precision
            own = np.bincount(at, weights=np.where(mine, gain, 0), minlength=len(contexts)).astype("<f4")
            out += bl.asked(block.block, KEPT + length, contexts, own, parts)
        return out

    return run


def _score(depth: int, least: int, alpha: float, total: int, distinct: int):
    def run(block, facts):
        p = base(block, facts, total, distinct)
        known = block.sums(_counts(block, facts)[block.seq] > 0)
        low = np.log10(p)
        best = low.copy()
        for length, (level, _, longer, _) in enumerate(_smoothed(block, facts, p.copy(), depth, least, alpha), 1):
            contexts, at = np.unique(level.contexts, return_inverse=True)
            kept = facts.array(KEPT + length, "?")[at] if len(contexts) else np.zeros(0, bool)
            best[level.where[kept]] = np.log10(longer[kept])
        return {
            "id": bl.nullable(block.ids, block.absent), "flag": block.flags, "n_tokens": block.sizes, "n_known": known.astype(np.int64),
            "base_score": block.sums(low), "score": block.sums(best),
        }

    return run


def _summed(batches):
    import pyarrow as pa

    for batch in batches:
        pairs = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i8").reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["total", "words"])


def score(docs: DataFrame, key: str = "doc_id", training: Column | None = None, depth: int = DEPTH, least: int = LEAST, alpha: float = ALPHA, divergence: float = DIVERGENCE, size: int = bl.BLOCK) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) of each document.

    training: which rows are learned from; by default those whose crc32(key as text) mod 7 is not 2.
    """
    spark = docs.sparkSession
    if training is None:
        training = F.coalesce(bucket(F.col(key), 7), F.lit(0)) != 2
    given = docs.select(F.col(key).cast("long").alias("id"), training.alias("flag"), "text")
    blocks = bl.encode(given, symbols, "symbols", size)
    parts = blocks.parts
    facts = materialised(blocks.dictionary(_word_counts, WORDS), "facts")[0]
    total, distinct = (sum(x) for x in zip((0, 0), *facts.select("more").mapInArrow(_summed, "total long, words long").agg(F.sum("total"), F.sum("words")).na.fill(0).collect()))
    for length in range(1, depth + 1):
        requests = blocks.map(facts, _ask(length, parts, least), bl.FACT)
        facts = facts.unionByName(materialised(blocks.answered(requests, lambda codes, n: n.astype("<i8"), "<u4"), "facts")[0])
        del requests
        release(spark)
    gains = blocks.map(facts, _diverge(depth, parts, least, alpha, total, distinct, divergence), bl.FACT)
    facts = facts.unionByName(materialised(blocks.answered(gains, lambda codes, gain: gain > 0, "<f4"), "facts")[0])
    del gains
    release(spark)
    rows = blocks.map(facts, _score(depth, least, alpha, total, distinct), "id long, flag boolean, n_tokens long, n_known long, base_score double, score double")
    return rows.select(F.col("id").alias(key), (~F.col("flag")).alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
