"""Trie of conversations by their first turns, with what sharing prefixes saves.

rebuilt() makes the conversations that the trie is built over; trie() builds it. A turn is
(role, text), compared by 128 bits of hash; a node is a distinct sequence of first turns and
goes by the least conv_id of its members and its depth.

Construction is level-synchronous. Equal conversations are one row with a weight first. Then,
per depth, live conversations are grouped by (parent node, next turn); a group's least
conv_id names the node. A conversation alone in its node is live no longer: below, its
nodes are a chain, known without grouping. So there are as many rounds as the longest prefix
that two different conversations share, and each round keeps the rows of live ones only.
Leaves and savings are rolled up by joins from the deepest level to the root.

Groups may be large: turns are numbered by ranges of (conversation, turn) and not by one
task for each conversation; nodes' groups are pre-aggregated, and what is joined back to the
rows of a frequent turn, class or conversation is salted. Members of a class are joined to
text in chunks of 1,024 numbers and hashed as a stream, so that no list is held. Savings of
chains of equal conversations are running sums by conversation, which spill. State between
rounds is a table in the shared folder; the driver holds counts and the keys of hot groups.

Rows: turns go by turn (null first), then role, then text; repeated rows stay; a null role or
text is empty. A turn without conv_id belongs to no conversation and is left out. An empty
table has no node, not even a root. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliowright.llm.common import hot_keys, lean, materialised, salted_join

NOTHING = hashlib.sha256(b"").hexdigest()
#: turns that a conversation may take from the first of its hundred
TAKEN = 6
OF = 100
#: members of a class that one chunk of text may hold, as a power of two
CHUNK = 10


def numbered(turns: DataFrame) -> DataFrame:
    """(conv_id, i, h1, h2, len): the turns of each conversation from 0 on, by their hashes and lengths.

    Rows are sorted by ranges; a conversation that spans ranges goes on counting from the ranges before.
    """
    spark = turns.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = turns.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role")]
    # the start of the text keeps the bounds of ranges short; equal starts share a range
    rows = rows.repartitionByRange(parts, *order, F.left("text", F.lit(32))).sortWithinPartitions(*order, "text")
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))
    half = lambda x: F.conv(x, 16, -10).cast("long")
    rows = rows.select("conv_id", half(F.left(digest, F.lit(16))).alias("h1"), half(F.right(digest, F.lit(16))).alias("h2"), F.length("text").cast("long").alias("len"), F.monotonically_increasing_id().alias("m"))
    rows = materialised(rows, "turns")[0].withColumn("part", F.shiftright("m", 33))
    runs = rows.groupBy("conv_id", "part").agg(F.min("m").alias("first"), F.count("*").alias("own"))
    before = F.sum("own").over(W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    runs = runs.select("conv_id", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"))
    return rows.join(runs, ["conv_id", "part"]).select("conv_id", (F.col("m") + F.col("shift")).alias("i"), "h1", "h2", "len")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, conversations): (conv_id, d, h1, h2, len) with d from 1 on, and (conv_id, n).

    Conversation c begins with the first h turns of c - c % 100 (as many as there are) and
    goes on with its own behind its first h; h is crc32 of c in digits, modulo 6.
    """
    own = materialised(numbered(turns), "numbered")[0]
    convs = own.groupBy("conv_id").agg(F.count("*").alias("n_own"))
    convs = convs.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % TAKEN).withColumn("base", F.col("conv_id") - F.col("conv_id") % OF)
    there = convs.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base"))
    convs = convs.join(there, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = materialised(convs.withColumn("n", F.col("taken") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))), "conversations")[0]
    hot = hot_keys(convs, ["conv_id"], "n_own")
    rest = salted_join(own, convs.select("conv_id", "h", "taken"), ["conv_id"], hot).where("i >= h")
    rest = rest.select("conv_id", (F.col("i") - F.col("h") + F.col("taken") + 1).alias("d"), "h1", "h2", "len")
    lent = own.where((F.col("conv_id") % OF == 0) & (F.col("i") < TAKEN)).withColumnRenamed("conv_id", "base")
    begin = convs.where("taken > 0").select("conv_id", "base", "taken").join(lent, "base").where("i < taken")
    rows = rest.unionByName(begin.select("conv_id", (F.col("i") + 1).alias("d"), "h1", "h2", "len"))
    return materialised(rows, "rebuilt")[0], convs.select("conv_id", "n")


def classes_of(rows: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(classes, members): (rep, w, n) for each distinct conversation; (rep, w, conv_id)."""
    sign = rows.groupBy("conv_id").agg(F.bit_xor(F.xxhash64("d", "h1", "h2")).alias("s1"), F.bit_xor(F.xxhash64("h2", "d", "h1", F.lit(1))).alias("s2"))
    none = convs.where("n = 0").select("conv_id", "n", F.lit(0).cast("long").alias("s1"), F.lit(0).cast("long").alias("s2"))
    signs = materialised(convs.where("n > 0").join(sign, "conv_id").select("conv_id", "n", "s1", "s2").unionByName(none), "signs")[0]
    keys = ["n", "s1", "s2"]
    classes = materialised(signs.groupBy(*keys).agg(F.min("conv_id").alias("rep"), F.count("*").alias("w")), "classes")[0]
    members = salted_join(signs, classes, keys, hot_keys(classes, keys, "w")).select("rep", "w", "conv_id")
    return classes.select("rep", "w", "n"), members


def member_hashes(members: DataFrame) -> DataFrame:
    """(rep, sha): SHA-256 of a class's conv_ids, ascending, with commas between."""
    single = members.where("w = 1").select("rep", F.sha2(F.col("conv_id").cast("string"), 256).alias("sha"))
    chunk = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    chunks = members.where("w > 1").groupBy("rep", F.shiftright("conv_id", CHUNK).alias("c")).agg(chunk.alias("ids"))

    def run(batches):
        import pyarrow as pa

        last, state = None, None
        for batch in batches:
            done = []
            for rep, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if rep != last or state is None:
                    if state is not None:
                        done.append((last, state.hexdigest()))
                    last, state = rep, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in done], pa.int64()), pa.array([s for _, s in done])], names=["rep", "sha"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.int64()), pa.array([state.hexdigest()])], names=["rep", "sha"])

    streams = chunks.repartition("rep").sortWithinPartitions("rep", "c").select("rep", "ids")
    return single.unionByName(streams.mapInArrow(lean(run), "rep long, sha string"))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def trie(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes over rows (conv_id, d, h1, h2, len) and convs (conv_id, n).

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.
    """
    classes, members = classes_of(rows, convs)
    whole = convs.agg(F.min("conv_id").alias("least"), F.count("*").alias("n")).first()
    root, total = whole.least or 0, whole.n
    long_ones = hot_keys(classes, ["rep"], "n")
    state = salted_join(rows.withColumnRenamed("conv_id", "rep"), classes, ["rep"], long_ones)
    live = materialised(state.withColumn("node", F.lit(root).cast("long")), "live")[0]
    #: for each depth: its nodes with several classes, and (rep, ...) of those that are alone from there on or end there
    nodes, chains, ended = [], [], [classes.where("n = 0").select(F.lit(root).cast("long").alias("conv"), F.lit(0).cast("long").alias("depth"), "rep")]
    depth, more = 0, True
    while more:
        depth += 1
        heads = live.where(F.col("d") == depth)
        keys = ["node", "h1", "h2"]
        groups = heads.groupBy(*keys).agg(F.min("rep").alias("child"), F.sum("w").alias("n_convs"), F.count("*").alias("classes"), F.first("len").alias("len"))
        groups = materialised(groups, "groups")[0]
        more = not groups.where("classes > 1").isEmpty()
        hot = hot_keys(groups, keys, "classes") if more else []
        child = salted_join(heads.select("rep", *keys), groups.select(*keys, "child", (F.col("classes") == 1).alias("alone")), keys, hot).select("rep", "child", "alone")
        after = salted_join(live, child, ["rep"], long_ones).select("rep", "w", "n", "d", "h1", "h2", "len", F.col("node").alias("parent"), F.col("child").alias("node"), "alone")
        after = materialised(after, "live")[0]
        nodes.append(groups.where("classes > 1").select(F.col("child").alias("conv"), F.lit(depth).cast("long").alias("depth"), F.col("node").alias("parent"), "n_convs", "len"))
        alone = after.where("alone")
        chains.append(alone.select("rep", "w", "n", "d", "len", "parent", F.lit(depth).cast("long").alias("start")))
        shared = after.where("NOT alone")
        ended.append(shared.where((F.col("d") == depth) & (F.col("n") == depth)).select(F.col("node").alias("conv"), F.lit(depth).cast("long").alias("depth"), "rep"))
        live = shared.where(F.col("d") > depth).select("rep", "w", "n", "d", "h1", "h2", "len", "node")
    return _finished(nodes, _union(chains), _union(ended), members, root, total)


def _finished(nodes: list[DataFrame], chain: DataFrame, ended: DataFrame, members: DataFrame, root: int, total: int) -> DataFrame:
    spark = chain.sparkSession
    saves = (F.col("w") - 1) * F.col("len")
    tops = chain.groupBy("rep", "parent", "start").agg(F.sum(saves).alias("saved"))
    tops = materialised(tops.select(F.col("rep").alias("conv"), F.col("start").alias("depth"), "parent", F.lit(1).cast("long").alias("n_leaves"), "saved"), "chains")[0]
    top = spark.range(1 if total else 0).select(F.lit(root).cast("long").alias("conv"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent"), F.lit(total).cast("long").alias("n_convs"), F.lit(0).cast("long").alias("len"))
    below, rolled = None, []
    for depth in range(len(nodes), -1, -1):
        children = tops.where(F.col("depth") == depth + 1).select("parent", "n_leaves", "saved")
        if below is not None:
            children = children.unionByName(below.select("parent", "n_leaves", "saved"))
        sums = children.groupBy(F.col("parent").alias("conv")).agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("below"))
        level = (nodes[depth - 1] if depth else top).join(sums, "conv", "left")
        level = level.select(
            "conv", "depth", "parent", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"),
            (F.coalesce("below", F.lit(0)) + (F.col("n_convs") - 1) * F.col("len")).alias("saved"),
        )
        below = materialised(level, "level")[0]
        rolled.append(below)

    def in_chain(rows: DataFrame, saved: Column) -> DataFrame:
        parent = F.when(F.col("d") == F.col("start"), F.col("parent")).otherwise(F.col("rep"))
        return rows.select(F.col("rep").alias("conv"), F.col("d").alias("depth"), parent.alias("parent"), F.col("w").alias("n_convs"), (F.col("d") < F.col("n")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), saved.cast("long").alias("saved"))

    downward = F.sum(saves).over(W.partitionBy("rep").orderBy(F.desc("d")).rowsBetween(W.unboundedPreceding, W.currentRow))
    every = _union([*rolled, in_chain(chain.where("w = 1"), F.lit(0)), in_chain(chain.where("w > 1"), downward)])
    ended = ended.unionByName(chain.where("d = n").select(F.col("rep").alias("conv"), F.col("d").alias("depth"), "rep"))
    hashes = ended.join(member_hashes(members), "rep").select("conv", "depth", "sha")
    out = every.join(hashes, ["conv", "depth"], "left")
    return out.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce("sha", F.lit(NOTHING)).alias("ends_sha256"),
    )


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations of turns (conv_id, turn, role, text)."""
    return trie(*rebuilt(turns))


#: The same nodes in DuckDB SQL. crc32 goes by its table of 256 remainders.
SQL = """
WITH remainders AS (
  SELECT list(r ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda v, k: xor(v >> 1, 3988292384 * (v & 1))) AS r FROM (SELECT unnest(range(256)) AS b))
), own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS i
  FROM conversations WHERE conv_id IS NOT NULL
), counted AS (
  SELECT conv_id, count(*) AS n_own, conv_id - conv_id % 100 AS base FROM own GROUP BY conv_id
), crc AS (
  SELECT conv_id, n_own, base, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda s, b: xor(s >> 8, t[(xor(s, b) & 255) + 1]))) % 6 AS h
  FROM counted, remainders
), convs AS (
  SELECT a.conv_id, a.h, a.base, least(a.h, coalesce(b.n_own, 0)) AS taken FROM crc a LEFT JOIN counted b ON b.conv_id = a.base
), turns AS (
  SELECT conv_id, i - h + taken + 1 AS d, role, text FROM own JOIN convs USING (conv_id) WHERE i >= h
  UNION ALL
  SELECT c.conv_id, o.i + 1, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.base AND o.i < c.taken
), paths AS (
  SELECT conv_id, d, length(text) AS len,
    md5(string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (PARTITION BY conv_id ORDER BY d ROWS UNBOUNDED PRECEDING)) AS key
  FROM turns
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs
), nodes AS (
  SELECT key, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(len) AS len FROM paths GROUP BY key, d
), links AS (
  SELECT DISTINCT a.key AS parent, b.key AS child, b.d FROM paths a JOIN paths b ON a.conv_id = b.conv_id AND b.d = a.d + 1
), widths AS (
  SELECT parent, count(*) AS n_children FROM links GROUP BY parent
), under AS (
  SELECT DISTINCT a.key AS top, b.key FROM paths a JOIN paths b ON a.conv_id = b.conv_id AND b.d >= a.d
), sums AS (
  SELECT top, count(*) FILTER (WHERE w.parent IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.len) AS saved
  FROM under u JOIN nodes n ON n.key = u.key LEFT JOIN widths w ON w.parent = u.key GROUP BY top
), ends AS (
  SELECT key, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, key, d, max(d) OVER (PARTITION BY conv_id) AS n FROM paths) WHERE d = n GROUP BY key
)
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs, coalesce(w.n_children, 0)::BIGINT AS n_children,
  s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes n LEFT JOIN links l ON l.child = n.key LEFT JOIN nodes p ON p.key = l.parent
LEFT JOIN widths w ON w.parent = n.key JOIN sums s ON s.top = n.key LEFT JOIN ends e ON e.key = n.key
"""
