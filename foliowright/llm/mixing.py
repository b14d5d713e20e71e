"""Mixing sources to target weights by iterative proportional fitting.

Native: DataFrame functions only. Documents are summed to cells (source, language,
topic) of tokens; the cells' weights are raked, one margin after the other, until every
sum of a margin is within TOLERANCE of its target (relatively); a document is kept with the probability that its
cell's weight asks for, scaled so that the largest is one. Only the cells are iterated;
each margin update is an aggregation and a join, so cells may be many; state between
rounds is a table in the shared folder. Up to ALONE cells (they are counted) are raked by
one task, each update a window over it and AT_ONCE rounds a plan: without exchanges and
broadcasts, which the driver would plan and hold anew for each update.

Targets are given, or tempered: a margin's own shares of tokens to the power ALPHA. The
draw is a hash of the id, so that runs repeat and repeated rows share their fate.

Targets that a margin's table lacks are 0, and cells of such values get the weight 0 and
the probability 0. A value whose cells all have the weight 0 can't reach its target: the
target is given up and the others are met among themselves. Targets that contradict each
other never meet; raking then ends after MOST rounds, with a warning that names the rest.

Topics are a column of the caller's, or by default told by strings that texts hold.
A null source, language or topic is the value `?`; a null text has no tokens (a cell of no
tokens keeps its documents with probability one); a null id is drawn as an empty string.
"""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliowright.llm.common import apart, materialised, release, remove_path

MARGINS = ("source", "lang", "topic")
ALPHA, TOLERANCE, MOST = 0.85, 1e-9, 50
#: cells are joined to documents by broadcast up to this number, by an exchange beyond it
BROADCAST = 100_000
#: up to so many cells are raked by one task, so many rounds a plan
ALONE, AT_ONCE = 10_000, 5
SEED = "mix"
#: topic -> a string that its documents hold; the first that fits, else `prose`
TOPICS = (("legal", "Licensed under"), ("tabular", " | "), ("contact", "@"), ("shouting", "!!"))
_SPACE = r"[\x20\x09-\x0D]"


def n_words(text: Column) -> Column:
    ends = text.rlike(rf"^{_SPACE}").cast("int") + text.rlike(rf"{_SPACE}\z").cast("int")
    return F.when(F.coalesce(text, F.lit("")) == "", 0).otherwise(F.size(F.split(text, rf"{_SPACE}+", -1)) - ends).cast("long")


def topic(text: Column) -> Column:
    out = F.lit("prose")
    for name, held in reversed(TOPICS):
        out = F.when(text.contains(held), name).otherwise(out)
    return out


def described(docs: DataFrame, key: str, topics: Column | None = None) -> DataFrame:
    """key, _source, _lang, _topic and _tokens of every document."""
    known = lambda c: F.coalesce(c.cast("string"), F.lit("?"))
    about = topic(F.col("text")) if topics is None else known(topics)
    return docs.select(F.col(key), known(F.col("source")).alias("_source"), known(F.col("lang")).alias("_lang"), about.alias("_topic"), n_words(F.col("text")).alias("_tokens"))


def _factor(goal: Column, own: Column) -> Column:
    """What a sum is multiplied by to meet its goal; 0 without one."""
    return F.coalesce(F.try_divide(F.coalesce(goal, F.lit(0.0)), own), F.lit(0.0))


def _round(out: DataFrame, goal: dict[str, DataFrame]) -> DataFrame:
    for m in MARGINS:
        factor = out.groupBy(m).agg(F.sum("w").alias("sum")).join(goal[m], m, "left").select(m, _factor(F.col("goal"), F.col("sum")).alias("factor"))
        out = out.join(factor, m).select(*MARGINS, "tokens", (F.col("w") * F.col("factor")).alias("w"))
    return out


def _sum(m: str, w: str) -> Column:
    return F.sum(w).over(W.partitionBy(m))


def _rounds_alone(out: DataFrame, n: int) -> DataFrame:
    """n times _round() of cells in one partition, with their goals: w after each as _w0, _w1 and so on."""
    for i in range(n):
        out = out.withColumn(f"_w{i}", F.col(f"_w{i - 1}" if i else "w"))
        for m in MARGINS:
            out = out.withColumn(f"_w{i}", F.col(f"_w{i}") * _factor(F.col(f"_goal_{m}"), _sum(m, f"_w{i}")))
    return out.drop("w")


def _off_alone(out: DataFrame, n: int) -> list[float]:
    """How far the margins are off after each of n rounds."""
    far = lambda m, w: F.when((_sum(m, w) > 0) & (F.col(f"_goal_{m}") > 0), F.abs(_sum(m, w) / F.col(f"_goal_{m}") - 1))
    each = out.select(*[far(m, f"_w{i}").alias(f"{m}{i}") for i in range(n) for m in MARGINS[:-1]])
    return list(each.agg(*[F.coalesce(F.greatest(*[F.max(f"{m}{i}") for m in MARGINS[:-1]]), F.lit(0.0)) for i in range(n)]).first())


def rake(cells: DataFrame, targets: dict[str, DataFrame] | None = None, most: int = MOST, alpha: float = ALPHA, tolerance: float = TOLERANCE, broadcast: int = BROADCAST) -> DataFrame:
    """Cells (margins, tokens) with probability.

    targets: by margin a table (value, share); margins without one are tempered.
    """
    spark = cells.sparkSession
    cells, path = materialised(cells.where("tokens > 0").withColumn("w", F.col("tokens").cast("double")), "cells")
    goal, paths = {}, []
    for m in MARGINS:
        if targets and m in targets:
            raw = targets[m].groupBy(F.col("value").alias(m)).agg(F.sum("share").alias("goal"))
        else:
            raw = cells.groupBy(m).agg(F.pow(F.sum("w"), F.lit(alpha)).alias("goal"))
        raw, at = materialised(raw, f"goal-{m}")
        paths.append(at)
        goal[m] = raw.select(m, (F.col("goal") / F.lit(raw.agg(F.sum("goal")).first()[0] or 1.0)).alias("goal"))
    n, rest, done = cells.count(), None, 0
    alone = n <= min(ALONE, broadcast)
    out = cells
    if alone:
        for m in MARGINS:
            out = out.join(goal[m].withColumnRenamed("goal", f"_goal_{m}"), m, "left")
        out = out.coalesce(1)
    while done < most:
        once = min(AT_ONCE, most - done) if alone else 1
        # a table's size is known when the next round is planned; a checkpoint would keep an estimate that each join squares
        out, new = materialised(_rounds_alone(out, once) if alone else _round(out, goal), "cells")
        remove_path(spark, path)
        path = new
        release(spark)
        done += once
        # how far the margins are off that were not the last one met
        if alone:
            out = out.coalesce(1)
            each = _off_alone(out, once)
            last = next((i for i, x in enumerate(each) if x <= tolerance), once - 1)
            rest = each[last]
            out = out.withColumnRenamed(f"_w{last}", "w").select(*MARGINS, "tokens", *[f"_goal_{m}" for m in MARGINS], "w")
        else:
            off = [out.groupBy(m).agg(F.sum("w").alias("sum")).join(goal[m], m).where("sum > 0 AND goal > 0").select(F.abs(F.col("sum") / F.col("goal") - 1).alias("off")) for m in MARGINS[:-1]]
            rest = reduce(DataFrame.unionByName, off).agg(F.coalesce(F.max("off"), F.lit(0.0))).first()[0]
        if rest <= tolerance:
            break
    else:
        warnings.warn(f"margins are up to {rest:.3g} off their targets after {most} rounds", stacklevel=2)
    largest = out.agg(F.max(F.col("w") / F.col("tokens"))).first()[0]
    for at in paths:
        remove_path(spark, at)
    out = out.select(*MARGINS, (F.col("w") / F.col("tokens") / F.lit(largest or 1.0)).alias("probability"))
    return F.broadcast(out) if n <= broadcast else out


def draw(key: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from a hash of the key."""
    digits = F.substr(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary")), F.lit(1), F.lit(8))
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 32))


def weighed(docs: DataFrame, key: str = "doc_id", targets: dict[str, DataFrame] | None = None, topics: Column | None = None, **how) -> DataFrame:
    """key, _source, _lang, _topic, _tokens, _probability and _kept of every document; other columns are not looked at."""
    rows = described(docs, key, topics)
    columns = [F.col(f"_{m}").alias(m) for m in MARGINS]
    cells = rows.groupBy(*columns).agg(F.sum("_tokens").alias("tokens"))
    found = rake(cells, targets, **how).select(*[F.col(m).alias(f"_{m}") for m in MARGINS], F.col("probability").alias("_found"))
    out = rows.join(found, [f"_{m}" for m in MARGINS], "left").withColumn("_probability", F.coalesce("_found", F.lit(1.0))).drop("_found")
    out = out.withColumn("_kept", draw(F.col(key)) < F.col("_probability"))
    return out.select(key, "_source", "_lang", "_topic", "_tokens", "_probability", "_kept")


def mix(docs: DataFrame, key: str = "doc_id", targets: dict[str, DataFrame] | None = None, topics: Column | None = None, **how) -> DataFrame:
    """The documents drawn, with the columns of docs."""
    own = docs if topics is None else docs.withColumn("_topics_given", topics)
    rows, names = apart(own, key, "text", "source", "lang", "_topics_given")
    about = topic(F.col("text")) if topics is None else F.coalesce(F.col("_topics_given").cast("string"), F.lit("?"))
    cell = {m: F.coalesce(F.col(m).cast("string"), F.lit("?")) for m in ("source", "lang")} | {"topic": about}
    cells = rows.groupBy(*[c.alias(m) for m, c in cell.items()]).agg(F.sum(n_words(F.col("text"))).alias("tokens"))
    found = rake(cells, targets, **how).select(*[F.col(m).alias(f"_cell_{m}") for m in MARGINS], "probability")
    keyed = rows.select("*", *[c.alias(f"_of_{m}") for m, c in cell.items()])
    same = reduce(Column.__and__, [F.col(f"_of_{m}") == F.col(f"_cell_{m}") for m in MARGINS])
    kept = keyed.join(found, same, "left").where(draw(F.col(key)) < F.coalesce("probability", F.lit(1.0)))
    out = kept.select(*rows.columns).toDF(*names)
    return out if topics is None else out.drop("_topics_given")


def sql(rounds: int = 20, alpha: float = ALPHA, documents: str = "documents") -> str:
    """weighed() of the documents with tempered targets, in DuckDB SQL."""
    cases = " ".join(f"WHEN contains(text, '{held}') THEN '{name}'" for name, held in TOPICS)
    words = rf"len(list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}+'), lambda w: w <> ''))"
    steps = [
        f"rows AS (SELECT *, coalesce(source, '?') AS s_source, coalesce(lang, '?') AS s_lang, CASE {cases} ELSE 'prose' END AS s_topic, {words}::BIGINT AS tokens FROM {documents})",
        "w0 AS (SELECT s_source, s_lang, s_topic, sum(tokens)::DOUBLE AS tokens, sum(tokens)::DOUBLE AS w FROM rows GROUP BY ALL HAVING sum(tokens) > 0)",
    ]
    for m in MARGINS:
        steps.append(f"goal_{m} AS (SELECT s_{m}, goal / sum(goal) OVER () AS goal FROM (SELECT s_{m}, pow(sum(w), {alpha}) AS goal FROM w0 GROUP BY s_{m}))")
    last = "w0"
    for i in range(rounds * len(MARGINS)):
        m = MARGINS[i % len(MARGINS)]
        steps.append(f"w{i + 1} AS MATERIALIZED (SELECT s_source, s_lang, s_topic, tokens, coalesce(w * goal / nullif(sum(w) OVER (PARTITION BY s_{m}), 0), 0) AS w FROM {last} JOIN goal_{m} USING (s_{m}))")
        last = f"w{i + 1}"
    steps.append(f"p AS (SELECT s_source, s_lang, s_topic, w / tokens / max(w / tokens) OVER () AS probability FROM {last})")
    steps.append(
        f"mixed AS (SELECT rows.*, coalesce(probability, 1) AS p, ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296 < coalesce(probability, 1) AS kept"
        " FROM rows LEFT JOIN p USING (s_source, s_lang, s_topic))"
    )
    return "WITH " + ",\n".join(steps) + "\nSELECT doc_id, s_source AS source, s_lang AS lang, s_topic AS topic, tokens AS n_tokens, round(p, 6) AS probability, kept FROM mixed"
