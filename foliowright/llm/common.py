"""Reading tables, shared storage and per-worker caches."""

from __future__ import annotations

import ctypes
import functools
import gc
import re
import sys
import tempfile
import types
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def apart(docs: DataFrame, *used: str) -> tuple[DataFrame, list[str]]:
    """docs with all columns but those used renamed, so that none clashes with an operator's own, and the names given."""
    return docs.toDF(*[c if c in used else f"_extra_{i}" for i, c in enumerate(docs.columns)]), docs.columns


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's spark.checkpoint.dir.

    Where the session names none, a temporary one is set on one machine; on a cluster, whose
    executors wouldn't see it, that is an error.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not named and not re.match(r"local(\[|$)", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="foliowright-"))
    return named or sc._jsc.sc().getCheckpointDir().get()


def checkpointed(df: DataFrame) -> DataFrame:
    """Writes df to the shared folder and cuts its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def new_path(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def materialised(df: DataFrame, what: str, by: str | None = None) -> tuple[DataFrame, str]:
    """df written as Parquet to the shared folder (in folders by a column, if one is named) and read again, and its path.

    Smaller than a checkpoint where columns repeat. Shuffle files behind df are given up.
    """
    spark, path = df.sparkSession, new_path(df.sparkSession, what)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    # without columns in folders the schema is df's, and no job has to look for it
    read = spark.read if by else spark.read.schema(df.schema)
    del df
    return read.parquet(path), path


#: Rows of a few numbers that are no work to deal out: one task reads them (2 MB), or they are sent to all.
FEW = 1 << 17


def gathered(df: DataFrame) -> DataFrame:
    """A written table of few columns, to be read by one task for each FEW of its rows; what one task reads needs no exchange."""
    return df.coalesce(max(1, -(-df.count() // FEW)))


def release(spark: SparkSession) -> None:
    """Has the driver give up what nothing refers to any more, so that its shuffle files go.

    Spark's listeners refer to the query that ended last until another one ends, so an empty
    one without a shuffle of its own comes in between.
    """
    spark.range(0, 1, 1, 1).write.format("noop").mode("overwrite").save()
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def remove_path(spark: SparkSession, path: str) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).delete(p, True)


def lean(run):
    """run, an iterator over batches, after which the worker gives the memory that it no longer uses back to the system."""

    @functools.wraps(run)
    def out(batches):
        try:
            yield from run(batches)
        finally:
            trim()

    return out


def trim() -> None:
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
    if give_back:
        give_back(0)


def worker_state(name: str) -> dict:
    """A dict that lives as long as the Python worker, across tasks."""
    holder = sys.modules.setdefault("_foliowright_worker", types.ModuleType("_foliowright_worker"))
    return holder.__dict__.setdefault(name, {})


def text_bytes(column) -> list[bytes]:
    """The UTF-8 bytes of an Arrow string column; null counts as empty."""
    import pyarrow as pa

    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


#: A key is hot if it has more than one row in this many; so no more keys than this are ever hot.
HOT = 1000
SALT = 64


def hot_keys(counts: DataFrame, keys: list[str], n: str, least: int = 1000) -> list[tuple]:
    """The keys of counts (keys, n) that have more than one in HOT of all rows, and more than `least`; at most HOT."""
    total = counts.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0]
    return [tuple(r) for r in counts.where(F.col(n) > max(total // HOT, least)).select(*keys).collect()]


def is_hot(keys: list[str], hot: list[tuple]) -> Column:
    if not hot:
        return F.lit(False)
    given = F.xxhash64(*keys)
    # a key of the same hash would only be salted too
    return given.isin(*[int(x) for x in _hashes(keys, hot)])


def _hashes(keys: list[str], hot: list[tuple]) -> list[int]:
    spark = SparkSession.active()
    rows = spark.createDataFrame(hot, ", ".join(f"`{k}` long" for k in keys))
    return [r[0] for r in rows.select(F.xxhash64(*keys)).collect()]


def salted_join(many: DataFrame, few: DataFrame, keys: list[str], hot: list[tuple], how: str = "inner") -> DataFrame:
    """many joined with few by keys; rows of many with a hot key are dealt over SALT tasks and few's rows copied to these."""
    if not hot:
        return many.join(few, keys, how)
    own = many.withColumn("_salt", F.when(is_hot(keys, hot), F.pmod(F.spark_partition_id(), F.lit(SALT))).otherwise(0))
    other = few.withColumn("_salt", F.explode(F.when(is_hot(keys, hot), F.sequence(F.lit(0), F.lit(SALT - 1))).otherwise(F.array(F.lit(0)))))
    return own.join(other, [*keys, "_salt"], how).drop("_salt")


def slices(batches, rows: int = 512):
    """Record batches of few rows, so that what is made of them in Python stays small."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def in_chunks(texts: list[bytes], limit: int = 1 << 20):
    """Consecutive (first, last + 1) of about limit bytes; one text may exceed it."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size >= limit:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)
