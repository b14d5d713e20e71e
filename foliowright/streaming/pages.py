"""Row-local page steps over a stream of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliowright.operators import headers

SCHEMA = "volume string, pos bigint, index bigint, global_index bigint, markdown string, header string"


def read_stream(spark: SparkSession, path: str, files: int | None = None) -> DataFrame:
    """Pages as JSON lines, as they arrive in a folder; at most so many files at a time, if a number is given."""
    reader = spark.readStream.schema(SCHEMA)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).json(path)


def clean(pages: DataFrame) -> DataFrame:
    """Headers out and footers off; joining words needs whole volumes and is a batch step."""
    rows = headers.extract_headers(pages)
    return rows.withColumn("markdown", headers.remove_footer(F.col("markdown")))
