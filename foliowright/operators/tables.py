"""Putting small tables together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def side_by_side(**columns: DataFrame) -> DataFrame:
    """One-row tables of one column each as one row: a union and an aggregate, no product."""
    out = None
    for name, table in columns.items():
        table = table.toDF(name)
        out = table if out is None else out.unionByName(table, allowMissingColumns=True)
    return out.agg(*[F.first(c, ignorenulls=True).alias(c) for c in columns])
