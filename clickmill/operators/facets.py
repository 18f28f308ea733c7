"""Distinct values of several columns in one narrow shuffle."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def facets(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], *aggregates: Column
) -> DataFrame:
    """One row per key, column name (`facet`) and distinct non-null `value`, with the aggregates.

    The rows are grouped before and after the shuffle by key and value together, so neither a hot
    key nor a hot value gathers in one task, and counting the result per key is exact. Against
    several COUNT(DISTINCT) in one aggregate, the copied rows carry no buffers of other aggregates.
    """
    rest = [c for c in df.columns if c not in columns]
    texts = [F.col(c).cast("string").alias(c) for c in columns]
    return (
        df.select(*rest, *texts)
        .unpivot(rest, list(columns), "facet", "value")
        .where(F.col("value").isNotNull())
        .groupBy(*keys, "facet", "value")
        .agg(*aggregates)
    )
