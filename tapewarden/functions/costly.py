"""Evaluating costly expressions once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, name: str, costly: Column) -> DataFrame:
    """Add a column whose expression runs once per row, whatever is filtered on it later.

    A filter on an ordinary column is pushed below the projection and repeats
    its expression there, once per mention: a JSON text would be parsed again
    for every check of a trade. A generator's output is never substituted.
    """
    return df.select("*", F.explode_outer(F.array(costly)).alias(name))
