"""Set operations that combine equal rows before they are shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def set_except(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of `left` that do not occur in `right`; nulls compare equal.

    One aggregate over the tagged union: copies of a row collapse on the map side,
    where an anti-join would send every copy to the same task.
    """
    names = left.columns
    tagged = left.withColumn("_in_right", F.lit(False)).unionByName(
        right.select(*names).withColumn("_in_right", F.lit(True))
    )
    seen = tagged.groupBy(*names).agg(F.bool_or("_in_right").alias("_in_right"))
    return seen.filter(~F.col("_in_right")).drop("_in_right")


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows that occur on one side only, by one aggregate; nulls compare equal."""
    names = left.columns
    tagged = left.withColumn("_in_right", F.lit(False)).unionByName(
        right.select(*names).withColumn("_in_right", F.lit(True))
    )
    sides = [F.bool_or("_in_right").alias("_any"), F.bool_and("_in_right").alias("_all")]
    return tagged.groupBy(*names).agg(*sides).filter(F.col("_any") == F.col("_all")).drop("_any", "_all")


def union_all_by_name(parts: Sequence[DataFrame], fill_missing: bool = False) -> DataFrame:
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part, allowMissingColumns=fill_missing)
    return first
