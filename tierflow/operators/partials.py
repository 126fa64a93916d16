"""Conditional aggregates as states that can be added up and taken back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.functions.scalar import as_col, nz
from tierflow.operators.aggregate import Metric

#: Rows of a key; a key without rows left is gone.
ROWS = "_rows"


def _names(metric: Metric) -> tuple[str, str]:
    return f"{metric.name}_n", f"{metric.name}_total"


def partial_states(df: DataFrame, keys: Sequence[str], metrics: Sequence[Metric], sign: int = 1) -> DataFrame:
    """One state per key: rows, and per metric the rows it takes and their total.

    With `sign=-1` the states take the rows of `df` back.
    """
    made = [(F.count(F.lit(1)) * sign).alias(ROWS)]
    for m in metrics:
        n, total = _names(m)
        made.append((F.count_if(m.when) * sign).alias(n))
        if m.kind != "count":
            amount = F.when(m.when, nz(as_col(m.value)))
            if m.scale is None:
                made.append((F.coalesce(F.sum(amount), F.lit(0.0)) * sign).alias(total))
            else:
                exact = F.sum(amount.cast(f"decimal(18,{m.scale})")) * F.lit(sign)
                made.append(F.coalesce(exact, F.lit(0)).cast(f"decimal(38,{m.scale})").alias(total))
    return df.groupBy(*keys).agg(*made)


def merge_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States of several batches as one per key. Keys whose rows are all taken back stay, as zeros."""
    kinds = dict(states.dtypes)
    added = [F.sum(c).cast(kinds[c]).alias(c) for c in states.columns if c not in keys]
    return states.groupBy(*keys).agg(*added)


def finished(states: DataFrame, keys: Sequence[str], metrics: Sequence[Metric]) -> DataFrame:
    """What `conditional_aggs` gives over the rows that the merged states stand for."""
    made = []
    for m in metrics:
        n, total = _names(m)
        if m.kind == "count":
            made.append(F.col(n).alias(m.name))
            continue
        value = F.col(total).cast("double")
        if m.kind == "avg":
            value = value / F.col(n)
        made.append(F.when(F.col(n) > 0, value).otherwise(0.0).alias(m.name))
    return states.filter(F.col(ROWS) > 0).select(*keys, *made)
