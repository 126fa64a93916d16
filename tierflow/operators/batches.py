"""Arrow-batch extension point for logic that built-in expressions cannot state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def map_batches(
    df: DataFrame,
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: T.StructType | str,
    partitions: int | None = None,
) -> DataFrame:
    """Apply `fn` to every Arrow batch; batches are bounded by
    spark.sql.execution.arrow.maxRecordsPerBatch, never a whole partition."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    source = df if partitions is None else df.repartition(partitions)
    return source.mapInPandas(each, schema)
