"""Aggregate views kept by deltas: a batch reads its own rows, never those of earlier ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tierflow.operators.aggregate import Metric
from tierflow.operators.partials import finished, merge_states, partial_states
from tierflow.streaming.runs import RunLog


class DeltaView:
    """Conditional metrics per key, kept under `root` as a log of partial states.

    Each batch adds the states of its rows and takes back those of the rows it retracts, so a
    corrected row is a retraction of the old and an addition of the new one. Metrics with a
    `scale` are exact; totals of doubles may differ from a rebuild in the last digits.
    """

    def __init__(
        self, spark: SparkSession, root: str, keys: Sequence[str], metrics: Sequence[Metric], fanout: int = 8
    ):
        self.keys, self.metrics = list(keys), list(metrics)
        self.log = RunLog(spark, root, lambda rows: merge_states(rows, self.keys), fanout)

    def through(self) -> int | None:
        """The last batch that the view holds."""
        return self.log.through()

    def apply(self, batch_id: int, added: DataFrame, retracted: DataFrame | None = None) -> bool:
        """Bring the view forward by one batch; False if it holds the batch already."""
        states = partial_states(added, self.keys, self.metrics)
        if retracted is not None:
            back = partial_states(retracted, self.keys, self.metrics, sign=-1)
            states = merge_states(states.unionByName(back), self.keys)
        return self.log.apply(batch_id, states)

    def rows(self) -> DataFrame | None:
        """The view; None before the first batch."""
        states = self.log.rows()
        return None if states is None else finished(self.log.merge(states), self.keys, self.metrics)
