"""Type-1 upserts and deletes from a stream, kept as a log of runs.

Each micro-batch writes only its own newest row per key; deletes stay as rows that carry their
sequence number, so a delete that arrives before the insert it follows still wins. The current
state is the newest row per key over the live runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.operators.latest import latest_by_key
from tierflow.sources import storage
from tierflow.streaming.runs import RunLog

#: Marks the rows that delete their key. At the same place in the order a delete wins.
DELETED = "_deleted"


def upsert_log(
    spark: SparkSession, root: str, keys: Sequence[str], order: Sequence[str], tie: Sequence[str], fanout: int = 8
) -> RunLog:
    return RunLog(spark, root, lambda rows: latest_by_key(rows, keys, [*order, DELETED], tie), fanout)


def apply_batches(stream: DataFrame, log: RunLog, checkpoint: str, prepare) -> None:
    """Apply everything that is new in the stream to a log, then return.

    `prepare(batch, batch_id)` gives the rows that a micro-batch adds.
    """
    spark = stream.sparkSession
    if not storage.exists(spark, f"{checkpoint}/metadata") and log.through() is not None:
        raise ValueError("the table has applied batches but the checkpoint is new")

    def merge(batch: DataFrame, batch_id: int) -> None:
        own = RunLog(batch.sparkSession, log.root, log.merge, log.fanout, log.layout)
        through = own.through()
        if through is None or batch_id > through:
            own.apply(batch_id, prepare(batch, batch_id))

    query = (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def upsert_stream(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[str],
    tie: Sequence[str],
    deletes: str | None = None,
    fanout: int = 8,
) -> None:
    """Apply everything that is new in the stream, then return. Rows for which the condition
    `deletes` holds delete their key as of their place in the order."""
    log = upsert_log(stream.sparkSession, root, keys, order, tie, fanout)
    gone = F.lit(False) if deletes is None else F.coalesce(F.expr(deletes), F.lit(False))
    apply_batches(
        stream, log, checkpoint, lambda batch, _: log.merge(batch.withColumn(DELETED, gone))
    )


def current_rows(
    spark: SparkSession,
    root: str,
    keys: Sequence[str],
    order: Sequence[str],
    tie: Sequence[str],
) -> DataFrame:
    """One row per key that is not deleted: the newest over all batches."""
    log = upsert_log(spark, root, keys, order, tie)
    rows = log.rows()
    if rows is None:
        raise ValueError(f"nothing has been applied to {root}")
    return log.merge(rows).filter(~F.col(DELETED)).drop(DELETED)


def fold(
    spark: SparkSession,
    root: str,
    keys: Sequence[str],
    order: Sequence[str],
    tie: Sequence[str],
) -> None:
    """Bring all runs together into one. Deletes stay, for rows that are yet to arrive."""
    upsert_log(spark, root, keys, order, tie).fold()
