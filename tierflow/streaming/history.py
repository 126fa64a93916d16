"""Type-2 history from a stream of changes that may arrive late and in any order.

The interval table is a log of runs. A micro-batch reads the intervals of the keys it touches, works
out where they now end, and writes the intervals that are new or end elsewhere: a
late event splits an interval, a delete closes one and begins none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.operators.latest import HEAVY_ROWS, latest_by_key, scd2_history
from tierflow.streaming.runs import RunLog
from tierflow.streaming.upsert import DELETED, apply_batches

#: Batch that wrote an interval; the newest one counts.
VERSION = "_version"
BUCKET = "_bucket"
_OWN = (DELETED, VERSION, BUCKET)


def history_log(
    spark: SparkSession, root: str, keys: Sequence[str], seq: str, tie: Sequence[str], fanout: int = 8
) -> RunLog:
    """Intervals by key, `seq` and `tie`; files are parted by a hash of the key."""
    same = [*keys, seq, *tie]
    return RunLog(spark, root, lambda rows: latest_by_key(rows, same, [VERSION], []), fanout, [BUCKET])


def apply_history(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    keys: Sequence[str],
    seq: str,
    tie: Sequence[str],
    deletes: str | None = None,
    start: str = "__START_AT",
    end: str = "__END_AT",
    buckets: int = 64,
    fanout: int = 8,
    heavy_rows: int = HEAVY_ROWS,
) -> None:
    """Apply everything that is new in the stream of changes, then return.

    Changes of one key with the same `seq` and `tie` are one change, of which the one that
    arrives last counts (in one batch, the greatest row). Null keys are a key. Only the
    buckets that hold touched keys are read, and of these only the touched keys; only changed intervals
    are written.
    """
    spark = stream.sparkSession
    log = history_log(spark, root, keys, seq, tie, fanout)
    gone = F.lit(False) if deletes is None else F.coalesce(F.expr(deletes), F.lit(False))
    same = [*keys, seq, *tie]

    def changed(batch: DataFrame, batch_id: int) -> DataFrame:
        own = RunLog(batch.sparkSession, root, log.merge, fanout, [BUCKET])
        bucket = F.pmod(F.xxhash64(F.struct(*keys)), F.lit(buckets)).cast("int")
        marked = batch.withColumns({DELETED: gone, BUCKET: bucket})
        others = [c for c in marked.columns if c not in same]
        arrived = latest_by_key(marked, same, others, []).withColumn(VERSION, F.lit(batch_id).cast("bigint"))
        known = own.rows()
        if known is None:
            before = None
            rows = arrived
        else:
            held = [r[BUCKET] for r in marked.select(BUCKET).distinct().collect()]  # at most `buckets`
            touched = marked.select(F.struct(*keys).alias("_touched")).distinct()
            near = known.filter(F.col(BUCKET).isin(held)).withColumn("_touched", F.struct(*keys))
            before = own.merge(near.join(touched, "_touched", "left_semi").drop("_touched"))
            rows = own.merge(
                before.drop(start).withColumnRenamed(end, "_end").unionByName(arrived, allowMissingColumns=True)
            )
        ended = scd2_history(rows, keys, seq, tie, start, end, heavy_rows)
        if before is None:
            return ended
        moved = (F.col(VERSION) == batch_id) | ~F.col(end).eqNullSafe(F.col("_end"))
        return ended.filter(moved).drop("_end").withColumn(VERSION, F.lit(batch_id).cast("bigint"))

    apply_batches(stream, log, checkpoint, changed)


def history_rows(
    spark: SparkSession, root: str, keys: Sequence[str], seq: str, tie: Sequence[str]
) -> DataFrame:
    """Every interval that is not a delete, as `scd2_history` over all changes would give it."""
    log = history_log(spark, root, keys, seq, tie)
    rows = log.rows()
    if rows is None:
        raise ValueError(f"nothing has been applied to {root}")
    return log.merge(rows).filter(~F.col(DELETED)).drop(*_OWN)
