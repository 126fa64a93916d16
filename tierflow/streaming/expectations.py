"""Row expectations on a stream, with their counts per micro-batch in a table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierflow.operators.quality import expect, holds
from tierflow.sources import storage

METRICS = "batch_id bigint, expectation string, action string, n_rows bigint, n_violations bigint"


def expecting_stream(
    stream: DataFrame,
    table: str,
    metrics: str,
    checkpoint: str,
    drop: Mapping[str, str] | None = None,
    keep: Mapping[str, str] | None = None,
    fail: Mapping[str, str] | None = None,
) -> None:
    """Append what is new in the stream to a table, under named expectations.

    Rows that violate a `drop` rule are left out, those of a `keep` rule stay; a row that
    violates a `fail` rule stops the batch before it is committed, so the table holds none of its
    rows. All rules see the rows as they arrive. They are counted while the batch is
    written, and the counts stand in `metrics` before the next batch begins. A batch that is
    repeated replaces what it had written without a commit.
    """
    rules = [(n, p, a) for a, own in (("drop", drop), ("keep", keep), ("fail", fail)) for n, p in (own or {}).items()]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        target, noted = f"{table}/batch_id={batch_id}", f"{metrics}/batch_id={batch_id}"
        if storage.is_complete(spark, target) and storage.is_complete(spark, noted):
            return
        seen = Observation()
        counts = [F.count_if(~holds(p)).alias(f"bad_{k}") for k, (_, p, _) in enumerate(rules)]
        rows = batch.observe(seen, F.count(F.lit(1)).alias("n_rows"), *counts)
        for name, predicate, action in rules:
            rows = expect(rows, name, predicate, action)
        rows.write.mode("overwrite").parquet(target)
        got = seen.get
        lines = [(batch_id, n, a, got["n_rows"], got[f"bad_{k}"]) for k, (n, _, a) in enumerate(rules)]
        made = spark.createDataFrame(lines, METRICS).drop("batch_id").coalesce(1)
        made.write.mode("overwrite").parquet(noted)

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _batches(spark: SparkSession, root: str) -> DataFrame | None:
    done = storage.committed(spark, root, "batch_id")
    if not done:
        return None
    return spark.read.option("basePath", root).parquet(*[f"{root}/batch_id={n}" for n in done])


def expected_rows(spark: SparkSession, table: str) -> DataFrame:
    """The rows of the committed batches."""
    rows = _batches(spark, table)
    if rows is None:
        raise ValueError(f"no committed batch in {table}")
    return rows.drop("batch_id")


def expectation_counts(spark: SparkSession, metrics: str) -> DataFrame:
    """batch_id, expectation, action, n_rows, n_violations of every committed batch."""
    rows = _batches(spark, metrics)
    if rows is None:
        return spark.createDataFrame([], METRICS)
    return rows.select(F.col("batch_id").cast("bigint"), "expectation", "action", "n_rows", "n_violations")
