"""An ingested table as a stream of its committed batches, and several flows into one table.

Every landed batch leaves a small note once it is complete. A file stream over the notes
tells which batches are new, its checkpoint remembers them, and the rows are read from the
batch folders: unfinished batches are never seen, finished ones once.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tierflow.operators.sets import union_all_by_name
from tierflow.sources import storage
from tierflow.streaming.append import ANY_AGE
from tierflow.streaming.ingest import committed_batches, read_ingested

NOTES = "_committed"
NOTE_SCHEMA = "batch_id bigint"


def note_batches(spark: SparkSession, table: str, flow: str = "main") -> str:
    """Note the complete batches that have no note yet; returns the folder of the notes."""
    folder = f"{table}/{NOTES}/{flow}"
    storage.make_folder(spark, folder)
    noted = set(storage.names(spark, folder))
    for n in committed_batches(spark, table, flow):
        if f"{n}.json" not in noted:
            storage.write_text(spark, f"{folder}/{n}.json", json.dumps({"batch_id": n}))
    return folder


def batch_stream(spark: SparkSession, table: str, flow: str = "main", max_batches: int = 100) -> DataFrame:
    """The numbers of the committed batches of a flow, as a stream."""
    reader = spark.readStream.schema(NOTE_SCHEMA).option("pathGlobFilter", "*.json")
    reader = reader.option("maxFileAge", ANY_AGE).option("maxFilesPerTrigger", max_batches)
    return reader.json(note_batches(spark, table, flow))


def for_each_batch(
    spark: SparkSession,
    table: str,
    checkpoint: str,
    apply: Callable[[DataFrame, list[int], int], None],
    flow: str = "main",
    max_batches: int = 100,
) -> None:
    """Call `apply(rows, landed, batch_id)` for what has landed in the table since the last run.

    `landed` are the numbers of the table's batches that the rows come from, `batch_id` numbers
    the calls. After a failure the same call is made again with the same rows.
    """

    def run(numbers: DataFrame, batch_id: int) -> None:
        landed = sorted(r.batch_id for r in numbers.collect())  # at most max_batches
        if landed:
            own = numbers.sparkSession
            apply(read_ingested(own, table, flows=[flow], batches=landed), landed, batch_id)

    query = (
        batch_stream(spark, table, flow, max_batches)
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def append_flow(
    spark: SparkSession,
    table: str,
    sink: str,
    checkpoint: str,
    name: str,
    project: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    flow: str = "main",
) -> None:
    """Append the projected new rows of a table to a sink that several flows may write to.

    A flow has a folder of its own in the sink, with one folder per call; one that is complete
    is not written again.
    """
    if not storage.exists(spark, f"{checkpoint}/metadata") and storage.exists(spark, f"{sink}/flow={name}"):
        raise ValueError(f"flow {name!r} has data but a new checkpoint; use another name")

    def write(rows: DataFrame, landed: list[int], batch_id: int) -> None:
        target = f"{sink}/flow={name}/batch_id={batch_id}"
        if not storage.is_complete(rows.sparkSession, target):
            project(rows).write.mode("overwrite").parquet(target)

    for_each_batch(spark, table, checkpoint, write, flow)


def read_flows(spark: SparkSession, sink: str, names: Sequence[str]) -> DataFrame:
    """The committed rows of several flows, by name; columns that a flow lacks are null."""
    parts = []
    for name in names:
        root = f"{sink}/flow={name}"
        paths = [f"{root}/batch_id={n}" for n in storage.committed(spark, root, "batch_id")]
        if paths:
            parts.append(spark.read.option("mergeSchema", "true").parquet(*paths))
    if not parts:
        raise ValueError(f"no flow of {list(names)} has written to {sink}")
    return union_all_by_name(parts, fill_missing=True)
