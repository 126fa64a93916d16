"""Contiguous shards of near equal byte size from global prefix sums."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.common import shuffle_partitions, stored


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the partition number and, within it, the bytes and rows that come before."""
    part, before, rows = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        sizes = batch.column("size").to_numpy()
        ends = before + np.cumsum(sizes)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("size"),
                batch.column("text_crc32"),
                pa.array(np.full(len(sizes), part, np.int32)),
                pa.array(ends - sizes),
                pa.array(rows + np.arange(len(sizes), dtype=np.int64)),
            ],
            names=["doc_id", "size", "text_crc32", "part", "bytes_before", "rows_before"],
        )
        if len(sizes):
            before, rows = int(ends[-1]), rows + len(sizes)


def byte_shards(
    docs: DataFrame,
    shards: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    partitions: int | None = None,
) -> DataFrame:
    """Cut the documents, ordered by id, into `shards` runs of near equal byte size.

    One pass over the texts leaves a narrow table (id, size, checksum). That table is
    range-partitioned by id; each partition adds up its own sizes in order, and the
    partition totals (one row per partition) give every row its place in the global
    prefix sum. A row goes to the shard in which the middle of its bytes falls, so each
    shard differs from total / shards by at most the largest row.

    Size is the UTF-8 bytes plus 1, so a null or empty text (size 1) still takes a
    place; the checksum of a null text is that of the empty one. A null id comes first.
    Repeated ids and repeated rows are ordered by checksum, size and place in the input;
    the last keeps one repeated row from filling a partition. An empty table gives no
    rows. Other columns are ignored. Whole sizes up to 2**58 bytes are exact.

    Returns doc_id, size, text_crc32, shard, slot.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text).cast("bigint") + 1).alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        ).withColumn("place", F.monotonically_increasing_id()),
        "shard-sizes",
    )
    order = ["doc_id", "text_crc32", "size", "place"]
    parts = partitions or shuffle_partitions(docs.sparkSession)
    local = stored(
        narrow.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .drop("place")
        .mapInArrow(
            _running,
            f"doc_id {dict(narrow.dtypes)['doc_id']}, size bigint, text_crc32 bigint, "
            "part int, bytes_before bigint, rows_before bigint",
        ),
        "shard-runs",
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    totals = (
        local.groupBy("part")
        .agg(F.sum("size").alias("part_bytes"), F.count(F.lit(1)).alias("part_rows"))
        .select(
            "part",
            F.coalesce(F.sum("part_bytes").over(earlier), F.lit(0)).alias("base_bytes"),
            F.coalesce(F.sum("part_rows").over(earlier), F.lit(0)).alias("base_rows"),
            F.sum("part_bytes").over(whole).alias("total"),
        )
    )
    # One row per partition: bounded by the partition count, whatever the data.
    placed = local.join(F.broadcast(totals), "part").select(
        "doc_id",
        "size",
        "text_crc32",
        (F.col("base_rows") + F.col("rows_before")).alias("row"),
        F.least(
            F.expr(f"({shards} * (2 * (base_bytes + bytes_before) + size)) div (2 * total)"),
            F.lit(shards - 1),
        )
        .cast("int")
        .alias("shard"),
    )
    firsts = placed.groupBy("shard").agg(F.min("row").alias("first_row"))
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        (F.col("row") - F.col("first_row")).alias("slot"),
    )
