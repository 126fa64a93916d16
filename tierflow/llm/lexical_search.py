"""Ranked lexical search by norm buckets: the best documents of every item, exactly."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tierflow.llm.common import stored

#: A byte outside terms becomes a space and A-Z becomes lower case; bytes over 0x7F stay.
_IN_TERM = [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]
TERM_BYTES = bytes(b if b in _IN_TERM else 0x20 for b in range(256)).lower()
#: Distinct terms of the items that are searched for together; bounds every broadcast.
BLOCK_TERMS = 200_000
#: Quantiles of the vector length that bound the buckets, and vectors scored at a time.
BUCKETS, ROWS = 64, 4096
#: Share of an item's squared length that its first coordinates hold.
FOCUS = 0.6
#: Bounds are computed in doubles and widened by this factor before anything is dropped.
SLACK = 1 + 1e-9
#: Fixed values of the score.
K_LENGTH, SCALE, PER_TF, PER_M = 75, 1_000_000_000, 1000, 8


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of 0-9, A-Z, a-z and everything beyond ASCII, with only A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(TERM_BYTES).split()


def term_weight(n_documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * df + 1)))


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The terms of each item row, counted."""
    for batch in batches:
        found = [Counter(terms_of(text.as_py())) for text in batch.column(1)]
        items = [k for k, one in enumerate(found) for _ in one]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(items, pa.int64())),
                pa.array([t for one in found for t in one], pa.binary()),
                pa.array([n for one in found for n in one.values()], pa.int64()),
            ],
            names=["item", "term", "n"],
        )


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the number of terms that the items before hold in the same task."""
    held = 0
    for batch in batches:
        sizes = batch.column("size").to_numpy()
        before = held + np.cumsum(sizes) - sizes
        held += int(sizes.sum())
        yield batch.append_column("before", pa.array(before, pa.int64()))


def item_blocks(items: DataFrame, block_terms: int) -> tuple[DataFrame, int]:
    """Items with their counted terms and a block of about `block_terms` terms, and the number of blocks."""
    kind = items.schema["item"].dataType.simpleString()
    counted = (
        items.select("item", "text")
        .mapInArrow(_asked, f"item {kind}, term binary, n bigint")
        .groupBy("item", "term")
        .agg(F.sum("n").alias("n"))
    )
    # The list of an item is as long as its vector, whatever rows it has.
    lists = counted.groupBy("item").agg(F.collect_list(F.struct("term", "n")).alias("terms"))
    shape = f"item {kind}, terms array<struct<term:binary,n:bigint>>, size bigint, task int"
    measured = lists.select(
        "item", "terms", F.size("terms").cast("bigint").alias("size"), F.spark_partition_id().alias("task")
    )
    known = stored(measured.mapInArrow(_running, f"{shape}, before bigint"), "search-items")
    offsets, total = [], 0
    for row in known.groupBy("task").agg(F.sum("size").alias("size")).sort("task").collect():
        offsets.append((row["task"], total))
        total += row["size"]
    starts = known.sparkSession.createDataFrame(offsets, "task int, start bigint")
    block = F.floor((F.col("start") + F.col("before")) / block_terms).cast("bigint")
    placed = known.join(F.broadcast(starts), "task").select("item", "terms", block.alias("block"))
    return placed, -(-total // block_terms)


def _vectors(vocabulary):
    """Term frequencies of the documents over the terms that items ask for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value
        for batch in batches:
            for at in range(0, len(batch), 1000):
                some = batch.slice(at, 1000)
                sizes, kinds, tfs = [], [], []
                for text in some.column(1):
                    found = terms_of(text.as_py())
                    counted = Counter(found)
                    known = sorted((number[t], n) for t, n in counted.items() if t in number)
                    sizes.append(len(found))
                    kinds.append([k for k, _ in known])
                    tfs.append([n for _, n in known])
                lists = [pa.array(kinds, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(sizes, pa.int64()), *lists],
                    names=["doc", "n", "terms", "tfs"],
                )

    return run


def _document_frequencies(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int32()), pa.array(df[held])], names=["term", "df"]
        )

    return run


def impacts(tfs: np.ndarray, sizes: np.ndarray, n_documents: int, length: int) -> np.ndarray:
    """What one unit of weight of each term adds to a document's score, as integers."""
    if len(sizes) and int(sizes.max()) * n_documents * K_LENGTH >= 1 << 63:
        m = np.array([100 - K_LENGTH + K_LENGTH * int(n) * n_documents // length for n in sizes], np.int64)
    else:
        m = 100 - K_LENGTH + K_LENGTH * sizes * n_documents // length
    return SCALE * tfs // (PER_TF * tfs + PER_M * m)


def _norms(n_documents: int, length: int):
    """Impact vectors with their length, without the documents that hold no term asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = batch.column("terms")
            counts = np.diff(terms.offsets.to_numpy())
            sizes = np.repeat(batch.column("n").to_numpy(), counts)
            made = impacts(batch.column("tfs").flatten().to_numpy(), sizes, n_documents, length)
            ends = np.cumsum(counts)
            sums = np.concatenate([[0.0], np.cumsum(made.astype(float) ** 2)])
            norm = np.sqrt(np.maximum(sums[ends] - sums[ends - counts], 0)) * SLACK
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(made))
            flat = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], ends]), pa.int32()), terms.flatten()
            )
            out = pa.RecordBatch.from_arrays(
                [batch.column("doc"), flat, lists, pa.array(norm)],
                names=["doc", "terms", "impacts", "norm"],
            )
            yield out.filter(pa.array(counts > 0))

    return run


class _Best:
    """The k best (score, doc) of one item; equal scores go by ascending doc, nulls first."""

    def __init__(self, k: int, floor: int):
        self.k, self.floor, self.rows = k, floor, []

    def add(self, scores: np.ndarray, docs: list) -> None:
        self.rows += zip(scores.tolist(), docs, strict=True)
        self.rows.sort(key=lambda r: (-r[0], r[1] is not None, 0 if r[1] is None else r[1]))
        del self.rows[self.k :]
        if len(self.rows) == self.k:
            self.floor = max(self.floor, self.rows[-1][0])


def _search(model, k: int):
    """Best documents of every item among the vectors of one task, longest vectors first.

    A block of vectors is a bucket. An item skips it if its own length times the longest
    vector's (Cauchy-Schwarz) stays under the item's k-th best score, or if the sum of
    its weights times the largest coordinates does. Inside, the heaviest
    coordinates are added up from inverted lists, the rest is bounded by the lengths that
    remain, and what still reaches the k-th best is scored again in integers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, n_terms, doc_type = model.value
        best = [_Best(k, floor) for *_, floor in queries]
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                _block(batch.slice(at, ROWS), queries, n_terms, best)
        found = [(q, doc, score) for q, b in enumerate(best) for score, doc in b.rows]
        columns = list(zip(*found, strict=True)) or [[], [], []]
        kinds = [pa.int32(), doc_type, pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
            names=["query", "doc", "score"],
        )

    return run


def _block(bucket: pa.RecordBatch, queries: list, n_terms: int, best: list[_Best]) -> None:
    terms = bucket.column("terms")
    counts = np.diff(terms.offsets.to_numpy())
    row = np.repeat(np.arange(len(bucket)), counts)
    kind, impact = terms.flatten().to_numpy(), bucket.column("impacts").flatten().to_numpy()
    norms = bucket.column("norm").to_numpy()
    order = np.argsort(kind, kind="stable")
    kind, row, impact = kind[order], row[order], impact[order]
    lists = np.searchsorted(kind, np.arange(n_terms + 1))
    top = np.zeros(n_terms, np.int64)
    held = np.flatnonzero(np.diff(lists))
    if len(held):
        top[held] = np.maximum.reduceat(impact, lists[held])
    squares = impact.astype(float) ** 2
    longest = norms.max(initial=0.0)
    for q, (ids, weights, norm, rest, focus, _) in enumerate(queries):
        floor = max(best[q].floor, 1)
        if norm * longest * SLACK < floor or float(weights @ top[ids].astype(float)) * SLACK < floor:
            continue
        partial, seen = np.zeros(len(bucket)), np.zeros(len(bucket))
        for t, w in zip(ids[:focus].tolist(), weights[:focus].tolist(), strict=True):
            here = slice(lists[t], lists[t + 1])
            partial[row[here]] += w * impact[here]
            seen[row[here]] += squares[here]
        left = np.sqrt(np.maximum(norms**2 - seen, 0))
        alive = np.flatnonzero((partial + rest * left) * SLACK >= floor)
        if not len(alive):
            continue
        place = np.full(len(bucket), -1)
        place[alive] = np.arange(len(alive))
        scores = np.zeros(len(alive), np.int64)
        for t, w in zip(ids.tolist(), weights.tolist(), strict=True):
            here = slice(lists[t], lists[t + 1])
            to = place[row[here]]
            scores[to[to >= 0]] += w * impact[here][to >= 0]
        kept = scores >= floor
        docs = bucket.column("doc").take(pa.array(alive[kept])).to_pylist()
        best[q].add(scores[kept], docs)


def _queries(items: list, number: dict, n_documents: int, df: np.ndarray, floors: dict) -> list:
    """Weight vectors, heaviest coordinate first, with their lengths and the length of the rest."""
    made = []
    for q, item in enumerate(items):
        ids = np.array([number[bytes(x["term"])] for x in item["terms"]], np.int64)
        counts = [x["n"] for x in item["terms"]]
        weights = np.array(
            [c * term_weight(n_documents, int(df[k])) for k, c in zip(ids, counts, strict=True)], np.int64
        )
        order = np.argsort(-weights, kind="stable")
        ids, weights = ids[order], weights[order]
        squares = np.cumsum(weights.astype(float) ** 2)
        whole = squares[-1] if len(squares) else 0.0
        focus = int(np.searchsorted(squares, FOCUS * whole)) + 1
        rest = math.sqrt(float((weights[focus:].astype(float) ** 2).sum())) * SLACK
        made.append((ids, weights, math.sqrt(whole) * SLACK, rest, focus, floors.get(q, 0)))
    return made


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """The k best documents of every item by a length-normalised term score, exactly.

    Items are taken in blocks of about `block_terms` terms (or one item), which bounds what
    is sent to the tasks. For each block the documents become sparse impact vectors over
    its terms, range-partitioned by length with the longest first. The longest bucket gives
    every item a first k-th best score; then all vectors are searched, and only the k best of
    each task and item are shuffled.

    Null and empty texts hold no terms; they are counted nowhere and found by no item. Rows
    that share a document id (or have none) are documents of their own; rows that share an
    item id are one item with the terms of all of them. Equal scores go by ascending document
    id, nulls first. Very long texts are counted whole. Empty tables give no rows. Other
    columns are not read, whatever their names.

    Returns the item id, rank, the document id and score.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    asked = items.select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{item_text_col}`").alias("text"))
    placed, n_blocks = item_blocks(asked, block_terms)
    kinds = [asked.schema["item"].dataType.simpleString(), narrow.schema["doc"].dataType.simpleString()]
    found = spark.createDataFrame([], "item {}, doc {}, score bigint".format(*kinds))
    for block in range(n_blocks):
        found = found.unionByName(_search_block(narrow, placed.filter(F.col("block") == block), k))
    by_score = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc"))
    ranked = found.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)
    return ranked.select(F.col("item").alias(item_col), "rank", F.col("doc").alias(id_col), "score")


def _search_block(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    spark = docs.sparkSession
    doc_type = docs.schema["doc"].dataType
    kind = doc_type.simpleString()
    mine = items.select("item", "terms").collect()
    number = {t: i for i, t in enumerate(sorted({bytes(x["term"]) for row in mine for x in row["terms"]}))}
    vocabulary = spark.sparkContext.broadcast(number)
    vectors = stored(
        docs.mapInArrow(_vectors(vocabulary), f"doc {kind}, n bigint, terms array<int>, tfs array<bigint>"),
        "search-vectors",
    )
    counted = vectors.filter("n > 0").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("l")).first()
    n_documents, length = counted["n"], counted["l"] or 1
    df = np.zeros(len(number), np.int64)
    # One row per term of the block.
    sums = vectors.select("terms").mapInArrow(_document_frequencies(len(number)), "term int, df bigint")
    for row in sums.groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[row["term"]] = row["df"]
    measured = vectors.mapInArrow(
        _norms(n_documents, length), f"doc {kind}, terms array<int>, impacts array<bigint>, norm double"
    )
    # Copies of one text have one length: the id and the input partition tell them apart.
    spread = [F.xxhash64("doc"), F.spark_partition_id()]
    ordered = measured.repartitionByRange(F.desc("norm"), *spread).sortWithinPartitions(F.desc("norm"))
    buckets = stored(ordered, "search-buckets")

    def searched(rows: DataFrame, floors: dict[int, int]) -> DataFrame:
        model = _queries(mine, number, n_documents, df, floors), len(number), to_arrow_type(doc_type)
        shared = spark.sparkContext.broadcast(model)
        return rows.mapInArrow(_search(shared, k), f"query int, doc {kind}, score bigint")

    floors: dict[int, int] = {}
    edge = buckets.approxQuantile("norm", [1 - 1 / BUCKETS], 1 / (4 * BUCKETS))
    if edge:
        by_score = Window.partitionBy("query").orderBy(F.desc("score"))
        first = searched(buckets.filter(F.col("norm") >= edge[0]), {})
        kth = first.withColumn("r", F.row_number().over(by_score)).filter(F.col("r") == k)
        floors = {row["query"]: row["score"] for row in kth.collect()}
    names = spark.createDataFrame([(q, row["item"]) for q, row in enumerate(mine)], items.select(F.lit(0).alias("query"), "item").schema)
    return stored(searched(buckets, floors), "search-hits").join(F.broadcast(names), "query").drop("query")
