"""Repeated passages: word windows as edges of a De Bruijn graph, compacted and verified."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import stored
from tierflow.llm.wordhash import Words, pieces, window_hashes

#: Words of the sampled runs that tell which windows can be repeated at all.
SEED_WORDS = 11
#: Bits of the row filter that spares the shuffle of texts that take no part, per row and at most (16 MB).
ROW_BITS, MAX_BITS = 16, 1 << 27
NOTHING = np.empty(0, np.int64)


def _sliding(values: np.ndarray, width: int, reduce: np.ufunc) -> np.ndarray:
    """Minimum or maximum over every run of `width` values, by doubling."""
    reach = 1
    while reach * 2 <= width:
        values = reduce(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return reduce(values[:-rest], values[rest:]) if rest else values


class Windows:
    """The windows of some texts and the seeds among them.

    Every window's least seeds (runs of SEED_WORDS words, by hash) are chosen, so equal windows have equal
    seeds at equal places, wherever they stand.
    """

    def __init__(self, words: Words, width: int, bits: int):
        self.width, self.seed = width, min(SEED_WORDS, width)
        n = len(words.hashes)
        self.text = np.searchsorted(words.bounds, np.arange(n), "right") - 1
        self.valid = np.zeros(max(n - width + 1, 0), bool)
        if not len(self.valid):
            self.seeds, self.least, self.chosen = np.empty(0, np.uint64), np.empty(0, np.uint64), NOTHING
            return
        self.valid = self.text[: len(self.valid)] == self.text[width - 1 :]
        self.seeds = window_hashes(words.hashes, self.seed) >> np.uint64(64 - bits)
        self.least = _sliding(self.seeds, width - self.seed + 1, np.minimum)
        # A seed is chosen if it is the least of some window: the greatest minimum over its windows.
        reach = width - self.seed
        floor = np.where(self.valid, self.least, np.uint64(0))
        padded = np.concatenate([np.zeros(reach, np.uint64), floor, np.zeros(reach, np.uint64)])
        ruled = np.concatenate([np.zeros(reach, bool), self.valid, np.zeros(reach, bool)])
        highest = _sliding(padded, reach + 1, np.maximum)
        any_valid = _sliding(ruled, reach + 1, np.logical_or)
        self.chosen = np.flatnonzero((highest == self.seeds) & any_valid)

    def candidates(self, repeated: np.ndarray) -> np.ndarray:
        """Windows with a least seed among the repeated places."""
        mark = np.zeros(len(self.seeds), bool)
        mark[repeated] = True
        reach = self.width - self.seed
        best = np.where(mark, self.seeds, ~np.uint64(0))
        there = _sliding(mark, reach + 1, np.logical_or)
        return np.flatnonzero(self.valid & there & (_sliding(best, reach + 1, np.minimum) == self.least))


def _lists(values: np.ndarray, owners: np.ndarray, n: int, kind: pa.DataType) -> pa.ListArray:
    """One list per owner 0 to n - 1 of values that are ordered by owner."""
    offsets = np.searchsorted(owners, np.arange(n + 1))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def _profiles(width: int, bits: int):
    """Texts with their number of words, a digest of the words, and their seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in pieces(batch.column("text")):
                words = Words(texts)
                found = Windows(words, width, bits)
                owners = found.text[found.chosen]
                places = found.chosen - words.bounds[owners]
                n = len(texts)
                digests = [
                    hashlib.sha256(words.text(a, b)).hexdigest()
                    for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc").slice(at, n),
                        texts,
                        pa.array(np.diff(words.bounds), pa.int64()),
                        pa.array(digests, pa.string()),
                        _lists(found.seeds[found.chosen].view(np.int64), owners, n, pa.int64()),
                        _lists(places, owners, n, pa.int32()),
                    ],
                    names=["doc", "text", "n_words", "sha", "seeds", "places"],
                )

    return run


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[int, Words]]:
    for at, texts in pieces(batch.column("text")):
        yield at, Words(texts)


def _absolute(lists: pa.ListArray, at: int, words: Words) -> np.ndarray:
    """Places given per text as places among all words of the piece, ascending."""
    own = lists.slice(at, len(words.bounds) - 1)
    counts = np.diff(own.offsets.to_numpy())
    return np.sort(own.flatten().to_numpy().astype(np.int64) + np.repeat(words.bounds[:-1], counts))


def _edges(width: int, bits: int):
    """Windows that can be repeated, per text: their places and hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, words in _groups(batch):
                n = len(words.bounds) - 1
                windows = Windows(words, width, bits)
                picked = windows.candidates(_absolute(batch.column("at"), at, words))
                owners = windows.text[picked] if len(picked) else NOTHING
                edges = window_hashes(words.hashes, width)[picked] >> np.uint64(64 - bits)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").slice(at, n),
                        _lists(picked - words.bounds[owners], owners, n, pa.int32()),
                        _lists(edges.view(np.int64), owners, n, pa.int64()),
                    ],
                    names=["row", "places", "edges"],
                )

    return run


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per edge occurrence with the edges that follow and precede it, null where none does."""
    for batch in batches:
        counts = np.diff(batch.column("edges").offsets.to_numpy())
        row = np.repeat(batch.column("row").to_numpy(), counts)
        place = batch.column("places").flatten().to_numpy()
        edge = batch.column("edges").flatten().to_numpy()
        follows = np.zeros(len(edge) + 1, bool)
        follows[1:-1] = (row[1:] == row[:-1]) & (place[1:] == place[:-1] + 1)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(row),
                pa.array(place),
                pa.array(edge),
                pa.array(np.append(edge[1:], 0), mask=~follows[1:]),
                pa.array(np.append([0], edge[:-1])[: len(edge)], mask=~follows[:-1]),
            ],
            names=["row", "place", "edge", "after", "before"],
        )


def compacted(steps: DataFrame) -> DataFrame:
    """Repeated edges of the graph, and whether each begins a nonbranching path.

    An edge continues the path of the one before if all occurrences of each stand beside the
    other; a text that ends or goes on without a repeated window is a branch as well. Both are
    read off sums that every task makes first, so a hot edge is one row per task.

    Takes edge, after, before; returns edge, head.
    """
    n = F.count(F.lit(1))
    edges = stored(
        steps.groupBy("edge")
        .agg(
            n.alias("n"),
            F.when((F.count("after") == n) & (F.min("after") == F.max("after")), F.max("after")).alias("after"),
            F.when((F.count("before") == n) & (F.min("before") == F.max("before")), F.max("before")).alias("before"),
        )
        .filter("n > 1"),
        "passage-edges",
    )
    links = edges.filter("after is not null and after <> edge").select(
        F.col("after").alias("edge"), F.col("edge").alias("before")
    )
    joined = edges.select("edge", "before").join(links.withColumn("_linked", F.lit(True)), ["edge", "before"], "left")
    return joined.select("edge", F.col("_linked").isNull().alias("head"))


SPANS = "array<struct<path:bigint,place:int,windows:int,lo:bigint,hi:bigint>>"


def digest(text: memoryview) -> tuple[int, int]:
    """Half of the SHA-256 as two signed numbers."""
    mark = hashlib.sha256(text).digest()
    return tuple(int.from_bytes(mark[i : i + 8], "little", signed=True) for i in (0, 8))


def _removed(width: int):
    """What is left of each text without its hits, and the path spans found in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, words in _groups(batch):
                n = len(words.bounds) - 1
                removed, kept, ends, spans = [], [], [0], []
                hits = batch.column("hits").slice(at, n)
                for k, (first, last) in enumerate(zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist())):
                    own = hits[k].values
                    place = own.field("place").to_numpy().astype(np.int64)
                    order = np.argsort(place, kind="stable")
                    place, edge = place[order], own.field("edge").to_numpy()[order]
                    head = own.field("head").to_numpy(zero_copy_only=False)[order]
                    change = np.bincount(place, minlength=last - first + 1)
                    change[width:] -= change[: len(change) - width].copy()
                    left = np.cumsum(change[: last - first]) == 0
                    removed.append(int((~left).sum()))
                    kept.append(hashlib.sha256(words.kept(first, left)).hexdigest())
                    cut = np.flatnonzero(head | (np.diff(place, prepend=-2) != 1))
                    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(place)], strict=True):
                        start = int(place[a])
                        text = words.text(first + start, first + int(place[b - 1]) + width)
                        spans.append((int(edge[a]), start, b - a, *digest(text)))
                    ends.append(len(spans))
                columns = list(zip(*spans, strict=True)) or [[]] * 5
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
                flat = pa.StructArray.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                    names=["path", "place", "windows", "lo", "hi"],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").slice(at, n),
                        pa.array(removed, pa.int64()),
                        pa.array(kept, pa.string()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat),
                    ],
                    names=["row", "n_removed", "kept_sha256", "spans"],
                )

    return run


def having(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """`texts` joined with `rows`, both by row.

    A bit per hashed row, of bounded size, goes to the tasks first, so that hardly any
    text without a partner is shuffled; the join decides.
    """
    n = rows.count()
    size = min(MAX_BITS, max(64, ROW_BITS * n))
    bit = F.pmod(F.xxhash64("row"), F.lit(size))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), (bit % 64).cast("int"))
    cells = rows.select((bit / 64).cast("int").alias("cell"), one.alias("bits"))
    found = cells.groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(-(-size // 64), np.int64)
    table[found["cell"].to_numpy()] = found["bits"].to_numpy()
    shared = texts.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            at = batch.column("_bit").to_numpy()
            mine = (bits[at // 64] >> (at % 64)) & 1 == 1
            yield batch.select(["row", "text"]).filter(pa.array(mine))

    near = texts.withColumn("_bit", bit).mapInArrow(run, texts.schema)
    return near.join(rows, "row")


def without(texts: DataFrame, hits: DataFrame, width: int) -> DataFrame:
    """Texts without the windows of `hits` (row, place, edge, head), and their path spans."""
    listed = hits.groupBy("row").agg(F.collect_list(F.struct("place", "edge", "head")).alias("hits"))
    schema = f"row bigint, n_removed bigint, kept_sha256 string, spans {SPANS}"
    return having(texts, stored(listed, "passage-hits")).mapInArrow(_removed(width), schema)


def _windows_read(width: int):
    """The digests of single windows, read in their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, words in _groups(batch):
                rows, places, marks = [], [], []
                lists = batch.column("at").slice(at, len(words.bounds) - 1)
                for k, first in enumerate(words.bounds[:-1].tolist()):
                    for place in lists[k].as_py():
                        rows.append(batch.column("row")[at + k].as_py())
                        places.append(place)
                        marks.append(digest(words.text(first + place, first + place + width)))
                lo, hi = zip(*marks, strict=True) if marks else ([], [])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows, pa.int64()),
                        pa.array(places, pa.int32()),
                        pa.array(lo, pa.int64()),
                        pa.array(hi, pa.int64()),
                    ],
                    names=["row", "place", "lo", "hi"],
                )

    return run


def verified(texts: DataFrame, cut: DataFrame, width: int) -> DataFrame:
    """Results whose paths spell the same words wherever they occur.

    All occurrences of a path have as many windows, so one digest per span tells whether
    hashes have clashed. Texts with a clashing path are done again: the windows of these
    paths are compared by the words in their texts, all others hold.
    """
    spans = cut.select("row", F.explode("spans").alias("s")).select("row", "s.*")
    marks = ("lo", "hi", "windows")
    ranges = [F.min(c).alias(f"{c}_min") for c in marks] + [F.max(c).alias(f"{c}_max") for c in marks]
    differ = " or ".join(f"{c}_min <> {c}_max" for c in marks)
    clashing = stored(spans.groupBy("path").agg(*ranges).filter(differ).select("path"), "passage-clashes")
    if clashing.isEmpty():
        return cut
    doubtful = stored(spans.join(clashing.withColumn("clash", F.lit(True)), "path", "left"), "passage-doubtful")
    touched = doubtful.filter("clash").select("row").distinct()
    singles = doubtful.join(touched, "row", "left_semi").select(
        "row", "clash", F.explode(F.sequence(F.col("place"), F.col("place") + F.col("windows") - 1)).alias("place")
    )
    asked = singles.filter("clash").groupBy("row").agg(F.collect_list("place").alias("at"))
    read = stored(
        having(texts, stored(asked, "passage-asked")).mapInArrow(_windows_read(width), "row bigint, place int, lo bigint, hi bigint"),
        "passage-windows",
    )
    same = stored(read.groupBy("lo", "hi").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "passage-same")
    sure = singles.filter("clash is null").select("row", "place")
    sure = sure.unionByName(read.join(same, ["lo", "hi"]).select("row", "place"))
    hits = sure.select("row", "place", F.lit(0).cast("bigint").alias("edge"), F.lit(False).alias("head"))
    again = without(texts, hits, width)
    # A touched text that keeps no window is whole again: it has no row here.
    return cut.join(touched, "row", "left_anti").unionByName(again)


def without_repeats(
    docs: DataFrame,
    width: int = 35,
    id_col: str = "doc_id",
    text_col: str = "text",
    hash_bits: int = 64,
) -> DataFrame:
    """Removes every word that a window of `width` words covers whose words start anywhere else too.

    Windows are edges of a De Bruijn graph from their first to their last `width` - 1 words.
    Seeds (least runs of words per window) leave only windows that can be repeated; their
    edges are counted, nonbranching paths of repeated edges compact by a join, and every path
    is read again in the texts it occurs in, so that clashing hashes change nothing.

    Words are runs of bytes other than 0x20 and 0x09 to 0x0D, unchanged. Null and empty texts have
    none. Rows are documents of their own even where they share an id, so a repeated row of
    `width` words or more loses all of them. Texts of fewer words lose none. Very long texts
    are read whole, in the memory of one task. Empty tables give no rows. Other columns
    are not read, whatever their names.

    Returns the id, n_words, n_removed, kept_sha256 (kept words joined by one space).
    """
    narrow = docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    kind = narrow.schema["doc"].dataType.simpleString()
    shape = f"doc {kind}, text string, n_words bigint, sha string, seeds array<bigint>, places array<int>"
    known = stored(
        narrow.mapInArrow(_profiles(width, hash_bits), shape).withColumn("row", F.monotonically_increasing_id()),
        "passage-texts",
        compression="zstd",
    )
    long = known.filter(F.col("n_words") >= width)
    groups = long.groupBy("sha").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    copies = stored(
        long.select("row", "sha").join(stored(groups.select("sha", "first"), "passage-groups"), "sha"),
        "passage-copies",
    ).select("row", "first")
    # One of equal texts stands for all: it is a witness for windows that others share with it.
    alone = long.join(copies.filter("row <> first"), "row", "left_anti")
    seeds = stored(
        alone.select("row", F.explode(F.arrays_zip("seeds", "places")).alias("s")).select("row", "s.*"),
        "passage-seeds",
    )
    counted = seeds.groupBy("seeds").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("seeds")
    shared = seeds.join(stored(counted, "passage-shared"), "seeds")
    asked = stored(shared.groupBy("row").agg(F.collect_list("places").alias("at")), "passage-asked")
    texts = known.select("row", "text")
    edges = stored(
        having(texts, asked).mapInArrow(_edges(width, hash_bits), "row bigint, places array<int>, edges array<bigint>"),
        "passage-windows",
    )
    steps = edges.mapInArrow(_steps, "row bigint, place int, edge bigint, after bigint, before bigint")
    paths = stored(compacted(steps), "passage-paths")
    # The witness of a group of copies takes part: a path is checked against it as well.
    hits = steps.select("row", "place", "edge").join(paths, "edge")
    cut = verified(texts, stored(without(texts, hits, width), "passage-cut"), width)
    nothing = hashlib.sha256(b"").hexdigest()
    result = (
        known.select("row", "doc", "n_words", "sha")
        .join(copies.select("row", F.lit(True).alias("copied")), "row", "left")
        .join(cut.select("row", "n_removed", "kept_sha256"), "row", "left")
    )
    return result.select(
        F.col("doc").alias(id_col),
        "n_words",
        F.when(F.col("copied"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("copied"), nothing).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )
