"""Packing token pieces into fixed-length sequences by cutting-stock column generation."""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.common import stored

END_ID = 0
#: Column generation stops at this relative gap to the best known lower bound, or after so many
#: columns; the plan is never worse than best fit, which counts too.
GAP, MAX_COLUMNS = 0.005, 300
#: Lengths count in units of so many tokens, rounded up.
UNIT = 1
#: The one special token of the vocabulary, with its id.
SPECIAL = {"<|endoftext|>": 50256}
FACTS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")


@lru_cache(maxsize=2)
def encoder(ranks_path: str, pattern: str):
    """Byte-level BPE from a file of base64 tokens and ranks (ids equal the ranks), and its special token."""
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens=SPECIAL)


def _price(duals: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack by dynamic programming: the most valuable pattern that fits."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    ends = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        best[room], pick[room] = best[room - 1], -1
        if n := ends[room]:
            values = best[room - lengths[:n]] + duals[:n]
            k = int(values.argmax())
            if values[k] > best[room]:
                best[room], pick[room] = values[k], k
    column, room = np.zeros(len(lengths)), capacity
    while room > 0:
        if pick[room] < 0:
            room -= 1
        else:
            column[pick[room]] += 1
            room -= lengths[pick[room]]
    return float(best[capacity]), column


def _first_fit_basis(
    lengths: np.ndarray, demand: np.ndarray, capacity: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Patterns filled with the longest lengths that are left, each used until one of them is spent.

    Uses may be fractions, so every pattern spends at least one length. No later pattern holds it, so
    the basis is triangular and its inverse changes in the rows of the pattern's lengths only.
    """
    left = demand.astype(float)
    columns, rates = np.zeros((len(lengths), len(lengths))), np.zeros(len(lengths))
    single = (capacity // lengths).astype(float)
    inverse = np.diag(1 / single)
    open_ = left > 0
    while open_.any():
        room, column = capacity, np.zeros(len(lengths))
        for k in np.flatnonzero(open_)[::-1]:
            if lengths[k] <= room:
                column[k] = room // lengths[k]
                room -= int(column[k]) * lengths[k]
                if room < lengths[0]:
                    break
        used = np.flatnonzero(column)
        spent = used[(left[used] / column[used]).argmin()]
        times = left[spent] / column[spent]
        left[used] = np.maximum(left[used] - times * column[used], 0)
        left[spent], open_[spent] = 0, False
        columns[:, spent], rates[spent] = column, times
        row = inverse[spent] * (single[spent] / column[spent])
        for k in used:
            inverse[k] -= column[k] / single[k] * row
        inverse[spent] = row
    return columns, rates, inverse


def column_generation(
    lengths: np.ndarray, demand: np.ndarray, capacity: int, gap: float = GAP, limit: int = MAX_COLUMNS
) -> tuple[np.ndarray, np.ndarray]:
    """Basic columns (length x pattern) and rates of the relaxed cutting-stock program.

    Minimise the number of sequences so that every length is covered exactly. The revised
    simplex method starts from first-fit patterns; the knapsack prices new columns until the
    objective is within `gap` of the best lower bound seen: all tokens over the capacity, or the
    objective over the best pattern's value. Demands are raised by tiny different amounts, which
    breaks ties between ratios, so that no basis comes twice.
    """
    nudged = demand * (1 + 1e-9 * np.random.default_rng(0).random(len(demand)))
    columns, rates, inverse = _first_fit_basis(lengths, nudged, capacity)
    bound = float((lengths * demand).sum()) / capacity
    for _ in range(limit):
        if rates.sum() <= bound * (1 + gap):
            break
        duals = inverse.sum(axis=0)
        value, entering = _price(duals, lengths, capacity)
        bound = max(bound, rates.sum() / max(value, 1))
        held = np.flatnonzero(entering)
        step = (inverse[:, held] * entering[held]).sum(axis=1)
        usable = step > 1e-9
        if value <= 1 + 1e-9 or not usable.any():
            break
        ratios = np.where(usable, rates / np.where(usable, step, 1), np.inf)
        out = int(ratios.argmin())
        theta = ratios[out]
        rates = np.maximum(rates - theta * step, 0)
        rates[out] = theta
        columns[:, out] = entering
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
    return columns, rates


def _best_fit(left: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Bins for the pieces, the longest first, each where the least room is left over.

    Equal pieces meet equal rooms at once: the work depends on the number of different
    lengths and rooms, not of pieces.
    """
    rooms: dict[int, dict[tuple, int]] = {}
    for size in sorted(left, reverse=True):
        n = left[size]
        while n:
            room = min((r for r in rooms if r >= size), default=None)
            if room is None:
                held, per = (), capacity // size
                bins, rest = divmod(n, per)
                for count, copies in ((bins, per), (1, rest)):
                    if count and copies:
                        _add(rooms, capacity - copies * size, (*held, (size, copies)), count)
                n = 0
                continue
            held, count = rooms[room].popitem()
            if not rooms[room]:
                del rooms[room]
            per = room // size
            bins = min(count, n // per)
            if bins:
                _add(rooms, room - per * size, (*held, (size, per)), bins)
                n -= bins * per
            if bins < count:
                if n and n < per:
                    _add(rooms, room - n * size, (*held, (size, n)), 1)
                    bins, n = bins + 1, 0
                if bins < count:
                    _add(rooms, room, held, count - bins)
    return [(dict(held), count) for room in sorted(rooms) for held, count in rooms[room].items()]


def _add(rooms: dict[int, dict[tuple, int]], room: int, held: tuple, count: int) -> None:
    same = rooms.setdefault(room, {})
    same[held] = same.get(held, 0) + count


def plan_patterns(
    histogram: dict[int, int], capacity: int, gap: float = GAP
) -> list[tuple[dict[int, int], int]]:
    """Patterns (pieces per length) with their multiplicities, covering the histogram exactly.

    Rates are rounded down; what is left over is packed by best fit. Best fit alone is the plan if it
    needs fewer sequences. The work depends on the number of different lengths (at most
    `capacity`), not of pieces.
    """
    plan = [({capacity: 1}, histogram[capacity])] if histogram.get(capacity) else []
    lengths = np.array(sorted(n for n, c in histogram.items() if c and n < capacity), dtype=int)
    if not len(lengths):
        return plan
    demand = np.array([histogram[n] for n in lengths], dtype=float)
    columns, rates = column_generation(lengths, demand, capacity, gap)
    left = np.array([histogram[n] for n in lengths], dtype=np.int64)
    rounded = []
    for k in np.argsort(-rates):
        column = np.rint(columns[:, k]).astype(np.int64)
        used = column > 0
        times = int(min(np.floor(rates[k] + 1e-6), (left[used] // column[used]).min()))
        if times > 0:
            left -= times * column
            rounded.append(({int(lengths[i]): int(column[i]) for i in np.flatnonzero(used)}, times))
    rounded += _best_fit({int(n): int(c) for n, c in zip(lengths, left, strict=True) if c}, capacity)
    plain = _best_fit({int(n): int(histogram[n]) for n in lengths}, capacity)
    return plan + min(rounded, plain, key=lambda p: sum(n for _, n in p))


def place_table(plan: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """Per length: rows (first rank, copies per sequence, first sequence, first slot)."""
    table, used, sequence = defaultdict(list), defaultdict(int), 0
    for pattern, times in plan:
        slot = 0
        for length, copies in sorted(pattern.items(), reverse=True):
            table[length].append((used[length], copies, sequence, slot))
            used[length] += copies * times
            slot += copies
        sequence += times
    return {length: np.array(rows, dtype=np.int64) for length, rows in table.items()}


def _pieces(id_type: str, capacity: int, unit: int, ranks_path: str, pattern: str):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "units", "part", "local_rank"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(ranks_path, pattern)

        def encode(text: str) -> list[int]:
            if any(token in text for token in SPECIAL):
                return model.encode(text, allowed_special="all")
            return model.encode_ordinary(text)

        part, seen = TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            source, starts, lengths, sums, totals, units, ranks = ([] for _ in range(7))
            for row, text in enumerate(batch.column(1)):
                ids = encode(text.as_py() or "")
                ids.append(END_ID)
                raw = np.array(ids, dtype="<u4").tobytes()
                for start in range(0, len(ids), capacity):
                    length = min(capacity, len(ids) - start)
                    source.append(row)
                    starts.append(start)
                    lengths.append(length)
                    sums.append(zlib.crc32(raw[4 * start : 4 * (start + length)]))
                    totals.append(len(ids))
                    size = -(-length // unit)
                    units.append(size)
                    ranks.append(seen[size])
                    seen[size] += 1
            longs = [pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals, units)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(source, pa.int64())),
                    *longs,
                    pa.array([part] * len(source), pa.int32()),
                    pa.array(ranks, pa.int64()),
                ],
                names=names,
            )

    kinds = f"doc_id {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    return run, f"{kinds}, units bigint, part int, local_rank bigint"


def _dealt(table: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, ranks = batch.column("units").to_numpy(), batch.column("rank").to_numpy()
            sequence, slot = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
            for size in np.unique(units):
                here = np.flatnonzero(units == size)
                rows, rank = table[int(size)], ranks[here]
                row = rows[np.searchsorted(rows[:, 0], rank, side="right") - 1]
                nth, copy = np.divmod(rank - row[:, 0], row[:, 1])
                sequence[here], slot[here] = row[:, 2] + nth, row[:, 3] + copy
            kept = [batch.column(c) for c in FACTS]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(slot)], names=[*FACTS, "sequence_id", "slot"]
            )

    return run


def pack_documents(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    capacity: int = 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
    unit: int = UNIT,
    gap: float = GAP,
) -> DataFrame:
    """Assign every token of every document to a place in a sequence of `capacity` tokens.

    A document is its text's ids and then id 0 (a null text: only id 0). It is cut into
    full pieces and one rest. The histogram of piece lengths, in units of `unit` tokens (at
    most capacity / unit numbers, whatever the corpus), goes to the driver, which solves
    the cutting-stock program: patterns of lengths from column generation, which starts from
    first-fit patterns and is priced by a knapsack, rounded down, the remainder by best fit. Pieces are ranked per length in
    input order (rank within the task that tokenised them plus the counts of earlier
    tasks, so no sort and no hot length), ranks are dealt to the patterns' places, and
    the pieces of a sequence (at most `capacity`) are laid end to end.

    The string of the vocabulary's special token is that token, as its tokenizer has it. Ids and repeated rows need not be
    unique: each row is packed on its own. Other columns are ignored. An empty table
    gives no rows.

    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id (0, 1, ...), offset.
    """
    if capacity % unit:
        raise ValueError("the capacity must be a multiple of the unit")
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    run, schema = _pieces(dict(narrow.dtypes)["doc_id"], capacity, unit, ranks_path, pattern)
    pieces = stored(narrow.mapInArrow(run, schema), "pack-pieces")
    counts = stored(
        pieces.groupBy("units", "part").agg(F.count(F.lit(1)).alias("n")), "pack-counts"
    )
    found = counts.groupBy("units").agg(F.sum("n").alias("n")).collect()
    table = place_table(plan_patterns({r["units"]: r["n"] for r in found}, capacity // unit, gap))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    earlier = before.partitionBy("units").orderBy("part")
    bases = counts.select("units", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["units", "part"]).withColumn(
        "rank", F.col("base") + F.col("local_rank")
    )
    kinds = dict(pieces.dtypes)
    dealt = ranked.mapInArrow(
        _dealt(table),
        ", ".join(f"{c} {kinds[c]}" for c in FACTS) + ", sequence_id bigint, slot bigint",
    )
    offset = F.sum("length").over(before.partitionBy("sequence_id").orderBy("slot"))
    return dealt.select(*FACTS, "sequence_id", F.coalesce(offset, F.lit(0)).alias("offset"))
