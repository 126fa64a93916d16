"""Spelling variants: words one edit apart, found by probing edits against Bloom filters."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import stored
from tierflow.llm.wordhash import Powers, mixed
from tierflow.operators.sets import union_all_by_name

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Words that a task counts before it hands on what it has.
FLUSH = 200_000
#: Bytes of all filters that are sent to the tasks at a time, and of filter per word.
FILTER_BYTES, WORD_BYTES = 32 << 20, 4
#: A filter block is a cache line of 64-bit words; a key sets three bits in each of two of them.
BLOCK_WORDS = 8
#: Words of this many code points and more share a filter.
LONGEST = 64
#: Code points whose edits are hashed at a time, and words of a piece of the filter.
CODES, PIECE = 1 << 18, 1 << 13
_POWERS = Powers(0x9E3779B97F4A7C15)


def lowered(run: str) -> str:
    """Only A-Z become lower case."""
    return run.lower() if run.isascii() else run.encode().lower().decode()


def _counted(min_length: int, every: int):
    """Words of a task with their occurrences."""
    runs = re.compile(RUN.pattern.replace("+", f"{{{min_length},}}"))

    def rows(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = Counter(runs.findall(text.as_py() or ""))
                folded: Counter = Counter()
                for word, n in own.items():
                    folded[lowered(word)] += n
                if doc is None or not every:
                    seen.update(folded)
                else:
                    start = zlib.crc32(f"{doc}:".encode())
                    for word, n in folded.items():
                        h = zlib.crc32(word.encode(), start)
                        if h % every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < min_length:
                                continue
                        seen[word] += n
                if len(seen) >= FLUSH:
                    yield rows(seen)
                    seen = Counter()
        if seen:
            yield rows(seen)

    return run


class _Codes:
    """Code points of some words, one after the other, with the sums that edits are hashed from."""

    def __init__(self, words: list[str]):
        self.words = words
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        self.ends = np.cumsum(self.lengths)
        self.word = np.repeat(np.arange(len(words)), self.lengths)
        self.place = np.arange(len(self.codes)) - (self.ends - self.lengths)[self.word]
        self.up, self.down = _POWERS.upto(int(self.lengths.max(initial=0)) + 2)
        terms = letter_values(self.codes) * self.up[self.place]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        starts = sums[self.ends - self.lengths]
        self.sums = sums[self.ends] - starts
        self.before = sums[:-1] - starts[self.word]
        self.own = terms

    def deletions(self) -> tuple[np.ndarray, np.ndarray]:
        """Places whose deletion gives a new word, and the sums of the words left."""
        same = np.zeros(len(self.codes), bool)
        same[1:] = (self.codes[1:] == self.codes[:-1]) & (self.place[1:] > 0)
        at = np.flatnonzero(~same)
        rest = self.sums[self.word[at]] - self.before[at] - self.own[at]
        return at, self.before[at] + rest * self.down[1]

    def replacements(self, letter: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of smaller code points, and the sums with `letter` there instead."""
        at = np.flatnonzero(self.codes < letter)
        value = letter_values(np.array([letter], np.uint32))
        return at, self.sums[self.word[at]] - self.own[at] + value * self.up[self.place[at]]


def letter_values(codes: np.ndarray) -> np.ndarray:
    return mixed((codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))


def keys_of(sums: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Filter keys: a word's polynomial sum and its length, mixed."""
    return mixed(sums ^ (lengths.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)))


class FilterPlan:
    """Where the keys of a length lie: `blocks` cache lines from `first`, those of one part of `parts`.

    A plan is what one round sends to the tasks. Lengths whose filter exceeds the limit are
    cut by hash into parts, each part in a round of its own; the number of rounds grows with
    the vocabulary and the size of a round does not.
    """

    def __init__(self, shards: list[tuple[int, int, int, int, int]]):
        self.shards = {length: (first, blocks, part, parts) for length, first, blocks, part, parts in shards}
        self.size = max((first + blocks for _, first, blocks, *_ in shards), default=0)
        table = np.zeros((LONGEST + 1, 4), np.uint64)
        for length, values in self.shards.items():
            table[length] = values
        self.table = table

    def places(self, keys: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys belong to this round, and their blocks."""
        first, blocks, part, parts = self.table[np.minimum(lengths, LONGEST)].T
        mine = blocks > 0
        split = np.flatnonzero(parts > 1)
        mine[split] &= (keys[split] & np.uint64(0xFFFF)) % parts[split] == part[split]
        at = np.flatnonzero(mine)
        block = first[at] + ((keys[at] >> np.uint64(32)) * blocks[at] >> np.uint64(32))
        return at, block.astype(np.int64)


def plan_rounds(
    counts: dict[int, int], filter_bytes: int = FILTER_BYTES, word_bytes: int = WORD_BYTES
) -> list[FilterPlan]:
    """Rounds of filters, none larger than `filter_bytes`, for the numbers of words by length."""
    line = 8 * BLOCK_WORDS
    limit = max(filter_bytes // line, 1)
    rounds, shards, first = [], [], 0
    for length, n in sorted(counts.items()):
        need = -(-n * word_bytes // line)
        parts = -(-need // limit)
        blocks = -(-need // parts)
        for part in range(parts):
            if first + blocks > limit and shards:
                rounds.append(FilterPlan(shards))
                shards, first = [], 0
            shards.append((length, first, blocks, part, parts))
            first += blocks
    return [*rounds, FilterPlan(shards)] if shards else rounds


def _bits(keys: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Two words of a block with three bits each."""
    more = mixed(keys ^ np.uint64(0x85EBCA77C2B2AE63))
    one, six = np.uint64(1), np.uint64(63)
    lower = more & np.uint64(7)
    upper = (lower + one + ((more >> np.uint64(3)) & np.uint64(3))) & np.uint64(7)
    out = []
    for k, word in enumerate((lower, upper)):
        bits = np.zeros(len(keys), np.uint64)
        for j in range(3):
            bits |= one << ((more >> np.uint64(8 + 18 * k + 6 * j)) & six)
        out.append((word.astype(np.int64), bits))
    return out


def _filter_cells(plan: FilterPlan):
    """The filter words that the vocabulary words of a task set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = _Codes(batch.column("word").to_pylist())
            keys = keys_of(codes.sums, codes.lengths)
            at, block = plan.places(keys, codes.lengths)
            cells, bits = [], []
            for word, mask in _bits(keys[at]):
                cells.append(block * BLOCK_WORDS + word)
                bits.append(mask)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(cells)), pa.array(np.concatenate(bits).view(np.int64))],
                names=["cell", "bits"],
            )

    return run


def _filter_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring filter words, in order, as pieces of the filter."""
    for batch in batches:
        cells, bits = batch.column("cell").to_numpy(), batch.column("bits").to_numpy().view(np.uint64)
        owner = cells // PIECE
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        blobs = []
        for rows in np.split(np.arange(len(cells)), starts[1:]) if len(cells) else []:
            piece = np.zeros(PIECE, np.uint64)
            piece[cells[rows] % PIECE] = bits[rows]
            blobs.append(piece.tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(owner[starts]), pa.array(blobs, pa.binary())], names=["id", "piece"]
        )


def build_filter(words: DataFrame, plan: FilterPlan) -> np.ndarray:
    """The filter of one round, which the plan bounds."""
    cells = words.mapInArrow(_filter_cells(plan), "cell bigint, bits bigint")
    merged = cells.groupBy("cell").agg(F.bit_or("bits").alias("bits"))
    ordered = merged.repartitionByRange("cell").sortWithinPartitions("cell")
    out = np.zeros(-(-plan.size * BLOCK_WORDS // PIECE) * PIECE, np.uint64)
    for row in ordered.mapInArrow(_filter_pieces, "id bigint, piece binary").collect():
        out[row["id"] * PIECE : (row["id"] + 1) * PIECE] |= np.frombuffer(row["piece"], np.uint64)
    return out


def _passing(table: np.ndarray, plan: FilterPlan, sums: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Which edits the filter of this round holds."""
    keys = keys_of(sums, lengths)
    at, block = plan.places(keys, lengths)
    for k in range(2):
        word, mask = _bits(keys[at])[k]
        hit = (table[block * BLOCK_WORDS + word] & mask) == mask
        at, block = at[hit], block[hit]
    return at


def _probe(plan: FilterPlan, filters, letters: list[int]):
    """Edits of the words that pass the filter: one code point less, or a greater one instead.

    An insertion is a deletion seen from the longer word and a smaller letter a greater one
    seen from the other word, so every pair of near words is met once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = filters.value
        for batch in batches:
            words, counts = batch.column("word").to_pylist(), batch.column("n").to_pylist()
            sizes = np.cumsum([len(w) for w in words])
            start = 0
            while start < len(words):
                done = sizes[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(sizes, done + CODES, "right")))
                yield _probed(words[start:stop], counts[start:stop], table, plan, letters)
                start = stop

    return run


def _probed(words: list[str], counts: list[int], table: np.ndarray, plan: FilterPlan, letters) -> pa.RecordBatch:
    codes = _Codes(words)
    near, owner = [], []
    at, sums = codes.deletions()
    hits = at[_passing(table, plan, sums, codes.lengths[codes.word[at]] - 1)]
    for k, place in zip(codes.word[hits].tolist(), codes.place[hits].tolist(), strict=True):
        near.append(words[k][:place] + words[k][place + 1 :])
        owner.append(k)
    for letter in letters:
        at, sums = codes.replacements(letter)
        hits = at[_passing(table, plan, sums, codes.lengths[codes.word[at]])]
        for k, place in zip(codes.word[hits].tolist(), codes.place[hits].tolist(), strict=True):
            near.append(words[k][:place] + chr(letter) + words[k][place + 1 :])
            owner.append(k)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(near, pa.string()),
            pa.array([words[k] for k in owner], pa.string()),
            pa.array([counts[k] for k in owner], pa.int64()),
        ],
        names=["near", "word", "n"],
    )


def _letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: set[str] = set()
    for batch in batches:
        for word in batch.column("word"):
            found.update(word.as_py())
    yield pa.RecordBatch.from_arrays([pa.array([ord(c) for c in sorted(found)], pa.int32())], names=["letter"])


def near_words(vocabulary: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Pairs of words that differ by one inserted, deleted or replaced code point, once each.

    Takes word and n, one row per word. Each round sends the filters of some lengths to the tasks
    and probes the words that can have an edit there; what passes is joined with
    the vocabulary, which removes the false positives.

    Returns word, n, near, near_n.
    """
    spark = vocabulary.sparkSession
    capped = F.least(F.length("word"), F.lit(LONGEST))
    counts = {row["k"]: row["c"] for row in vocabulary.groupBy(capped.alias("k")).agg(F.count("*").alias("c")).collect()}
    # At most 90 letters can stand in a word.
    letters = sorted(r["letter"] for r in vocabulary.mapInArrow(_letters, "letter int").distinct().collect())
    found = []
    for plan in plan_rounds(counts, filter_bytes):
        held = sorted(plan.shards)
        filters = spark.sparkContext.broadcast(build_filter(vocabulary.filter(capped.isin(held)), plan))
        asking = vocabulary.filter(capped.isin(sorted({*held, *(k + 1 for k in held)})))
        edits = asking.mapInArrow(_probe(plan, filters, letters), "near string, word string, n bigint")
        found.append(edits)
    if not found:
        return spark.createDataFrame([], "word string, n bigint, near string, near_n bigint")
    edits = stored(union_all_by_name(found), "spelling-edits")
    known = vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    return edits.join(known, "near").select("word", "n", "near", "near_n")


def roots(forms: DataFrame, max_rounds: int = 40) -> DataFrame:
    """The last word that each word's forms lead to. Takes word and form, with no cycles.

    Every round doubles the length of the steps.
    """
    steps = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    for _ in range(max_rounds):
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        longer = steps.join(further, "root", "left")
        steps = stored(
            longer.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")),
            "spelling-roots",
        )
        if steps.filter("moved").isEmpty():
            return steps.select("word", "root")
        steps = steps.select("word", "root")
    raise RuntimeError(f"forms lead on after {max_rounds} rounds")


def vocabulary_of(
    docs: DataFrame,
    min_length: int = 7,
    min_count: int = 2,
    misspell_every: int = 31,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Counted words of the documents.

    Runs of letters are lower-cased (A-Z only); where `misspell_every` divides the checksum of
    document id and run, one code point of the run is left out (never with 0, nor where the
    id is null).
    """
    texts = docs.select(F.col(f"`{id_col}`").cast("string"), f"`{text_col}`")
    counted = texts.mapInArrow(_counted(min_length, misspell_every), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def spelling_variants(
    docs: DataFrame,
    min_length: int = 7,
    min_count: int = 2,
    ratio: int = 10,
    misspell_every: int = 31,
    id_col: str = "doc_id",
    text_col: str = "text",
    filter_bytes: int = FILTER_BYTES,
) -> DataFrame:
    """Groups the words of all documents with the frequent words that they are variants of.

    A word's form is its most frequent near word (equal counts: the smallest in
    code-point order) if that one is at least `ratio` times as frequent; its root is the last of
    the forms that follow one another.

    Null and empty texts hold no words. Rows that share a document id are documents of their own,
    and equal rows count again. Very long texts and words are taken whole. Empty tables give no
    rows. Other columns are not read, whatever their names.

    Returns word, form, root, n, n_near, form_n.
    """
    words = stored(
        vocabulary_of(docs, min_length, min_count, misspell_every, id_col, text_col), "spelling-words"
    )
    pairs = near_words(words, filter_bytes)
    sides = F.array(
        F.struct(F.col("word").alias("w"), F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("form")).alias("x")),
        F.struct(F.col("near").alias("w"), F.struct((-F.col("n")).alias("m"), F.col("word").alias("form")).alias("x")),
    )
    each = pairs.select(F.explode(sides).alias("side")).select("side.w", "side.x")
    best = each.groupBy("w").agg(F.count(F.lit(1)).alias("n_near"), F.min("x").alias("x"))
    joined = words.join(best.withColumnRenamed("w", "word"), "word", "left")
    enough = -F.col("x.m") >= ratio * F.col("n")
    decided = stored(
        joined.select(
            "word",
            F.when(enough, F.col("x.form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(enough, -F.col("x.m")).alias("form_n"),
        ),
        "spelling-forms",
    )
    led = roots(decided.filter("form is not null"))
    return decided.join(led, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
