"""Exact Jaccard self-join on word shingles by distributed T-occurrence search."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import free_name, shuffle_partitions, stored
from tierflow.llm.components import components
from tierflow.llm.shingles import overlap, packed, set_digest, shingle_set, shingle_sets, unpacked

#: Shingles in more documents than HEAVY are told apart by frequency, the HEAVY_KEYS most
#: frequent at most (12 bytes each go to every task).
HEAVY, HEAVY_KEYS = 2, 1 << 20
#: Matches asked for among the short lists, so that chance matches do not become candidates.
MATCHES = 4
#: Lists longer than SHORT_LIST are first joined to one member; lists longer than BLOCK
#: are cut into blocks of about that many documents.
SHORT_LIST, BLOCK = 8, 4096
#: Shingles that a task holds before it hands on what it has gathered.
FLUSH = 500_000
#: Texts that are fetched by sending their ids to every task (about 50 bytes each).
MAX_BROADCAST = 300_000
#: Sets and shingles in a block when the links of a component are counted, about, and
#: columns of the table of sets and shingles that are held at a time.
COUNTED_SETS, COUNTED_SHINGLES, COLUMNS = 128, 1 << 20, 1 << 15
#: Rounds in which members outside a list's largest component meet only one inside it: the
#: one with the fewest shingles of its own, then any.
ROUNDS = 2


def required(size, percent: int):
    """Least overlap of a set of this size with any set it links with."""
    return (percent * size + 99) // 100


def entity_of(digest: bytes) -> int:
    """Short name of a set in the lists: the first half of its digest, as a signed number."""
    return int.from_bytes(digest[:8], "little", signed=True)


def _profile_schema(id_type: str) -> str:
    return f"doc_id {id_type}, n_shingles bigint, digest binary, e bigint"


def _profile(width: int, keep_text: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, entities = [], [], []
            for found in shingle_sets(batch.column(1), width):
                sizes.append(len(found))
                digests.append(set_digest(found) if len(found) else None)
                entities.append(entity_of(digests[-1]) if len(found) else None)
            kinds = [pa.int64(), pa.binary(), pa.int64()]
            lists = zip((sizes, digests, entities), kinds, strict=True)
            columns = [batch.column(0), *[pa.array(c, k) for c, k in lists]]
            names = ["doc_id", "n_shingles", "digest", "e"]
            if keep_text:
                columns, names = [*columns, batch.column(1)], [*names, "text"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _runs(keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """Parts of a sorted key array by their leading bits."""
    lead = (keys >> np.uint64(64 - bits)).astype(np.int64)
    starts = np.flatnonzero(np.diff(lead, prepend=-1))
    for at, end in zip(starts, [*starts[1:], len(keys)], strict=True):
        yield int(lead[at]), slice(at, end)


def _counted(width: int, bits: int):
    """Shingles of a task with their document counts, one row per hash range."""

    def rows(sets: list[np.ndarray]) -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate(sets) >> np.uint64(32 - bits), return_counts=True)
        full = keys << np.uint64(32 - bits)
        found = [
            (lead, packed((keys[part] & np.uint64(0xFFFFFFFF)).astype(np.uint32)), counts[part])
            for lead, part in _runs(full, bits)
        ]
        several = [np.flatnonzero(c > 1).astype("<u4") for _, _, c in found]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([f[0] for f in found], pa.int32()),
                pa.array([f[1] for f in found], pa.binary()),
                pa.array([s.tobytes() for s in several], pa.binary()),
                pa.array(
                    [f[2][s].astype("<u4").tobytes() for f, s in zip(found, several, strict=True)],
                    pa.binary(),
                ),
            ],
            names=["lead", "keys", "at", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, held, seen = [], 0, set()
        for batch in batches:
            for found in shingle_sets(batch.column(1), width):
                if not len(found) or (digest := set_digest(found)) in seen:
                    continue
                seen.add(digest)
                sets.append(found)
                held += len(found)
                if held >= FLUSH:
                    yield rows(sets)
                    sets, held, seen = [], 0, set()
        if sets:
            yield rows(sets)

    return run


def _frequent(bits: int, least: int):
    """Keys of one hash range that more than `least` documents have."""

    def run(table: pa.Table) -> pa.Table:
        keys, counts = [], []
        for row in table.to_pylist():
            key = unpacked(row["keys"])
            count = np.ones(len(key), np.int64)
            count[np.frombuffer(row["at"], "<u4")] = np.frombuffer(row["counts"], "<u4")
            keys.append(key)
            counts.append(count)
        key, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate(counts)).astype(np.int64)
        often = total > least
        lead = np.uint64(table.column("lead")[0].as_py()) << np.uint64(32)
        full = (key[often].astype(np.uint64) + lead).astype(np.int64)
        return pa.table({"key": full, "n": total[often]})

    return run


def frequent_keys(texts: DataFrame, width: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys (leading bits + 32 of the hash) of the longest inverted lists, and counts.

    Every shingle of every document is counted; equal sets count once per task. Tasks
    send one row per hash range, holding its keys as compressed differences. The limit on
    the number of keys raises the threshold, by powers of two, instead of cutting ties;
    it changes the order in which lists are read, never the result.
    """
    parts = texts.mapInArrow(
        _counted(width, bits), "lead int, keys binary, at binary, counts binary"
    )
    found = stored(
        parts.groupBy("lead").applyInArrow(_frequent(bits, HEAVY), "key bigint, n bigint"),
        "join-frequent",
    )
    level = F.floor(F.log2("n")).cast("int")
    sizes = sorted(found.groupBy(level.alias("l")).agg(F.count(F.lit(1)).alias("k")).collect())
    least, total = 64, 0
    for row in reversed(sizes):
        total += row["k"]
        if total > HEAVY_KEYS:
            break
        least = row["l"]
    rows = found.filter(level >= least).toArrow().sort_by("key")
    return (
        rows.column("key").to_numpy().astype(np.uint64),
        rows.column("n").to_numpy().astype(np.uint32),
    )


def _postings(width: int, bits: int, percent: int, heavy: tuple[np.ndarray, np.ndarray]):
    """Rare-first prefixes of a task's documents, one row per hash range and block."""
    keys, counts = heavy

    def frequency(shingles: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(len(shingles), np.int64)
        wanted = shingles >> np.uint64(32 - bits)
        at = np.searchsorted(keys, wanted)
        at[at == len(keys)] = 0
        return np.where(keys[at] == wanted, counts[at], 0).astype(np.int64)

    def rows(found: list[tuple[np.ndarray, np.ndarray, int, int]]) -> pa.RecordBatch:
        lengths = [len(f[0]) for f in found]
        h = np.concatenate([f[0] for f in found])
        freq = np.concatenate([f[1] for f in found])
        e = np.repeat(np.array([f[2] for f in found], np.int64), lengths).view(np.uint64)
        n = np.repeat(np.array([f[3] for f in found], np.int64), lengths)
        blocks = np.maximum(1, -(-freq // BLOCK))
        block = ((e >> np.uint64(20)) % blocks.astype(np.uint64)).astype(np.int64)
        order = np.lexsort((h, block))
        h, e, n, blocks, block = (x[order] for x in (h, e, n, blocks, block))
        out = []
        for b in np.unique(block):
            part = slice(*np.searchsorted(block, [b, b + 1]))
            for lead, run in _runs(h[part], bits):
                at = slice(part.start + run.start, part.start + run.stop)
                columns = (h[at], e[at], n[at].astype("<u4"), blocks[at].astype("<u4"))
                out.append((lead, int(b), *(c.tobytes() for c in columns)))
        kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 4]
        columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["lead", "block", "h", "e", "n", "blocks"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held, seen = [], 0, set()
        for batch in batches:
            for shingles in shingle_sets(batch.column(1), width):
                size = len(shingles)
                if not size or (digest := set_digest(shingles)) in seen:
                    continue
                seen.add(digest)
                least = required(size, percent)
                many = size - least + min(MATCHES, least)
                freq = frequency(shingles)
                order = np.lexsort((shingles, freq))[:many]
                found.append((shingles[order], freq[order], entity_of(digest), size))
                held += many
                if held >= FLUSH // 2:
                    yield rows(found)
                    found, held, seen = [], 0, set()
        if found:
            yield rows(found)

    return run


def _lists(table: pa.Table) -> pa.Table:
    """Inverted lists of one hash range and block, without those of a single document.

    Each member of a list is given the list's lead: its member with the smallest digest.
    """
    kinds = {"h": "<u8", "e": "<u8", "n": "<u4", "blocks": "<u4"}
    h, e, n, blocks = (
        np.concatenate([np.frombuffer(b, k) for b in table.column(c).to_pylist()])
        for c, k in kinds.items()
    )
    order = np.lexsort((e, h))
    h, e, n, blocks = (x[order] for x in (h, e, n, blocks))
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (e[1:] != e[:-1])
    h, e, n, blocks = (x[fresh] for x in (h, e, n, blocks))
    starts = np.flatnonzero(np.diff(h, prepend=h[0] ^ np.uint64(1)))
    lengths = np.diff(starts, append=len(h))
    first, size = np.repeat(starts, lengths), np.repeat(lengths, lengths)
    keep = (size > 1) | (blocks > 1)
    block = table.column("block")[0].as_py() if len(table) else 0
    return pa.table(
        {
            "h": h[keep].view(np.int64),
            "e": e[keep].view(np.int64),
            "n": n[keep].astype(np.int64),
            "block": np.full(keep.sum(), block, np.int64),
            "blocks": blocks[keep].astype(np.int64),
            "lead_e": e[first][keep].view(np.int64),
            "members": size[keep].astype(np.int64),
        }
    )


def _verified(width: int, percent: int):
    """Pairs whose sets reach the similarity; the set of the right side is kept while it lasts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, right = None, None
        for batch in batches:
            x, y = [], []
            lefts = shingle_sets(batch.column("text_x"), width)
            names = [batch.column(c).to_pylist() for c in ("x", "y")]
            for at, (name, other, left) in enumerate(zip(*names, lefts, strict=True)):
                if other != last:
                    last, right = other, shingle_set(batch.column("text_y")[at].as_py(), width)
                common = overlap(left, right)
                if 100 * common >= percent * (len(left) + len(right) - common):
                    x.append(name)
                    y.append(other)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, batch.schema.field("x").type), pa.array(y, batch.schema.field("y").type)],
                names=["x", "y"],
            )

    return run


def _similar_sizes(n: str, m: str, percent: int):
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _links(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (x, y) that link, by fetching both texts and comparing whole sets."""
    kind = dict(pairs.dtypes)["x"]
    left = texts.select(F.col("node").alias("x"), F.col("text").alias("text_x"))
    right = texts.select(F.col("node").alias("y"), F.col("text").alias("text_y"))
    fetched = pairs.select("x", "y").join(left, "x").join(right, "y")
    return stored(
        fetched.select("x", "y", "text_x", "text_y").mapInArrow(
            _verified(width, percent), f"x {kind}, y {kind}"
        ),
        "join-links",
    )


def jaccard_join(
    docs: DataFrame,
    width: int = 4,
    percent: int = 85,
    id_col: str = "doc_id",
    text_col: str = "text",
    count_links: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """All documents with the component that links of Jaccard >= percent / 100 put them in.

    Documents with equal sets are one entity. For an entity with n shingles, every partner
    shares at least T = ceil(0.85 n). DivideSkip: the longest T - MATCHES lists are set
    aside, the remaining short lists (rarest shingles first, by counts over the whole
    corpus) are merged, and the partners that meet often enough there are candidates, whose
    other shingles are probed by binary search in the partner's whole sorted set. Merging
    is one grouping by hash range, with lists beyond BLOCK documents cut into blocks.

    Groups of thousands of near copies would fill each list with pairs of one group. So
    members of lists beyond SHORT_LIST are first compared with the list's lead alone (and
    leads of blocks with each other); components are formed, and in ROUNDS more turns
    members outside a list's largest component are compared with one inside it, first with
    the one that has the fewest shingles of its own. After that the lists are merged by set and
    group instead of by pair. A group is a component, or the single sets that meet the same head
    often. A set visits each larger group that it meets often enough, and all
    members there that can be partners are probed, in blocks; single sets also visit
    their own group. That loses no link. A group costs each visitor one row and one more
    per block of members; the probing itself is quadratic in a group of near copies.

    Null or empty texts have no shingles and link with nothing. Rows that share an id are
    one document. Rows without an id stay in the result, in the component of an equal set
    that has an id, else without one. Other columns are ignored; an empty table gives no
    rows.

    With `count_links` the documents also have n_links, how many other documents they link
    with: all pairs of sets inside a component are compared, block by block. The `links`
    that are returned are those that were needed to find the components.

    Returns (documents: doc_id, n_shingles, component_id; links verified: x, y).
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[id_col]
    bits = int(np.clip(np.ceil(np.log2(4 * shuffle_partitions(spark))), 4, 24))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    profile = stored(texts.mapInArrow(_profile(width), _profile_schema(kind)), "join-profile")
    classes = stored(
        profile.filter("digest is not null")
        .groupBy("digest", "e", "n_shingles")
        .agg(F.min("doc_id").alias("node")),
        "join-classes",
    )
    nodes = classes.filter("node is not null").withColumnRenamed("n_shingles", "n")
    heavy = frequent_keys(texts, width, bits)
    postings = texts.mapInArrow(
        _postings(width, bits, percent, heavy),
        "lead int, block bigint, h binary, e binary, n binary, blocks binary",
    )
    lists = stored(
        postings.groupBy("lead", "block").applyInArrow(
            _lists,
            "h bigint, e bigint, n bigint, block bigint, blocks bigint, lead_e bigint, "
            "members bigint",
        ),
        "join-lists",
    )
    # Classes whose digests begin alike share an entity; all of them get its rows.
    entities = nodes.select("e", "node").distinct()

    leads = lists.filter(F.col("members") > SHORT_LIST).select("e", "lead_e", "n").distinct()
    across = lists.filter("blocks > 1").select("h", "lead_e").distinct()
    top = across.groupBy("h").agg(F.min("lead_e").alias("top"))
    across = across.join(top, "h").select(F.col("lead_e").alias("e"), F.col("top").alias("lead_e"))
    near = (
        leads.select("e", "lead_e").unionByName(across).filter("e <> lead_e").distinct()
        .join(entities.withColumnRenamed("node", "x"), "e")
        .join(entities.select(F.col("e").alias("lead_e"), F.col("node").alias("y")), "lead_e")
        .filter("x <> y")
        .select("x", "y")
    )
    sized = (
        near.join(nodes.select(F.col("node").alias("x"), F.col("n").alias("nx")), "x")
        .join(nodes.select(F.col("node").alias("y"), F.col("n").alias("ny")), "y")
        .filter(_similar_sizes("nx", "ny", percent))
        .select("x", "y")
    )
    first = stored(sized, "join-leads")
    # Shingles of a prefix that are in no list are the set's own.
    prefix = F.col("n") - required_col("n", percent) + F.least(F.lit(MATCHES), required_col("n", percent))
    held = lists.groupBy("e").agg(F.count(F.lit(1)).alias("held"))
    members = stored(
        lists.join(entities, "e").join(held, "e").select("h", "node", "n", (prefix - F.col("held")).alias("lone")),
        "join-members",
    )
    texts_of = _fetch(texts, first, nodes, width, kind)
    links = _links(first, texts_of, width, percent)
    parts = components(links, "x", "y")
    for turn in range(ROUNDS):
        pairs = stored(_inward(members, parts, percent, turn), "join-inward")
        found = _links(pairs, _fetch(texts, pairs, nodes, width, kind), width, percent)
        links = stored(links.unionByName(found), "join-inward-links")
        parts = components(links, "x", "y")
    visits, hosts = _visits(members, parts, percent)
    asked = visits.select("x").union(hosts.select("node")).select("x", F.col("x").alias("y"))
    fetched = _fetch(texts, asked, nodes, width, kind)
    more = _joined(visits, hosts, fetched, percent, width, kind)
    links = stored(links.unionByName(more), "join-all-links")
    parts = components(links, "x", "y")

    named = classes.join(parts, "node", "left").select(
        "digest", F.coalesce("component", "node").alias("component_id")
    )
    columns = ["doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")]
    if count_links:
        # A document with an id is not its own partner; one without an id is nobody's.
        copies = profile.filter("digest is not null and doc_id is not null").select("digest", "doc_id")
        copies = copies.distinct().groupBy("digest").agg(F.count(F.lit(1)).alias("copies"))
        sets = stored(nodes.join(parts, "node").join(copies, "digest"), "join-sets")
        linked = _link_counts(sets, texts, nodes, width, percent, kind)
        named = named.join(copies, "digest", "left").join(linked, "digest", "left")
        equal = F.coalesce("copies", F.lit(0)) - F.col("doc_id").isNotNull().cast("bigint")
        n_links = F.coalesce("linked", F.lit(0)) + equal
        columns.append(F.when(F.col("digest").isNull(), 0).otherwise(n_links).alias("n_links"))
    return profile.join(named, "digest", "left").select(*columns), links


def _link_counts(
    sets: DataFrame, texts: DataFrame, nodes: DataFrame, width: int, percent: int, kind: str
) -> DataFrame:
    """For each set of a component the documents of the other sets that it links with.

    Links lie within components, so every pair of sets in a component is compared: in
    blocks of about COUNTED_SETS sets or COUNTED_SHINGLES shingles, each pair of blocks once.
    """
    blocks = sets.groupBy("component").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / COUNTED_SETS), F.ceil(F.sum("n") / COUNTED_SHINGLES)
        ).alias("blocks")
    )
    pairs = sets.select(F.col("node").alias("x"), F.col("node").alias("y"))
    fetched = _fetch(texts, pairs, nodes, width, kind)
    own = F.pmod(F.xxhash64("digest"), F.col("blocks"))
    turns = F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)
    placed = (
        sets.join(blocks, "component")
        .select("component", "digest", "copies", own.alias("own"), turns.alias("turns"))
        .join(fetched.select(F.col("set").alias("digest"), "text"), "digest")
        .select("component", "digest", "copies", "own", "text", F.explode("turns").alias("turn"))
        .withColumn("low", F.least("own", "turn"))
        .withColumn("high", F.greatest("own", "turn"))
    )
    counted = placed.groupBy("component", "low", "high").applyInArrow(
        _counted_links(width, percent), "digest binary, linked bigint"
    )
    return stored(counted.groupBy("digest").agg(F.sum("linked").alias("linked")), "join-counts")


def _counted_links(width: int, percent: int):
    """Links between two blocks of a component, or within one."""

    def run(table: pa.Table) -> pa.Table:
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        own, copies = table.column("own").to_numpy(), table.column("copies").to_numpy()
        sets = list(shingle_sets(table.column("text").combine_chunks(), width))
        sizes = np.array([len(x) for x in sets])
        count = len(sets)
        _, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        # A shingle of a single set is common to no pair.
        number = np.cumsum(often > 1) - 1
        row = np.repeat(np.arange(count), sizes)[often[column] > 1]
        column = number[column[often[column] > 1]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        common = np.zeros((count, count))
        for at in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
            part = slice(*np.searchsorted(column, [at, at + COLUMNS]))
            has = np.zeros((count, min(COLUMNS, int(column[-1]) + 1 - at)), np.float32)
            has[row[part], column[part] - at] = 1
            common += has @ has.T
        link = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
        np.fill_diagonal(link, False)
        if low != high:
            link &= own[:, None] != own[None, :]
        linked = pa.array((link * copies[None, :]).sum(axis=1), pa.int64())
        return pa.table({"digest": table.column("digest"), "linked": linked})

    return run


def _fetch(texts: DataFrame, pairs: DataFrame, nodes: DataFrame, width: int, kind: str) -> DataFrame:
    """One text for every node of the pairs, with the set that the node stands for."""
    wanted = pairs.select(F.col("x").alias("node")).union(pairs.select("y")).distinct()
    wanted = stored(
        wanted.join(nodes, "node").select(F.col("node").alias("doc_id"), F.col("digest").alias("set")),
        "join-wanted",
    )
    # Few enough texts are picked out where they stand; otherwise both sides are shuffled.
    wanted = F.broadcast(wanted) if wanted.count() <= MAX_BROADCAST else wanted
    found = texts.join(wanted.select("doc_id"), "doc_id", "left_semi")
    profiled = found.select("doc_id", "text").mapInArrow(
        _profile(width, keep_text=True), _profile_schema(kind) + ", text string"
    )
    matched = profiled.join(wanted, "doc_id").filter(F.col("digest") == F.col("set"))
    once = matched.groupBy("doc_id", "digest").agg(F.min("text").alias("text"))
    named = once.select(F.col("doc_id").alias("node"), F.col("digest").alias("set"), "text")
    return stored(named, "join-texts")


def _mixed(members: DataFrame, parts: DataFrame) -> DataFrame:
    """Lists with several components: members with their component, the largest one in the list, and its head.

    The head of a list is the component in it that is the largest anywhere; between equal ones
    the set with the fewest shingles of its own decides.
    """
    weights = parts.groupBy("component").agg(F.count(F.lit(1)).alias("weight"))
    known = (
        members.join(parts.join(weights, "component"), "node", "left")
        .withColumns({"c": F.coalesce("component", "node"), "weight": F.coalesce("weight", F.lit(1))})
        .select("h", "node", "n", "lone", "c", "weight")
    )
    per_list = known.groupBy("h", "c").agg(
        F.count(F.lit(1)).alias("k"), F.max("weight").alias("weight"), F.min("lone").alias("lone")
    )
    mixed = (
        per_list.groupBy("h")
        .agg(
            F.max(F.struct("k", "c")).alias("largest"),
            F.max(F.struct("weight", -F.col("lone"), "c")).alias("head"),
            F.count(F.lit(1)).alias("parts"),
        )
        .filter("parts > 1")
        .select("h", F.col("largest.c").alias("major"), F.col("largest.k").alias("size"), F.col("head.c").alias("head"))
    )
    return stored(known.join(mixed, "h"), "join-mixed")


def _inward(members: DataFrame, parts: DataFrame, percent: int, turn: int) -> DataFrame:
    """Members of long lists outside the largest component, each with one member inside it.

    At first that is the one with the fewest shingles of its own: the text that near copies were
    made from links with more of them than they do with each other.
    """
    marked = _mixed(members, parts).filter(F.col("size") >= SHORT_LIST)
    draw = F.struct(F.lit(0) if turn else F.col("lone"), F.xxhash64("node", F.lit(turn)), "node", "n")
    inside = F.col("c") == F.col("major")
    chosen = marked.filter(inside).groupBy("h").agg(F.min(draw).alias("one"))
    return (
        marked.filter(~inside)
        .select("h", "node", "n")
        .join(chosen, "h")
        .filter(_similar_sizes("n", "one.n", percent))
        .select(F.col("node").alias("x"), F.col("one.node").alias("y"))
        .distinct()
    )


def _visits(members: DataFrame, parts: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Sets with the other groups that may hold a partner, and the members to look at there.

    A group is a component, or the sets that no link has joined to any other yet and that meet
    the same head half as often as sets that link must (`loose`). In each list a member meets
    every larger group there once, however many members that has, so a list
    that one group fills costs nothing. The members of a loose group also visit their own group.

    Sets of sizes n and m that link share at least alpha = ceil(percent (n + m) / (100 +
    percent)) shingles. The shared ones outside both merged prefixes lie beyond one of
    the two, so at least alpha minus the longer remainder meet inside. Groups are ordered as a
    whole, so that all these lists count for the member of the smaller one; a group stays when they
    reach the least number asked for by any size that it has there.

    Returns (x, nx, c, loose) and (c, loose, node, n).
    """
    marked = _mixed(members, parts)
    # A node in fewer mixed lists than a partner asks for cannot be its partner.
    degree = marked.groupBy("node", "n", "c", "weight").agg(F.count(F.lit(1)).alias("lists"))
    degree = degree.filter(F.col("lists") >= F.least(F.lit(MATCHES), required_col("n", percent)))
    home = (
        marked.filter("weight = 1")
        .groupBy("node", "n", "head")
        .agg(F.count(F.lit(1)).alias("met"))
        .filter(2 * F.col("met") >= F.greatest(F.lit(2 * MATCHES), least_meetings(F.col("n"), F.col("n"), percent)))
        .groupBy("node")
        .agg(F.max(F.struct("met", "head")).alias("home"))
        .select("node", F.col("home.head").alias("home"))
    )
    grouped = stored(
        degree.join(home, "node", "left").select(
            "node", "n", "lists", F.coalesce("home", "c").alias("c"), F.col("home").isNotNull().alias("loose")
        ),
        "join-groups",
    )
    group = ["c", "loose"]
    ranks = grouped.groupBy(*group).agg(F.count(F.lit(1)).alias("sets"))
    marked = stored(
        marked.select("h", "node").join(grouped.join(ranks, group), "node")
        .withColumn("rank", F.struct("sets", "c", "loose")),
        "join-lists-mixed",
    )
    met = marked.groupBy("h", "rank").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.max("lists").alias("most")
    )
    larger = met.groupBy("h").agg(F.max("rank").alias("top"))
    few = marked.select("h", F.col("node").alias("x"), F.col("n").alias("nx"), F.col("rank").alias("own"), "lists")
    few = few.join(larger, "h").filter("own < top").drop("top")
    low = F.greatest("low", required_col("nx", percent))
    high = F.least("high", F.expr(f"(100 * nx) div {percent}"))
    # Up to nx the number asked for grows with the size, above it falls, but for rounding.
    ends = [least_meetings(F.col("nx"), F.col(end), percent) for end in ("low", "high")]
    asked = F.least(ends[0], ends[1] - 1)
    visits = (
        few.join(met, "h")
        .filter("own < rank")
        .withColumns({"low": low, "high": high})
        .filter("low <= high")
        .filter(asked <= F.least("lists", "most"))
        .groupBy("x", "nx", "rank")
        .agg(F.count(F.lit(1)).alias("met"), F.min("low").alias("low"), F.max("high").alias("high"))
        .filter(F.col("met") >= asked)
        .select("x", "nx", "rank.c", "rank.loose")
    )
    together = grouped.join(ranks.filter("loose and sets > 1"), group)
    visits = visits.unionByName(together.select(F.col("node").alias("x"), F.col("n").alias("nx"), *group))
    visits = stored(visits, "join-visits")
    hosts = grouped.select(*group, "node", "n")
    return visits, stored(hosts.join(visits.select(*group).distinct(), group, "left_semi"), "join-hosts")


def _joined(
    visits: DataFrame, hosts: DataFrame, texts: DataFrame, percent: int, width: int, kind: str
) -> DataFrame:
    """Links of visitors with the members of the groups that they visit, as many as matter.

    The members of a component are joined already, so one link of a visitor says all. Visitors and
    members are compared in blocks of about COUNTED_SETS sets or COUNTED_SHINGLES shingles.
    """
    group = ["c", "loose"]
    blocks = [
        side.groupBy(*group).agg(
            F.greatest(
                F.ceil(F.count(F.lit(1)) / COUNTED_SETS), F.ceil(F.sum(size) / COUNTED_SHINGLES)
            ).alias(name)
        )
        for side, size, name in ((visits, "nx", "left_blocks"), (hosts, "n", "right_blocks"))
    ]
    grid = stored(blocks[0].join(blocks[1], group), "join-grid")

    def dealt(side: DataFrame, node: str, own: str, other: str) -> DataFrame:
        """Rows of a side, once for every block of the other one."""
        turns = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(f"{other}_blocks") - 1))
        return (
            side.select(*group, F.col(node).alias("node"))
            .join(grid, group)
            .join(texts.select("node", "text"), "node")
            .select(
                *group, "node", "text", F.lit(own == "left").alias("visitor"),
                F.pmod(F.xxhash64("node"), F.col(f"{own}_blocks")).alias(own), turns.alias(other),
            )
        )

    placed = dealt(visits, "x", "left", "right").unionByName(dealt(hosts, "node", "right", "left"))
    found = placed.groupBy(*group, "left", "right").applyInArrow(
        _first_links(width, percent), f"x {kind}, y {kind}"
    )
    return stored(found, "join-links")


def _spanning(link: np.ndarray) -> list[tuple[int, int]]:
    """Row and column of the links that suffice to join all rows and columns that links join."""
    rows = link.shape[0]
    above = list(range(sum(link.shape)))

    def root(k: int) -> int:
        while above[k] != k:
            above[k] = above[above[k]]
            k = above[k]
        return k

    kept = []
    for row, column in zip(*np.nonzero(link), strict=True):
        a, b = root(int(row)), root(rows + int(column))
        if a != b:
            above[max(a, b)] = min(a, b)
            kept.append((int(row), int(column)))
    return kept


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Common members of every set on the left with every set on the right."""
    shared = np.intersect1d(np.concatenate(left), np.concatenate(right))
    sides = []
    for sets in (left, right):
        keys = np.concatenate(sets)
        column = np.minimum(np.searchsorted(shared, keys), max(len(shared) - 1, 0))
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        hit = shared[column] == keys if len(shared) else np.zeros(len(keys), bool)
        order = np.argsort(column[hit], kind="stable")
        sides.append((row[hit][order], column[hit][order], len(sets)))
    common = np.zeros((len(left), len(right)))
    for at in range(0, len(shared), COLUMNS):
        both = []
        for row, column, count in sides:
            part = slice(*np.searchsorted(column, [at, at + COLUMNS]))
            has = np.zeros((count, min(COLUMNS, len(shared) - at)), np.float32)
            has[row[part], column[part] - at] = 1
            both.append(has)
        common += both[0] @ both[1].T
    return common


def _first_links(width: int, percent: int):
    """The smallest member of a block that each visitor of another block links with.

    The members of a loose group are not joined yet: there the links that join all that link.
    """

    def run(table: pa.Table) -> pa.Table:
        names, kind = table.column("node"), table.schema.field("node").type
        visitor = table.column("visitor").to_numpy()
        if visitor.all() or not visitor.any():
            return pa.table({"x": pa.array([], kind), "y": pa.array([], kind)})
        sets = list(shingle_sets(table.column("text").combine_chunks(), width))
        at, to = np.flatnonzero(visitor), np.flatnonzero(~visitor)
        to = to[np.argsort(names.take(to).to_numpy(), kind="stable")]
        left, right = [sets[k] for k in at], [sets[k] for k in to]
        common = _overlaps(left, right)
        n, m = np.array([len(s) for s in left]), np.array([len(s) for s in right])
        link = (common > 0) & (100 * common >= percent * (n[:, None] + m[None, :] - common))
        if "loose" in table.column_names and table.column("loose")[0].as_py():
            kept = np.array(_spanning(link), np.int64).reshape(-1, 2)
            return pa.table({"x": names.take(at[kept[:, 0]]), "y": names.take(to[kept[:, 1]])})
        some = np.flatnonzero(link.any(axis=1))
        return pa.table({"x": names.take(at[some]), "y": names.take(to[link[some].argmax(axis=1)])})

    return run


def least_meetings(n: Column, m: Column, percent: int) -> Column:
    """How often two sets of these sizes that link meet in the merged lists, at least."""
    alpha = F.floor((percent * (n + m) + 99 + percent) / (100 + percent))
    tail = [F.floor((percent * s + 99) / 100) for s in (n, m)]
    return alpha - F.greatest(*[t - F.least(F.lit(MATCHES), t) for t in tail])


def required_col(size: str, percent: int):
    return F.expr(f"({percent} * {size} + 99) div 100")


def keep_one_per_component(docs: DataFrame, decided: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents that stand for their component; only the dropped ids are looked up."""
    key = free_name(docs.columns, "dropped")
    dropped = decided.filter("component_id <> doc_id").select(F.col("doc_id").alias(key)).distinct()
    return docs.join(dropped, F.col(id_col) == F.col(key), "left_anti")
