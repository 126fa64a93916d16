"""Near-duplicate vectors by a robust-pruned flat graph over overlapping cluster shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import stored
from tierflow.llm.components import components

#: Vectors that the cluster centres are fitted on, about; most centres; vectors per cluster.
SAMPLE, MAX_CENTRES, CLUSTER = 16_384, 1024, 2000
#: Larger clusters are searched as all pairs of blocks of about this many vectors.
BLOCK = 4096
#: Neighbours considered and kept per vector, and how much closer a detour must be.
CANDIDATES, DEGREE, ALPHA = 64, 24, 1.2
#: Beam of the greedy search; cosine below the threshold at which it still spreads.
BEAM, SLACK = 16, 0.1
#: Vectors compared with all others to audit the recall, and the recall that is asked for.
AUDITED, RECALL, MAX_OVERLAP = 512, 0.95, 5


def unit_rows(vectors: pa.Array, dim: int) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(-1, dim)
    # Scaled first, so that squares neither overflow nor vanish.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def fit_centres(sample: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means from evenly spaced rows of the sample."""
    centres = sample[np.linspace(0, len(sample) - 1, count).astype(int)]
    for _ in range(rounds):
        nearest = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 0, sums / np.where(norms > 0, norms, 1), centres)
    return centres


def _assigned(centres: dict[int, np.ndarray], overlap: int):
    """Each vector with its nearest clusters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                near = np.zeros((part.num_rows, 1), np.int64)
                if dim in centres:
                    sims = unit_rows(part.column("vector"), int(dim)) @ centres[dim].T
                    near = np.argsort(-sims, axis=1, kind="stable")[:, :overlap]
                lists = pa.array(near.tolist(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, "cells"])

    return run


def prune(sims: np.ndarray, between: np.ndarray, degree: int, alpha: float) -> list[int]:
    """Robust prune: candidates by similarity, without those that a kept one is closer to.

    `sims` are the candidates' cosines to the vector, in falling order, `between` those
    among the candidates. A candidate goes if alpha times its distance to a kept one is
    at most its distance to the vector.
    """
    away, apart = np.sqrt(np.maximum(0, 2 - 2 * sims)), np.sqrt(np.maximum(0, 2 - 2 * between))
    alive, kept = np.ones(len(sims), bool), []
    for k in range(len(sims)):
        if alive[k]:
            kept.append(k)
            if len(kept) == degree:
                break
            alive &= alpha * apart[k] > away
    return kept


def shard_graph(units: np.ndarray) -> list[np.ndarray]:
    """Pruned neighbours of every vector of a shard."""
    count = len(units)
    size, out = min(CANDIDATES, count - 1), []
    for at in range(0, count, 512):
        sims = units[at : at + 512] @ units.T
        sims[np.arange(len(sims)), at + np.arange(len(sims))] = -2
        near = np.argpartition(-sims, size - 1, axis=1)[:, :size] if size else np.empty((len(sims), 0), int)
        for row, found in zip(sims, near, strict=True):
            found = found[np.argsort(-row[found], kind="stable")]
            close = units[found]
            out.append(found[prune(row[found], close @ close.T, DEGREE, ALPHA)])
    return out


def _built(table: pa.Table) -> pa.Table:
    """Adjacency lists of one shard."""
    dim = table.column("dim")[0].as_py()
    nodes = table.column("node").to_numpy()
    units = unit_rows(table.column("vector").combine_chunks(), dim)
    near = [nodes[found].tolist() for found in shard_graph(units)]
    return pa.table({"node": nodes, "near": pa.array(near, pa.list_(pa.int64()))})


def range_search(
    query: int, units: np.ndarray, near: list[np.ndarray], medoid: int, threshold: float
) -> np.ndarray:
    """Vectors within the threshold of a stored one, by greedy search, then expansion.

    A beam search leads from the medoid to the query. From the end of the beam and the
    query itself, the search spreads over all neighbours of vectors within the range (plus
    some slack) until it meets no new one.
    """
    target = units[query]
    best, seen, expanded = [(float(units[medoid] @ target), medoid)], {medoid}, set()
    while True:
        node = next((n for _, n in best if n not in expanded), None)
        if node is None or (query in seen and len(expanded) >= BEAM):
            break
        expanded.add(node)
        fresh = [n for n in near[node].tolist() if n not in seen]
        if fresh:
            seen.update(fresh)
            sims = units[fresh] @ target
            best = sorted([*best, *zip(sims.tolist(), fresh, strict=True)], reverse=True)[:BEAM]
    reached = np.zeros(len(units), bool)
    frontier = np.array(sorted({query, *(n for s, n in best if s >= threshold - SLACK)}))
    reached[frontier] = True
    found = [frontier]
    while len(frontier):
        onward = np.unique(np.concatenate([near[n] for n in frontier]))
        onward = onward[~reached[onward]]
        reached[onward] = True
        frontier = onward[units[onward] @ target >= threshold - SLACK]
        found.append(frontier)
    every = np.concatenate(found)
    return every[(every != query) & (units[every] @ target >= threshold)]


def _searched(threshold: float):
    """Links of one shard, counted where both ends first meet, and local components."""

    def run(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        nodes, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        shard = table.column("shard")[0].as_py()
        units = unit_rows(table.column("vector").combine_chunks(), dim)
        homes = [set(h) for h in table.column("shards").to_pylist()]
        place = {int(n): k for k, n in enumerate(nodes)}
        near = [
            np.array([place[n] for n in found if n in place], dtype=int)
            for found in table.column("near").to_pylist()
        ]
        back: list[list[int]] = [[] for _ in nodes]
        for k, found in enumerate(near):
            for n in found.tolist():
                back[n].append(k)
        near = [np.unique(np.array([*f.tolist(), *b], dtype=int)) for f, b in zip(near, back, strict=True)]
        medoid = int((units @ units.mean(axis=0)).argmax())
        links: list[set[int]] = [set() for _ in nodes]
        for k in range(len(nodes)):
            for n in range_search(k, units, near, medoid, threshold).tolist():
                links[k].add(n)
                links[n].add(k)
        parent = np.arange(len(nodes))

        def root(k: int) -> int:
            while parent[k] != k:
                parent[k] = parent[parent[k]]
                k = parent[k]
            return k

        counts = np.zeros(len(nodes), np.int64)
        for k, found in enumerate(links):
            for n in found:
                if shard == min(homes[k] & homes[n]):
                    counts[k] += copies[n]
                a, b = root(k), root(n)
                if a != b:
                    parent[max(a, b, key=lambda x: nodes[x])] = min(a, b, key=lambda x: nodes[x])
        lead = nodes[[root(k) for k in range(len(nodes))]]
        return pa.table({"node": nodes, "n_links": counts, "lead": lead})

    return run


def valid_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Distinct usable vectors: node (smallest id), vector, dim, copies (distinct ids).

    Equal rows are one, so that a repeated id is nobody's partner twice; a row without an id is none.
    """
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col("vector").isNotNull() & ~odd & F.exists("vector", lambda x: x != 0)
    named = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vector"))
    return (
        named.filter(F.coalesce(usable, F.lit(False)) & F.col("id").isNotNull())
        .distinct()
        .groupBy("vector")
        .agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("copies"))
        .withColumn("dim", F.size("vector"))
    )


def _centres(nodes: DataFrame, count: int) -> dict[int, np.ndarray]:
    """Cluster centres for each length of vectors, from a bounded hash sample."""
    share = F.lit(int(min(1.0, SAMPLE / max(count, 1)) * (1 << 40)))
    drawn = nodes.filter(F.pmod(F.xxhash64("node", F.lit("centres")), F.lit(1 << 40)) < share)
    sample: dict[int, list] = {}
    for batch in drawn.orderBy("node").select("dim", "vector").toArrow().to_batches():
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims):
            part = batch.filter(pa.array(dims == dim)).column("vector")
            sample.setdefault(int(dim), []).append(unit_rows(part, int(dim)))
    whole = sum(len(x) for parts in sample.values() for x in parts)
    centres = {}
    for dim, parts in sample.items():
        rows = np.concatenate(parts)
        wanted = -(-count * len(rows) // (whole * CLUSTER))
        centres[dim] = fit_centres(rows, int(np.clip(wanted, 1, min(MAX_CENTRES, len(rows)))))
    return centres


def _shards(nodes: DataFrame, count: int, overlap: int) -> DataFrame:
    """Every vector once per shard that it belongs to, with the list of its shards."""
    centres = _centres(nodes, count)
    kinds = dict(nodes.dtypes)
    assigned = stored(
        nodes.mapInArrow(
            _assigned(centres, overlap),
            f"vector {kinds['vector']}, node {kinds['node']}, copies bigint, dim int, cells array<bigint>",
        ),
        "graph-cells",
    )
    blocks = (
        assigned.select("dim", F.explode("cells").alias("cell"))
        .groupBy("dim", "cell")
        .agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    )
    own = F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks"))
    paired = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1),
        lambda j: F.concat_ws(
            "/", "dim", "cell", F.least(own, j).cast("string"), F.greatest(own, j).cast("string")
        ),
    )
    # One row per cluster: bounded by MAX_CENTRES for each length of vectors.
    placed = (
        assigned.withColumn("cell", F.explode("cells"))
        .join(F.broadcast(blocks), ["dim", "cell"])
        .select("node", F.explode(paired).alias("shard"))
    )
    homes = placed.groupBy("node").agg(F.collect_set("shard").alias("shards"))
    return stored(
        assigned.drop("cells").join(homes, "node").withColumn("shard", F.explode("shards")),
        "graph-shards",
    )


def _linked(nodes: DataFrame, count: int, threshold: float, overlap: int) -> tuple[DataFrame, DataFrame]:
    shards = _shards(nodes, count, overlap)
    kind = dict(nodes.dtypes)["node"]
    lists = shards.groupBy("shard").applyInArrow(_built, f"node {kind}, near array<{kind}>")
    union = lists.groupBy("node").agg(
        F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")
    )
    graph = shards.join(stored(union, "graph-lists"), "node")
    found = stored(
        graph.groupBy("shard").applyInArrow(
            _searched(threshold), f"node {kind}, n_links bigint, lead {kind}"
        ),
        "graph-links",
    )
    counts = found.groupBy("node").agg(F.sum("n_links").alias("linked"))
    parts = components(found.select("node", "lead"), "node", "lead")
    return stored(counts, "graph-counts"), parts


def _angles(units: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ centres.T, -1, 1))


def _homes(centres: dict[int, np.ndarray]):
    """Each vector with its nearest cluster and the angle to its centre."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                home, angle = np.zeros(part.num_rows, np.int64), np.full(part.num_rows, np.pi)
                if dim in centres:
                    angles = _angles(unit_rows(part.column("vector"), int(dim)), centres[dim])
                    home = angles.argmin(axis=1)
                    angle = angles[np.arange(len(home)), home]
                columns = [*part.columns, pa.array(home, pa.int64()), pa.array(angle)]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "home", "angle"])

    return run


def _visits(centres: dict[int, np.ndarray], radii: dict[int, dict[int, float]], threshold: float):
    """Each vector with all clusters that can hold a vector within the threshold of it.

    By the triangle inequality of angles these are the clusters whose centre is at most
    their radius plus the threshold's angle away.
    """
    reach = np.arccos(np.clip(threshold, -1, 1)) + 1e-6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                cells = [sorted(radii[int(dim)])] * part.num_rows
                if dim in centres:
                    used = np.array(cells[0])
                    limits = np.array([radii[int(dim)][c] for c in cells[0]]) + reach
                    angles = _angles(unit_rows(part.column("vector"), int(dim)), centres[dim][used])
                    cells = [used[row].tolist() for row in angles <= limits]
                lists = pa.array(cells, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, "cells"])

    return run


def _compared(threshold: float):
    """Links from the visitors of one block to its own vectors, and local components."""

    def run(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        own = table.column("own").to_numpy()
        nodes, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        units = unit_rows(table.column("vector").combine_chunks(), dim)
        homes, visitors = np.flatnonzero(own), np.flatnonzero(~own)
        close = np.zeros((len(visitors), len(homes)), bool)
        for at in range(0, len(visitors), 512):
            part = visitors[at : at + 512]
            close[at : at + 512] = units[part] @ units[homes].T >= threshold
            close[at : at + 512] &= nodes[part][:, None] != nodes[homes][None, :]
        counts = np.array([copies[homes[row]].sum() for row in close], np.int64)
        lead = nodes.copy()
        left, right = counts > 0, close.any(axis=0)
        for k in range(len(visitors)):
            if not left[k]:
                continue
            front, group = np.array([k]), [visitors[[k]]]
            left[k] = False
            while len(front):
                met = np.flatnonzero(close[front].any(axis=0) & right)
                right[met] = False
                front = np.flatnonzero(close[:, met].any(axis=1) & left)
                left[front] = False
                group += [homes[met], visitors[front]]
            members = np.concatenate(group)
            lead[members] = nodes[members].min()
        n = np.zeros(len(nodes), np.int64)
        n[visitors] = counts
        return pa.table({"node": nodes, "n_links": n, "lead": lead})

    return run


def audited_recall(nodes: DataFrame, counts: DataFrame, count: int, threshold: float) -> float:
    """Found links over true links of a hash sample of AUDITED vectors, about.

    The sample is compared with all vectors, block by block and in double precision. The
    recall is the lower one of the share of all links and the mean share per vector.
    """
    share = F.lit(int(min(1.0, AUDITED / max(count, 1)) * (1 << 40)))
    drawn = nodes.filter(F.pmod(F.xxhash64("node", F.lit("audit")), F.lit(1 << 40)) < share)
    asked = drawn.join(counts, "node", "left").select("node", "dim", "vector", "linked").toArrow()
    kind = dict(nodes.dtypes)["node"]
    queries = {}
    for dim in set(asked.column("dim").to_pylist()):
        part = asked.filter(pa.compute.equal(asked.column("dim"), dim))
        queries[dim] = (
            part.column("node").to_numpy(),
            unit_rows(part.column("vector").combine_chunks(), dim),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        true = {dim: np.zeros(len(ids), np.int64) for dim, (ids, _) in queries.items()}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                if int(dim) in queries:
                    part = batch.filter(pa.array(dims == dim))
                    ids, units = queries[int(dim)]
                    close = unit_rows(part.column("vector"), int(dim)) @ units.T >= threshold
                    close &= part.column("node").to_numpy()[:, None] != ids[None, :]
                    true[int(dim)] += part.column("copies").to_numpy() @ close
        for dim, (ids, _) in queries.items():
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(true[dim])], names=["node", "n"])

    counted = nodes.mapInArrow(run, f"node {kind}, n bigint").groupBy("node").agg(F.sum("n").alias("n"))
    true = {r["node"]: r["n"] for r in counted.collect() if r["n"]}
    pairs = zip(asked.column("node").to_pylist(), asked.column("linked").to_pylist(), strict=True)
    found = {node: linked or 0 for node, linked in pairs if node in true}
    if not true:
        return 1.0
    shares = [found[node] / n for node, n in true.items()]
    return float(min(sum(found.values()) / sum(true.values()), np.mean(shares)))


def _exactly_linked(nodes: DataFrame, count: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """All links, by comparing each cluster with every vector that can link into it.

    A link is counted for each end in the home cluster of the other. Clusters and their
    visitors are cut into blocks of about BLOCK vectors.
    """
    centres = _centres(nodes, count)
    kinds = dict(nodes.dtypes)
    kept = f"vector {kinds['vector']}, node {kinds['node']}, copies bigint, dim int"
    at_home = stored(
        nodes.select("vector", "node", "copies", "dim").mapInArrow(
            _homes(centres), f"{kept}, home bigint, angle double"
        ),
        "exact-homes",
    )
    # One row per cluster: bounded by MAX_CENTRES for each length of vectors.
    cells = at_home.groupBy("dim", F.col("home").alias("cell")).agg(
        F.max("angle").alias("radius"), F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks")
    )
    cells = stored(cells, "exact-cells")
    radii: dict[int, dict[int, float]] = {}
    for r in cells.collect():
        radii.setdefault(r["dim"], {})[r["cell"]] = r["radius"]
    guests = stored(
        at_home.drop("home", "angle").mapInArrow(
            _visits(centres, radii, threshold), f"{kept}, cells array<bigint>"
        ),
        "exact-visits",
    )
    visited = guests.select("dim", F.explode("cells").alias("cell")).groupBy("dim", "cell")
    sizes = cells.select("dim", "cell", "blocks").join(
        visited.agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("turns")), ["dim", "cell"]
    )
    sizes = F.broadcast(stored(sizes, "exact-sizes"))

    def drawn(name: str) -> Column:
        return F.pmod(F.xxhash64("node", F.lit(name)), F.col(name))

    def every(name: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(name) - 1))

    columns = ["vector", "node", "copies", "dim", "cell"]
    own = at_home.withColumnRenamed("home", "cell").join(sizes, ["dim", "cell"]).select(
        *columns, drawn("blocks").alias("block"), every("turns").alias("turn"), F.lit(True).alias("own")
    )
    come = guests.withColumn("cell", F.explode("cells")).join(sizes, ["dim", "cell"]).select(
        *columns, every("blocks").alias("block"), drawn("turns").alias("turn"), F.lit(False).alias("own")
    )
    found = stored(
        own.unionByName(come).groupBy("dim", "cell", "block", "turn").applyInArrow(
            _compared(threshold), f"node {kinds['node']}, n_links bigint, lead {kinds['node']}"
        ),
        "exact-links",
    )
    counts = found.groupBy("node").agg(F.sum("n_links").alias("linked"))
    return stored(counts, "exact-counts"), components(found.select("node", "lead"), "node", "lead")


def near_duplicate_vectors(
    vectors: DataFrame,
    threshold: float = 0.9,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    overlap: int = 2,
) -> tuple[DataFrame, float]:
    """Links of cosine >= threshold, their components, and the audited recall.

    Equal vectors are one node. Cluster centres are fitted on a bounded hash sample; every
    vector is indexed in the shards of its nearest clusters. Each shard builds a
    robust-pruned graph; the adjacency lists of a vector are united over its shards; in
    each shard every vector is searched for by range-expanding greedy search from the
    medoid. A link is counted in the first shard that both ends share, so pairs are never
    written out; only counts and local components leave a shard. Clusters beyond BLOCK
    vectors are searched as pairs of blocks, so none of their pairs is left out. All
    links are verified in double precision. If the recall of audited vectors, compared
    with all others, is below RECALL, the index is built again with one more overlap. If
    MAX_OVERLAP is not enough either, as when many centres cut up a group of near copies,
    all links are found by exact comparison.

    Vectors that are null, zero, or hold null or non-finite components link with nothing,
    and so do vectors of different lengths. Rows that share an id count as one vector.
    A row without an id has no component. An empty table gives no rows. Other columns
    are ignored.

    Returns (vec_id, n_links, component_id, kept) and the recall.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("vector"))
    nodes = stored(valid_vectors(vectors, id_col, vec_col), "graph-nodes")
    count = nodes.count()
    if not count:
        alone = rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"))
        return alone.select("*", F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept")), 1.0
    while True:
        counts, parts = _linked(nodes, count, threshold, overlap)
        recall = audited_recall(nodes, counts, count, threshold)
        if recall >= RECALL:
            break
        if overlap >= MAX_OVERLAP:
            counts, parts = _exactly_linked(nodes, count, threshold)
            recall = audited_recall(nodes, counts, count, threshold)
            break
        overlap += 1
    named = (
        nodes.join(counts, "node", "left")
        .join(parts, "node", "left")
        .select(
            "vector",
            (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    whole = rows.join(named, "vector", "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    return (
        whole.select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            component.alias("component_id"),
        ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))),
        recall,
    )
