"""Connected components by large-star and small-star rounds of joins and minima."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import stored


def _star(edges: DataFrame, keep: Column) -> DataFrame:
    """Hang the chosen neighbours of every node on its smallest neighbour."""
    low = edges.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m"))
    kept = edges.filter(keep)
    return kept.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def components(links: DataFrame, left: str, right: str, max_rounds: int = 100) -> DataFrame:
    """The smallest node reachable from every node that has a link to another node.

    Alternates the two star operations until nothing changes, which takes a number of
    rounds logarithmic in the number of nodes. Each is a minimum per node, combined on
    the map side, and a join that adaptive execution can split for nodes with many links.
    Every round is a stored table; only a row count and a checksum reach the driver.

    Returns node, component.
    """
    both = links.select(F.col(left).alias("u"), F.col(right).alias("v")).filter("u <> v")
    edges = stored(
        both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "components",
    )
    state = None
    for _ in range(max_rounds):
        turned = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
        large = _star(edges.unionByName(turned), F.col("v") > F.col("u"))
        large = large.filter("u <> v").distinct()
        # Small star: a node's smaller neighbours, and itself, hang on the smallest.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")
        )
        edges = stored(small.filter("u <> v").distinct(), "components")
        mark = edges.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("mark"),
        ).first()
        if (mark["n"], mark["mark"]) == state:
            break
        state = (mark["n"], mark["mark"])
    else:
        raise RuntimeError(f"no fixpoint after {max_rounds} rounds")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stored(nodes.unionByName(roots), "components")
