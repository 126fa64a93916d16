"""Exact duplicates by content-defined chunk recipes, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import SPACES, free_name, row_digest, stored

#: A chunk ends after one of these letter pairs, once it has CHUNK_MIN code points, and
#: at the latest after CHUNK_MAX. Content alone decides, so shared passages share chunks.
CHUNK_MIN, CHUNK_MAX = 256, 1024
CHUNK_END = "[en0-4][rst5-9]"
CHUNK = f"(?s).{{{CHUNK_MIN},{CHUNK_MAX - 2}}}?{CHUNK_END}|.{{1,{CHUNK_MAX}}}"


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def chunks(norm: Column) -> Column:
    """The text cut into content-defined chunks, in order."""
    return F.regexp_extract_all(norm, F.lit(CHUNK), F.lit(0))


def _chunk_hash(chunk: Column, hash_bits: int) -> Column:
    digest = F.xxhash64(chunk)
    return digest if hash_bits >= 64 else digest.bitwiseAND(F.lit((1 << hash_bits) - 1))


def _ambiguous(rows: DataFrame, hash_bits: int) -> DataFrame | None:
    """Chunks whose hash stands for several contents, each with its number there.

    Equal chunks combine on the map side, so each moves about once per task, whatever
    the number of copies. None where every hash stands for one content, as is normal.
    """
    distinct = (
        rows.select(F.explode(chunks(F.col("norm"))).alias("chunk"))
        .select(_chunk_hash(F.col("chunk"), hash_bits).alias("h"), "chunk")
        .groupBy("h", "chunk")
        .agg(F.count(F.lit(1)).alias("uses"))
    )
    repeated = distinct.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    shared = stored(repeated, "dedup-shared")
    if shared.isEmpty():
        return None
    return stored(distinct.join(shared, "h").select("h", "chunk"), "dedup-clashes")


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_bits: int = 64):
    """A stored table with one row per document: its facts and its chunk recipe.

    A recipe is the ordered list of chunk identifiers. An identifier is the chunk's
    64-bit hash, verified against the contents of all chunks of the corpus: where a hash
    stands for more than one content, the texts of those chunks take its place in
    `variants`. So equal (recipe, variants) means equal texts, with no trust in hashes.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        normalised(F.col(text_col)).alias("norm"),
        F.coalesce(F.length(text_col), F.lit(0)).alias("n_chars"),
        row_digest(docs).alias("digest"),
    )
    clashes = _ambiguous(rows, hash_bits)
    recipe = F.transform(F.col("pieces"), lambda c: _chunk_hash(c, hash_bits))
    facts = rows.select(
        "doc_id",
        "n_chars",
        "digest",
        F.sha2(F.encode("norm", "UTF-8"), 256).alias("text_sha256"),
        chunks(F.col("norm")).alias("pieces"),
        F.monotonically_increasing_id().alias("tag"),
    )
    if clashes is None:
        variants = F.array().cast("array<string>")
        return stored(
            facts.select("*", recipe.alias("recipe"), variants.alias("variants")).drop("pieces"),
            "dedup-recipes",
        )
    named = stored(facts.withColumn("recipe", recipe), "dedup-recipes")
    doubtful = (
        named.select("tag", F.posexplode("pieces").alias("pos", "chunk"))
        .withColumn("h", _chunk_hash(F.col("chunk"), hash_bits))
        .join(clashes.select("h", "chunk"), ["h", "chunk"])
        .groupBy("tag")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "chunk"))).alias("list"))
        .select("tag", F.transform("list", lambda p: p["chunk"]).alias("variants"))
    )
    return stored(
        named.drop("pieces")
        .join(doubtful, "tag", "left")
        .withColumn("variants", F.coalesce("variants", F.array().cast("array<string>"))),
        "dedup-named",
    )


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_bits: int = 64
) -> DataFrame:
    """Which documents are equal apart from white space, and which one of each stays.

    Of equal texts the row with the most code points in its original text stays, then
    the smallest id (null last), then the smallest row digest, then the first of
    identical rows. Long texts are cut into chunks once; after that only recipes (8
    bytes per chunk) are grouped. Copies combine on the map side, the join back splits
    hot recipes by adaptive execution, and texts without copies skip that join's output.
    Null and empty texts are equal to each other. An empty table gives no rows. Columns
    other than the two named only enter the digest. `hash_bits` below 64 exists to test
    the handling of hash collisions.

    Returns doc_id, keep_id, group_size, kept, text_sha256, digest.
    """
    table = recipes(docs, id_col, text_col, hash_bits)
    rank = F.struct(
        (-F.col("n_chars")).alias("less"),
        F.col("doc_id").isNull().alias("no_id"),
        F.col("doc_id").alias("id"),
        F.col("digest").alias("digest"),
        F.col("tag").alias("tag"),
    )
    groups = stored(
        table.groupBy("recipe", "variants")
        .agg(F.min(rank).alias("best"), F.count(F.lit(1)).alias("group_size"))
        .filter("group_size > 1"),
        "dedup-groups",
    )
    alone = F.col("group_size").isNull()
    return table.join(groups, ["recipe", "variants"], "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        F.coalesce(F.col("tag") == F.col("best.tag"), F.lit(True)).alias("kept"),
        "text_sha256",
        "digest",
    )


def drop_exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents that `exact_duplicates` keeps, with all their columns.

    Only documents with copies are looked up. Rows repeated in full are reduced to one.
    """
    decided = stored(exact_duplicates(docs, id_col, text_col), "dedup-decided")
    per_row = (
        decided.filter("group_size > 1")
        .groupBy("doc_id", "digest")
        .agg(F.count(F.lit(1)).alias("times"), F.max("kept").alias("stays"))
        .filter("times > 1 or not stays")
    )
    affected = stored(per_row, "dedup-affected")
    digest, stays = free_name(docs.columns, "digest"), free_name(docs.columns, "stays")
    key = free_name(docs.columns, "key")
    marked = docs.withColumn(digest, row_digest(docs))

    def matching(rows: DataFrame, how: str) -> DataFrame:
        lookup = rows.select(F.col("doc_id").alias(key), F.col("digest").alias(stays))
        same = F.col(id_col).eqNullSafe(F.col(key)) & (F.col(digest) == F.col(stays))
        return marked.join(lookup, same, how)

    single = matching(affected, "left_anti").drop(digest)
    repeated = affected.filter("stays")
    if repeated.isEmpty():
        return single
    once = matching(repeated, "left_semi").dropDuplicates([id_col, digest]).drop(digest)
    return single.unionByName(once)
