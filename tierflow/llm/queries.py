"""One query per corpus operator, over its whole table, and SQL where SQL can state it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.exact_dedup import exact_duplicates
from tierflow.llm.language import learn_dictionaries, predict_language
from tierflow.llm.lexical_search import ranked_search
from tierflow.llm.mixing import mixing_rates
from tierflow.llm.ngram_join import jaccard_join
from tierflow.llm.packing import pack_documents
from tierflow.llm.perplexity import classify_quality
from tierflow.llm.pii import with_surrogates
from tierflow.llm.secrets import find_secrets
from tierflow.llm.sharding import byte_shards
from tierflow.llm.spelling import spelling_variants
from tierflow.llm.substring_dedup import without_repeats
from tierflow.llm.vector_graph import near_duplicate_vectors
from tierflow.workload.registry import Query

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Domains of the labels table, and the shares of tokens that the mixture aims at.
MIX_WEIGHTS = {"clean": 0.92, "junk": 0.06, "toxic": 0.02}


def label_domains(spark: SparkSession, folder: str) -> DataFrame:
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "clean")
    labels = _table(spark, folder, "labels").filter("quality is not null and toxic is not null")
    return labels.select(F.col("doc_id").alias("id"), domain.otherwise("junk").alias("domain"))


@_query
def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    rated = mixing_rates(docs, label_domains(spark, folder), MIX_WEIGHTS)
    shares = [F.col("posterior")[k].alias(f"p_{d}") for k, d in enumerate(MIX_WEIGHTS)]
    return rated.select("doc_id", "tokens", *shares, "rate")


@_query
def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return find_secrets(_table(spark, folder, "documents"))


@_query
def op3_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    found, _ = jaccard_join(docs, width=4, percent=85, count_links=True)
    return found.select("doc_id", "n_shingles", "component_id", "n_links")


@_query
def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = byte_shards(_table(spark, folder, "documents"), shards=16)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@_query
def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    trusted = _table(spark, folder, "labels").filter("quality = 1 and toxic = 0")
    return classify_quality(
        _table(spark, folder, "documents"),
        trusted.select(F.col("doc_id").alias("id")),
        ranks_path=public_tokenizers.path("byte_bpe_50k.tiktoken"),
        pattern=public_tokenizers.PATTERN,
        quantile=0.99,
    )


@_query
def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    decided = exact_duplicates(_table(spark, folder, "documents"))
    return decided.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLES["op6_exact_dedup"] = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), r AS (
  SELECT doc_id, text_sha256,
         first_value(doc_id) OVER w AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM n WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM r
"""


@_query
def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(
        _table(spark, folder, "documents"),
        ranks_path=public_tokenizers.path("byte_bpe_50k.tiktoken"),
        pattern=public_tokenizers.PATTERN,
        capacity=1024,
    )


def held_out() -> Column:
    """The fold of documents that nothing is learned from."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return F.coalesce(fold, F.lit(False))


#: Language predictions with a smaller margin are rejected.
MIN_MARGIN = 0.002


@_query
def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    marked = docs.select("doc_id", "text", held_out().alias("held_out"))
    learned = learn_dictionaries(docs.filter(~held_out()))
    return predict_language(marked, learned, min_margin=MIN_MARGIN).select(
        "doc_id", "held_out", "lang_pred", "score", "rejected"
    )


#: Setting that holds the secret key of the surrogates; the fallback is for tables without secrets.
SURROGATE_KEY = "spark.tierflow.surrogate.key"


@_query
def op9_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return with_surrogates(docs, key=spark.conf.get(SURROGATE_KEY, "synthetic documents"))


@_query
def op10_vector_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found, _ = near_duplicate_vectors(_table(spark, folder, "embeddings"), threshold=0.9)
    return found


@_query
def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"), k=10)


ORACLES["op11_lexical_search"] = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), tfs AS (
  SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL
), sizes AS (
  SELECT doc_id, sum(tf)::BIGINT AS n FROM tfs GROUP BY doc_id
), totals AS (
  SELECT count(*) AS n_docs, sum(n)::BIGINT AS l FROM sizes
), asked AS (
  SELECT item_id, term, count(*) AS c FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM tfs, totals GROUP BY term, n_docs
), scores AS (
  SELECT item_id, doc_id,
    sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // l))))::BIGINT AS score
  FROM asked JOIN tfs USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), totals
  GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@_query
def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(_table(spark, folder, "documents"))


@_query
def op13_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return without_repeats(_table(spark, folder, "documents"), width=35)


ORACLES["op13_substring_dedup"] = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), starts AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i FROM w
), windows AS (
  SELECT doc_id, i, sha256(array_to_string(words[i:i + 34], ' ')) AS h FROM starts
), hit AS (
  SELECT doc_id, i FROM windows WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM hit
), each AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS words
  FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, len(w.words)::BIGINT AS n_words, (len(w.words) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept.words, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


def _pipeline(spark: SparkSession, folder: str) -> DataFrame:
    from corpus_pipeline import run  # imported late: the pipeline imports this module

    return run(spark, folder)


QUERIES["pipeline"] = _pipeline
