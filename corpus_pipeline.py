"""From raw documents to packed training sequences, one stored stage after the other."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tierflow.llm.common import stored
from tierflow.llm.exact_dedup import drop_exact_duplicates
from tierflow.llm.language import learn_dictionaries, predict_language
from tierflow.llm.mixing import mixed
from tierflow.llm.ngram_join import jaccard_join, keep_one_per_component
from tierflow.llm.packing import pack_documents
from tierflow.llm.queries import MIX_WEIGHTS, held_out, label_domains

#: Language predictions with a smaller margin are rejected.
MIN_MARGIN = 0.002


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language is not recognised."""
    learned = learn_dictionaries(docs.filter(~held_out()))
    seen = predict_language(docs, learned, min_margin=MIN_MARGIN, lang_name="_lang",
                            score_name="_score", rejected_name="_rejected")
    return seen.filter("not _rejected").select(*docs.columns)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one of the documents that are equal apart from white space."""
    return drop_exact_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group linked by five-word shingles, Jaccard 0.8 or more."""
    decided, _ = jaccard_join(docs, width=5, percent=80)
    return keep_one_per_component(docs, decided)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draw documents at rates that give the label domains their weights; clean ones stay."""
    return mixed(docs, label_domains(spark, sf_dir), MIX_WEIGHTS, anchor="clean")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the token pieces of the documents into sequences of 1024."""
    return pack_documents(
        docs,
        ranks_path=public_tokenizers.path("byte_bpe_50k.tiktoken"),
        pattern=public_tokenizers.PATTERN,
        capacity=1024,
    )


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("ngram_jaccard_join", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Compression, classification and packing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; each reads what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
