"""Language identification by compression against per-language dictionaries."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.common import free_name

UNDECIDED = "und"
#: Bounds of the training sample: documents per language, code points taken from each.
SAMPLE_DOCS, SAMPLE_CHARS = 512, 1024
#: The most languages that are learned; more labels than that are an error.
MAX_LANGUAGES = 500
#: Texts are compressed in blocks, so that the dictionary and not the text's own past
#: decides, however long the text is.
BLOCK_CHARS = 1024
LEVEL = 5
#: Blocks this short are compressed at a stronger level, which finds shorter matches.
SHORT_CHARS, SHORT_LEVEL = 160, 19
LETTER = regex.compile(r"\p{L}")


def _piece(text: Column, size: int) -> Column:
    """Code points from a place that the text's hash chooses, so that common openings count no more."""
    places = F.greatest(F.length(text) - size, F.lit(0)) + 1
    return F.substring(text, F.pmod(F.xxhash64(text), places).cast("int") + 1, F.lit(size))


def learn_dictionaries(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_docs: int = SAMPLE_DOCS,
    sample_chars: int = SAMPLE_CHARS,
) -> dict[str, bytes]:
    """Raw-content dictionaries: text of a bounded sample of each language's documents.

    The documents with the smallest id hashes are taken, so the sample depends on the
    rows alone. Ranking runs on ids, not texts, and keeps at most `sample_docs` rows of a
    language per task. Rows without text, letters or language are ignored. At most
    `sample_docs * sample_chars` code points per language reach the driver.
    """
    usable = labelled.filter(
        F.col(lang_col).isNotNull() & F.coalesce(F.col(text_col), F.lit("")).rlike(r"\p{L}")
    )
    draw = F.xxhash64(F.col(id_col), F.lit("language sample"))
    best = Window.partitionBy("lang").orderBy("draw", "id")
    chosen = (
        usable.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), draw.alias("draw"))
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= sample_docs)
        .select("lang", "id")
        .distinct()
    )
    texts = usable.select(
        F.col(lang_col).alias("lang"),
        F.col(id_col).alias("id"),
        _piece(F.col(text_col), sample_chars).alias("piece"),
    )
    # At most sample_docs rows per language, hence small enough to send to every task.
    same = texts["lang"].eqNullSafe(chosen["lang"]) & texts["id"].eqNullSafe(chosen["id"])
    found = texts.join(F.broadcast(chosen), same, "left_semi")
    # Rows that share an id give one piece, so the bound holds for repeated ids too.
    sample = found.groupBy("lang", "id").agg(F.min("piece").alias("piece")).collect()
    pieces: dict[str, list] = {}
    for row in sorted(sample, key=lambda r: (r["lang"], repr(r["id"]), r["piece"])):
        pieces.setdefault(row["lang"], []).append(row["piece"])
    if len(pieces) > MAX_LANGUAGES:
        raise ValueError(f"{len(pieces)} languages; at most {MAX_LANGUAGES} are supported")
    return {
        lang: "\n".join(found[:sample_docs]).lower().encode()
        for lang, found in sorted(pieces.items())
    }


@lru_cache(maxsize=4)
def _compressors(model: tuple[tuple[str, bytes], ...], level: int):
    made = []
    for _, content in model:
        raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        raw.precompute_compress(level=level)
        made.append(
            zstandard.ZstdCompressor(
                level=level,
                dict_data=raw,
                write_content_size=False,
                write_checksum=False,
                write_dict_id=False,
            )
        )
    return made


def compressed_sizes(text: str, model: tuple[tuple[str, bytes], ...]) -> list[int]:
    """Compressed bytes of the whole text under each language's dictionary."""
    lowered = text.lower()
    sizes = [0] * len(model)
    for at in range(0, len(lowered), BLOCK_CHARS):
        piece = lowered[at : at + BLOCK_CHARS]
        level = SHORT_LEVEL if len(piece) <= SHORT_CHARS else LEVEL
        block = piece.encode("utf-8", "surrogatepass")
        for k, one in enumerate(_compressors(model, level)):
            sizes[k] += len(one.compress(block))
    return sizes


def classify(text: str | None, model: tuple[tuple[str, bytes], ...]) -> tuple[str, float]:
    """Language with the smallest size and the margin to the next, as a share of it."""
    if not model or not text or not LETTER.search(text):
        return UNDECIDED, 0.0
    if len(model) == 1:
        return model[0][0], 1.0
    sizes = compressed_sizes(text, model)
    ranked = sorted(range(len(model)), key=lambda k: (sizes[k], k))
    first, second = sizes[ranked[0]], sizes[ranked[1]]
    return model[ranked[0]][0], (second - first) / second if second else 0.0


def predict_language(
    docs: DataFrame,
    dictionaries: dict[str, bytes],
    text_col: str = "text",
    min_margin: float = 0.0,
    lang_name: str = "lang_pred",
    score_name: str = "score",
    rejected_name: str = "rejected",
) -> DataFrame:
    """Add the predicted language, its score and whether the prediction is rejected.

    Every whole text is compressed, block by block, with each dictionary; the language
    with the smallest total wins, ties go to the first in alphabetical order. The score
    (0 to 1) is the saving against the second best, as a share of its size. A prediction
    is rejected when it has no language or when the score is below `min_margin`. Null
    texts and texts without letters get `und` and score 0, as do all texts when nothing
    was learned. All columns stay; a new column whose name is taken gets underscores in
    front of it.
    """
    lang_name, score_name, rejected_name = (
        free_name(docs.columns, name) for name in (lang_name, score_name, rejected_name)
    )
    model = tuple(dictionaries.items())
    at = docs.columns.index(text_col)
    added = pa.schema(
        [(lang_name, pa.string()), (score_name, pa.float64()), (rejected_name, pa.bool_())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from labelled(batches)
        finally:
            # Workers live on: the next stage needs their memory.
            _compressors.cache_clear()

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [classify(t.as_py(), model) for t in batch.column(at)]
            langs = pa.array([f[0] for f in found], pa.string())
            scores = pa.array([f[1] for f in found], pa.float64())
            out = pa.array([f[0] == UNDECIDED or f[1] < min_margin for f in found], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, langs, scores, out],
                schema=pa.schema([*batch.schema, *added]),
            )

    schema = T.StructType(docs.schema.fields.copy())
    for name, kind in ((lang_name, "string"), (score_name, "double"), (rejected_name, "boolean")):
        schema = schema.add(name, kind)
    return docs.mapInArrow(run, schema)
