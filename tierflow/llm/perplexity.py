"""Quality by perplexity under a modified Kneser-Ney model of trusted text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import shuffle_partitions, stored
from tierflow.llm.packing import encoder
from tierflow.llm.shingles import packed, unpacked

#: Token ids are below VOCABULARY; EDGE stands for both ends of a text.
VOCABULARY, EDGE = 50_257, 50_256
#: Spreads neighbouring keys over the shards; odd, hence one to one on 32 bits.
SPREAD = np.uint32(2_654_435_761)
#: Documents per chunk of requests, and tokens that a training task holds at most.
CHUNK, FLUSH = 1000, 4_000_000
#: Trusted ids up to this number are sent to every task (8 bytes each); more are joined.
MAX_BROADCAST_IDS = 1_000_000
#: Trusted documents whose id hash falls into one of FOLDS set the thresholds, unseen.
FOLDS = 10


def bigrams(ids: list[int]) -> np.ndarray:
    """Keys of neighbouring tokens, ends included: 16 bits each, spread over 32."""
    line = np.array([EDGE, *ids, EDGE], np.uint32)
    return (line[:-1] << np.uint32(16) | line[1:]) * SPREAD


def _unspread() -> np.uint32:
    return np.uint32(pow(int(SPREAD), -1, 1 << 32))


def _by_shard(keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """Parts of sorted keys by their leading bits."""
    lead = (keys >> np.uint32(32 - bits)).astype(np.int64)
    edges = np.searchsorted(lead, np.arange((1 << bits) + 1))
    for shard in np.unique(lead):
        yield int(shard), slice(edges[shard], edges[shard + 1])


def _squeezed(counts: np.ndarray) -> bytes:
    planes = counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes)


def _unsqueezed(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _counted(bits: int, ranks_path: str, pattern: str):
    """Counts of a task's bigrams, one row per shard."""

    def rows(parts: list[np.ndarray]) -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate(parts), return_counts=True)
        found = [(s, packed(keys[at]), _squeezed(counts[at])) for s, at in _by_shard(keys, bits)]
        kinds = [pa.int32(), pa.binary(), pa.binary()]
        columns = [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["shard", "keys", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, parts, held = encoder(ranks_path, pattern).encode_ordinary, [], 0
        for batch in batches:
            for text in batch.column(0):
                parts.append(bigrams(encode(text.as_py())))
                held += len(parts[-1])
                if held >= FLUSH:
                    yield rows(parts)
                    parts, held = [], 0
        if parts:
            yield rows(parts)

    return run


def _merged(table: pa.Table) -> pa.Table:
    """All counts of one shard in one row."""
    keys = np.concatenate([unpacked(b) for b in table.column("keys").to_pylist()])
    counts = np.concatenate([_unsqueezed(b) for b in table.column("counts").to_pylist()])
    key, inverse = np.unique(keys, return_inverse=True)
    total = np.bincount(inverse, weights=counts).astype(np.int64)
    return pa.table(
        {
            "shard": table.column("shard").slice(0, 1),
            "keys": pa.array([packed(key)], pa.binary()),
            "counts": pa.array([_squeezed(total)], pa.binary()),
        }
    )


def _token_facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per token: how often it is a context, after how many types, and how many precede it."""
    facts, levels = np.zeros((5, 1 << 16), np.int64), np.zeros(5, np.int64)
    for batch in batches:
        for keys, counts in zip(batch.column("keys"), batch.column("counts"), strict=True):
            pair = unpacked(keys.as_py()) * _unspread()
            count = _unsqueezed(counts.as_py())
            left, right = pair >> np.uint32(16), pair & np.uint32(0xFFFF)
            facts[0] += np.bincount(left, weights=count, minlength=1 << 16).astype(np.int64)
            for k in (1, 2, 3):
                level = count == k if k < 3 else count >= 3
                facts[k] += np.bincount(left[level], minlength=1 << 16)
            facts[4] += np.bincount(right, minlength=1 << 16)
            levels += np.bincount(np.minimum(count, 5), minlength=6)[1:]
    used = np.flatnonzero(facts.any(axis=0))
    # The numbers of bigrams that occur once, twice, ... come under negative ids.
    ids = np.concatenate([used, -np.arange(1, 6)])
    total = np.concatenate([facts[0][used], levels])
    rest = [np.concatenate([facts[k][used], np.zeros(5, np.int64)]) for k in range(1, 5)]
    yield pa.RecordBatch.from_arrays(
        [pa.array(ids.astype(np.int64)), pa.array(total), *[pa.array(r) for r in rest]],
        names=["token", "total", "n1", "n2", "n3", "before"],
    )


def discounts(levels: np.ndarray) -> np.ndarray:
    """Discounts for counts 0, 1, 2 and 3 or more, from the numbers of counts 1 to 4."""
    n1, n2, n3, n4 = (float(max(x, 0)) for x in levels[:4])
    if not n1 or not n2:
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    raw = [0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.0]
    return np.clip(np.array(raw), [0, 0.05, 0.05, 0.05], [0, 0.95, 1.95, 2.95])


class Model:
    """What scoring needs besides bigram counts; its size is bounded by the vocabulary."""

    def __init__(self, facts: pa.Table):
        table = np.zeros((5, 1 << 16))
        ids = facts.column("token").to_numpy()
        inside = ids >= 0
        for k, name in enumerate(("total", "n1", "n2", "n3", "before")):
            table[k][ids[inside]] = facts.column(name).to_numpy()[inside]
        levels = np.zeros(5)
        levels[-ids[~inside] - 1] = facts.column("total").to_numpy()[~inside]
        self.cut = discounts(levels)
        self.total, before = table[0], table[4]
        context = np.maximum(self.total, 1)
        self.back = np.where(
            self.total > 0, (self.cut[1:, None] * table[1:4]).sum(axis=0) / context, 1.0
        )
        # The lower order: discounted numbers of contexts, interpolated with equal shares.
        few = np.bincount(np.minimum(before.astype(int), 5), minlength=6)[1:]
        cut, every = discounts(few), max(before.sum(), 1)
        kept = np.maximum(before - cut[np.minimum(before, 3).astype(int)], 0) / every
        self.unigram = kept + (1 - kept.sum()) / VOCABULARY

    def log_prob(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        pair = keys * _unspread()
        left, right = pair >> np.uint32(16), pair & np.uint32(0xFFFF)
        cut = np.maximum(counts - self.cut[np.minimum(counts, 3)], 0) / np.maximum(self.total[left], 1)
        return np.log(cut + self.back[left] * self.unigram[right])


def _requests(bits: int, ranks_path: str, pattern: str):
    """Distinct bigrams of each chunk, one row per shard."""

    def rows(chunk: int, parts: list[np.ndarray]) -> pa.RecordBatch:
        keys = np.unique(np.concatenate(parts))
        found = [(chunk, shard, packed(keys[at])) for shard, at in _by_shard(keys, bits)]
        kinds = [pa.int64(), pa.int32(), pa.binary()]
        columns = [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["chunk", "shard", "keys"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, parts, last = encoder(ranks_path, pattern).encode_ordinary, [], None
        for batch in batches:
            for text, chunk in zip(batch.column(2), batch.column(3).to_pylist(), strict=True):
                if parts and chunk != last:
                    yield rows(last, parts)
                    parts = []
                last = chunk
                parts.append(np.unique(bigrams(encode(text.as_py() or ""))))
        if parts:
            yield rows(last, parts)

    return run


def _answers(asked: pa.Table, known: pa.Table) -> pa.Table:
    """Counts for the requested bigrams of one shard, in the order of the request."""
    keys, counts = np.empty(0, np.uint32), np.empty(0, np.int64)
    if known.num_rows:
        keys = unpacked(known.column("keys")[0].as_py())
        counts = _unsqueezed(known.column("counts")[0].as_py())
    out, sums = [], []
    for blob in asked.column("keys").to_pylist():
        wanted = unpacked(blob)
        at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
        hit = keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)
        out.append(_squeezed(np.where(hit, counts[at], 0) if len(keys) else np.zeros(len(wanted))))
        sums.append(int(wanted.sum(dtype=np.uint64) & np.uint64(0x7FFFFFFF)))
    return pa.table(
        {
            "chunk": asked.column("chunk"),
            "shard": asked.column("shard"),
            "answer": pa.array(out, pa.binary()),
            "mark": pa.array(sums, pa.int64()),
        }
    )


def _scored(bits: int, ranks_path: str, pattern: str, model: Model):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        encode = encoder(ranks_path, pattern).encode_ordinary
        lines = [bigrams(encode(t.as_py() or "")) for t in docs.column("text")]
        keys = np.unique(np.concatenate(lines))
        found = {
            s: (a, m)
            for s, a, m in zip(
                *(answers.column(c).to_pylist() for c in ("shard", "answer", "mark")), strict=True
            )
        }
        counts = np.zeros(len(keys), np.int64)
        for shard, at in _by_shard(keys, bits):
            answer, mark = found[shard]
            if int(keys[at].sum(dtype=np.uint64) & np.uint64(0x7FFFFFFF)) != mark:
                raise RuntimeError("the input was read in another order than before")
            counts[at] = _unsqueezed(answer)
        values = model.log_prob(keys, counts)
        sums = [float(values[np.searchsorted(keys, line)].sum()) for line in lines]
        return pa.table(
            {
                "doc_id": docs.column("doc_id"),
                "lang": docs.column("lang"),
                "n_tokens": pa.array([len(line) - 1 for line in lines], pa.int64()),
                "log_prob": pa.array(sums, pa.float64()),
            }
        )

    return run


def perplexities(
    docs: DataFrame,
    trusted_ids: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """Log probability of every document under a bigram model of the trusted ones.

    Symbols are the tokens of a public byte-level BPE, so every text has a probability
    and all facts but the bigram counts are bounded by the vocabulary. Bigram counts of
    all trusted text are merged in shards. To score, each chunk of documents asks each
    shard once for the bigrams it holds, and the answers meet the chunk's documents in
    one join: counts move, once per chunk, not once per occurrence. Chunks follow the
    order of the input, so repeated rows fill no group; a checksum stops the job should a
    rerun read its input in another order.

    Returns doc_id, lang, n_tokens, log_prob, held_out (trusted, but not learned from).
    """
    spark = docs.sparkSession
    bits = int(np.clip(np.ceil(np.log2(2 * shuffle_partitions(spark))), 3, 12))
    ids = stored(
        trusted_ids.filter("id is not null").select("id").distinct(), "quality-trusted"
    )
    ids = F.broadcast(ids) if ids.count() <= MAX_BROADCAST_IDS else ids
    lang = F.col(lang_col) if lang_col in docs.columns else F.lit(None)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), lang.cast("string").alias("lang"), F.col(text_col).alias("text")
    )
    unseen = F.pmod(F.xxhash64("doc_id", F.lit("quality fold")), F.lit(FOLDS)) == 0
    taught = rows.filter(F.length("text") > 0).filter(~unseen)
    taught = taught.join(ids, taught["doc_id"] == ids["id"], "left_semi").select("text")
    model = stored(
        taught.mapInArrow(_counted(bits, ranks_path, pattern), "shard int, keys binary, counts binary")
        .groupBy("shard")
        .applyInArrow(_merged, "shard int, keys binary, counts binary"),
        "quality-model",
    )
    names = ("total", "n1", "n2", "n3", "before")
    facts = model.mapInArrow(_token_facts, "token bigint, " + ", ".join(f"{n} bigint" for n in names))
    # At most one row per token of the vocabulary.
    facts = facts.groupBy("token").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    learned = Model(facts)

    cut = rows.withColumn("chunk", F.expr(f"monotonically_increasing_id() div {CHUNK}"))
    asked = cut.mapInArrow(_requests(bits, ranks_path, pattern), "chunk bigint, shard int, keys binary")
    answers = stored(
        asked.groupBy("shard")
        .cogroup(model.groupBy("shard"))
        .applyInArrow(_answers, "chunk bigint, shard int, answer binary, mark bigint")
        .filter("chunk is not null"),
        "quality-answers",
    )
    known = ids.withColumn("trusted", F.lit(True))
    kind = dict(rows.dtypes)["doc_id"]
    scored = (
        cut.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(
            _scored(bits, ranks_path, pattern, learned),
            f"doc_id {kind}, lang string, n_tokens bigint, log_prob double",
        )
    )
    flagged = scored.join(known, scored["doc_id"] == known["id"], "left")
    return stored(
        flagged.select(
            "doc_id",
            "lang",
            "n_tokens",
            "log_prob",
            (F.coalesce("trusted", F.lit(False)) & F.coalesce(unseen, F.lit(False))).alias("held_out"),
        ),
        "quality-scores",
    )


def classify_quality(
    docs: DataFrame,
    trusted_ids: DataFrame,
    ranks_path: str,
    pattern: str,
    quantile: float = 0.99,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """Keep documents whose perplexity is not above their language's threshold.

    The threshold is a quantile of the perplexity of trusted documents that the model was
    not trained on, per language; languages without any take the quantile over all. Null
    and empty texts have no perplexity and are not kept; a null language is a language of
    its own. Without trusted held-out text there is no threshold and all texts are kept.
    Rows may repeat; other columns are ignored; an empty table gives no rows.

    Returns doc_id, lang, n_tokens, perplexity, threshold, kept.
    """
    scores = perplexities(docs, trusted_ids, ranks_path, pattern, id_col, text_col, lang_col)
    value = F.when(F.col("n_tokens") > 0, F.exp(-F.col("log_prob") / (F.col("n_tokens") + 1)))
    rated = scores.withColumn("perplexity", value)
    held = rated.filter("held_out and perplexity is not null")
    limit = F.percentile_approx("perplexity", F.lit(quantile), F.lit(10_000))
    by_lang = held.groupBy(F.col("lang").alias("_lang")).agg(limit.alias("_own"))
    overall = held.agg(limit.alias("l")).first()["l"]
    joined = rated.join(by_lang, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    threshold = F.coalesce("_own", F.lit(overall).cast("double"))
    kept = F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity") <= threshold, F.lit(True))
    return joined.select(
        "doc_id", "lang", "n_tokens", "perplexity", threshold.alias("threshold"), kept.alias("kept")
    )
