"""Soft-membership mixing to target weights, in DataFrame functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.common import row_digest, stored

#: Labelled documents per domain, at most, that the classifier is fitted on.
SAMPLE_DOCS = 1000
#: Marker words per domain: at most LEXICON, each in at least SUPPORT of the domain's
#: sample and LIFT times as common there as elsewhere.
LEXICON, SUPPORT, LIFT = 32, 0.02, 3.0
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = "!#$%&*|<>{}[]=~^@_\\/+"
#: Bins per feature.
BINS = 8
#: The solver stops at this error, as a share of the whole budget, or after so many steps.
TOLERANCE, MAX_STEPS = 1e-6, 150


def with_words(docs: DataFrame, text_col: str) -> DataFrame:
    """Add `_text`, the word count `_tokens` and the distinct words `_words`."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")
    cut = docs.withColumn("_text", text).withColumn("_all", words)
    return (
        cut.withColumn("_tokens", F.size("_all").cast("bigint"))
        .withColumn("_words", F.array_distinct("_all"))
        .drop("_all")
    )


def _features(lexicons: list[list[str]]) -> list[Column]:
    """Bin numbers (0 to BINS - 1): letter case, symbols, word length, repetition, markers."""
    size = F.greatest(F.length("_text"), F.lit(1))
    tokens = F.greatest(F.col("_tokens"), F.lit(1))

    def share(of: str, steps: int) -> Column:
        return F.floor((size - F.length(F.translate("_text", of, ""))) / size * steps)

    raw = [
        share(UPPER, BINS),
        share(SYMBOLS, 40),
        F.floor(F.length("_text") / tokens / 2),
        F.floor(F.size("_words") / tokens * BINS),
    ]
    for words in lexicons:
        known = F.array(*[F.lit(w) for w in words]).cast("array<string>")
        raw.append(F.size(F.array_intersect("_words", known)))
    return [F.greatest(F.lit(0), F.least(F.lit(BINS - 1), x)).cast("int") for x in raw]


def _sample(docs: DataFrame, labelled: DataFrame, id_col: str, text_col: str, most: int):
    """Texts and domains of at most `most` labelled ids per domain, by id hash."""
    known = labelled.groupBy("id").agg(F.min("domain").alias("domain"))
    here = docs.select(F.col(id_col).alias("id")).join(known, "id")
    best = Window.partitionBy("domain").orderBy(F.xxhash64("id", F.lit("mixing sample")), "id")
    chosen = (
        here.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= most)
        .select(F.col("id").alias("_id"), F.col("domain").alias("_domain"))
        .distinct()
    )
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_raw"))
    # At most `most` ids per domain, hence small enough to send to every task.
    matched = texts.join(F.broadcast(chosen), F.col("_doc") == F.col("_id"))
    return stored(
        with_words(matched, "_raw").select("_domain", "_text", "_tokens", "_words"), "mix-sample"
    )


@dataclass(frozen=True)
class Membership:
    """Naive Bayes over binned features: tables of feature x bin x domain, bounded in size."""

    lexicons: list[list[str]]
    priors: list[float]
    tables: list[list[list[float]]]

    def add_to(self, docs: DataFrame, text_col: str) -> DataFrame:
        """Add `_tokens` and `_posterior`, an array in the order of the domains.

        Bins and logits are columns of their own, so that each is computed once.
        """
        binned = with_words(docs, text_col).withColumn("_bins", F.array(*_features(self.lexicons)))
        logits = []
        for prior, table in zip(self.priors, self.tables, strict=True):
            score = F.lit(prior)
            for f, row in enumerate(table):
                score = score + F.element_at(F.array(*[F.lit(x) for x in row]), F.col("_bins")[f] + 1)
            logits.append(score)
        scored = binned.withColumn("_logits", F.array(*logits))
        top = scored.withColumn("_top", F.array_max("_logits"))
        raised = top.withColumn("_raised", F.transform("_logits", lambda x: F.exp(x - F.col("_top"))))
        total = F.aggregate("_raised", F.lit(0.0), lambda a, x: a + x)
        # Rounded, so that documents that look alike share a posterior.
        posterior = F.transform("_raised", lambda x: F.round(x / F.col("_total"), 6))
        return (
            raised.withColumn("_total", total)
            .withColumn("_posterior", posterior)
            .drop("_text", "_words", "_bins", "_logits", "_top", "_raised", "_total")
        )


def fit_membership(
    docs: DataFrame,
    labelled: DataFrame,
    domains: list[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_docs: int = SAMPLE_DOCS,
) -> Membership:
    """Fit the classifier on the labelled table (id, domain).

    Marker words and bin tables come from the sample, prior shares from all labels.
    Without labelled documents every domain has the same posterior.
    """
    usable = labelled.filter(F.col("id").isNotNull() & F.col("domain").isin(domains))
    sample = _sample(docs, usable, id_col, text_col, sample_docs)
    sizes = {r["_domain"]: r["n"] for r in sample.groupBy("_domain").agg(F.count("*").alias("n")).collect()}
    priors = {r["domain"]: r["n"] for r in usable.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    whole = sum(sizes.values())
    inside = [F.sum((F.col("_domain") == d).cast("int")).alias(f"n{k}") for k, d in enumerate(domains)]
    words = stored(
        sample.select("_domain", F.explode("_words").alias("word")).groupBy("word").agg(*inside),
        "mix-words",
    )
    lexicons = []
    for k, domain in enumerate(domains):
        own, rest = sizes.get(domain, 0), whole - sizes.get(domain, 0)
        every = reduce(Column.__add__, [F.col(f"n{j}") for j in range(len(domains))])
        lift = (F.col(f"n{k}") / max(own, 1)) / ((every - F.col(f"n{k}") + 1) / (rest + 1))
        best = (
            words.withColumn("lift", lift)
            .filter((F.col(f"n{k}") >= max(SUPPORT * own, 2)) & (F.col("lift") >= LIFT))
            .orderBy(F.desc("lift"), "word")
            .limit(LEXICON)
        )
        lexicons.append([r["word"] for r in best.collect()])
    binned = sample.select("_domain", F.array(*_features(lexicons)).alias("bins"))
    tables = (
        binned.select("_domain", F.posexplode("bins").alias("feature", "bin"))
        .groupBy("_domain", "feature", "bin")
        .agg(F.count("*").alias("n"))
    )
    seen = {(r["_domain"], r["feature"], r["bin"]): r["n"] for r in tables.collect()}
    every = sum(priors.values()) + len(domains)
    features = range(len(_features(lexicons)))
    return Membership(
        lexicons,
        [math.log((priors.get(d, 0) + 1) / every) for d in domains],
        [
            [
                [
                    math.log((seen.get((d, f, b), 0) + 0.5) / (sizes.get(d, 0) + 0.5 * BINS))
                    for b in range(BINS)
                ]
                for f in features
            ]
            for d in domains
        ],
    )


def _advance(rate: Column, last: Column, pulled: Column, ahead: Column) -> tuple[Column, Column]:
    """One projected step, and the point extrapolated from it, both nonnegative."""
    now = F.greatest(F.lit(0.0), rate + pulled)
    return F.greatest(F.lit(0.0), now + ahead * (now - last)), now


def _folded(steps: list[list[float]], posterior: Column) -> Column:
    """The rate after all steps (domain moves, then the extrapolation), from rate 1."""
    if not steps:
        return F.lit(1.0)
    moves = F.array(*[F.array(*[F.lit(x) for x in s]) for s in steps])

    def step(state: Column, move: Column) -> Column:
        parts = F.zip_with(posterior, move, lambda p, g: F.coalesce(p * g, F.lit(0.0)))
        pulled = F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)
        rate, now = _advance(state["rate"], state["last"], pulled, F.element_at(move, -1))
        return F.struct(rate.alias("rate"), now.alias("last"))

    start = F.struct(F.lit(1.0).alias("rate"), F.lit(1.0).alias("last"))
    return F.aggregate(moves, start, step, lambda state: state["rate"])


def solve_rates(
    members: DataFrame, targets: list[float], tolerance: float = TOLERANCE, max_steps: int = MAX_STEPS
) -> list[list[float]]:
    """Steps of projected gradient descent that bring the domain totals to `targets`.

    `members` has posterior (array) and tokens. Minimises the squared error of each
    domain's expected tokens, weighted by the inverse of its tokens at rate 1, over
    nonnegative rates. In the metric of document sizes the step of a document is its
    posterior times the relative errors, and step size 1 is below the stability bound;
    momentum (k / (k + 3), projected too) speeds up uncertain posteriors.
    Each step is one distributed sum; only the domain totals reach the driver. Documents
    with the same posterior have the same rate and are added up beforehand.
    """
    domains = range(len(targets))
    grouped = stored(
        members.groupBy("posterior").agg(F.sum("tokens").cast("double").alias("tokens")), "mix-groups"
    )
    p, steps, base = F.col("posterior"), [], None
    budget = sum(targets) or 1.0
    for k in range(max_steps):
        rated = grouped.withColumn("share", _folded(steps, p) * F.col("tokens"))
        sums = [F.sum(F.col("share") * p[d]).alias(f"s{d}") for d in domains]
        found = [x or 0.0 for x in rated.agg(*sums).first()]
        base = base or found
        errors = [t - s for t, s in zip(targets, found, strict=True)]
        if max(map(abs, errors)) <= tolerance * budget:
            break
        move = [e / b if b > 0 else 0.0 for e, b in zip(errors, base, strict=True)]
        if not any(move):
            break
        steps.append([*move, k / (k + 3)])
    return steps


def fit_rates(
    members: DataFrame, weights: dict[str, float], anchor: str | None = None
) -> list[list[float]]:
    """Solver steps for target shares; `members` has _tokens and _posterior."""
    domains, total = list(weights), sum(weights.values())
    sums = members.select(
        F.sum("_tokens").alias("all"),
        *[F.sum(F.col("_tokens") * F.col("_posterior")[d]).alias(f"s{d}") for d in range(len(domains))],
    ).first()
    whole = float(sums["all"] or 0)
    if anchor is not None:
        whole = (sums[f"s{domains.index(anchor)}"] or 0.0) * total / weights[anchor]
    named = members.select(F.col("_tokens").alias("tokens"), F.col("_posterior").alias("posterior"))
    return solve_rates(named, [whole * weights[d] / total for d in domains])


def mixing_rates(
    docs: DataFrame,
    labelled: DataFrame,
    weights: dict[str, float],
    anchor: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Soft membership in domains and the rate at which each document should be drawn.

    A classifier fitted on the labelled table (id, domain) gives each document posteriors
    of the domains in `weights`. Rates are the nonnegative numbers, reached by descent
    from rate 1, for which the expected tokens (rate x tokens x posterior) of the domains
    are in proportion to `weights`. The whole is as large as the input or, with an
    `anchor`, such that this domain keeps its present size. Tokens are runs of letters
    and digits.

    Null and empty texts have 0 tokens, so they carry no weight; they still get a
    posterior and a rate. Labels without a document, documents without a label, and
    labels outside `weights` only leave the sample; of several labels of one id the
    first in alphabetical order counts. A domain that no document belongs to stays at 0.
    Rows may repeat; other columns are ignored; an empty table gives no rows.

    Returns doc_id, tokens, posterior (in the order of `weights`), rate.
    """
    model = fit_membership(docs, labelled, list(weights), id_col, text_col)
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    members = stored(model.add_to(narrow, "text").drop("text"), "mix-members")
    steps = fit_rates(members, weights, anchor)
    return members.select(
        "doc_id",
        F.col("_tokens").alias("tokens"),
        F.col("_posterior").alias("posterior"),
        _folded(steps, F.col("_posterior")).alias("rate"),
    )


def mixed(
    docs: DataFrame,
    labelled: DataFrame,
    weights: dict[str, float],
    anchor: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The documents at their rates: a row with rate 1.3 comes once, or twice in 3 of 10 cases.

    All columns stay, whatever their names. The draw is fixed by the row, so equal rows
    are treated alike on every run.
    """
    model = fit_membership(docs, labelled, list(weights), id_col, text_col)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        row_digest(docs).alias("_digest"),
        F.col(text_col).alias("_raw"),
    )
    placed = model.add_to(rows, "_raw")
    steps = fit_rates(stored(placed.select("_tokens", "_posterior"), "mix-members"), weights, anchor)
    grain = F.lit(1 << 53)
    draw = F.pmod(F.xxhash64(F.lit("mixing draw"), F.col("_digest")), grain) / grain
    # The number is never below 0. It keeps the filter from moving below the classifier,
    # where the optimizer would repeat the whole classifier inside the predicate.
    fence = (F.monotonically_increasing_id() < 0).cast("int")
    times = F.floor(_folded(steps, F.col("_posterior")) + draw).cast("int") + fence
    repeated = placed.withColumn("_times", times).filter("_times > 0")
    copies = repeated.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    return copies.select("_row.*")
