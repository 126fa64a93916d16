"""Row expectations and table audits.

Audits return small DataFrames; each scans its table once and shuffles partial
aggregates only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.functions.scalar import as_col
from tierflow.operators.keys import one_row_per_key
from tierflow.operators.literals import literal_table


def holds(predicate: str | Column) -> Column:
    """Whether a row meets the predicate; null does not."""
    test = F.expr(predicate) if isinstance(predicate, str) else predicate
    return F.coalesce(test, F.lit(False))


def expect(
    df: DataFrame,
    name: str,
    predicate: str | Column,
    action: str = "drop",
    observation: Observation | None = None,
) -> DataFrame:
    """Apply a row expectation; a null predicate counts as violated.

    `drop` removes violating rows, `keep` leaves them, `fail` stops the job. With an
    observation the violations are counted while the rows pass; counting keeps
    Catalyst from pushing the filter further down, so it is optional.
    """
    ok = holds(predicate)
    if observation is not None:
        df = df.observe(
            observation,
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(~ok).alias("n_violations"),
        )
    if action == "keep":
        return df
    if action == "drop":
        return df.filter(ok)
    if action == "fail":
        stop = F.raise_error(F.lit(f"expectation {name} violated")).cast("boolean")
        return df.filter(F.when(ok, F.lit(True)).otherwise(stop))
    raise ValueError(f"unknown action {action!r}")


def expectation_metrics(df: DataFrame, rules: Mapping[str, str | Column]) -> DataFrame:
    """Passed and violated row counts of every rule, from one scan."""
    counts = [F.count_if(~holds(rule)).alias(f"bad_{i}") for i, rule in enumerate(rules.values())]
    one = df.agg(F.count(F.lit(1)).alias("n_rows"), *counts)
    lines = [
        F.struct(
            F.lit(name).alias("expectation"),
            (F.col("n_rows") - F.col(f"bad_{i}")).alias("n_passed"),
            F.col(f"bad_{i}").alias("n_violations"),
        )
        for i, name in enumerate(rules)
    ]
    return one.select(F.explode(F.array(*lines)).alias("m")).select("m.*")


def schema_conformance(
    df: DataFrame, contract: T.StructType, forbidden: Sequence[str] = ()
) -> DataFrame:
    """Contract column by column: expected and actual type, and how many rows fill it.

    Extra and forbidden columns get a line with no expected type.
    """
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = {f.name: f.dataType.simpleString() for f in contract.fields}
    names = [*wanted, *[c for c in actual if c not in wanted]]
    filled = df.agg(
        *[
            (F.count(F.col(f"`{c}`")) if c in actual else F.lit(0).cast("bigint")).alias(f"c{i}")
            for i, c in enumerate(names)
        ]
    )
    lines = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(wanted.get(c)).cast("string").alias("expected"),
            F.lit(actual.get(c)).cast("string").alias("observed"),
            F.col(f"c{i}").alias("n_filled"),
            F.lit(wanted.get(c) == actual.get(c) and c not in forbidden).alias("ok"),
        )
        for i, c in enumerate(names)
    ]
    return filled.select(F.explode(F.array(*lines)).alias("m")).select("m.*")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def key_uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys, repeated keys, null keys, and the verdict."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    no_null = F.lit(True)
    for k in keys:
        no_null = no_null & F.col(k).isNotNull()
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.count_if(F.col("n") > 1).alias("n_repeated"),
        F.count_if(~no_null).alias("n_null_keys"),
    ).withColumn("ok", F.col("n_repeated") == 0)


def one_to_one(parent: DataFrame, child: DataFrame, key: str) -> DataFrame:
    """One row: parents without child, children without parent, keys not matched 1:1.

    A tagged union with one aggregate: no join, and copies of a key combine on the
    map side.
    """
    tagged = parent.select(F.col(key).alias("k"), F.lit(1).alias("p"), F.lit(0).alias("c")).union(
        child.select(F.col(key), F.lit(0), F.lit(1))
    )
    per_key = tagged.groupBy("k").agg(F.sum("p").alias("p"), F.sum("c").alias("c"))
    return per_key.agg(
        F.coalesce(F.sum("p"), F.lit(0)).alias("n_parent"),
        F.coalesce(F.sum("c"), F.lit(0)).alias("n_child"),
        F.count_if(F.col("c") == 0).alias("n_missing"),
        F.count_if(F.col("p") == 0).alias("n_orphan"),
        F.count_if((F.col("p") > 1) | (F.col("c") > 1)).alias("n_repeated"),
    ).withColumn("ok", F.expr("n_missing = 0 AND n_orphan = 0 AND n_repeated = 0"))


def value_domain(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Every value seen or allowed, with its row count and whether it may and does occur.

    The table is counted per value first; the allowed list joins those counts.
    """
    counted = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
    domain = literal_table(
        df.sparkSession, [(v, True) for v in allowed], "v string, allowed boolean"
    )
    both = counted.join(domain, F.col("value") == F.col("v"), "full")
    return both.select(
        F.coalesce("value", "v").alias("value"),
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        F.coalesce("allowed", F.lit(False)).alias("allowed"),
        (F.col("n_rows").isNotNull() & F.coalesce("allowed", F.lit(False))).alias("ok"),
    )


def category_limits(
    df: DataFrame, category: str, value: str, limits: Mapping[str, tuple[float, float]]
) -> DataFrame:
    """Observed range of every category against its limits; unknown categories fail."""
    seen = df.groupBy(F.col(category).alias("category")).agg(
        F.min(value).alias("min_value"), F.max(value).alias("max_value")
    )
    rows = [(c, float(lo), float(hi)) for c, (lo, hi) in limits.items()]
    bound = literal_table(df.sparkSession, rows, "category string, low double, high double")
    within = (F.col("min_value") >= F.col("low")) & (F.col("max_value") <= F.col("high"))
    return seen.join(bound, "category", "left").withColumn("ok", F.coalesce(within, F.lit(False)))


def distribution_check(
    shares: DataFrame, targets: Mapping[str, float], tolerance: float
) -> DataFrame:
    """Band shares against their target percentages, within a tolerance in points."""
    wanted = literal_table(
        shares.sparkSession, list(targets.items()), "band string, target_pct double"
    )
    near = F.abs(F.col("share_pct") - F.col("target_pct")) <= F.lit(tolerance)
    return shares.join(wanted, "band", "full").withColumn("ok", F.coalesce(near, F.lit(False)))


def null_nan_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null and NaN counts of every column from one aggregate."""
    kinds = dict(df.dtypes)
    made = []
    for i, c in enumerate(columns):
        is_float = kinds[c] in ("double", "float")
        made += [
            F.count_if(F.col(c).isNull()).alias(f"null_{i}"),
            (F.count_if(F.isnan(c)) if is_float else F.lit(0).cast("bigint")).alias(f"nan_{i}"),
        ]
    lines = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"null_{i}").alias("n_null"),
            F.col(f"nan_{i}").alias("n_nan"),
        )
        for i, c in enumerate(columns)
    ]
    return df.agg(*made).select(F.explode(F.array(*lines)).alias("m")).select("m.*")


def formula_breaks(
    df: DataFrame, formulas: Mapping[str, Column], tolerance: float = 0.001
) -> DataFrame:
    """Per stored column: rows checked and rows that differ from the recomputed formula.

    A missing value counts as a break unless both sides are missing.
    """
    made = []
    for i, (c, formula) in enumerate(formulas.items()):
        same = F.coalesce(F.abs(F.col(c) - formula) <= tolerance, F.col(c).isNull() & formula.isNull())
        made.append(F.count_if(~same).alias(f"bad_{i}"))
    lines = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("n_rows"),
            F.col(f"bad_{i}").alias("n_breaks"),
            (F.col(f"bad_{i}") == 0).alias("ok"),
        )
        for i, c in enumerate(formulas)
    ]
    one = df.agg(F.count(F.lit(1)).alias("n_rows"), *made)
    return one.select(F.explode(F.array(*lines)).alias("m")).select("m.*")


def composite_breaks(df: DataFrame, whole: str, expected: Column) -> DataFrame:
    """One row: rows checked and rows whose field is not the text built from its parts."""
    same = F.col(whole).eqNullSafe(expected)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(~same).alias("n_breaks")
    ).withColumn("ok", F.col("n_breaks") == 0)


def volume_check(df: DataFrame, at_least: int = 0, exactly: int | None = None) -> DataFrame:
    bound = F.col("n_rows") >= at_least
    if exactly is not None:
        bound = bound & (F.col("n_rows") == exactly)
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("ok", bound)


def run_date_breaks(df: DataFrame, column: str, day: str | Column) -> DataFrame:
    """One row: rows checked and rows not carrying the run date."""
    wanted = F.lit(day).cast("date") if isinstance(day, str) else day
    bad = ~F.col(column).cast("date").eqNullSafe(wanted)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(bad).alias("n_breaks")
    ).withColumn("ok", F.col("n_breaks") == 0)


def time_part_breaks(df: DataFrame, column: str) -> DataFrame:
    """One row: hour and minute ranges, and rows whose parts are missing or invalid."""
    hour, minute = F.hour(column), F.minute(column)
    valid = hour.between(0, 23) & minute.between(0, 59)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~F.coalesce(valid, F.lit(False))).alias("n_breaks"),
        F.min(hour).alias("min_hour"),
        F.max(hour).alias("max_hour"),
        F.min(minute).alias("min_minute"),
        F.max(minute).alias("max_minute"),
    ).withColumn("ok", F.col("n_breaks") == 0)


def reconcile(
    left: DataFrame,
    right: DataFrame,
    key: str,
    columns: Sequence[str],
    tolerance: float = 0.0,
) -> DataFrame:
    """Per column: keys on both sides, and keys whose values differ.

    Numbers may differ by up to the tolerance; nulls equal nulls. Keys found on one
    side only are counted on the line of the key column. A repeated key fails.
    """
    numeric = {
        f.name for f in left.schema.fields if isinstance(f.dataType, T.NumericType)
    }
    a = one_row_per_key(left, [key], columns, "_lk", "_l")
    b = one_row_per_key(right, [key], columns, "_rk", "_r")
    both = a.join(b, F.col("_lk") == F.col("_rk"), "full")
    on_both = F.col("_lk").isNotNull() & F.col("_rk").isNotNull()
    checks: dict[str, Column] = {key: ~on_both}
    for c in columns:
        x, y = F.col(f"_l.{c}"), F.col(f"_r.{c}")
        same = x.eqNullSafe(y)
        if c in numeric:
            same = same | F.coalesce(F.abs(x - y) <= tolerance, F.lit(False))
        checks[c] = on_both & ~same
    made = [F.count_if(bad).alias(f"bad_{i}") for i, bad in enumerate(checks.values())]
    lines = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("n_keys"),
            F.col(f"bad_{i}").alias("n_breaks"),
            (F.col(f"bad_{i}") == 0).alias("ok"),
        )
        for i, c in enumerate(checks)
    ]
    one = both.agg(F.count_if(on_both).alias("n_keys"), *made)
    return one.select(F.explode(F.array(*lines)).alias("m")).select("m.*")


def config_completeness(
    config: DataFrame, required: Sequence[str], key: str = "Clave", value: str = "Valor"
) -> DataFrame:
    """Required configuration keys with the number of non-blank values found."""
    wanted = literal_table(config.sparkSession, [(k,) for k in required], "required string")
    present = config.groupBy(F.col(key).alias("required")).agg(
        F.count_if(F.length(F.trim(as_col(value))) > 0).alias("n_values")
    )
    found = F.coalesce("n_values", F.lit(0))
    return wanted.join(present, "required", "left").select(
        "required", found.alias("n_values"), (found > 0).alias("ok")
    )
