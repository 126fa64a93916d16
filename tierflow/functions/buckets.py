"""Deterministic sampling and weighted assignment driven by a key, not by the data layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions.scalar import as_col


def key_digest(key: str | Column | list[str], salt: str = "") -> Column:
    """64-bit hash of the key; draws that must be independent take different salts."""
    keys = key if isinstance(key, list) else [key]
    return F.xxhash64(*[as_col(k) for k in keys], *([F.lit(salt)] if salt else []))


#: Slots that hashes are dealt to; a given digest is dealt to fewer unless told otherwise.
FINE = 1 << 53


def _slot(
    key: str | Column | list[str], grain: int | None, digest: Column | None, salt: str, coarse: int
) -> tuple[Column, int]:
    grain = grain or (FINE if digest is None else coarse)
    return F.pmod(key_digest(key, salt) if digest is None else digest, F.lit(grain)), grain


def hash_flag(
    key: str | Column | list[str],
    fraction: float,
    grain: int | None = None,
    digest: Column | None = None,
    salt: str = "",
) -> Column:
    """True for about `fraction` of the keys; the same keys on every run and layout.

    A fraction that the grain cannot state to a thousandth of itself is an error.
    """
    slot, grain = _slot(key, grain, digest, salt, 10_000)
    chosen = round(fraction * grain)
    if abs(chosen - fraction * grain) > fraction * grain / 1000:
        raise ValueError(f"a fraction of {fraction} needs a finer grain than {grain}")
    return slot < F.lit(chosen)


def hash_sample(
    df: DataFrame, key: str | list[str], fraction: float, digest: Column | None = None
) -> DataFrame:
    return df.filter(hash_flag(key, fraction, digest=digest))


def unit_interval(
    key: str | Column | list[str],
    grain: int = 1_000_000,
    digest: Column | None = None,
    salt: str = "",
) -> Column:
    """A number in [0, 1) fixed by the key."""
    return F.pmod(key_digest(key, salt) if digest is None else digest, F.lit(grain)) / F.lit(grain)


def weighted_choice(
    key: str | Column | list[str],
    weights: dict[str, float],
    grain: int | None = None,
    digest: Column | None = None,
    salt: str = "",
) -> Column:
    """One of the labels per key, in proportion to the (not yet normalised) weights.

    A weight above 0 that the grain would round to nothing is an error.
    """
    slot, grain = _slot(key, grain, digest, salt, 1_000_000)
    whole, labels = sum(weights.values()), list(weights)
    choice, reached, last = None, 0.0, 0
    for label in labels:
        reached += weights[label]
        edge = round(grain * reached / whole)
        if weights[label] > 0 and edge == last:
            raise ValueError(f"the weight of {label!r} needs a finer grain than {grain}")
        last = edge
        if label == labels[-1]:
            break
        chosen = slot < F.lit(edge)
        choice = F.when(chosen, label) if choice is None else choice.when(chosen, label)
    if choice is None:
        return F.lit(labels[0])
    return choice.otherwise(labels[-1])
