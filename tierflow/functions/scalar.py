"""Null-safe arithmetic, identifiers and dates as plain column expressions."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nz(c: str | Column, default: float = 0.0) -> Column:
    """The value, or `default` where it is null."""
    return F.coalesce(as_col(c), F.lit(default))


def total(*cols: str | Column) -> Column:
    """Sum of the columns, nulls counting as zero, added from left to right."""
    return functools.reduce(operator.add, [nz(c) for c in cols])


def net_of(base: str | Column, *charges: str | Column) -> Column:
    """`base` minus the sum of all charges."""
    return nz(base) - total(*charges)


def gap(after: str | Column, before: str | Column) -> Column:
    """Absolute movement between two balances."""
    return F.abs(nz(after) - nz(before))


def pct_of(part: str | Column, whole: str | Column) -> Column:
    """`part` as a percentage of `whole`; 0 where `whole` is null or 0."""
    whole = as_col(whole)
    usable = F.coalesce(whole != 0, F.lit(False))
    return F.when(usable, nz(part) / whole * 100).otherwise(F.lit(0.0))


def when_type(kind: str | Column, codes: list[str], amount: str | Column) -> Column:
    """`amount` for the listed codes, 0 for all others."""
    return F.when(as_col(kind).isin(*codes), as_col(amount)).otherwise(F.lit(0.0))


def signed_movement(
    kind: str | Column, debit_codes: list[str], before: str | Column, amount: str | Column
) -> Column:
    """Balance after the movement: debit codes subtract, all others add."""
    amount = as_col(amount)
    return as_col(before) + F.when(as_col(kind).isin(*debit_codes), -amount).otherwise(amount)


def fingerprint(key: str | Column) -> Column:
    """SHA-256 hex of the key as text; null stays null."""
    return F.sha2(as_col(key).cast("string"), 256)


def zero_fill(c: str | Column, digits: int) -> Column:
    """Number as text, zero-padded to `digits`; longer numbers keep every digit."""
    text = as_col(c).cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(digits)), F.lit("0"))


def dated_sequence_id(day: str | Column, sequence: str | Column, digits: int = 9) -> Column:
    """bigint made of yyyymmdd followed by the zero-padded sequence."""
    return F.concat(F.date_format(as_col(day), "yyyyMMdd"), zero_fill(sequence, digits)).cast(
        "bigint"
    )


def padded_key(prefix: str | Column, key: str | Column, digits: int = 15) -> Column:
    """Text id: prefix followed by the zero-padded key."""
    return F.concat(as_col(prefix), zero_fill(key, digits))


def join_text(*parts: str | Column) -> Column:
    """Parts joined by one space; null when any part is null."""
    spaced: list[Column] = []
    for part in parts:
        spaced += [F.lit(" "), as_col(part)] if spaced else [as_col(part)]
    return F.concat(*spaced)


def first_part(c: str | Column, separator: str = " ") -> Column:
    return F.split_part(as_col(c), F.lit(separator), F.lit(1))


def last_part(c: str | Column, separator: str = " ") -> Column:
    return F.split_part(as_col(c), F.lit(separator), F.lit(-1))


def mailbox(first: str | Column, last: str | Column, domain: str) -> Column:
    """first.last@domain in lower case."""
    return F.lower(F.concat(as_col(first), F.lit("."), as_col(last), F.lit("@" + domain)))


def age_years(born: str | Column, as_of: str | Column) -> Column:
    """Whole years between two dates, a year being 365.25 days."""
    return F.floor(F.datediff(as_col(as_of), as_col(born)) / F.lit(365.25)).cast("bigint")


def add_days_if(condition: Column, day: str | Column, days: str | Column | int) -> Column:
    """`day` moved by `days` where the condition holds, else null."""
    days = F.lit(days) if isinstance(days, int) else as_col(days)
    return F.when(condition, F.date_add(as_col(day), days.cast("int")))


def parse_day(text: str | Column) -> Column:
    """Strict yyyy-MM-dd date; anything else is null."""
    text = as_col(text)
    shaped = text.rlike(r"^\d{4}-\d{2}-\d{2}$")
    return F.when(shaped, F.try_to_timestamp(text, F.lit("yyyy-MM-dd"))).cast("date")
