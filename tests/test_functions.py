import datetime

import pytest
from pyspark.sql import functions as F

from tierflow import functions as fn
from tierflow.plans import rules


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def lit(value, kind="double"):
    return F.lit(value).cast(kind)


@pytest.mark.parametrize(
    "part, whole, expected",
    [(5.0, None, 0.0), (5.0, 0.0, 0.0), (5.0, 20.0, 25.0), (None, 20.0, 0.0), (None, None, 0.0)],
)
def test_percentage_is_guarded(spark, part, whole, expected):
    assert one(spark, fn.pct_of(lit(part), lit(whole))) == (expected,)


def test_null_safe_arithmetic(spark):
    assert one(
        spark,
        fn.net_of(lit(10.0), lit(None), lit(3.0)),
        fn.gap(lit(None), lit(4.0)),
        fn.total(lit(None), lit(None)),
    ) == (7.0, 4.0, 0.0)


def test_identifiers_keep_every_digit(spark):
    day = F.lit("2026-03-29").cast("date")
    assert one(
        spark,
        fn.dated_sequence_id(day, F.lit(7)),
        fn.dated_sequence_id(day, F.lit(1234567890)),
        fn.padded_key(F.lit("AHRO"), F.lit(42)),
        fn.padded_key(F.lit("X"), F.lit(12345), digits=3),
        fn.fingerprint(F.lit(None).cast("bigint")),
    ) == (20260329000000007, 202603291234567890, "AHRO000000000000042", "X12345", None)


@pytest.mark.parametrize(
    "text", ["15-01-2026", "2026/01/15", "01-15-2026", "abc", "", "2026-13-32", "2026-1-5"]
)
def test_only_strict_dates_parse(spark, text):
    assert one(spark, fn.parse_day(F.lit(text))) == (None,)


def test_strict_date_parses(spark):
    assert one(spark, fn.parse_day(F.lit("2026-01-15"))) == (datetime.date(2026, 1, 15),)


def test_age_and_conditional_dates(spark):
    born, today = (F.lit(d).cast("date") for d in ("2000-06-15", "2020-06-14"))
    assert one(
        spark,
        fn.age_years(born, today),
        fn.add_days_if(F.lit(True), born, 3),
        fn.add_days_if(F.lit(False), born, 3),
    ) == (19, datetime.date(2000, 6, 18), None)


def test_signed_movement_and_gated_amounts(spark):
    debit = ["DATM"]
    assert one(
        spark,
        fn.signed_movement(F.lit("DATM"), debit, lit(10.0), lit(4.0)),
        fn.signed_movement(F.lit("CATM"), debit, lit(10.0), lit(4.0)),
        fn.when_type(F.lit("CATM"), ["CATM"], lit(4.0)),
        fn.when_type(F.lit("DATM"), ["CATM"], lit(4.0)),
    ) == (6.0, 14.0, 4.0, 0.0)


@pytest.mark.parametrize(
    "level, score, arrears, label",
    [
        ("04", 499, "SI", "RIESGO_CRITICO"),
        ("05", 500, "SI", "RIESGO_ALTO"),
        ("03", 499, "SI", "RIESGO_ALTO"),
        ("04", 599, "SI", "RIESGO_ALTO"),
        ("04", 600, "SI", "RIESGO_MEDIO"),
        ("04", 499, None, "RIESGO_MEDIO"),
        ("01", 649, "SI", "RIESGO_MEDIO"),
        ("01", 650, "SI", "RIESGO_BAJO"),
        ("01", 699, "NO", "RIESGO_BAJO"),
        ("02", 700, "NO", "RIESGO_BAJO"),
        ("01", 700, "NO", "SIN_RIESGO"),
        (None, None, None, "SIN_RIESGO"),
    ],
)
def test_risk_boundaries(spark, level, score, arrears, label):
    row = spark.createDataFrame([(level, score, arrears)], "l string, s bigint, a string")
    assert row.select(rules.RISK.bind(level="l", score="s", arrears="a")).first()[0] == label


@pytest.mark.parametrize(
    "available, limit, segment, label",
    [
        (200000.0, 100000.0, "VIP", "SALDO_PREMIUM"),
        (199999.99, 100000.0, "VIP", "SALDO_ALTO"),
        (200000.0, 100000.0, "PREM", "SALDO_ALTO"),
        (200000.0, 100000.0, "STD", "SALDO_MEDIO"),
        (25000.0, 9999.0, "VIP", "SALDO_BAJO"),
        (4999.0, 5000.0, "BAS", "SALDO_BAJO"),
        (4999.0, 5000.0, "VIP", "SALDO_CRITICO"),
        (None, None, "VIP", "SALDO_CRITICO"),
    ],
)
def test_balance_boundaries(spark, available, limit, segment, label):
    row = spark.createDataFrame([(available, limit, segment)], "a double, l double, s string")
    made = rules.BALANCE.bind(available="a", limit="l", segment="s")
    assert row.select(made).first()[0] == label


@pytest.mark.parametrize(
    "days, products, state, label",
    [
        (30, 8, "AC", "CLIENTE_INTEGRAL"),
        (31, 8, "AC", "ACTIVIDAD_ALTA"),
        (90, 5, "AC", "ACTIVIDAD_ALTA"),
        (91, 5, "AC", "ACTIVIDAD_MEDIA"),
        (180, 3, "AC", "ACTIVIDAD_MEDIA"),
        (181, 3, "AC", "ACTIVIDAD_BAJA"),
        (30, 8, "IN", "ACTIVIDAD_BAJA"),
        (365, 1, "IN", "ACTIVIDAD_BAJA"),
        (366, 9, "AC", "INACTIVO"),
        (10, 9, "CL", "INACTIVO"),
        (None, 9, "AC", "INACTIVO"),
    ],
)
def test_activity_boundaries(spark, days, products, state, label):
    row = spark.createDataFrame([(days, products, state)], "d int, p bigint, s string")
    assert row.select(rules.ACTIVITY.bind(days="d", products="p", state="s")).first()[0] == label


def test_hash_flag_is_stable_and_close_to_the_fraction(spark):
    ids = spark.range(20000)
    flagged = ids.filter(fn.hash_flag("id", 0.2))
    again = ids.repartition(7).filter(fn.hash_flag("id", 0.2))
    assert flagged.exceptAll(again).count() == 0
    assert abs(flagged.count() / 20000 - 0.2) < 0.02
    assert ids.filter(fn.hash_flag("id", 0.0)).count() == 0
    assert ids.filter(fn.hash_flag("id", 1.0)).count() == 20000


def test_weighted_choice_follows_the_weights(spark):
    chosen = spark.range(50000).select(fn.weighted_choice("id", rules.code_weights()).alias("c"))
    shares = {r.c: r["count"] / 500 for r in chosen.groupBy("c").count().collect()}
    for band, codes in rules.BANDS.items():
        assert abs(sum(shares[c] for c in codes) - rules.BAND_SHARE[band]) < 5
    assert set(shares) == set(rules.TRANSACTION_CODES)


def test_small_fractions_and_weights_are_not_lost(spark):
    rows = spark.range(4_000_000)
    assert 0 < rows.filter(fn.hash_flag("id", 1e-6)).count() < 20
    with pytest.raises(ValueError):
        fn.hash_flag("id", 1e-6, digest=F.col("id"))
    with pytest.raises(ValueError):
        fn.weighted_choice("id", {"a": 1.0, "b": 1e-9}, digest=F.col("id"))
