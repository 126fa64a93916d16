"""Gold layer: ATM behaviour per customer and the customer summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierflow.operators.aggregate import Metric, conditional_aggs
from tierflow.operators.joins import left_join_fill
from tierflow.operators.projection import lead_with
from tierflow.operators.quality import expect
from tierflow.plans import contracts
from tierflow.streaming.deltas import DeltaView

# Metric name, aggregate and transaction code.
ATM_METRICS = """
cantidad_depositos_atm count CATM
cantidad_retiros_atm count DATM
promedio_monto_depositos_atm avg CATM
promedio_monto_retiros_atm avg DATM
total_pagos_saldo_cliente sum PGSL
"""
METRIC_NAMES = [line.split()[0] for line in ATM_METRICS.strip().splitlines()]

# Dimension columns of the summary.
SUMMARY_COLUMNS = """
huella_identificacion_cliente identificador_cliente nombre_completo_cliente
tipo_documento_identidad numero_documento_identidad segmento_cliente categoria_cliente
ciudad_residencia pais_residencia clasificacion_riesgo_cliente categoria_saldo_disponible
perfil_actividad_bancaria saldo_disponible saldo_actual limite_credito puntaje_crediticio
ingreso_anual_declarado
""".split()


def atm_metrics(money_scale: int | None = None) -> list[Metric]:
    """The five metrics; with `money_scale` amounts are added exactly, as decimals."""
    lines = [line.split() for line in ATM_METRICS.strip().splitlines()]
    return [
        Metric(name, kind, F.col("tipo_transaccion") == code, "monto_transaccion", money_scale)
        for name, kind, code in lines
    ]


def atm_behaviour(
    transactions: DataFrame, money_scale: int | None = None, dropped: Observation | None = None
) -> DataFrame:
    """One row per customer found in the transactions; the null customer is dropped.

    With an observation, dropped rows are counted.
    """
    keys = ["identificador_cliente"]
    return identified_behaviour(conditional_aggs(transactions, keys, atm_metrics(money_scale)), dropped)


def identified_behaviour(grouped: DataFrame, dropped: Observation | None = None) -> DataFrame:
    """Metrics per customer without the null customer."""
    return lead_with(
        expect(
            grouped, "cliente_identificado", "identificador_cliente IS NOT NULL", observation=dropped
        ),
        contracts.CLUSTERING["comportamiento_atm_cliente"],
    )


def behaviour_view(spark: SparkSession, root: str, money_scale: int | None = None) -> DeltaView:
    """The same metrics kept by deltas."""
    return DeltaView(spark, root, ["identificador_cliente"], atm_metrics(money_scale))


def customer_summary(customers: DataFrame, behaviour: DataFrame) -> DataFrame:
    """Every customer with 17 attributes and the five metrics, 0 where there are none."""
    fills = {m.name: 0 if m.kind == "count" else 0.0 for m in atm_metrics()}
    joined = left_join_fill(
        customers.select(*SUMMARY_COLUMNS), behaviour, "identificador_cliente", fills
    )
    return lead_with(joined, contracts.CLUSTERING["resumen_integral_cliente"])
