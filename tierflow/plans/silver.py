"""Silver layer: the customer dimension and the enriched transactions."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tierflow.functions import fingerprint, gap, net_of, pct_of, total
from tierflow.operators.joins import dim_left_join
from tierflow.operators.latest import latest_by_key
from tierflow.operators.projection import lead_with, rename_select, select_except
from tierflow.operators.quality import expect
from tierflow.plans import contracts, rules


def customer_classes(as_of: datetime.date | None = None) -> dict[str, Column]:
    """The derived columns of the customer dimension, on its descriptive names.

    Days without a transaction count up to `as_of`, or to the current date.
    """
    day = "current_date()" if as_of is None else f"DATE '{as_of.isoformat()}'"
    return {
        "clasificacion_riesgo_cliente": rules.RISK.bind(
            level="nivel_riesgo_cliente", score="puntaje_crediticio", arrears="estado_mora"
        ),
        "categoria_saldo_disponible": rules.BALANCE.bind(
            available="saldo_disponible", limit="limite_credito", segment="segmento_cliente"
        ),
        "perfil_actividad_bancaria": rules.ACTIVITY.bind(
            days=f"datediff({day}, fecha_ultima_transaccion)",
            products="total_productos_contratados",
            state="estado_cuenta_cliente",
        ),
        "huella_identificacion_cliente": fingerprint("identificador_cliente"),
    }


def customer_dimension(
    master: DataFrame,
    balances: DataFrame,
    as_of: datetime.date | None = None,
    dropped: Observation | None = None,
) -> DataFrame:
    """Newest master row per customer with its newest balance row, classified.

    Both sides are renamed first, so the join has no name collisions. Rows of one
    ingest share their timestamp: the record's own update date decides between them,
    then the other columns, so that the choice does not depend on the file order. (They
    are plain sort columns: a hash over all of them would multiply the optimizer's
    alias constraints when they are renamed.) With an observation, dropped rows are counted.
    """
    people = _newest(master, contracts.MASTER, "LSTUPD", "master")
    accounts = _newest(balances, contracts.BALANCES, "UPDDT", "balances", keep_key="_account_key")
    joined = dim_left_join(people, accounts, "identificador_cliente", "_account_key")
    wide = joined.withColumns(customer_classes(as_of))
    checked = expect(wide, "cliente_identificado", "identificador_cliente IS NOT NULL", observation=dropped)
    return lead_with(checked, contracts.CLUSTERING["clientes_saldos_consolidados"])


def _newest(
    bronze: DataFrame, contract: str, updated: str, source: str, keep_key: str | None = None
) -> DataFrame:
    rows = select_except(bronze)
    rest = [c for c in rows.columns if c not in ("CUSTID", "FechaIngestaDatos", updated)]
    tie = [updated, *rest]
    newest = latest_by_key(rows, ["CUSTID"], ["FechaIngestaDatos"], tie)
    names = contracts.renames(contract, contracts.INGESTED_AS[source])
    return rename_select(newest, {"CUSTID": keep_key, **names} if keep_key else names)


def transaction_measures() -> dict[str, Column]:
    """The derived measures of a transaction, on its descriptive names.

    The net amount already excludes fee and tax; the first measure deducts them from
    it once more, as the product defines it.
    """
    return {
        "monto_neto_comisiones": net_of("monto_neto", "monto_comision", "monto_impuesto"),
        "porcentaje_comision_sobre_monto": pct_of("monto_comision", "monto_original"),
        "variacion_saldo_transaccion": gap("saldo_despues_transaccion", "saldo_antes_transaccion"),
        "indicador_impacto_financiero": total(
            "monto_transaccion", "monto_comision", "monto_impuesto", "monto_penalidad"
        ),
    }


def enriched_transactions(transactions: DataFrame) -> DataFrame:
    """Renamed transactions with four measures; row-local, so it also runs on a stream."""
    names = contracts.renames(contracts.TRANSACTIONS, contracts.INGESTED_AS["transactions"])
    renamed = rename_select(select_except(transactions), names)
    return lead_with(
        renamed.withColumns(transaction_measures()),
        contracts.CLUSTERING["transacciones_enriquecidas"],
    )
