"""The seven tables of the banking product, from landing folders to gold.

Each table is one function call on the tables before it; refreshed tables are written
as versions and read back, so no stage recomputes an earlier one.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierflow.plans import contracts
from tierflow.plans.gold import (
    atm_behaviour,
    behaviour_view,
    customer_summary,
    identified_behaviour,
)
from tierflow.plans.silver import customer_dimension, enriched_transactions
from tierflow.session import join_path
from tierflow.sources import storage
from tierflow.sources.sinks import cluster_rows, current_view, ranges_for, refresh_view
from tierflow.streaming.ingest import committed_batches, read_ingested, start_ingest
from tierflow.streaming.tables import for_each_batch

BRONZE = ("cmstfl", "trxpfl", "blncfl")


def ingest_bronze(
    spark: SparkSession,
    landing: dict[str, str],
    root: str,
    ingested_at: datetime.datetime | None = None,
) -> None:
    """Append the files that arrived in the three landing folders, side by side."""
    running = [
        start_ingest(
            spark,
            landing[name],
            join_path(root, "bronze", name),
            join_path(root, "checkpoints", name),
            lead=contracts.CLUSTERING[name],
            ingested_at=ingested_at,
        )
        for name in BRONZE
    ]
    for query in running:
        query.awaitTermination()


def bronze_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    lead = contracts.CLUSTERING[name]
    return read_ingested(spark, join_path(root, "bronze", name), lead=lead)


def _refresh(
    df: DataFrame, root: str, layer: str, name: str, salt: list[str], files: int | None = None
) -> DataFrame:
    clustered = cluster_rows(df, contracts.CLUSTERING[name], files, salt)
    path = join_path(root, layer, name)
    refresh_view(clustered, path)
    return current_view(df.sparkSession, path)


FACTS = "transacciones_enriquecidas"


def refresh_facts(spark: SparkSession, root: str, file_bytes: int = 256 << 20) -> tuple[DataFrame, int]:
    """Enrich the bronze transactions that arrived since the last refresh.

    The bronze table is read as a stream of its landed batches. Each becomes one
    clustered batch of the fact table, in a folder of the same number. A finished one is never written
    again and an unfinished one is replaced, so each transaction is there exactly
    once, however often the refresh is repeated. Returns the whole fact table and the number
    of batches written now.
    """
    bronze, facts = join_path(root, "bronze", "trxpfl"), join_path(root, "silver", FACTS)
    written = []

    def enrich(rows: DataFrame, landed: list[int], _: int) -> None:
        own = rows.sparkSession
        for n in landed:
            if storage.is_complete(own, f"{facts}/batch_id={n}"):
                continue
            arrived = read_ingested(own, bronze, batches=[n])
            made = enriched_transactions(arrived)
            size = _bytes(own, f"{bronze}/flow=main/batch_id={n}")
            files = ranges_for(arrived.count(), len(made.columns), size, file_bytes)
            clustered = cluster_rows(made, contracts.CLUSTERING[FACTS], files, ["identificador_transaccion"])
            clustered.write.mode("overwrite").parquet(f"{facts}/batch_id={n}")
            written.append(n)

    for_each_batch(spark, bronze, join_path(root, "checkpoints", FACTS), enrich)
    landed = committed_batches(spark, bronze)
    if not landed:
        return enriched_transactions(bronze_table(spark, root, "trxpfl")), 0
    return fact_batches(spark, root, landed), len(written)


def fact_batches(spark: SparkSession, root: str, numbers: Sequence[int]) -> DataFrame:
    """The fact rows of some landed batches."""
    bronze, facts = join_path(root, "bronze", "trxpfl"), join_path(root, "silver", FACTS)
    layout = enriched_transactions(read_ingested(spark, bronze, batches=[max(numbers)])).schema
    return spark.read.schema(layout).parquet(*[f"{facts}/batch_id={n}" for n in numbers])


def refresh_behaviour(
    spark: SparkSession, root: str, money_scale: int | None = None, dropped: Observation | None = None
) -> tuple[DataFrame, list[int]]:
    """Bring the ATM view forward by the fact batches it does not hold yet.

    Only these batches are read; the view is finished from the states of all. Returns the view
    and the batches added now.
    """
    name = f"comportamiento_atm_cliente-{'double' if money_scale is None else money_scale}"
    view = behaviour_view(spark, join_path(root, "gold", "_states", name), money_scale)
    through = view.through()
    done = storage.committed(spark, join_path(root, "silver", FACTS), "batch_id")
    fresh = [n for n in done if through is None or n > through]
    for n in fresh:
        view.apply(n, fact_batches(spark, root, [n]))
    rows = view.rows()
    if rows is None:
        empty = enriched_transactions(bronze_table(spark, root, "trxpfl"))
        return atm_behaviour(empty, money_scale, dropped), []
    return identified_behaviour(rows, dropped), fresh


def refresh_all(
    spark: SparkSession,
    root: str,
    as_of: datetime.date | None = None,
    money_scale: int | None = None,
    file_bytes: int = 256 << 20,
    report: dict[str, int] | None = None,
) -> dict[str, DataFrame]:
    """Bring silver and gold up to date with bronze; returns the four tables.

    The fact table and the ATM view take only the batches that are new; the dimension and the
    gold views are written as new versions. The number of files follows from the size and the number of rows of the inputs.
    `report`, if given, is filled with the rows dropped by each expectation and the fact
    batches written.
    """
    people, activity = Observation(), Observation()
    bronze = {name: bronze_table(spark, root, name) for name in ("cmstfl", "blncfl")}
    size = sum(_bytes(spark, join_path(root, "bronze", name)) for name in bronze)
    customers = _refresh(
        customer_dimension(bronze["cmstfl"], bronze["blncfl"], as_of, people),
        root, "silver", "clientes_saldos_consolidados", ["identificador_cliente"],
        ranges_for(bronze["cmstfl"].count(), sum(len(b.columns) for b in bronze.values()), size, file_bytes),
    )
    transactions, written = refresh_facts(spark, root, file_bytes)
    behaviour = _refresh(
        refresh_behaviour(spark, root, money_scale, activity)[0],
        root, "gold", "comportamiento_atm_cliente", ["identificador_cliente"],
    )
    summary = _refresh(
        customer_summary(customers, behaviour),
        root, "gold", "resumen_integral_cliente", ["identificador_cliente"],
    )
    if report is not None:
        report["clientes_saldos_consolidados"] = people.get["n_violations"]
        report["comportamiento_atm_cliente"] = activity.get["n_violations"]
        report["fact_batches_written"] = written
    return {
        "clientes_saldos_consolidados": customers,
        "transacciones_enriquecidas": transactions,
        "comportamiento_atm_cliente": behaviour,
        "resumen_integral_cliente": summary,
    }


def _bytes(spark: SparkSession, path: str) -> int:
    return storage.total_bytes(spark, path) if storage.exists(spark, path) else 0


def with_ingest_time(df: DataFrame, at: datetime.datetime) -> DataFrame:
    return df.withColumn("FechaIngestaDatos", F.lit(at))
