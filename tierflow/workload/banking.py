"""Queries over the tables of the banking data product.

The source tables hold what customer, nation, region, orders and lineitem say; the SQL
states the same mapping and the same product rules on its own.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.operators import quality
from tierflow.operators.projection import suffix_columns
from tierflow.plans import contracts
from tierflow.plans.gold import METRIC_NAMES, SUMMARY_COLUMNS, atm_behaviour, customer_summary
from tierflow.plans.mapping import balance_rows, customer_facts, master_rows, transaction_rows
from tierflow.plans.pipeline import ingest_bronze, refresh_all, with_ingest_time
from tierflow.plans.silver import (
    customer_dimension,
    enriched_transactions,
    transaction_measures,
)
from tierflow.session import scratch
from tierflow.workload.registry import Tables, query

AS_OF = datetime.date(2001, 8, 1)
FIRST = datetime.datetime(2001, 8, 1, 6, 0, 0)
SECOND = datetime.datetime(2001, 8, 2, 6, 0, 0)
SPLIT = datetime.datetime(1998, 1, 1)


def facts(t: Tables, orders: DataFrame | None = None) -> DataFrame:
    return customer_facts(t.customer, t.nation, t.region, t.orders if orders is None else orders)


def split_date():
    return F.lit(SPLIT).cast("timestamp_ntz")


def first_master(t: Tables) -> DataFrame:
    """The first load: what was known before the split date."""
    return master_rows(facts(t, t.orders.filter(F.col("o_orderdate") < split_date())))


def corrections(t: Tables) -> DataFrame:
    """The second load: the customers that have ordered since."""
    return master_rows(facts(t)).filter(F.col("LSTUPD") >= split_date())


def balances(t: Tables) -> DataFrame:
    return balance_rows(facts(t))


def transactions(t: Tables) -> DataFrame:
    return transaction_rows(t.orders, t.lineitem)


def bronze_master(t: Tables) -> DataFrame:
    first = with_ingest_time(first_master(t), FIRST)
    return first.unionByName(with_ingest_time(corrections(t), SECOND))


def silver_customers(t: Tables) -> DataFrame:
    return customer_dimension(bronze_master(t), with_ingest_time(balances(t), FIRST), AS_OF)


def silver_transactions(t: Tables) -> DataFrame:
    return enriched_transactions(with_ingest_time(transactions(t), FIRST))


# ------------------------------------------------------------------------- SQL

SQL_TYPES = {
    "string": "varchar",
    "bigint": "bigint",
    "double": "double",
    "date": "date",
    "timestamp": "timestamp",
}


def contract_select(contract: str, filled: dict[str, str]) -> str:
    """Select list in contract order; columns without an expression are typed nulls."""
    made = []
    for line in contract.strip().splitlines():
        name, kind, _ = line.split()
        kind = SQL_TYPES[kind.rstrip("!")]
        made.append(f"cast({filled.get(name, 'null')} as {kind}) as {name}")
    return ",\n".join(made)


def expressions(text: str) -> dict[str, str]:
    return dict(line.strip().split(" := ", 1) for line in text.strip().splitlines())


FACTS_SQL = """{name} as (select c.*, n_name, r_name, n_regionkey, last_order, n_orders, spent
  from customer c left join nation on c_nationkey = n_nationkey
  left join region on n_regionkey = r_regionkey
  left join (select o_custkey, cast(max(o_orderdate) as date) as last_order, count(*) as n_orders,
      cast(sum(cast(o_totalprice as decimal(18,2))) as double) as spent
    from orders {where} group by o_custkey) on c.c_custkey = o_custkey)"""
EARLY = "where o_orderdate < timestamp '1998-01-01'"

MASTER_SQL = expressions("""
CUSTID := c_custkey
CUSTNM := c_name
NATNLT := cast(c_nationkey as varchar)
CNTRY := n_name
SGMNT := c_mktsegment
LSTTRX := last_order
LSTUPD := last_order
""")

BALANCE_SQL = expressions("""
CUSTID := c_custkey
SGMNT := c_mktsegment
RGNCD := cast(n_regionkey as varchar)
RGNNM := r_name
AVLBAL := c_acctbal
CURBAL := c_acctbal
TTLDBT := coalesce(spent, 0.0)
TTLTRX := coalesce(n_orders, 0)
LSTTRX := last_order
""")

TRANSACTION_SQL = expressions("""
TRXID := cast(strftime(d, '%Y%m%d') || lpad(cast(o_orderkey as varchar), 9, '0') as bigint)
CUSTID := o_custkey
TRXTYP := code
TRXDSC := descr
CHNLCD := channel
TRXSTS := o_orderstatus
TRXDT := d
TRXTM := o_orderdate
TRXAMT := o_totalprice
ORGAMT := gross
DSCAMT := discount
TAXAMT := tax
NETAMT := net
""")

SOURCES_SQL = f"""{FACTS_SQL.format(name="early", where=EARLY)},
  {FACTS_SQL.format(name="facts", where="")},
  m1 as (select {contract_select(contracts.MASTER, MASTER_SQL)} from early),
  m2 as (select {contract_select(contracts.MASTER, MASTER_SQL)} from facts
    where last_order >= date '1998-01-01'),
  b1 as (select {contract_select(contracts.BALANCES, BALANCE_SQL)} from facts)"""

TRANSACTIONS_SQL = f"""codes(priority, code, descr, channel) as (values
    ('1-URGENT', 'CATM', 'Credito por ATM', 'ATM'), ('2-HIGH', 'DATM', 'Debito por ATM', 'ATM'),
    ('3-MEDIUM', 'CMPR', 'Compra POS', 'POS'),
    ('4-NOT SPECIFIED', 'TINT', 'Transferencia Interna', 'WEB'),
    ('5-LOW', 'PGSL', 'Pago al Saldo', 'WEB')),
  exact_lines as (select l_orderkey, cast(l_extendedprice as decimal(18,2)) as price,
      cast(l_discount as decimal(18,2)) as off, cast(l_tax as decimal(18,2)) as rate from lineitem),
  charges as (select l_orderkey, cast(sum(price) as double) as gross,
      cast(sum(price * off) as double) as discount, cast(sum(price * rate) as double) as tax,
      cast(sum(price * (1 - off)) as double) as net from exact_lines group by l_orderkey),
  settled as (select *, cast(o_orderdate as date) as d from orders
    left join charges on o_orderkey = l_orderkey left join codes on o_orderpriority = priority),
  t1 as (select {contract_select(contracts.TRANSACTIONS, TRANSACTION_SQL)} from settled)"""


def renamed_select(contract: str, side: str, skip: tuple[str, ...] = ()) -> str:
    lines = [line.split() for line in contract.strip().splitlines()]
    return ", ".join(f"{side}.{a} as {b}" for a, _, b in lines if b != "-" and a not in skip)


SILVER_CUSTOMERS_SQL = f"""{SOURCES_SQL},
  bronze as (select *, timestamp '2001-08-01 06:00:00' as came from m1
    union all by name select *, timestamp '2001-08-02 06:00:00' as came from m2),
  newest as (select * exclude (rn) from (select *, row_number() over (
      partition by CUSTID order by came desc, LSTUPD desc) as rn from bronze) where rn = 1),
  wide as (select {renamed_select(contracts.MASTER, "c")}, c.came as fecha_ingesta_maestro,
      {renamed_select(contracts.BALANCES, "b")},
      case when b.CUSTID is not null then timestamp '2001-08-01 06:00:00' end as fecha_ingesta_saldo
    from newest c left join b1 b on c.CUSTID = b.CUSTID),
  customers as (select *,
    case when nivel_riesgo_cliente in ('04', '05') and puntaje_crediticio < 500
        and estado_mora = 'SI' then 'RIESGO_CRITICO'
      when nivel_riesgo_cliente in ('03', '04', '05') and puntaje_crediticio < 600
        and estado_mora = 'SI' then 'RIESGO_ALTO'
      when nivel_riesgo_cliente in ('03', '04', '05')
        or (puntaje_crediticio < 650 and estado_mora = 'SI') then 'RIESGO_MEDIO'
      when nivel_riesgo_cliente = '02' or puntaje_crediticio < 700 then 'RIESGO_BAJO'
      else 'SIN_RIESGO' end as clasificacion_riesgo_cliente,
    case when saldo_disponible >= 200000 and limite_credito >= 100000
        and segmento_cliente = 'VIP' then 'SALDO_PREMIUM'
      when saldo_disponible >= 100000 and limite_credito >= 50000
        and segmento_cliente in ('VIP', 'PREM') then 'SALDO_ALTO'
      when saldo_disponible >= 25000 and limite_credito >= 10000 then 'SALDO_MEDIO'
      when saldo_disponible >= 5000 or (limite_credito >= 5000
        and segmento_cliente in ('STD', 'BAS')) then 'SALDO_BAJO'
      else 'SALDO_CRITICO' end as categoria_saldo_disponible,
    case when idle <= 30 and total_productos_contratados >= 8
        and estado_cuenta_cliente = 'AC' then 'CLIENTE_INTEGRAL'
      when idle <= 90 and total_productos_contratados >= 5
        and estado_cuenta_cliente = 'AC' then 'ACTIVIDAD_ALTA'
      when idle <= 180 and total_productos_contratados >= 3
        and estado_cuenta_cliente = 'AC' then 'ACTIVIDAD_MEDIA'
      when idle <= 365 and total_productos_contratados >= 1
        and estado_cuenta_cliente in ('AC', 'IN') then 'ACTIVIDAD_BAJA'
      else 'INACTIVO' end as perfil_actividad_bancaria,
    sha256(cast(identificador_cliente as varchar)) as huella_identificacion_cliente
    from (select *, date_diff('day', fecha_ultima_transaccion, date '2001-08-01') as idle from wide))"""

SILVER_TRANSACTIONS_SQL = f"""{TRANSACTIONS_SQL},
  named as (select {renamed_select(contracts.TRANSACTIONS, "t")},
      timestamp '2001-08-01 06:00:00' as fecha_ingesta_datos from t1 t),
  enriched as (select *,
    coalesce(monto_neto, 0) - (coalesce(monto_comision, 0) + coalesce(monto_impuesto, 0))
      as monto_neto_comisiones,
    case when monto_original is null or monto_original = 0 then 0.0
      else coalesce(monto_comision, 0) / monto_original * 100 end as porcentaje_comision_sobre_monto,
    abs(coalesce(saldo_despues_transaccion, 0) - coalesce(saldo_antes_transaccion, 0))
      as variacion_saldo_transaccion,
    coalesce(monto_transaccion, 0) + coalesce(monto_comision, 0) + coalesce(monto_impuesto, 0)
      + coalesce(monto_penalidad, 0) as indicador_impacto_financiero from named)"""

ATM_SQL = f"""{SILVER_TRANSACTIONS_SQL},
  behaviour as (select identificador_cliente,
    count(*) filter (where tipo_transaccion = 'CATM') as cantidad_depositos_atm,
    count(*) filter (where tipo_transaccion = 'DATM') as cantidad_retiros_atm,
    coalesce(cast(sum(cast(monto_transaccion as decimal(18,2)))
      filter (where tipo_transaccion = 'CATM') as double)
      / nullif(count(*) filter (where tipo_transaccion = 'CATM'), 0), 0.0)
      as promedio_monto_depositos_atm,
    coalesce(cast(sum(cast(monto_transaccion as decimal(18,2)))
      filter (where tipo_transaccion = 'DATM') as double)
      / nullif(count(*) filter (where tipo_transaccion = 'DATM'), 0), 0.0)
      as promedio_monto_retiros_atm,
    coalesce(cast(sum(cast(monto_transaccion as decimal(18,2)))
      filter (where tipo_transaccion = 'PGSL') as double), 0.0) as total_pagos_saldo_cliente
    from enriched where identificador_cliente is not null group by identificador_cliente)"""

SUMMARY_SQL = f"""with {SILVER_CUSTOMERS_SQL}, {ATM_SQL}
  select {", ".join("c." + name for name in SUMMARY_COLUMNS)},
    coalesce(cantidad_depositos_atm, 0) as cantidad_depositos_atm,
    coalesce(cantidad_retiros_atm, 0) as cantidad_retiros_atm,
    coalesce(promedio_monto_depositos_atm, 0.0) as promedio_monto_depositos_atm,
    coalesce(promedio_monto_retiros_atm, 0.0) as promedio_monto_retiros_atm,
    coalesce(total_pagos_saldo_cliente, 0.0) as total_pagos_saldo_cliente
  from customers c left join behaviour a on c.identificador_cliente = a.identificador_cliente"""


# --------------------------------------------------------------------- queries


@query(f"with {SILVER_CUSTOMERS_SQL} select * exclude (idle) from customers")
def bank_customers_silver(t: Tables):
    return silver_customers(t)


@query(f"with {SILVER_TRANSACTIONS_SQL} select * from enriched")
def bank_transactions_silver(t: Tables):
    return silver_transactions(t)


@query(f"with {ATM_SQL} select * from behaviour")
def gold_atm_behaviour(t: Tables):
    return atm_behaviour(silver_transactions(t), money_scale=2)


@query(SUMMARY_SQL)
def gold_customer_summary(t: Tables):
    behaviour = atm_behaviour(silver_transactions(t), money_scale=2)
    return customer_summary(silver_customers(t), behaviour)


@query(SUMMARY_SQL)
def bank_product_end_to_end(t: Tables):
    """Land two loads, ingest each, refresh silver and gold, and read the summary."""
    root = scratch(t.spark, "bank")
    landing = {name: f"{root}/landing/{name}" for name in ("cmstfl", "trxpfl", "blncfl")}
    first_master(t).write.parquet(f"{landing['cmstfl']}/2001/08/01")
    balances(t).write.parquet(f"{landing['blncfl']}/2001/08/01")
    transactions(t).write.parquet(f"{landing['trxpfl']}/2001/08/01")
    ingest_bronze(t.spark, landing, root, FIRST)
    corrections(t).write.parquet(f"{landing['cmstfl']}/2001/08/02")
    ingest_bronze(t.spark, landing, root, SECOND)
    return refresh_all(t.spark, root, AS_OF, money_scale=2)["resumen_integral_cliente"]


@query(
    f"""with {SILVER_TRANSACTIONS_SQL}, n as (select count(*) as n,
      count(*) filter (where identificador_transaccion % 97 = 0) as odd,
      count(*) filter (where identificador_transaccion % 89 = 0) as lost from enriched)
    select unnest(['monto_neto_comisiones', 'porcentaje_comision_sobre_monto',
        'variacion_saldo_transaccion', 'indicador_impacto_financiero']) as column_name,
      unnest([n, n, n, n]) as n_rows, unnest([odd, 0, 0, lost]) as n_breaks,
      unnest([odd = 0, true, true, lost = 0]) as ok from n"""
)
def bank_formula_recheck(t: Tables):
    """Breaks are planted in two measures: a wrong amount and a lost one."""
    key = F.col("identificador_transaccion")
    net, impact = F.col("monto_neto_comisiones"), F.col("indicador_impacto_financiero")
    stored = silver_transactions(t).withColumns(
        {
            "monto_neto_comisiones": F.when(key % 97 == 0, net + 1).otherwise(net),
            "indicador_impacto_financiero": F.when(key % 89 != 0, impact),
        }
    )
    return quality.formula_breaks(stored, transaction_measures())


@query(
    f"""with {ATM_SQL}, n as (select count(*) as n,
      count(*) filter (where identificador_cliente % 50 = 0) as odd from behaviour)
    select unnest(['identificador_cliente', {", ".join(f"'{name}'" for name in METRIC_NAMES)}])
        as column_name, n as n_keys, unnest([0, odd, 0, 0, 0, 0]) as n_breaks,
      unnest([true, odd = 0, true, true, true, true]) as ok from n"""
)
def bank_gold_reconciliation(t: Tables):
    """The five metrics of every customer, recomputed from silver; some counts are off."""
    silver = silver_transactions(t)
    count = F.col("cantidad_depositos_atm")
    off = (F.col("identificador_cliente") % 50 == 0).cast("bigint")
    gold = atm_behaviour(silver).withColumn("cantidad_depositos_atm", count + off)
    amount = F.coalesce("monto_transaccion", F.lit(0.0))
    kind = F.col("tipo_transaccion")
    per_kind = silver.groupBy("identificador_cliente").pivot(
        "tipo_transaccion", ["CATM", "DATM", "PGSL"]
    ).agg(F.count(kind).alias("n"), F.avg(amount).alias("mean"), F.sum(amount).alias("total"))
    again = per_kind.select(
        "identificador_cliente",
        F.coalesce("CATM_n", F.lit(0)).alias("cantidad_depositos_atm"),
        F.coalesce("DATM_n", F.lit(0)).alias("cantidad_retiros_atm"),
        F.coalesce("CATM_mean", F.lit(0.0)).alias("promedio_monto_depositos_atm"),
        F.coalesce("DATM_mean", F.lit(0.0)).alias("promedio_monto_retiros_atm"),
        F.coalesce("PGSL_total", F.lit(0.0)).alias("total_pagos_saldo_cliente"),
    )
    return quality.reconcile(gold, again, "identificador_cliente", METRIC_NAMES, 0.01)


@query(
    f"""with {SILVER_CUSTOMERS_SQL}
    select identificador_cliente, nombre_completo_cliente as nombre_completo_cliente_plata,
      segmento_cliente as segmento_cliente_plata from customers"""
)
def bank_suffixed_attributes(t: Tables):
    narrow = silver_customers(t).select(
        "identificador_cliente", "nombre_completo_cliente", "segmento_cliente"
    )
    return suffix_columns(narrow, "_plata", keep=["identificador_cliente"])
