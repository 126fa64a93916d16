"""Queries over the relational and scalar operators."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tierflow.functions import (
    Ladder,
    add_days_if,
    age_years,
    dated_sequence_id,
    fingerprint,
    first_part,
    gap,
    hash_sample,
    join_text,
    last_part,
    mailbox,
    net_of,
    padded_key,
    parse_day,
    pct_of,
    signed_movement,
    total,
    weighted_choice,
    when_type,
)
from tierflow.operators.aggregate import (
    Metric,
    band_shares,
    conditional_aggs,
    group_counts,
    range_by_category,
    table_stats,
    top_groups,
)
from tierflow.operators.batches import map_batches
from tierflow.operators.changes import table_changes
from tierflow.operators.joins import (
    anti_keys,
    assign_key,
    code_table,
    dim_left_join,
    has_only,
    left_join_fill,
    lookup,
    qualified_join,
)
from tierflow.operators.keys import continue_key, row_sequence
from tierflow.operators.latest import latest_by_key, latest_by_key_agg, scd2_history
from tierflow.operators.projection import lead_with, rename_select, select_except, suffix_columns
from tierflow.operators.sets import set_except, union_all_by_name
from tierflow.operators.snapshot import evolve_snapshot, grow_snapshot, snapshot_drift
from tierflow.plans import rules
from tierflow.workload.registry import Tables, query

AS_OF = datetime.date(2001, 8, 1)
KIND = "o_orderpriority"


def order_metrics(prefix: str = "") -> list[Metric]:
    kind = F.col(KIND)
    return [
        Metric(f"{prefix}n_deposits", "count", kind == "1-URGENT"),
        Metric(f"{prefix}n_withdrawals", "count", kind == "2-HIGH"),
        Metric(f"{prefix}avg_deposit", "avg", kind == "1-URGENT", "o_totalprice", 2),
        Metric(f"{prefix}avg_withdrawal", "avg", kind == "2-HIGH", "o_totalprice", 2),
        Metric(f"{prefix}paid", "sum", kind == "5-LOW", "o_totalprice", 2),
    ]


ORDER_METRICS_SQL = """
  count(*) filter (where o_orderpriority = '1-URGENT') as n_deposits,
  count(*) filter (where o_orderpriority = '2-HIGH') as n_withdrawals,
  coalesce(cast(sum(case when o_orderpriority = '1-URGENT'
      then cast(coalesce(o_totalprice, 0) as decimal(18,2)) end) as double)
    / nullif(count(*) filter (where o_orderpriority = '1-URGENT'), 0), 0.0) as avg_deposit,
  coalesce(cast(sum(case when o_orderpriority = '2-HIGH'
      then cast(coalesce(o_totalprice, 0) as decimal(18,2)) end) as double)
    / nullif(count(*) filter (where o_orderpriority = '2-HIGH'), 0), 0.0) as avg_withdrawal,
  coalesce(cast(sum(case when o_orderpriority = '5-LOW'
      then cast(coalesce(o_totalprice, 0) as decimal(18,2)) end) as double), 0.0) as paid
"""


# ---------------------------------------------------------------- aggregation


@query(f"select o_custkey, {ORDER_METRICS_SQL} from orders group by o_custkey")
def cond_agg(t: Tables):
    return conditional_aggs(t.orders, ["o_custkey"], order_metrics())


@query(
    f"""with o as (select * replace (nullif(o_custkey, 7) as o_custkey) from orders)
    select o_custkey, {ORDER_METRICS_SQL} from o where o_custkey is not null
    group by o_custkey"""
)
def cond_agg_null_key(t: Tables):
    orders = t.orders.withColumn("o_custkey", F.nullif("o_custkey", F.lit(7)))
    grouped = conditional_aggs(orders, ["o_custkey"], order_metrics())
    return grouped.filter(F.col("o_custkey").isNotNull())


@query("select l_returnflag, l_linestatus, count(*) as n_rows from lineitem group by all")
def group_count(t: Tables):
    return group_counts(t.lineitem, ["l_returnflag", "l_linestatus"])


@query(
    """select l_partkey, count(*) as n_rows from lineitem group by l_partkey
    order by n_rows desc, l_partkey limit 10"""
)
def top_k_keys(t: Tables):
    return top_groups(t.lineitem, ["l_partkey"], 10)


@query(
    """select event_type, min(value) as min_value, max(value) as max_value,
      count(*) as n_rows from events group by event_type"""
)
def range_by_category_stats(t: Tables):
    return range_by_category(t.events, "event_type", "value")


@query(
    """with b as (select case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'ALTA'
        when o_orderpriority in ('3-MEDIUM') then 'MEDIA' else 'OTHER' end as band from orders)
    select band, count(*) as n_rows,
      count(*) * 100 / sum(count(*)) over () as share_pct from b group by band"""
)
def distribution_bands(t: Tables):
    return band_shares(t.orders, KIND, {"ALTA": ["1-URGENT", "2-HIGH"], "MEDIA": ["3-MEDIUM"]})


@query(
    """select count(*) as n_rows, min(l_quantity) as l_quantity_min,
      max(l_quantity) as l_quantity_max, min(l_quantity) = max(l_quantity) as l_quantity_constant,
      min(l_orderkey) as l_orderkey_min, max(l_orderkey) as l_orderkey_max,
      min(l_orderkey) = max(l_orderkey) as l_orderkey_constant from lineitem"""
)
def global_stats(t: Tables):
    return table_stats(t.lineitem, ["l_quantity", "l_orderkey"])


@query(
    """select coalesce(cast(sum(cast(o_totalprice as decimal(18,2))) as double)
        / nullif(count(*), 0), 0.0) as avg_deposit
    from orders where o_custkey = 899 and o_orderpriority = '1-URGENT'"""
)
def point_aggregate(t: Tables):
    one = t.orders.filter((F.col("o_custkey") == 899) & (F.col(KIND) == "1-URGENT"))
    return one.agg(Metric("avg_deposit", "avg", F.lit(True), "o_totalprice", 2).column())


# ----------------------------------------------------------------------- joins


@query(
    f"""with m as (select o_custkey as c_custkey, {ORDER_METRICS_SQL} from orders
      group by o_custkey)
    select c.c_custkey, c_name, c_mktsegment, coalesce(n_deposits, 0) as n_deposits,
      coalesce(n_withdrawals, 0) as n_withdrawals, coalesce(avg_deposit, 0.0) as avg_deposit,
      coalesce(avg_withdrawal, 0.0) as avg_withdrawal, coalesce(paid, 0.0) as paid
    from customer c left join m on c.c_custkey = m.c_custkey"""
)
def left_join_zero_fill(t: Tables):
    metrics = order_metrics()
    measured = conditional_aggs(
        t.orders.withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"], metrics
    )
    fills = {m.name: 0 if m.kind == "count" else 0.0 for m in metrics}
    return left_join_fill(
        t.customer.select("c_custkey", "c_name", "c_mktsegment"), measured, "c_custkey", fills
    )


def latest_order(t: Tables):
    return latest_by_key(t.orders, ["o_custkey"], ["o_orderdate"], ["o_orderkey"])


LATEST_ORDER_SQL = """latest as (select * exclude (rn) from (select *, row_number() over (
    partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn
    from orders {where}) where rn = 1)"""
LATEST_SQL = LATEST_ORDER_SQL.format(where="")
LATEST_URGENT_SQL = LATEST_ORDER_SQL.format(where="where o_orderpriority = '1-URGENT'")


@query(
    """select d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
    from documents d left join labels l on d.doc_id = l.doc_id""",
    name="dim_left_join",
)
def documents_with_labels(t: Tables):
    labels = t.labels.withColumnRenamed("doc_id", "label_id")
    return dim_left_join(
        t.documents.select("doc_id", "lang", "source", "n_chars"), labels, "doc_id", "label_id"
    )


@query(
    f"""with {LATEST_SQL}
    select c_custkey as id, c_name as name_customer, c_acctbal as amount_customer, o_orderkey,
      o_orderpriority as name_order, o_totalprice as amount_order
    from customer left join latest on c_custkey = o_custkey"""
)
def join_qualified_rename(t: Tables):
    people = rename_select(
        t.customer, {"c_custkey": "id", "c_name": "name", "c_acctbal": "amount"}
    )
    orders = rename_select(
        latest_order(t),
        {"o_custkey": "id", "o_orderkey": "o_orderkey", KIND: "name", "o_totalprice": "amount"},
    )
    return qualified_join(people, orders, "id", "_customer", "_order")


@query(
    """select doc_id as key, count(*) as n_rows from documents
    where doc_id not in (select doc_id from labels) group by doc_id"""
)
def orphan_keys(t: Tables):
    return anti_keys(t.documents, t.labels, "doc_id", "doc_id")


@query(
    """select o_custkey, count(*) filter (where o_orderpriority = '1-URGENT') as n_rows from orders
    group by o_custkey having count(*) filter (where o_orderpriority = '1-URGENT') > 0
      and count(*) filter (where o_orderpriority = '2-HIGH') = 0"""
)
def only_type_a(t: Tables):
    return has_only(t.orders, ["o_custkey"], KIND, "1-URGENT", "2-HIGH")


@query(
    """with codes(o_orderpriority, label, channel, low, high) as (values
        ('1-URGENT', 'Deposito', 'ATM', 10, 1000), ('2-HIGH', 'Retiro', 'SUC', 50, 100000),
        ('5-LOW', 'Pago', 'ACH', 100, 25000))
    select o_orderkey, o.o_orderpriority, label, coalesce(channel, 'WEB') as channel,
      cast(low as bigint) as low, cast(high as bigint) as high
    from orders o left join codes c on o.o_orderpriority = c.o_orderpriority""",
    name="lookup_broadcast",
)
def lookup_codes(t: Tables):
    codes = code_table(
        t.spark,
        {
            "1-URGENT": ("Deposito", "ATM", 10, 1000),
            "2-HIGH": ("Retiro", "SUC", 50, 100000),
            "5-LOW": ("Pago", "ACH", 100, 25000),
        },
        f"{KIND} string, label string, channel string, low bigint, high bigint",
    )
    return lookup(t.orders.select("o_orderkey", KIND), codes, KIND, {"channel": "WEB"})


@query(
    """with idx as (select c_custkey, row_number() over (
        order by c_custkey % 64, c_custkey) - 1 as slot from customer),
      n as (select count(*) as n from customer)
    select o_orderkey, c_custkey from orders join idx
      on slot = (o_orderkey * 7919) % (select n from n)"""
)
def hash_assign_fk(t: Tables):
    return assign_key(
        t.orders.select("o_orderkey"), "o_orderkey", t.customer, "c_custkey",
        digest=F.col("o_orderkey") * 7919, buckets=64, dim_bucket=F.col("c_custkey"),
    )


# ---------------------------------------------------------------------- windows

LATEST_EVENT_SQL = """select * exclude (rn) from (select *, row_number() over (
    partition by user_id order by ts desc, event_id desc) as rn from events) where rn = 1"""


@query(LATEST_EVENT_SQL, name="latest_by_key")
def latest_event(t: Tables):
    return latest_by_key(t.events, ["user_id"], ["ts"], ["event_id"])


@query(LATEST_EVENT_SQL, name="latest_by_key_agg")
def latest_event_agg(t: Tables):
    return latest_by_key_agg(t.events, ["user_id"], ["ts"], ["event_id"])


@query(
    """select *, ts as valid_from,
      lead(ts) over (partition by user_id order by ts, event_id) as valid_to from events""",
    name="scd2_history",
)
def event_history(t: Tables):
    return scd2_history(
        t.events, ["user_id"], "ts", ["event_id"], start="valid_from", end="valid_to"
    )


@query(
    """select *, ts as valid_from,
      lead(ts) over (partition by event_type order by ts, event_id) as valid_to from events"""
)
def scd2_heavy_keys(t: Tables):
    """A handful of keys hold all rows: each is spread over ranges."""
    return scd2_history(
        t.events, ["event_type"], "ts", ["event_id"], start="valid_from", end="valid_to",
        heavy_rows=1000,
    )


# ------------------------------------------------------------------ projections


@query("select * exclude (props) from events", name="select_except")
def select_except_columns(t: Tables):
    return select_except(t.events, ["props", "no_such_column"])


@query(
    """select l_orderkey as pedido, l_linenumber as linea, l_quantity as cantidad,
      l_extendedprice as importe, l_shipdate as fecha_envio from lineitem"""
)
def bulk_rename(t: Tables):
    return rename_select(
        t.lineitem,
        {
            "l_orderkey": "pedido",
            "l_linenumber": "linea",
            "l_quantity": "cantidad",
            "l_extendedprice": "importe",
            "l_shipdate": "fecha_envio",
        },
    )


@query("select * from lineitem")
def reorder_columns(t: Tables):
    return lead_with(t.lineitem, ["l_shipdate", "l_suppkey", "l_partkey"])


@query(
    """select c_custkey, c_name as c_name_left, c_nationkey as c_nationkey_left,
      c_acctbal as c_acctbal_left, c_mktsegment as c_mktsegment_left from customer"""
)
def suffix_all(t: Tables):
    return suffix_columns(t.customer, "_left", keep=["c_custkey"])


@query("select * from orders where o_orderpriority in ('1-URGENT', '5-LOW') and o_totalprice >= 1000")
def filter_in_list(t: Tables):
    return t.orders.filter(F.col(KIND).isin("1-URGENT", "5-LOW") & (F.col("o_totalprice") >= 1000))


# ----------------------------------------------------------------------- scalars


@query(
    """with l as (select *, nullif(l_discount, 0) as d, nullif(l_tax, 0) as x from lineitem)
    select l_orderkey, l_linenumber, l_partkey,
      coalesce(l_extendedprice, 0) - (coalesce(d, 0) + coalesce(x, 0)) as net,
      abs(coalesce(l_quantity, 0) - coalesce(d, 0)) as movement,
      coalesce(l_extendedprice, 0) + coalesce(d, 0) + coalesce(x, 0) + coalesce(l_quantity, 0)
        as impact from l"""
)
def null_safe_arith(t: Tables):
    d, x = F.nullif("l_discount", F.lit(0.0)), F.nullif("l_tax", F.lit(0.0))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        net_of("l_extendedprice", d, x).alias("net"),
        gap("l_quantity", d).alias("movement"),
        total("l_extendedprice", d, x, "l_quantity").alias("impact"),
    )


@query(
    """select l_orderkey, l_linenumber, l_partkey,
      case when l_discount is null or l_discount = 0 then 0.0
        else coalesce(l_tax, 0) / l_discount * 100 end as pct from lineitem"""
)
def safe_ratio_pct(t: Tables):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", pct_of("l_tax", "l_discount").alias("pct")
    )


@query(
    """select o_orderkey,
      case when o_orderpriority in ('2-HIGH', '5-LOW') then 100000 - o_totalprice
        else 100000 + o_totalprice end as balance_after,
      case when o_orderpriority in ('1-URGENT') then o_totalprice else 0 end as cash_in,
      case when o_orderpriority in ('2-HIGH', '5-LOW') then o_totalprice else 0 end as cash_out
    from orders""",
    name="signed_movement",
)
def signed_order_movement(t: Tables):
    debits = ["2-HIGH", "5-LOW"]
    return t.orders.select(
        "o_orderkey",
        signed_movement(KIND, debits, F.lit(100000.0), "o_totalprice").alias("balance_after"),
        when_type(KIND, ["1-URGENT"], "o_totalprice").alias("cash_in"),
        when_type(KIND, debits, "o_totalprice").alias("cash_out"),
    )


@query(
    """select l_orderkey, l_linenumber, l_partkey, l_extendedprice * l_tax as converted,
      105000.0 - l_extendedprice as headroom,
      (l_extendedprice + l_quantity) / 2.0 as mean_balance, l_extendedprice * 7 as weekly,
      l_extendedprice * 30 as monthly, l_tax / 365.0 * l_extendedprice as accrued from lineitem"""
)
def row_rollups(t: Tables):
    price = F.col("l_extendedprice")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        (price * F.col("l_tax")).alias("converted"),
        (F.lit(105000.0) - price).alias("headroom"),
        ((price + F.col("l_quantity")) / F.lit(2.0)).alias("mean_balance"),
        (price * 7).alias("weekly"),
        (price * 30).alias("monthly"),
        (F.col("l_tax") / F.lit(365.0) * price).alias("accrued"),
    )


@query(
    """select c_custkey, sha256(cast(c_custkey as varchar)) as fingerprint,
      cast(length(sha256(cast(c_custkey as varchar))) as integer) as digits from customer"""
)
def key_fingerprint(t: Tables):
    mark = fingerprint("c_custkey")
    return t.customer.select(
        "c_custkey", mark.alias("fingerprint"), F.length(mark).alias("digits")
    )


@query(
    """select c_custkey, split_part(c_name, '#', 1) as head, split_part(c_name, '#', -1) as tail,
      lower(split_part(c_name, '#', 1) || '.' || split_part(c_name, '#', -1) || '@mail.example')
        as mailbox from customer"""
)
def split_parts(t: Tables):
    head, tail = first_part("c_name", "#"), last_part("c_name", "#")
    return t.customer.select(
        "c_custkey", head.alias("head"), tail.alias("tail"),
        mailbox(head, tail, "mail.example").alias("mailbox"),
    )


@query(
    """select event_id, cast(hour(ts) as integer) as hh, cast(minute(ts) as integer) as mm,
      cast(second(ts) as integer) as ss from events"""
)
def time_parts(t: Tables):
    return t.events.select(
        "event_id", F.hour("ts").alias("hh"), F.minute("ts").alias("mm"), F.second("ts").alias("ss")
    )


@query(
    """select o_orderkey, 'AHRO' || lpad(cast(o_orderkey as varchar), 15, '0') as account
    from orders""",
    name="padded_key",
)
def padded_order_key(t: Tables):
    return t.orders.select("o_orderkey", padded_key(F.lit("AHRO"), "o_orderkey").alias("account"))


@query(
    """select o_orderkey, cast(strftime(o_orderdate, '%Y%m%d')
      || lpad(cast(o_orderkey as varchar), 9, '0') as bigint) as trx_id from orders""",
    name="dated_sequence_id",
)
def dated_order_id(t: Tables):
    return t.orders.select("o_orderkey", dated_sequence_id("o_orderdate", "o_orderkey").alias("trx_id"))


@query(
    """select o_orderkey, cast(floor(date_diff('day', cast(o_orderdate as date),
      date '2001-08-01') / 365.25) as bigint) as years from orders""",
    name="age_years",
)
def order_age_years(t: Tables):
    return t.orders.select("o_orderkey", age_years("o_orderdate", F.lit(AS_OF)).alias("years"))


@query(
    """select o_orderkey, cast(o_orderdate as date) + 30 as due,
      case when o_orderstatus = 'P' then cast(o_orderdate as date) + cast(o_orderkey % 30 as int) end
        as reversed from orders"""
)
def date_offset(t: Tables):
    return t.orders.select(
        "o_orderkey",
        F.date_add("o_orderdate", 30).alias("due"),
        add_days_if(
            F.col("o_orderstatus") == "P", "o_orderdate", F.col("o_orderkey") % 30
        ).alias("reversed"),
    )


@query(
    """select o_orderkey, make_timestamp(year(o_orderdate), month(o_orderdate), day(o_orderdate),
      o_orderkey % 24, o_orderkey % 60, cast(o_orderkey % 59 as double)) as at from orders"""
)
def timestamp_from_parts(t: Tables):
    key = F.col("o_orderkey")
    at = F.make_timestamp_ntz(
        F.year("o_orderdate"), F.month("o_orderdate"), F.dayofmonth("o_orderdate"),
        (key % 24).cast("int"), (key % 60).cast("int"), (key % 59).cast("decimal(16,6)"),
    )
    return t.orders.select("o_orderkey", at.alias("at"))


@query(
    """with p as (select event_id, case when event_type = 'click' then strftime(ts, '%Y-%m-%d')
        when event_type = 'view' then strftime(ts, '%d-%m-%Y')
        when event_type = 'error' then strftime(ts, '%Y/%m/%d') else event_type end as text
      from events)
    select event_id, case when regexp_full_match(text, '\\d{4}-\\d{2}-\\d{2}')
      then try_cast(text as date) end as day from p"""
)
def strict_date_parse(t: Tables):
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", F.date_format("ts", "yyyy-MM-dd"))
        .when(kind == "view", F.date_format("ts", "dd-MM-yyyy"))
        .when(kind == "error", F.date_format("ts", "yyyy/MM/dd"))
        .otherwise(kind)
    )
    return t.events.select("event_id", parse_day(text).alias("day"))


@query(
    """select c_custkey, c_mktsegment || ' ' || c_name as full_name from customer"""
)
def text_join(t: Tables):
    return t.customer.select("c_custkey", join_text("c_mktsegment", "c_name").alias("full_name"))


# ----------------------------------------------------------------------- ladders


def ladder_input(t: Tables):
    # Customers without an urgent order have nulls here.
    urgent = F.struct("o_orderdate", "o_orderkey", "o_orderstatus", "o_totalprice")
    newest = F.max(F.when(F.col(KIND) == "1-URGENT", urgent)).alias("newest")
    summary = t.orders.groupBy("o_custkey").agg(newest).select("o_custkey", "newest.*")
    joined = dim_left_join(t.customer, summary, "c_custkey", "o_custkey")
    market = F.col("c_mktsegment")
    return joined.select(
        "c_custkey",
        F.concat(F.lit("0"), (F.col("c_nationkey") % 5 + 1).cast("string")).alias("level"),
        (F.col("c_custkey") * 7919 % 551 + 300).alias("score"),
        F.when(F.col("o_orderstatus") == "F", "SI")
        .when(F.col("o_orderstatus").isNotNull(), "NO").alias("arrears"),
        (F.col("c_acctbal") * 30).alias("available"),
        F.col("o_totalprice").alias("credit_limit"),
        F.when(market == "AUTOMOBILE", "VIP").when(market == "BUILDING", "PREM")
        .when(market == "FURNITURE", "STD").otherwise("BAS").alias("segment"),
        F.datediff(F.lit(AS_OF), "o_orderdate").alias("idle_days"),
        (F.col("c_custkey") % 12).alias("products"),
        F.when(F.col("c_custkey") % 10 < 7, "AC").otherwise("IN").alias("state"),
    )


LADDER_INPUT_SQL = f"""{LATEST_URGENT_SQL}, x as (select c_custkey,
    '0' || cast(c_nationkey % 5 + 1 as varchar) as level, c_custkey * 7919 % 551 + 300 as score,
    case when o_orderstatus = 'F' then 'SI' when o_orderstatus is not null then 'NO' end as arrears,
    c_acctbal * 30 as available, o_totalprice as credit_limit,
    case c_mktsegment when 'AUTOMOBILE' then 'VIP' when 'BUILDING' then 'PREM'
      when 'FURNITURE' then 'STD' else 'BAS' end as segment,
    date_diff('day', cast(o_orderdate as date), date '2001-08-01') as idle_days,
    c_custkey % 12 as products, case when c_custkey % 10 < 7 then 'AC' else 'IN' end as state
  from customer left join latest on c_custkey = o_custkey)"""


@query(
    f"""with {LADDER_INPUT_SQL}
    select c_custkey, case
      when level in ('04', '05') and score < 500 and arrears = 'SI' then 'RIESGO_CRITICO'
      when level in ('03', '04', '05') and score < 600 and arrears = 'SI' then 'RIESGO_ALTO'
      when level in ('03', '04', '05') or (score < 650 and arrears = 'SI') then 'RIESGO_MEDIO'
      when level = '02' or score < 700 then 'RIESGO_BAJO' else 'SIN_RIESGO' end as label from x"""
)
def risk_ladder(t: Tables):
    label = rules.RISK.bind(level="level", score="score", arrears="arrears")
    return ladder_input(t).select("c_custkey", label.alias("label"))


@query(
    f"""with {LADDER_INPUT_SQL}
    select c_custkey, case
      when available >= 200000 and credit_limit >= 100000 and segment = 'VIP' then 'SALDO_PREMIUM'
      when available >= 100000 and credit_limit >= 50000 and segment in ('VIP', 'PREM')
        then 'SALDO_ALTO'
      when available >= 25000 and credit_limit >= 10000 then 'SALDO_MEDIO'
      when available >= 5000 or (credit_limit >= 5000 and segment in ('STD', 'BAS'))
        then 'SALDO_BAJO' else 'SALDO_CRITICO' end as label from x"""
)
def balance_ladder(t: Tables):
    label = rules.BALANCE.bind(available="available", limit="credit_limit", segment="segment")
    return ladder_input(t).select("c_custkey", label.alias("label"))


@query(
    f"""with {LADDER_INPUT_SQL}
    select c_custkey, case
      when idle_days <= 30 and products >= 8 and state = 'AC' then 'CLIENTE_INTEGRAL'
      when idle_days <= 90 and products >= 5 and state = 'AC' then 'ACTIVIDAD_ALTA'
      when idle_days <= 180 and products >= 3 and state = 'AC' then 'ACTIVIDAD_MEDIA'
      when idle_days <= 365 and products >= 1 and state in ('AC', 'IN') then 'ACTIVIDAD_BAJA'
      else 'INACTIVO' end as label from x"""
)
def activity_ladder(t: Tables):
    label = rules.ACTIVITY.bind(days="idle_days", products="products", state="state")
    return ladder_input(t).select("c_custkey", label.alias("label"))


@query(
    """select l_orderkey, l_linenumber, l_partkey, case when l_quantity >= 40 then 'L'
      when l_quantity >= 20 then 'M' else 'S' end as size_class from lineitem"""
)
def custom_ladder(t: Tables):
    sizes = Ladder.from_text("L: {q} >= 40\nM: {q} >= 20\nS")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", sizes.bind(q="l_quantity").alias("size_class")
    )


# ------------------------------------------------------- sampling and assignment


@query("select * from customer where c_custkey * 7919 % 10000 < 2000", name="hash_sample")
def customer_sample(t: Tables):
    return hash_sample(t.customer, "c_custkey", 0.2, digest=F.col("c_custkey") * 7919)


@query(
    """with s as (select o_orderkey, o_orderkey * 7919 % 1000000 as slot from orders)
    select o_orderkey, case when slot < 400000 then 'AHRO' when slot < 700000 then 'CRTE'
      when slot < 900000 then 'PRES' else 'INVR' end as account_type from s"""
)
def weighted_bucket(t: Tables):
    weights = {code: row[1] for code, row in rules.ACCOUNT_TYPES.items()}
    kind = weighted_choice("o_orderkey", weights, digest=F.col("o_orderkey") * 7919)
    return t.orders.select("o_orderkey", kind.alias("account_type"))


# ------------------------------------------------------- sets, snapshots, changes


def mutated_customer(t: Tables):
    """Every fifth customer changed (some to null), every eleventh removed, newcomers added."""
    key = F.col("c_custkey")
    evolved = evolve_snapshot(
        t.customer,
        F.pmod(key, F.lit(5)) == 0,
        {
            "c_acctbal": F.col("c_acctbal") + 1,
            "c_mktsegment": F.nullif("c_mktsegment", F.lit("BUILDING")),
        },
    )
    newcomers = grow_snapshot(t.customer, "c_custkey", 0.01, buckets=64, bucket=key)
    return evolved.filter(F.pmod(key, F.lit(11)) != 0).unionByName(newcomers)


@query(
    """select * replace (case when o_orderstatus = 'P' then o_totalprice + 1 else o_totalprice end
        as o_totalprice, case when o_orderstatus = 'P' then timestamp '2001-08-01'
        else o_orderdate end as o_orderdate) from orders"""
)
def snapshot_stamped(t: Tables):
    """Open orders cost one more and carry the day of the change; all others keep their date."""
    return evolve_snapshot(
        t.orders,
        F.col("o_orderstatus") == "P",
        {"o_totalprice": F.col("o_totalprice") + 1},
        stamps={"o_orderdate": F.lit(AS_OF).cast("timestamp_ntz")},
    )


GROWN_SQL = """idx as (select *, row_number() over (
      order by c_custkey % 64, c_custkey) - 1 as i from customer),
  models as (select * exclude (i), row_number() over (
      order by c_custkey % 64, c_custkey) - 1 as j from idx
      where i < (select round(count(*) * {growth}) from customer)),
  newcomers as (select (select max(c_custkey) from customer) + 1 + j as c_custkey,
      * exclude (c_custkey, j) from models)"""
MUTATED_SQL = f"""{GROWN_SQL.format(growth=0.01)},
  changed as (select c_custkey, c_name, c_nationkey,
      case when c_custkey % 5 = 0 then c_acctbal + 1 else c_acctbal end as c_acctbal,
      case when c_custkey % 5 = 0 then nullif(c_mktsegment, 'BUILDING') else c_mktsegment end
        as c_mktsegment from customer),
  mutated as (select * from changed where c_custkey % 11 <> 0
      union all by name select * from newcomers)"""


@query(f"with {MUTATED_SQL} select * from mutated")
def snapshot_evolve(t: Tables):
    return mutated_customer(t)


@query(
    f"""with {MUTATED_SQL}
    select n.c_custkey, n.c_name, n.c_nationkey, n.c_acctbal, n.c_mktsegment,
      'insert' as _change_type from mutated n where n.c_custkey not in (select c_custkey from customer)
    union all
    select *, 'delete' from customer where c_custkey not in (select c_custkey from mutated)
    union all
    select o.*, 'update_preimage' from customer o join mutated n using (c_custkey)
      where o.c_acctbal is distinct from n.c_acctbal
        or o.c_mktsegment is distinct from n.c_mktsegment
    union all
    select n.c_custkey, n.c_name, n.c_nationkey, n.c_acctbal, n.c_mktsegment, 'update_postimage'
      from customer o join mutated n using (c_custkey)
      where o.c_acctbal is distinct from n.c_acctbal
        or o.c_mktsegment is distinct from n.c_mktsegment""",
    name="table_changes",
)
def customer_changes(t: Tables):
    return table_changes(t.customer, mutated_customer(t), ["c_custkey"])


@query(
    f"""with {MUTATED_SQL}, j as (select o.c_custkey as ok, n.c_custkey as nk,
        o.c_acctbal is distinct from n.c_acctbal
          or o.c_mktsegment is distinct from n.c_mktsegment as diff
      from customer o full join mutated n on o.c_custkey = n.c_custkey),
    s as (select count(*) filter (where ok is not null and nk is not null) as n_kept,
        count(*) filter (where ok is not null and nk is not null and diff) as n_changed,
        count(*) filter (where ok is null) as n_added,
        count(*) filter (where nk is null) as n_removed, max(ok) as max_old_key,
        min(case when ok is null then nk end) as min_added_key from j)
    select *, coalesce(n_changed * 100 / n_kept, 0.0) as changed_pct,
      min_added_key = max_old_key + 1 as keys_continue from s""",
    name="snapshot_drift",
)
def customer_drift(t: Tables):
    return snapshot_drift(
        t.customer, mutated_customer(t), "c_custkey", ["c_acctbal", "c_mktsegment"]
    )


@query(
    """select (select max(c_custkey) from customer) + row_number() over (
        order by s_suppkey % 16, s_suppkey) as c_custkey, s_suppkey, s_name from supplier"""
)
def continue_surrogate_key(t: Tables):
    return continue_key(
        t.customer, "c_custkey", t.supplier.select("s_suppkey", "s_name"), "s_suppkey",
        buckets=16, bucket=F.col("s_suppkey"),
    )


@query("select row_number() over () - 1 as id from orders")
def sequence_ids(t: Tables):
    return row_sequence(t.orders)


@query(
    """select l_orderkey, l_partkey from lineitem
    except select l_orderkey, l_partkey from lineitem where l_returnflag = 'R'""",
    name="set_except",
)
def unreturned_items(t: Tables):
    items = t.lineitem.select("l_orderkey", "l_partkey", "l_returnflag")
    returned = items.filter("l_returnflag = 'R'").drop("l_returnflag")
    return set_except(items.drop("l_returnflag"), returned)


@query(
    """select c_custkey as key, c_name as name, c_acctbal as balance, c_mktsegment as segment
      from customer
    union all select s_suppkey, s_name, s_acctbal, null from supplier
    union all select p_partkey, p_name, p_retailprice, null from part"""
)
def union_by_name(t: Tables):
    people = rename_select(
        t.customer,
        {"c_custkey": "key", "c_name": "name", "c_acctbal": "balance", "c_mktsegment": "segment"},
    )
    firms = rename_select(t.supplier, {"s_acctbal": "balance", "s_suppkey": "key", "s_name": "name"})
    goods = rename_select(t.part, {"p_name": "name", "p_partkey": "key", "p_retailprice": "balance"})
    return union_all_by_name([people, firms, goods], fill_missing=True)


@query(
    """select l_orderkey, l_linenumber, l_partkey, l_extendedprice * (1 - l_discount) as net
    from lineitem""",
    name="map_batches",
)
def net_by_batch(t: Tables):
    items = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_discount"
    )

    def price(batch):
        net = batch.l_extendedprice * (1 - batch.l_discount)
        return batch[["l_orderkey", "l_linenumber", "l_partkey"]].assign(net=net)

    return map_batches(
        items, price, "l_orderkey bigint, l_linenumber int, l_partkey bigint, net double"
    )
