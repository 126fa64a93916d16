"""Queries over the data-quality operators."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.functions import join_text, net_of, pct_of
from tierflow.operators import quality
from tierflow.operators.aggregate import band_shares
from tierflow.operators.projection import rename_select
from tierflow.sources.jdbc import config_row
from tierflow.workload.registry import Tables, query
from tierflow.workload.relational import KIND, latest_order


@query("select * from lineitem where nullif(l_discount, 0) is not null and l_quantity > 5")
def expect_or_drop(t: Tables):
    items = quality.expect(t.lineitem, "discounted", "nullif(l_discount, 0) IS NOT NULL")
    return quality.expect(items, "bulk", F.col("l_quantity") > 5)


@query("select * from lineitem")
def expect_keep(t: Tables):
    return quality.expect(t.lineitem, "discounted", "l_discount > 0", action="keep")


@query("select * from orders")
def expect_or_fail(t: Tables):
    return quality.expect(t.orders, "has_key", "o_orderkey IS NOT NULL", action="fail")


@query(
    """select unnest(['discounted', 'taxed', 'bulk']) as expectation,
      unnest([count(*) filter (where l_discount > 0), count(*) filter (where nullif(l_tax, 0) > 0),
        count(*) filter (where l_quantity >= 10)]) as n_passed,
      unnest([count(*) - count(*) filter (where l_discount > 0),
        count(*) - count(*) filter (where nullif(l_tax, 0) > 0),
        count(*) - count(*) filter (where l_quantity >= 10)]) as n_violations from lineitem"""
)
def expect_metrics(t: Tables):
    return quality.expectation_metrics(
        t.lineitem,
        {"discounted": "l_discount > 0", "taxed": "nullif(l_tax, 0) > 0", "bulk": "l_quantity >= 10"},
    )


@query(
    """select unnest(['c_custkey', 'c_name', 'c_acctbal', 'c_segment', 'c_nationkey', 'c_mktsegment'])
        as column_name,
      unnest(['bigint', 'string', 'decimal(18,2)', 'string', null, null]) as expected,
      unnest(['bigint', 'string', 'double', null, 'int', 'string']) as observed,
      unnest([count(c_custkey), count(c_name), count(c_acctbal), 0, count(c_nationkey),
        count(c_mktsegment)]) as n_filled,
      unnest([true, true, false, false, false, false]) as ok from customer""",
    name="schema_conformance",
)
def customer_schema(t: Tables):
    contract = T.StructType.fromDDL(
        "c_custkey bigint, c_name string, c_acctbal decimal(18,2), c_segment string"
    )
    return quality.schema_conformance(t.customer, contract, forbidden=["c_mktsegment"])


@query(
    """select l_orderkey, l_linenumber, count(*) as n_rows from lineitem
    group by l_orderkey, l_linenumber having count(*) > 1""",
    name="duplicate_keys",
)
def duplicate_lines(t: Tables):
    return quality.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    """with g as (select l_orderkey, l_linenumber, count(*) as n from lineitem group by all)
    select cast(sum(n) as bigint) as n_rows, count(*) as n_keys,
      count(*) filter (where n > 1) as n_repeated,
      count(*) filter (where l_orderkey is null or l_linenumber is null) as n_null_keys,
      count(*) filter (where n > 1) = 0 as ok from g"""
)
def unique_key_check(t: Tables):
    return quality.key_uniqueness(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    """with p as (select doc_id, count(*) as n from documents group by doc_id),
      c as (select doc_id, count(*) as n from labels group by doc_id),
      j as (select coalesce(p.n, 0) as p, coalesce(c.n, 0) as c from p full join c using (doc_id))
    select cast(sum(p) as bigint) as n_parent, cast(sum(c) as bigint) as n_child,
      count(*) filter (where c = 0) as n_missing, count(*) filter (where p = 0) as n_orphan,
      count(*) filter (where p > 1 or c > 1) as n_repeated,
      count(*) filter (where c = 0 or p = 0 or p > 1 or c > 1) = 0 as ok from j"""
)
def one_to_one_satellite(t: Tables):
    return quality.one_to_one(t.documents, t.labels, "doc_id")


@query(
    """with seen as (select event_type as v, count(*) as n from events group by event_type),
      allowed(v) as (values ('signup'), ('purchase'), ('view'), ('click'), ('refund'))
    select coalesce(seen.v, allowed.v) as value, coalesce(n, 0) as n_rows,
      allowed.v is not null as allowed, seen.v is not null and allowed.v is not null as ok
    from seen full join allowed on seen.v = allowed.v""",
    name="value_domain",
)
def event_domain(t: Tables):
    allowed = ["signup", "purchase", "view", "click", "refund"]
    return quality.value_domain(t.events, "event_type", allowed)


@query(
    """with l(category, low, high) as (values ('signup', 0.0, 1000.0), ('purchase', 0.0, 10.0),
        ('view', 0.0, 1000.0), ('click', -5.0, 5000.0)),
      s as (select event_type as category, min(value) as min_value, max(value) as max_value
        from events group by event_type)
    select s.category, min_value, max_value, cast(low as double) as low,
      cast(high as double) as high, coalesce(min_value >= low and max_value <= high, false) as ok
    from s left join l on s.category = l.category"""
)
def range_by_category(t: Tables):
    limits = {"signup": (0, 1000), "purchase": (0, 10), "view": (0, 1000), "click": (-5, 5000)}
    return quality.category_limits(t.events, "event_type", "value", limits)


@query(
    """with b as (select case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'ALTA'
        when o_orderpriority in ('3-MEDIUM', '4-NOT SPECIFIED') then 'MEDIA' else 'BAJA' end as band
      from orders),
      s as (select band, count(*) as n_rows, count(*) * 100 / sum(count(*)) over () as share_pct
        from b group by band),
      w(band, target_pct) as (values ('ALTA', 40.0), ('MEDIA', 40.0), ('BAJA', 30.0))
    select s.band, n_rows, share_pct, cast(target_pct as double) as target_pct,
      coalesce(abs(share_pct - target_pct) <= 5.0, false) as ok
    from s full join w on s.band = w.band"""
)
def distribution_tolerance(t: Tables):
    bands = {
        "ALTA": ["1-URGENT", "2-HIGH"],
        "MEDIA": ["3-MEDIUM", "4-NOT SPECIFIED"],
        "BAJA": ["5-LOW"],
    }
    shares = band_shares(t.orders, KIND, bands)
    return quality.distribution_check(shares, {"ALTA": 40, "MEDIA": 40, "BAJA": 30}, 5.0)


@query(
    """with x as (select nullif(l_discount, 0) as d, nullif(l_returnflag, 'R') as f,
        case when l_tax = 0 then 'NaN'::double else l_tax end as x from lineitem)
    select unnest(['d', 'f', 'x']) as column_name,
      unnest([count(*) - count(d), count(*) - count(f), count(*) - count(x)]) as n_null,
      unnest([0, 0, count(*) filter (where isnan(x))]) as n_nan from x"""
)
def null_nan_audit(t: Tables):
    nan = F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(F.col("l_tax"))
    made = t.lineitem.select(
        F.nullif("l_discount", F.lit(0.0)).alias("d"),
        F.nullif("l_returnflag", F.lit("R")).alias("f"),
        nan.alias("x"),
    )
    return quality.null_nan_counts(made, ["d", "f", "x"])


@query(
    """select unnest(['net', 'pct']) as column_name, unnest([count(*), count(*)]) as n_rows,
      unnest([count(*) filter (where l_returnflag = 'R'), 0]) as n_breaks,
      unnest([count(*) filter (where l_returnflag = 'R') = 0, true]) as ok from lineitem"""
)
def formula_recheck(t: Tables):
    net = net_of("l_extendedprice", "l_discount", "l_tax")
    pct = pct_of("l_tax", "l_discount")
    shift = F.when(F.col("l_returnflag") == "R", F.lit(0.01)).otherwise(F.lit(0.0))
    stored = t.lineitem.withColumns({"net": net + shift, "pct": pct})
    return quality.formula_breaks(stored, {"net": net, "pct": pct})


@query(
    """select count(*) as n_rows, count(*) filter (where c_mktsegment = 'BUILDING') as n_breaks,
      count(*) filter (where c_mktsegment = 'BUILDING') = 0 as ok from customer"""
)
def concat_check(t: Tables):
    parts = join_text("c_mktsegment", "c_name")
    stored = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_name")).otherwise(parts)
    return quality.composite_breaks(t.customer.withColumn("full_name", stored), "full_name", parts)


@query("select count(*) as n_rows, count(*) >= 1000 as ok from lineitem", name="volume_check")
def lineitem_volume(t: Tables):
    return quality.volume_check(t.lineitem, at_least=1000)


@query(
    """select count(*) as n_rows, count(*) filter (where cast(ts as date) <> date '2024-01-02')
      as n_breaks, count(*) filter (where cast(ts as date) <> date '2024-01-02') = 0 as ok
    from events"""
)
def run_date_check(t: Tables):
    return quality.run_date_breaks(t.events, "ts", "2024-01-02")


@query(
    """select count(*) as n_rows, 0::bigint as n_breaks, cast(min(hour(ts)) as int) as min_hour,
      cast(max(hour(ts)) as int) as max_hour, cast(min(minute(ts)) as int) as min_minute,
      cast(max(minute(ts)) as int) as max_minute, true as ok from events"""
)
def time_part_check(t: Tables):
    return quality.time_part_breaks(t.events, "ts")


@query(
    """with latest as (select * from (select *, row_number() over (partition by o_custkey
        order by o_orderdate desc, o_orderkey desc) as rn from orders) where rn = 1),
      l as (select o_custkey as k, o_orderkey as last_key, o_totalprice as amount,
        o_orderpriority as kind from latest),
      r as (select o_custkey as k, max(o_orderkey) as last_key, max(o_totalprice) as amount,
        max(o_orderpriority) as kind from orders group by o_custkey),
      j as (select l.k, l.last_key is distinct from r.last_key as b1,
        abs(l.amount - r.amount) > 0.01 as b2, l.kind is distinct from r.kind as b3
        from l join r on l.k = r.k)
    select unnest(['k', 'last_key', 'amount', 'kind']) as column_name,
      unnest([count(*), count(*), count(*), count(*)]) as n_keys,
      unnest([0, count(*) filter (where b1), count(*) filter (where b2),
        count(*) filter (where b3)]) as n_breaks,
      unnest([true, count(*) filter (where b1) = 0, count(*) filter (where b2) = 0,
        count(*) filter (where b3) = 0]) as ok from j"""
)
def layer_reconcile(t: Tables):
    names = {"o_custkey": "k", "o_orderkey": "last_key", "o_totalprice": "amount", KIND: "kind"}
    newest = rename_select(latest_order(t), names)
    recomputed = t.orders.groupBy(F.col("o_custkey").alias("k")).agg(
        F.max("o_orderkey").alias("last_key"),
        F.max("o_totalprice").alias("amount"),
        F.max(KIND).alias("kind"),
    )
    return quality.reconcile(newest, recomputed, "k", ["last_key", "amount", "kind"], 0.01)


@query(
    """select max(case when p_brand = 'Brand#1' then p_name end) as "Brand#1",
      max(case when p_brand = 'Brand#2' then p_name end) as "Brand#2",
      max(case when p_brand = 'Brand#3' then p_name end) as "Brand#3" from part"""
)
def config_lookup(t: Tables):
    config = rename_select(t.part, {"p_brand": "Clave", "p_name": "Valor"})
    return config_row(config, ["Brand#1", "Brand#2", "Brand#3"])


@query(
    """with r(required) as (values ('Brand#1'), ('Brand#2'), ('Brand#0'))
    select required, count(p_name) as n_values, count(p_name) > 0 as ok
    from r left join part on p_brand = required and length(trim(p_name)) > 0 group by required"""
)
def config_completeness(t: Tables):
    config = rename_select(t.part, {"p_brand": "Clave", "p_name": "Valor"})
    return quality.config_completeness(config, ["Brand#1", "Brand#2", "Brand#0"])
