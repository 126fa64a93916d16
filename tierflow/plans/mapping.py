"""The three source tables of the banking product, as far as the given tables hold them.

Only values that stand in customer, nation, region, orders and lineitem, and sums of
them, are carried over. Every other column of the contracts is a typed null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions import dated_sequence_id
from tierflow.operators.joins import code_table, dim_left_join, lookup
from tierflow.operators.projection import conform
from tierflow.plans import contracts, rules

#: Order priorities under the transaction codes that the product's rules know.
PRIORITY_CODES = {
    "1-URGENT": "CATM",
    "2-HIGH": "DATM",
    "3-MEDIUM": "CMPR",
    "4-NOT SPECIFIED": "TINT",
    "5-LOW": "PGSL",
}


def exact(c: str | Column) -> Column:
    """An amount as a decimal, so that sums do not depend on their order."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def customer_facts(
    customer: DataFrame, nation: DataFrame, region: DataFrame, orders: DataFrame
) -> DataFrame:
    """Customer with nation, region and a summary of its orders."""
    places = nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name", "n_regionkey"
    )
    activity = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_orderdate").cast("date").alias("last_order"),
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(exact("o_totalprice")).cast("double").alias("spent"),
    )
    return customer.join(places, "c_nationkey", "left").join(activity, "c_custkey", "left")


def _conformed(rows: DataFrame, made: dict[str, Column], contract: str) -> DataFrame:
    columns = [c.alias(name) for name, c in made.items()]
    return conform(rows.select(*columns), contracts.source_schema(contract))


def master_rows(facts: DataFrame) -> DataFrame:
    """One row per customer in the layout of the master."""
    made = {
        "CUSTID": F.col("c_custkey"),
        "CUSTNM": F.col("c_name"),
        "NATNLT": F.col("c_nationkey").cast("string"),
        "CNTRY": F.col("n_name"),
        "SGMNT": F.col("c_mktsegment"),
        "LSTTRX": F.col("last_order"),
        "LSTUPD": F.col("last_order"),
    }
    return _conformed(facts, made, contracts.MASTER)


def balance_rows(facts: DataFrame) -> DataFrame:
    """One row per customer in the layout of the balances."""
    made = {
        "CUSTID": F.col("c_custkey"),
        "SGMNT": F.col("c_mktsegment"),
        "RGNCD": F.col("n_regionkey").cast("string"),
        "RGNNM": F.col("r_name"),
        "AVLBAL": F.col("c_acctbal"),
        "CURBAL": F.col("c_acctbal"),
        "TTLDBT": F.coalesce("spent", F.lit(0.0)),
        "TTLTRX": F.coalesce("n_orders", F.lit(0)),
        "LSTTRX": F.col("last_order"),
    }
    return _conformed(facts, made, contracts.BALANCES)


def transaction_rows(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One row per order in the layout of the transactions; charges come from its lines."""
    price, off = exact("l_extendedprice"), exact("l_discount")
    lines = lineitem.groupBy("l_orderkey").agg(
        F.sum(price).cast("double").alias("gross"),
        F.sum(price * off).cast("double").alias("discount"),
        F.sum(price * exact("l_tax")).cast("double").alias("tax"),
        F.sum(price * (1 - off)).cast("double").alias("net"),
    )
    priced = dim_left_join(orders, lines, "o_orderkey", "l_orderkey")
    codes = code_table(
        orders.sparkSession,
        {p: (c, *rules.TRANSACTION_CODES[c][:2]) for p, c in PRIORITY_CODES.items()},
        "o_orderpriority string, code string, description string, channel string",
    )
    rows = lookup(priced, codes, "o_orderpriority")
    day = F.col("o_orderdate").cast("date")
    made = {
        "TRXID": dated_sequence_id(day, F.col("o_orderkey")),
        "CUSTID": F.col("o_custkey"),
        "TRXTYP": F.col("code"),
        "TRXDSC": F.col("description"),
        "CHNLCD": F.col("channel"),
        "TRXSTS": F.col("o_orderstatus"),
        "TRXDT": day,
        "TRXTM": F.col("o_orderdate"),
        "TRXAMT": F.col("o_totalprice"),
        "ORGAMT": F.col("gross"),
        "FEEAMT": F.lit(None).cast("double"),
        "DSCAMT": F.col("discount"),
        "TAXAMT": F.col("tax"),
        "NETAMT": F.col("net"),
    }
    return _conformed(rows, made, contracts.TRANSACTIONS)
