"""TPC-H Q1-Q4 (A15, U3, O2, J8, J10) with fixed parameters.

The reference draws parameters at random at compile time; here they are
arguments with defaults so runs are reproducible.  Columns the supplied
tables lack (p_mfgr, addresses, phones, comments, o_shippriority) are left
out; PARTSUPP and commit/receipt dates are the stand-ins of FIXTURES.md.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.sources.standins import lineitem_with_dates, partsupp
from strata.functions.numeric import exact_avg, money_sum
from strata.session import RunContext


def q1_pricing_summary(cat, ctx: RunContext = RunContext(), delta_days: int = 90) -> DataFrame:
    """Pricing summary: one scan of lineitem with the ship-date filter pushed
    into Parquet, one partial+final hash aggregate on 2 low-cardinality keys."""
    cutoff = F.date_sub(F.lit(dt.date(1998, 12, 1)), delta_days)
    li = cat.lineitem.where(F.col("l_shipdate") <= cutoff.cast("timestamp_ntz"))
    disc = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    charge = disc * (1 + F.col("l_tax"))
    return (li.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"),
        money_sum("l_extendedprice").alias("sum_base_price"),
        money_sum(disc).alias("sum_disc_price"),
        money_sum(charge).alias("sum_charge"),
        exact_avg("l_quantity").alias("avg_qty"),
        exact_avg("l_extendedprice").alias("avg_price"),
        exact_avg("l_discount").alias("avg_disc"),
        F.count(F.lit(1)).alias("count_order"))
        .orderBy("l_returnflag", "l_linestatus"))


def q2_minimum_cost_supplier(cat, ctx: RunContext = RunContext(), size: int = 15, region: str = "EUROPE",
                             limit: int = 100) -> DataFrame:
    """Minimum-cost supplier per part within a region.  The correlated
    min() subquery is a grouped min over the same region-filtered join,
    joined back on (part, cost); region/nation are broadcast dimensions."""
    ps = partsupp(cat.lineitem)
    nat = cat.nation.join(F.broadcast(cat.region.where(F.col("r_name") == region)),
                          F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name")
    sup = cat.supplier.join(F.broadcast(nat), F.col("s_nationkey") == F.col("n_nationkey"))
    offers = ps.join(sup, F.col("ps_suppkey") == F.col("s_suppkey"))
    parts = cat.part.where(F.col("p_size") == size).select("p_partkey")
    offers = offers.join(parts, F.col("ps_partkey") == F.col("p_partkey"))
    best = offers.groupBy("p_partkey").agg(F.min("ps_supplycost").alias("__min"))
    out = offers.join(best, "p_partkey").where(F.col("ps_supplycost") == F.col("__min"))
    return (out.select("s_acctbal", "s_name", "n_name", "p_partkey", "ps_supplycost")
            .orderBy(F.col("s_acctbal").desc(), "n_name", "s_name", "p_partkey").limit(limit))


def q3_shipping_priority(cat, ctx: RunContext = RunContext(), segment: str = "BUILDING",
                         date: dt.date = dt.date(1995, 3, 15), limit: int = 10) -> DataFrame:
    """Top unshipped orders by revenue: filters pushed to all three scans,
    customer filter shrinks the orders side before the lineitem join, top-k
    via TakeOrderedAndProject (no global sort)."""
    d = F.lit(date).cast("timestamp_ntz")
    c = cat.customer.where(F.col("c_mktsegment") == segment).select("c_custkey")
    o = cat.orders.where(F.col("o_orderdate") < d).select("o_orderkey", "o_custkey", "o_orderdate")
    li = cat.lineitem.where(F.col("l_shipdate") > d).select("l_orderkey", "l_extendedprice", "l_discount")
    co = o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    j = li.join(co, F.col("l_orderkey") == F.col("o_orderkey"))
    rev = money_sum(F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return (j.groupBy("l_orderkey", "o_orderdate").agg(rev.alias("revenue"))
            .orderBy(F.col("revenue").desc(), "o_orderdate", "l_orderkey").limit(limit))


def q4_order_priority(cat, ctx: RunContext = RunContext(), start: dt.date = dt.date(1996, 7, 1),
                      months: int = 3) -> DataFrame:
    """Orders in a quarter with at least one late line: EXISTS as a
    left-semi join (no duplicate orders, no distinct needed)."""
    lo = F.lit(start)
    hi = F.add_months(lo, months)
    o = cat.orders.where((F.col("o_orderdate") >= lo.cast("timestamp_ntz")) & (F.col("o_orderdate") < hi.cast("timestamp_ntz")))
    late = lineitem_with_dates(cat.lineitem).where(F.col("l_commitdate") < F.col("l_receiptdate")).select("l_orderkey")
    return (o.join(late, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
            .groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("order_count")).orderBy("o_orderpriority"))
