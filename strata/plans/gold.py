"""Gold layer: dimensions, facts and analytics marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.merge import newer_than
from strata.plans import silver, staging
from strata.session import RunContext


def customer_insights(cat, ctx: RunContext = RunContext(), segments: DataFrame | None = None) -> DataFrame:
    """J1 + P3 + O1.  Nation is a dimension (bounded size): broadcast."""
    seg = segments if segments is not None else silver.customer_segments(cat, ctx)
    nation = cat.nation.select(F.col("n_nationkey").alias("nation_key"), F.col("n_name").alias("country"))
    b = seg.join(F.broadcast(nation), "nation_key", "left")
    tier, rank_cls, stat = F.col("customer_segment"), F.col("nation_ranking"), F.col("statistical_class")
    classification = (F.when((tier == "PREMIUM") & (rank_cls == "TOP_10_IN_NATION"), "VIP Customer")
                      .when(tier.isin("PREMIUM", "HIGH_VALUE"), "High Value Customer")
                      .when(stat == "ABOVE_AVERAGE", "Above Average Customer")
                      .otherwise("Standard Customer"))
    risk = (F.when(F.col("account_balance") < 0, "Credit Risk").when(tier == "LOW_VALUE", "Retention Risk")
            .when(F.col("balance_vs_nation_avg") < -1000, "Performance Risk").otherwise("Low Risk"))
    return b.select(
        "customer_key", "customer_name", "country", "account_balance",
        F.col("avg_nation_balance").alias("country_average_balance"),
        F.col("balance_vs_nation_avg").alias("balance_vs_country_average"),
        tier.alias("customer_tier"), "market_segment",
        rank_cls.alias("country_ranking"), stat.alias("statistical_classification"),
        F.round(F.col("balance_percentile") * 100, 1).alias("balance_percentile_score"),
        F.col("balance_rank_in_nation").alias("rank_in_country"),
        classification.alias("customer_classification"), risk.alias("risk_category"),
        F.col("processed_at").alias("last_updated"),
    ).orderBy(F.col("account_balance").desc(), "customer_key")


def nation_summary(cat, ctx: RunContext = RunContext()) -> DataFrame:
    n = silver.clean_nations(cat, ctx)
    ln = F.col("name_length")
    return n.select("nation_name", "government_type", "name_length",
                    F.when(ln <= 5, "SHORT").when(ln <= 10, "MEDIUM").otherwise("LONG").alias("name_category"),
                    F.initcap("nation_name").alias("display_name"),
                    F.col("processed_at").alias("last_updated")).orderBy("nation_name")


def value_segment(balance):
    return (F.when(balance >= 5000, "High Value").when(balance >= 1000, "Medium Value").otherwise("Standard"))


def dim_customers(cat, ctx: RunContext = RunContext(), existing: DataFrame | None = None) -> DataFrame:
    """Enriched customer dimension (J1, P3, K6).  The per-customer order
    aggregate is hash-partitioned on customer_key, so the customer side is
    the only one shuffled for the join; nations are broadcast."""
    c = staging.stg_customers(cat, ctx)
    o = silver.int_customers_with_orders(cat, ctx)
    n = staging.stg_nations(cat, ctx).select("nation_key", "nation_name", "region_key")
    j = c.join(o, "customer_key", "left").join(F.broadcast(n), "nation_key", "left")
    oc = F.coalesce(F.col("order_count"), F.lit(0)).cast("long")
    op = F.coalesce(F.col("open_order_count"), F.lit(0)).cast("long")
    out = j.select("customer_key", "customer_name", "account_balance", "market_segment", "nation_key",
                   "nation_name", "region_key", oc.alias("total_orders"), op.alias("open_orders"),
                   F.when(oc > 0, "Y").otherwise("N").alias("has_orders_flag"),
                   F.when(op > 0, "Y").otherwise("N").alias("has_open_orders_flag"),
                   value_segment(F.col("account_balance")).alias("value_segment"),
                   "_loaded_at", ctx.now().alias("_updated_at"))
    # K6: customers carry no change time; new ones have higher keys.
    return newer_than(out, existing, "customer_key")


def dim_orders(cat, ctx: RunContext = RunContext(), customers: DataFrame | None = None,
               existing: DataFrame | None = None) -> DataFrame:
    """Orders enriched with customer attributes (J1).  Customers are
    deduplicated first (one row per key) so the join cannot fan out; the
    join shuffles orders and customers on customer_key (sort-merge).  With
    ``existing``, only orders dated after its last one (K6)."""
    from strata.operators.dedup import keep_one_per_key
    o = newer_than(staging.stg_orders(cat, ctx), existing, "order_date")
    cust = customers if customers is not None else dim_customers(cat, ctx)
    cust = keep_one_per_key(cust.select("customer_key", "customer_name", "nation_key", "value_segment"),
                            ["customer_key"])
    j = o.join(cust, "customer_key", "left")
    return j.select("order_key", "customer_key", "order_status", "total_price", "order_date", "order_priority",
                    "customer_name", "nation_key", "value_segment",
                    staging.map_values("order_status", staging.ORDER_STATUS_TITLE, "Unknown").alias("order_status_desc"),
                    F.year("order_date").alias("order_year"), F.quarter("order_date").alias("order_quarter"),
                    F.month("order_date").alias("order_month"), "_loaded_at", ctx.now().alias("_updated_at"))


def dim_current_year_orders(cat, ctx: RunContext = RunContext(), orders: DataFrame | None = None) -> DataFrame:
    """Orders within a year of the latest order day (scalar subquery as
    a broadcast one-row aggregate)."""
    d = orders if orders is not None else dim_orders(cat, ctx)
    cut = d.agg(F.add_months(F.to_date(F.max("order_date")), -12).alias("__cut"))
    return (d.crossJoin(F.broadcast(cut)).where(F.col("order_date") >= F.col("__cut")).drop("__cut")
            .sortWithinPartitions("order_key"))


def dim_current_year_open_orders(cat, ctx: RunContext = RunContext()) -> DataFrame:
    return dim_current_year_orders(cat, ctx).where(F.col("order_status") == "O")


def dim_customers_share(cat, ctx: RunContext = RunContext(), role: str = "PUBLIC") -> DataFrame:
    """Shareable column subset; the name is masked unless the role
    may see it."""
    from strata.operators.keys import masked
    d = dim_customers(cat, ctx)
    return d.select("customer_key", masked("customer_name", role).alias("customer_name"), "market_segment",
                    "nation_key", "nation_name", "region_key", "value_segment", "has_orders_flag")


def fct_order_lines(cat, ctx: RunContext = RunContext(), orders: DataFrame | None = None,
                    existing: DataFrame | None = None) -> DataFrame:
    """Order-line fact (J3, J4, P12; with ``existing``, K6: lines of orders
    dated after its last one): lines join orders on order_key
    (sort-merge, both sides hash-partitioned on the key, into tasks of a
    bounded number of lines), then the USD->EUR rate valid on the order day
    via the day-expanded interval join."""
    from strata.operators.interval_join import interval_join
    from strata.operators.tasks import dealt
    li = staging.stg_lineitem(cat, ctx)
    od = newer_than(orders if orders is not None else dim_orders(cat, ctx), existing, "order_date")
    od = od.select("order_key", "customer_key", "order_date", "order_status_desc")
    fx = silver.int_fx_rates_daily(cat, ctx).where((F.col("from_currency") == "USD") & (F.col("to_currency") == "EUR"))
    fx = fx.select("day_dt", "end_date", "conversion_rate")
    n = cat.lineitem.count()  # from the files' footers
    j = dealt(li, n, "order_key").join(dealt(od, n, "order_key"), "order_key", "inner")
    # Day span from the orders' date column alone (a two-value aggregate,
    # answered from one column), not from the joined facts.
    bounds = cat.orders.agg(F.min(F.to_date("o_orderdate")).alias("__lo"), F.max(F.to_date("o_orderdate")).alias("__hi"))
    j = interval_join(j, F.col("order_date"), fx, "day_dt", "end_date", how="left",
                      bounds=bounds).drop("day_dt", "end_date")
    disc = F.col("extended_price") * (1 - F.col("discount"))
    final = disc * (1 + F.col("tax"))
    rate = F.coalesce(F.col("conversion_rate"), F.lit(1.0).cast("decimal(18,6)"))
    return j.select("order_key", "line_number", "part_key", "supplier_key", "customer_key", "quantity",
                    "extended_price", "discount", "tax", disc.alias("discounted_price"), final.alias("final_price"),
                    rate.alias("eur_conversion_rate"), (final * rate.cast("double")).alias("final_price_eur"),
                    "return_flag", "line_status", "ship_date", "commit_date", "receipt_date", "order_date",
                    "order_status_desc", "_loaded_at", ctx.now().alias("_updated_at"))


from strata.functions.numeric import exact_avg, exact_product_sum, money_sum as _money_sum, round_half_up


def fct_order_lines_by_supplier_month(cat, ctx: RunContext = RunContext(),
                                      lines: DataFrame | None = None, approx_distinct: bool = False) -> DataFrame:
    """A7 monthly roll-up per supplier.  Sums are exact (order independent).
    ``approx_distinct`` counts orders with HyperLogLog++
    (``approx_count_distinct``, mergeable partial sketches, ~1% error), which
    avoids the extra aggregation level an exact distinct count needs."""
    fol = lines if lines is not None else fct_order_lines(cat, ctx)
    g = fol.groupBy("supplier_key", F.year("order_date").alias("order_year"),
                    F.month("order_date").alias("order_month"))
    orders = F.approx_count_distinct("order_key") if approx_distinct else F.count_distinct("order_key")
    a = g.agg(F.count(F.lit(1)).alias("total_order_lines"), orders.alias("total_orders"),
              _money_sum("quantity").alias("total_quantity"), _money_sum("extended_price").alias("total_extended_price"),
              _money_sum("discounted_price").alias("total_discounted_price"),
              _money_sum("final_price").alias("total_final_price"),
              exact_product_sum("final_price", "eur_conversion_rate").alias("total_final_price_eur"),
              exact_avg("quantity").alias("avg_quantity_per_line"),
              exact_avg("final_price").alias("avg_final_price_per_line"),
              exact_avg("discount").alias("avg_discount_rate"),
              F.min("ship_date").alias("earliest_ship_date"), F.max("ship_date").alias("latest_ship_date"))
    return a.select("supplier_key", "order_year", "order_month",
                    F.make_date("order_year", "order_month", F.lit(1)).alias("month_start_date"),
                    "total_order_lines", "total_orders", "total_quantity", "total_extended_price",
                    "total_discounted_price", "total_final_price", "total_final_price_eur",
                    "avg_quantity_per_line", "avg_final_price_per_line", "avg_discount_rate",
                    "earliest_ship_date", "latest_ship_date",
                    F.when(F.col("total_orders") > 0, F.col("total_order_lines").cast("double") / F.col("total_orders"))
                    .otherwise(F.lit(0.0)).alias("avg_lines_per_order"),
                    ctx.now().alias("_updated_at"))


def fact_order_line_pivot(cat, ctx: RunContext = RunContext(), lines: DataFrame | None = None,
                          years: list[int] | None = None) -> DataFrame:
    """Quantity by ship year as columns.  The distinct years (a
    handful of values) are fetched first unless given, so ``pivot`` does not
    run its own discovery job.  Few lines share supplier, part and year, so
    they are dealt into tasks of a bounded number of lines before the hash
    aggregates; a frequent pair is spread by day and quantity and summed in
    parts before its parts meet."""
    from strata.operators.tasks import dealt
    fol = lines if lines is not None else staging.stg_lineitem(cat, ctx).select(
        "supplier_key", "part_key", "ship_date", "quantity")
    spread = F.pmod(F.xxhash64("ship_date", "quantity"), F.lit(16)).alias("__spread")
    fol = fol.select("supplier_key", "part_key", F.year("ship_date").alias("ship_year"), "quantity", spread)
    if years is None:
        years = sorted(r[0] for r in fol.select("ship_year").distinct().collect() if r[0] is not None)
    n = fol.count()
    part = ["supplier_key", "part_key", "ship_year", "__spread"]
    sums = dealt(fol, n, *part).groupBy(*part).agg(F.sum("quantity").alias("quantity"))
    p = (dealt(sums, n, "supplier_key", "part_key").groupBy("supplier_key", "part_key")
         .pivot("ship_year", years).agg(F.sum("quantity")))
    for y in years:
        p = p.withColumnRenamed(str(y), f"shipped_{y}")
    return p.withColumn("last_update_ts", ctx.now())


def fact_order_line_full_reload(cat, ctx: RunContext = RunContext(), orders: DataFrame | None = None,
                                rates: DataFrame | None = None, existing: DataFrame | None = None) -> DataFrame:
    """Raw lines with order/customer keys (unknown ->
    ``ctx.unknown_key``), the USD->EUR rate of the order day (exact-day
    join on the calendar-expanded lookup), and the line integration id.
    Later runs replace the rows of their own source system in ``existing``
    and leave those of others.  Lines and orders meet in tasks of a bounded
    number of lines."""
    from strata.operators.keys import integration_key
    from strata.operators.merge import replace_slice
    from strata.operators.tasks import dealt
    from strata.plans.runlog import bounded_broadcast
    li = cat.lineitem
    od = orders if orders is not None else dim_orders(cat, ctx)
    od = od.select(F.col("order_key"), F.col("customer_key"), F.to_date("order_date").alias("__od"))
    fx = rates if rates is not None else silver.lookup_exchange_rates(cat, ctx)
    fx = fx.where((F.col("from_currency") == "USD") & (F.col("to_currency") == "EUR")).select(
        F.col("day_dt").alias("__od"), F.col("exchange_rate").alias("eur_conversion_rate"))
    # The looked-up rates hold one row per calendar day; a caller's rates are counted first.
    fx = F.broadcast(fx) if rates is None else bounded_broadcast(fx)
    n = li.count()  # from the files' footers
    j = (dealt(li, n, "l_orderkey").join(dealt(od, n, "order_key"), F.col("l_orderkey") == F.col("order_key"), "left")
         .join(fx, "__od", "left"))
    unk = F.lit(ctx.unknown_key).cast("long")
    rows = j.select(F.lit(ctx.source_system_code).alias("source_system_code"),
                    F.coalesce(F.col("order_key"), unk).alias("l_order_wid"),
                    F.coalesce(F.col("customer_key"), unk).alias("l_cust_wid"),
                    *[F.col(c) for c in li.columns], "eur_conversion_rate",
                    integration_key("l_orderkey", "l_linenumber").alias("integration_id"),
                    ctx.now().alias("insert_ts"), ctx.now().alias("last_update_ts"))
    return rows if existing is None else replace_slice(existing, rows, F.col("source_system_code") == ctx.source_system_code)


# Dashboard trend labels (rising, falling, flat).
TREND_LABELS = ("↗️ Increasing", "↘️ Decreasing", "➡️ Stable")


def executive_dashboard(cat, ctx: RunContext = RunContext(), facts: DataFrame | None = None) -> DataFrame:
    """A8 + W8 + W9: daily KPIs from the order facts.  The windows run over
    the daily aggregate (one row per day, bounded by the calendar, not by
    order volume), so their single ordered partition stays small."""
    from pyspark.sql import Window
    from strata.session import today_frame
    of = facts if facts is not None else silver.order_facts(cat, ctx)
    daily = of.groupBy("order_date", "order_year", "order_month", "order_quarter").agg(
        _money_sum("total_order_value").alias("daily_revenue"), F.sum("order_count").alias("daily_orders"),
        F.sum("unique_customers").alias("daily_active_customers"),
        F.avg(F.col("avg_order_value").cast("decimal(38,10)")).alias("daily_avg_order_value"),
        _money_sum("revenue_o_status").alias("open_revenue"), _money_sum("revenue_f_status").alias("fulfilled_revenue"),
        _money_sum("revenue_p_status").alias("partial_revenue"))
    w = Window.orderBy("order_date")
    daily = daily.withColumn("prev_day_revenue", F.lag("daily_revenue").over(w)).withColumn(
        "seven_day_avg_revenue", F.avg("daily_revenue").over(w.rowsBetween(-6, 0)))
    rev, prev, avg7 = F.col("daily_revenue"), F.col("prev_day_revenue"), F.col("seven_day_avg_revenue")
    pct = lambda num, den, p: round_half_up(num / F.nullif(den, F.lit(0.0)) * 100, p)
    kpis = daily.select(
        F.col("order_date").alias("metric_date"), rev.alias("total_revenue"), F.col("daily_orders").alias("total_orders"),
        round_half_up("daily_avg_order_value", 2).alias("avg_order_value"),
        F.col("daily_active_customers").alias("active_customers"),
        round_half_up(avg7, 6).alias("7-Day Average Revenue"),
        F.when(prev > 0, round_half_up((rev - prev) / prev * 100, 2)).alias("Daily Revenue Growth %"),
        round_half_up(rev / F.nullif(F.col("daily_orders").cast("double"), F.lit(0.0)), 2).alias("Revenue per Order"),
        round_half_up(rev / F.nullif(F.col("daily_active_customers").cast("double"), F.lit(0.0)), 2).alias("Revenue per Customer"),
        pct(F.col("fulfilled_revenue"), rev, 1).alias("Fulfillment Rate %"),
        pct(F.col("open_revenue"), rev, 1).alias("Open Orders %"),
        pct(F.col("partial_revenue"), rev, 1).alias("Partial Orders %"),
        F.when(rev > avg7 * 1.2, "Excellent").when(rev > avg7 * 1.1, "Good").when(rev > avg7 * 0.9, "Average")
         .otherwise("Below Average").alias("Performance Rating"),
        F.when(rev > prev, TREND_LABELS[0]).when(rev < prev, TREND_LABELS[1]).otherwise(TREND_LABELS[2]).alias("Trend"),
        F.col("order_year").alias("Year"), F.col("order_quarter").alias("Quarter"), F.col("order_month").alias("Month"))
    today = today_frame(ctx, cat.orders)
    return (kpis.crossJoin(F.broadcast(today)).where(F.col("metric_date") >= F.add_months(F.col("__today"), -24))
            .drop("__today").orderBy(F.col("metric_date").desc()))
