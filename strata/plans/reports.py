"""Quality suites and run reports (D1-D16 applied to the staged tables;
segment shares, top customers, calendar range and change mix)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators import quality as Q
from strata.plans import gold, history, silver, staging
from strata.session import RunContext

# Accepted code sets from the reference's column tests.
MARKET_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
ORDER_STATUSES = ("O", "F", "P")
RETURN_FLAGS = ("A", "N", "R")
LINE_STATUSES = ("F", "O")


def staging_checks(cat, ctx: RunContext = RunContext()) -> list[Q.Check]:
    """The column and table tests of the staged layer as Check objects."""
    c = staging.stg_customers(cat, ctx)
    o = staging.stg_orders(cat, ctx)
    li = staging.stg_lineitem(cat, ctx)
    n = staging.stg_nations(cat, ctx)
    rc, fc = Q.row_check, Q.frame_check
    return [
        rc("customers_key_not_null", "stg_customers", c, Q.null_pred("customer_key"), "customer_key"),
        fc("customers_key_unique", "stg_customers", c, lambda d: Q.unique(d, "customer_key"), "customer_key"),
        rc("customers_segment_accepted", "stg_customers", c,
           Q.accepted_values_pred("market_segment", MARKET_SEGMENTS), "market_segment"),
        rc("customers_name_not_empty", "stg_customers", c, Q.empty_string_pred("customer_name"), "customer_name"),
        rc("customers_balance_range", "stg_customers", c, Q.range_pred("account_balance", -999.99, 9999.99),
           "account_balance", severity="warn"),
        fc("customers_nation_fk", "stg_customers", c,
           lambda d: Q.relationships(d, "nation_key", n, "nation_key"), "nation_key"),
        rc("orders_key_not_null", "stg_orders", o, Q.null_pred("order_key"), "order_key"),
        fc("orders_key_unique", "stg_orders", o, lambda d: Q.unique(d, "order_key"), "order_key"),
        rc("orders_status_accepted", "stg_orders", o, Q.accepted_values_pred("order_status", ORDER_STATUSES),
           "order_status"),
        rc("orders_price_non_negative", "stg_orders", o, Q.expression_pred("total_price >= 0"), "total_price"),
        fc("orders_customer_fk", "stg_orders", o,
           lambda d: Q.relationships(d, "customer_key", c, "customer_key"), "customer_key"),
        fc("lineitem_key_unique_combination", "stg_lineitem", li,
           lambda d: Q.unique_combination_of_columns(d, "order_key", "line_number"), "order_key,line_number",
           severity="warn"),
        fc("lineitem_order_fk", "stg_lineitem", li,
           lambda d: Q.relationships(d, "order_key", o, "order_key"), "order_key"),
        rc("lineitem_quantity_positive", "stg_lineitem", li, Q.non_positive_pred("quantity"), "quantity"),
        rc("lineitem_discount_range", "stg_lineitem", li, Q.range_pred("discount", 0, 1), "discount"),
        rc("lineitem_return_flag_accepted", "stg_lineitem", li,
           Q.accepted_values_pred("return_flag", RETURN_FLAGS), "return_flag"),
        rc("lineitem_line_status_accepted", "stg_lineitem", li,
           Q.accepted_values_pred("line_status", LINE_STATUSES), "line_status"),
        fc("nations_primary_key", "stg_nations", n, lambda d: Q.primary_key(d, "nation_key"), "nation_key"),
        rc("nations_name_not_empty", "stg_nations", n, Q.empty_string_pred("nation_name"), "nation_name"),
    ]


def quality_summary(cat, ctx: RunContext = RunContext()) -> DataFrame:
    """One row per staged-layer check: failures and pass/warn/fail."""
    return Q.run_checks(staging_checks(cat, ctx))


def lineitem_duplicate_keys(cat, ctx: RunContext = RunContext()) -> DataFrame:
    """Failing keys of the (order_key, line_number) uniqueness test."""
    return Q.unique_combination_of_columns(staging.stg_lineitem(cat, ctx), "order_key", "line_number")


def customer_balance_distribution(cat, ctx: RunContext = RunContext(), threshold_pct: float = 10.0) -> DataFrame:
    """A row only when more than ``threshold_pct`` % of customers have a
    negative balance."""
    return Q.share_above(cat.customer, F.col("c_acctbal") < 0, threshold_pct, "negative_balance_check",
                         "negative_balance_customers", "total_customers", "negative_balance_percentage")


def segment_distribution(cat, ctx: RunContext = RunContext(), segments: DataFrame | None = None) -> DataFrame:
    """Customers per segment and share of all customers.  The total is
    an un-partitioned window over the *aggregated* rows (one per segment),
    so the single-partition step sees five rows, not the customers."""
    seg = segments if segments is not None else silver.customer_segments(cat, ctx)
    g = seg.groupBy("customer_segment").agg(F.count(F.lit(1)).alias("customer_count"))
    total = F.sum("customer_count").over(Window.partitionBy())
    return g.select("customer_segment", "customer_count",
                    F.round(F.col("customer_count") * 100.0 / total, 1).alias("pct")) \
        .orderBy(F.col("customer_count").desc(), "customer_segment")


def top_customers(cat, ctx: RunContext = RunContext(), n: int = 10, insights: DataFrame | None = None) -> DataFrame:
    """O2 top-k report (the limit is the feature): planned as
    TakeOrderedAndProject, a per-task top-k merged on the driver side of
    the final stage, never a full sort."""
    ins = insights if insights is not None else gold.customer_insights(cat, ctx)
    return (ins.select("customer_key", "customer_name", "customer_tier", "risk_category", "country",
                       "account_balance")
            .orderBy(F.col("account_balance").desc(), "customer_key").limit(n))


def calendar_range(cat, ctx: RunContext = RunContext(), calendar: DataFrame | None = None) -> DataFrame:
    """First and last day and day count of the calendar dimension (ghost row
    excluded)."""
    from strata.plans.calendar import data_calendar
    cal = calendar if calendar is not None else data_calendar(cat, ctx)
    return cal.where(F.col("day_key") != 0).agg(F.min("day_dt").alias("start_date"), F.max("day_dt").alias("end_date"),
                                                F.count(F.lit(1)).alias("total_days"))


def cdc_change_mix(cat, ctx: RunContext = RunContext(), changes: DataFrame | None = None) -> DataFrame:
    """Change rows per change type (default: the feed between the first two
    customer loads)."""
    ch = changes if changes is not None else history.customer_change_feed(cat, ctx)
    return ch.groupBy("cdc_change_type").agg(F.count(F.lit(1)).alias("change_count")) \
        .orderBy(F.col("change_count").desc(), "cdc_change_type")


def e2e_assertions(cat, ctx: RunContext = RunContext()) -> DataFrame:
    """The end-to-end count assertions of a full build, scaled to the
    data: staged customers and orders equal the sources, five segments,
    one FX interval per USD rate row, no unclassified customer."""
    from strata.sources.standins import fx_rates
    cust, orders = cat.customer, cat.orders
    segs = silver.customer_segments(cat, ctx)
    fx = fx_rates(orders)
    counts = {
        "customers_staged": staging.stg_customers(cat, ctx),
        "orders_staged": staging.stg_orders(cat, ctx),
        "customer_segments_distinct": segs.select("customer_segment").distinct(),
        "fx_usd_rows": fx.where(F.col("base_currency") == "USD"),
        "fx_intervals_usd": silver.int_fx_rates_daily(cat, ctx).where(F.col("from_currency") == "USD"),
        "null_customer_classifications": gold.customer_insights(cat, ctx, segs)
        .where(F.col("customer_classification").isNull()),
    }
    n_cust = cust.select("c_custkey").distinct()
    exp_parts = {
        "customers_staged": ("==", n_cust), "orders_staged": ("==", orders),
        "customer_segments_distinct": ("==", 5), "fx_usd_rows": (">", 0),
        "fx_intervals_usd": ("==", fx.where(F.col("base_currency") == "USD")),
        "null_customer_classifications": ("==", 0),
    }
    parts = []
    for name, df in counts.items():
        op, exp = exp_parts[name]
        actual = df.agg(F.count(F.lit(1)).alias("actual"))
        if isinstance(exp, DataFrame):
            e = exp.agg(F.count(F.lit(1)).alias("expected"))
        else:
            e = actual.sparkSession.range(1).select(F.lit(exp).cast("long").alias("expected"))
        a, x = F.col("actual"), F.col("expected")
        ok = {"==": a == x, ">": a > x, ">=": a >= x}[op]
        parts.append(actual.crossJoin(e).select(F.lit(name).alias("assertion"), "actual", F.lit(op).alias("op"),
                                                "expected", ok.alias("passed")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def segment_statements(cat, ctx: RunContext = RunContext()) -> DataFrame:
    """M4 over the supplied tables: a query generates one aggregate
    statement per market segment, and the statements run as one unioned
    job (failures would be reported, not dropped)."""
    from strata.operators.bulk import combine_statements, statements_from
    spark = cat.spark
    cat.customer.createOrReplaceTempView("strata_customer")
    seg = F.regexp_replace("c_mktsegment", "'", "''")  # quoted as a SQL literal
    gen = cat.customer.select("c_mktsegment").distinct().where(F.col("c_mktsegment").isNotNull()).select(
        F.concat(F.lit("SELECT '"), seg, F.lit("' AS market_segment, count(*) AS customers, "
                 "CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS total_balance, "
                 "min(c_acctbal) AS min_balance, max(c_acctbal) AS max_balance "
                 "FROM strata_customer WHERE c_mktsegment = '"), seg, F.lit("'")))
    out, errors = combine_statements(spark, statements_from(gen))
    if out is None:
        raise ValueError("no statement could be analysed")
    return out
