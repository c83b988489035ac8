"""History-keeping datasets: hash-detected Type 1 dimensions with surrogate
keys and ghost rows, customer change capture and consumption, Type 2
snapshots, and the hybrid dimension / date-range fact loads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.cdc import change_feed, consume_changes
from strata.operators.keys import integration_key, row_hash, with_ghost_row
from strata.operators.merge import replace_date_range
from strata.operators.scd import hybrid_dimension_load, scd1_apply, scd2_snapshot
from strata.plans import gold, silver, staging
from strata.session import RunContext, today_frame

# Run stamps used by the registered two-load examples (run parameters).
LOAD_TS = (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3))


def _scd_customer_source(cat, ctx: RunContext, hash_flags: bool, customers: DataFrame | None = None) -> DataFrame:
    c = customers if customers is not None else staging.stg_customers(cat, ctx).drop("_loaded_at")
    o = silver.int_customers_with_orders(cat, ctx)
    j = c.join(o, "customer_key", "left")
    has_o = F.when(F.col("order_count") > 0, "Y").otherwise("N")
    has_open = F.when(F.col("open_order_count") > 0, "Y").otherwise("N")
    j = j.select("customer_key", "customer_name", "nation_key", "account_balance", "market_segment",
                 has_o.alias("has_orders_flag"), has_open.alias("has_open_orders_flag"),
                 "order_count", "open_order_count")
    hashed = ["customer_name", "nation_key", "account_balance", "market_segment"]
    if hash_flags:
        hashed += ["has_orders_flag", "has_open_orders_flag"]
    return j.withColumn("integration_id", integration_key("customer_key")).withColumn("cdc_hash_key", row_hash(*hashed))


def dim_customers_hashed(cat, ctx: RunContext = RunContext(), existing: DataFrame | None = None,
                         hash_flags: bool = False) -> DataFrame:
    """K4 hash-detected customer dimension: new integration ids get
    surrogate keys above the current maximum; changed rows keep their key and
    first-insert stamp.  Returns the next table version."""
    src = _scd_customer_source(cat, ctx, hash_flags)
    return scd1_apply(src, existing, integration_key="integration_id", hash_key="cdc_hash_key",
                      surrogate_key="customer_surrogate_key", order_by=["customer_key"], run_ts=ctx.now())


# Ghost (unknown-member) rows of the macro-built dimensions.
CUSTOMER_GHOST = {"customer_surrogate_key": 0, "customer_key": 0, "customer_name": "Unknown",
                  "has_orders_flag": "N", "has_open_orders_flag": "N"}
ORDER_GHOST = {"o_order_wid": 0, "o_cust_wid": 0}


def dim_customers_macro_example(cat, ctx: RunContext = RunContext(), existing: DataFrame | None = None) -> DataFrame:
    """K2-K5: integration key, change hash, surrogate key and ghost row."""
    return with_ghost_row(dim_customers_hashed(cat, ctx, existing), "customer_surrogate_key", CUSTOMER_GHOST)


def dim_orders_macro_example(cat, ctx: RunContext = RunContext(), existing: DataFrame | None = None,
                             recent_days: int = 90) -> DataFrame:
    """K8 + K4 + K5: orders with the customer key looked up (unknown ->
    ``ctx.unknown_key``); later runs only consider orders of the last
    ``recent_days`` or still open."""
    o = cat.orders
    cust = gold.dim_customers(cat, ctx).select("customer_key")
    j = o.join(cust, o.o_custkey == cust.customer_key, "left")
    wid = F.coalesce(F.col("customer_key"), F.lit(ctx.unknown_key).cast("long"))
    src = j.select(*o.columns, wid.alias("o_cust_wid"))
    if existing is not None:
        today = today_frame(ctx, o)
        src = (src.crossJoin(F.broadcast(today))
               .where((F.to_date("o_orderdate") >= F.date_sub("__today", recent_days)) | (F.col("o_orderstatus") == "O"))
               .drop("__today"))
    src = src.withColumn("integration_id", integration_key("o_orderkey")).withColumn(
        "cdc_hash_key", row_hash(*[c for c in o.columns if c != "o_orderkey"], "o_cust_wid"))
    nxt = scd1_apply(src, existing, integration_key="integration_id", hash_key="cdc_hash_key",
                     surrogate_key="o_order_wid", order_by=["o_orderkey"], run_ts=ctx.now())
    return with_ghost_row(nxt, "o_order_wid", ORDER_GHOST)


# Market segment a changed customer moves to (second load).
SEGMENT_SWAP = ("HOUSEHOLD", "BUILDING")


def customer_load(cat, n: int = 1) -> DataFrame:
    """Successive source loads derived from ``customer`` (FIXTURES.md §3):
    load 2 raises balances of keys ending in 1 by 100, moves keys ending in 2
    to another segment, drops keys ending in 3 and adds a copy of keys ending
    in 4 above the maximum key; load 3 is load 2 with the dropped keys back."""
    c = cat.customer.select(F.col("c_custkey").alias("customer_key"), F.col("c_name").alias("customer_name"),
                            F.col("c_acctbal").alias("account_balance"), F.col("c_mktsegment").alias("market_segment"),
                            F.col("c_nationkey").alias("nation_key"))
    if n == 1:
        return c
    d = F.col("customer_key") % 10
    seg = F.when(F.col("market_segment") == SEGMENT_SWAP[0], SEGMENT_SWAP[1]).otherwise(SEGMENT_SWAP[0])
    changed = c.select("customer_key", "customer_name",
                       F.when(d == 1, F.col("account_balance") + 100).otherwise(F.col("account_balance")).alias("account_balance"),
                       F.when(d == 2, seg).otherwise(F.col("market_segment")).alias("market_segment"), "nation_key")
    kept = changed.where(d != 3)
    mx = c.agg(F.max("customer_key").alias("__mx"))
    added = (c.where(d == 4).crossJoin(F.broadcast(mx))
             .select((F.col("customer_key") + F.col("__mx") + 1).alias("customer_key"),
                     F.concat(F.col("customer_name"), F.lit("-new")).alias("customer_name"),
                     "account_balance", "market_segment", "nation_key"))
    load2 = kept.unionByName(added)
    if n == 2:
        return load2
    return load2.unionByName(c.where(d == 3))


def customer_cdc_stream(cat, ctx: RunContext = RunContext(), incremental: bool = False,
                        sample_percent: float = 10.0, seed: int = 42) -> DataFrame:
    """Change stream of the customer table: every row as INSERT, version =
    key text (the original's initial rows).  Later (``incremental``) runs
    load a random ``sample_percent`` % row sample (S4), to be appended to
    the stream table (S11)."""
    from strata.operators.sampling import percent_sample
    c = customer_load(cat, 1).select("customer_key", "customer_name", "account_balance")
    if incremental:
        c = percent_sample(c, sample_percent, seed)
    return change_feed(None, c, ["customer_key"], ctx.now(), version=F.col("customer_key").cast("string"))


def customer_change_feed(cat, ctx: RunContext = RunContext(), from_load: int = 1, to_load: int = 2) -> DataFrame:
    """K9 between two loads; version = target load number."""
    return change_feed(customer_load(cat, from_load), customer_load(cat, to_load), ["customer_key"],
                       F.lit(LOAD_TS[to_load - 1]).cast("timestamp_ntz"), version=F.lit(str(to_load)))


def dim_customer_changes(cat, ctx: RunContext = RunContext(), existing_log: DataFrame | None = None) -> DataFrame:
    """K10 consumer of the change feed (newest change per key, delete flag,
    log ids above the log's maximum)."""
    return consume_changes(customer_change_feed(cat, ctx), ["customer_key"], existing_log)


def customers_snapshot(cat, ctx: RunContext = RunContext(), loads: int = 2, hard_deletes: str = "invalidate") -> DataFrame:
    """K11 check-strategy Type 2 history after ``loads`` successive loads."""
    hist = None
    for i in range(1, loads + 1):
        hist = scd2_snapshot(hist, customer_load(cat, i), ["customer_key"], strategy="check",
                             check_cols=["customer_name", "account_balance", "market_segment"],
                             run_ts=F.lit(LOAD_TS[i - 1]).cast("timestamp_ntz"), hard_deletes=hard_deletes,
                             current_flag="current_flag")
    return hist


def staging_customer(cat, n: int = 1) -> DataFrame:
    """STAGING.CUSTOMER stand-in: customer load joined to nation and region."""
    c = customer_load(cat, n)
    geo = cat.nation.join(F.broadcast(cat.region), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("nation_key"), F.col("n_name").alias("country"), F.col("r_name").alias("region"))
    return c.join(F.broadcast(geo), "nation_key", "left").select(
        F.col("customer_key").alias("customer_business_key"), "customer_name",
        F.col("market_segment").alias("customer_segment"), "region", "country", "account_balance")


def customer_dim_load(cat, ctx: RunContext = RunContext(), loads: int = 2) -> tuple[DataFrame, DataFrame]:
    """K16 hybrid load run ``loads`` times; returns (dimension, counts of
    the last run)."""
    dim, counts = None, None
    for i in range(1, loads + 1):
        dim, counts = hybrid_dimension_load(
            dim, staging_customer(cat, i), "customer_business_key",
            ["customer_name", "customer_segment", "region", "country"], ["account_balance"],
            F.lit(LOAD_TS[i - 1]).cast("timestamp_ntz"))
    return dim, counts


def staging_sales_order(cat) -> DataFrame:
    """STAGING.SALESORDER stand-in: lines joined to their orders."""
    li, o = cat.lineitem, cat.orders
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    unit = F.col("l_extendedprice") / F.nullif(F.col("l_quantity"), F.lit(0.0))
    return j.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("source_order_id"),
                    F.col("l_orderkey").alias("order_number"), F.col("l_linenumber").alias("order_line_number"),
                    F.to_date("o_orderdate").alias("order_date"), F.to_date("l_shipdate").alias("ship_date"),
                    F.col("o_custkey").alias("customer_id"), F.col("l_partkey").alias("product_id"),
                    F.col("l_quantity").alias("quantity"), unit.alias("unit_price"), (unit * 0.7).alias("unit_cost"),
                    (F.col("l_extendedprice") * F.col("l_discount")).alias("discount_amount"),
                    F.lit(1).alias("batch_id"))


def sales_fact_rows(staging_rows: DataFrame, date_dim: DataFrame, customer_dim: DataFrame,
                    product_dim: DataFrame | None = None, unknown_key: int = -1,
                    load_ts=None) -> DataFrame:
    """Role-playing date lookups (order and ship day), current
    customer version, product; missing keys -> ``unknown_key``; sales,
    cost and gross profit with a null discount counted as 0.  The dimensions
    are keyed lookups: the date dimension (bounded by its calendar) and
    current customer rows join by key; AQE picks broadcast or shuffle."""
    from strata.plans.runlog import bounded_broadcast
    unk = F.lit(unknown_key).cast("long")
    dd = date_dim.select(F.col("day_dt").alias("__d"), F.col("day_key").cast("long").alias("__dk"))
    dd = bounded_broadcast(dd)  # a caller's calendar: counted before it is sent
    od, sd = dd.alias("__od"), dd.alias("__sd")
    cur = customer_dim.where(F.col("is_current")).select(
        F.col("customer_business_key").alias("__cbk"), F.col("customer_key").alias("__ck"))
    s = staging_rows.join(od, F.col("order_date") == F.col("__od.__d"), "left") \
        .join(sd, F.col("ship_date") == F.col("__sd.__d"), "left") \
        .join(cur, F.col("customer_id") == F.col("__cbk"), "left")
    prod = F.lit(None).cast("long")
    if product_dim is not None:
        p = product_dim.select(F.col("product_business_key").alias("__pbk"), F.col("product_key").alias("__pk"))
        s = s.join(p, F.col("product_id") == F.col("__pbk"), "left")
        prod = F.col("__pk")
    sales = F.col("quantity") * F.col("unit_price") - F.coalesce(F.col("discount_amount"), F.lit(0.0))
    cost = F.col("quantity") * F.col("unit_cost")
    return s.select(F.coalesce(F.col("__od.__dk"), unk).alias("order_date_key"),
                    F.coalesce(F.col("__sd.__dk"), unk).alias("ship_date_key"),
                    F.coalesce(F.col("__ck"), unk).alias("customer_key"),
                    F.coalesce(prod, unk).alias("product_key"),
                    "order_number", "order_line_number", "quantity", "unit_price", "unit_cost", "discount_amount",
                    sales.alias("sales_amount"), cost.alias("cost_amount"), (sales - cost).alias("gross_profit"),
                    F.col("source_order_id").alias("source_system_key"), "order_date",
                    (load_ts if load_ts is not None else F.localtimestamp()).alias("load_date"), "batch_id")


def load_fact_sales(fact: DataFrame | None, staging_rows: DataFrame, date_dim: DataFrame, customer_dim: DataFrame,
                    load_date: dt.date, product_dim: DataFrame | None = None, unknown_key: int = -1,
                    load_ts=None) -> DataFrame:
    """Staging rows dated on/after ``load_date`` replace the fact rows
    in their [min, max] order-date range; empty batch -> unchanged."""
    batch = staging_rows.where(F.col("order_date") >= F.lit(load_date))
    rows = sales_fact_rows(batch, date_dim, customer_dim, product_dim, unknown_key, load_ts)
    if fact is None:
        return rows
    return replace_date_range(fact, rows, "order_date")


def fact_load_orphans(staging_rows: DataFrame, customer_dim: DataFrame, load_ts=None) -> DataFrame:
    """Distinct staging rows whose customer has no current dimension row."""
    cur = customer_dim.where(F.col("is_current")).select(F.col("customer_business_key").alias("customer_id"))
    miss = staging_rows.where(F.col("customer_id").isNotNull()).join(cur, "customer_id", "left_anti")
    return miss.select(F.lit("FactSales").alias("table_name"), F.col("source_order_id").alias("source_key"),
                       F.lit("Customer").alias("orphan_type"), F.col("customer_id").cast("string").alias("orphan_value"),
                       (load_ts if load_ts is not None else F.localtimestamp()).alias("load_date")).distinct()


def stream_snapshot_source(changes: DataFrame) -> DataFrame:
    """Snapshot source from a change set: the before-image half of updates
    dropped, the newest change per key kept (insert side over delete on
    equal commit time), a delete flag, and the commit time as updated_at."""
    from strata.operators.dedup import keep_one_per_key
    c = changes.where(F.col("cdc_change_type") != "UPDATE_BEFORE").withColumn(
        "__prio", F.when(F.col("cdc_change_type") == "DELETE", 0).otherwise(1))
    c = keep_one_per_key(c, ["customer_key"], order_by=["cdc_commit_ts", "__prio"], descending=True)
    return c.select(F.col("customer_key").alias("c_custkey"), F.col("customer_name").alias("c_name"),
                    F.col("account_balance").alias("c_acctbal"), F.col("cdc_change_type").alias("cdc_action"),
                    F.col("cdc_commit_ts").alias("c_last_update_date"),
                    F.when(F.col("cdc_change_type") == "DELETE", "Y").otherwise("N").alias("delete_flag"))


def customers_stream_snapshot(cat, ctx: RunContext = RunContext(), loads: int = 2) -> DataFrame:
    """K12 timestamp-strategy Type 2 history fed by the change stream: the
    initial rows (all inserts at the first load time), then the change set
    of each later load.  Keys absent from a change set stay open (hard
    deletes arrive as DELETE change rows and open a flagged version)."""
    first = change_feed(None, customer_load(cat, 1).select("customer_key", "customer_name", "account_balance",
                                                             "market_segment", "nation_key"),
                        ["customer_key"], F.lit(LOAD_TS[0]).cast("timestamp_ntz"))
    hist = scd2_snapshot(None, stream_snapshot_source(first), ["c_custkey"], strategy="timestamp",
                         updated_at="c_last_update_date")
    for i in range(2, loads + 1):
        hist = scd2_snapshot(hist, stream_snapshot_source(customer_change_feed(cat, ctx, i - 1, i)), ["c_custkey"],
                             strategy="timestamp", updated_at="c_last_update_date")
    return hist


def dim_customers_scd1_changes(cat, ctx: RunContext = RunContext(), hash_flags: bool = False) -> DataFrame:
    """K4 change set of the second customer load against the first version
    of the hash-detected dimension: new integration ids with surrogate keys
    above the stored maximum, and changed rows (hash differs) keeping their
    surrogate key and first-insert stamp.  Unchanged rows are absent."""
    from strata.operators.scd import scd1_changes
    first = dim_customers_hashed(cat, ctx, hash_flags=hash_flags)
    src2 = _scd_customer_source(cat, ctx, hash_flags, customers=customer_load(cat, 2))
    return scd1_changes(src2, first, integration_key="integration_id", hash_key="cdc_hash_key",
                        surrogate_key="customer_surrogate_key", order_by=["customer_key"],
                        run_ts=F.lit(LOAD_TS[1]).cast("timestamp_ntz"))
