"""Silver layer: business logic over staged data."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.numeric import cents, div_half_up, money_sum
from strata.operators.ranking import rank_rows
from strata.plans import staging
from strata.session import RunContext


def int_customers_with_orders(cat, ctx: RunContext = RunContext()) -> DataFrame:
    """A1: orders and open orders per customer (hash aggregate, map-side combine)."""
    o = staging.stg_orders(cat, ctx)
    return o.groupBy("customer_key").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum(F.when(F.col("order_status") == "O", 1).otherwise(0)).cast("long").alias("open_order_count"))


def segment_label(p):
    """P3 percentile bins, first match wins."""
    return (F.when(p >= 0.9, "PREMIUM").when(p >= 0.7, "HIGH_VALUE").when(p >= 0.3, "STANDARD")
            .when(p >= 0.1, "BASIC").otherwise("LOW_VALUE"))


def customer_segments(cat, ctx: RunContext = RunContext(), valid_only: bool = False) -> DataFrame:
    """W1-W3 + P3.  Global percent_rank and per-nation row_number use the
    range-partitioned ranking operator (no single-partition window); nation
    mean/stddev is a grouped aggregate broadcast back (one row per nation)."""
    if valid_only:
        c = staging.stg_customers_with_tests(cat, ctx).where(F.col("data_quality_flag") == "VALID").select(
            F.col("c_custkey").alias("customer_key"), F.col("c_name").alias("customer_name"),
            F.col("c_nationkey").alias("nation_key"), F.col("c_acctbal").alias("account_balance"),
            F.col("c_mktsegment").alias("market_segment"))
    else:
        c = staging.stg_customers(cat, ctx).drop("_loaded_at")
    ranked = rank_rows(c, ["account_balance"], tiebreak=["customer_key"], outputs=("percent_rank",))
    ranked = ranked.withColumnRenamed("percent_rank", "balance_percentile")
    ranked = rank_rows(ranked, ["account_balance"], descending=[True], partition_by=["nation_key"],
                       tiebreak=["customer_key"], outputs=("row_number",), prefix="n_")
    ranked = ranked.withColumnRenamed("n_row_number", "balance_rank_in_nation")
    # Money averages are exact: sums in integer cents, rounded half-up in
    # long arithmetic (balances carry two decimals, like NUMBER(12,2)).
    stats = c.groupBy("nation_key").agg(F.avg("account_balance").alias("avg_nation_balance"),
                                        F.stddev_samp("account_balance").alias("stddev_nation_balance"),
                                        F.sum(cents("account_balance")).alias("__sum_c"),
                                        F.count("account_balance").alias("__n_c"))
    m = ranked.join(F.broadcast(stats), "nation_key", "left")
    m = m.withColumn("__dev_c", cents("account_balance") * F.col("__n_c") - F.col("__sum_c"))
    bal, avg, sd = F.col("account_balance"), F.col("avg_nation_balance"), F.col("stddev_nation_balance")
    rank_in_nation = F.col("balance_rank_in_nation")
    return m.select(
        "customer_key", "customer_name", "nation_key", "account_balance", "market_segment",
        segment_label(F.col("balance_percentile")).alias("customer_segment"),
        F.when(rank_in_nation <= 10, "TOP_10_IN_NATION").when(rank_in_nation <= 100, "TOP_100_IN_NATION")
         .otherwise("STANDARD_IN_NATION").alias("nation_ranking"),
        F.when(bal > avg + sd, "ABOVE_AVERAGE").when(bal < avg - sd, "BELOW_AVERAGE")
         .otherwise("AVERAGE").alias("statistical_class"),
        "balance_percentile", "balance_rank_in_nation",
        (div_half_up("__sum_c", "__n_c") / 100).alias("avg_nation_balance"),
        (div_half_up("__dev_c", "__n_c") / 100).alias("balance_vs_nation_avg"),
        ctx.now().alias("processed_at"))


# Ntile cluster number -> name (M2).
CLUSTER_NAMES = ("Premium Elite", "High Value Stable", "Growth Potential", "Standard Base", "At Risk")
CLUSTER_FEATURES = '["ACCOUNT_BALANCE", "BALANCE_PERCENTILE", "BALANCE_RANK_IN_NATION"]'


def cluster_names(names: tuple[str, ...], k: int) -> tuple[str, ...]:
    """The given names if there is one for each of k clusters, else numbers."""
    return names if k == len(names) else tuple(f"Cluster {i + 1}" for i in range(k))


def customer_clustering_ntile(cat, ctx: RunContext = RunContext(), segments: DataFrame | None = None,
                              k: int = 5) -> DataFrame:
    """M2: ntile(k) over percentile (desc, customer key breaks ties), minus 1;
    z-distance to the bucket mean; outlier above 2; confidence against the
    global maximum distance (a one-row aggregate, broadcast)."""
    seg = segments if segments is not None else customer_segments(cat, ctx)
    base = seg.select("customer_key", "customer_name", "nation_key", "account_balance", "balance_percentile",
                      "balance_rank_in_nation", "customer_segment", "market_segment")
    nt = rank_rows(base, ["balance_percentile"], descending=[True], tiebreak=["customer_key"],
                   outputs=(), ntiles=(k,), prefix="c_")
    nt = nt.withColumn("ml_cluster", F.col(f"c_ntile_{k}") - 1).drop(f"c_ntile_{k}")
    stats = nt.groupBy("ml_cluster").agg(F.avg("account_balance").alias("center_balance"),
                                         F.stddev_samp("account_balance").alias("stddev_balance"))
    scored = nt.join(F.broadcast(stats), "ml_cluster")
    dist = F.abs(F.col("account_balance") - F.col("center_balance")) / F.nullif(F.col("stddev_balance"), F.lit(0.0))
    scored = scored.withColumn("__d", dist)
    dmax = scored.agg(F.max("__d").alias("__dmax"))
    name = F.element_at(F.array(*[F.lit(n) for n in cluster_names(CLUSTER_NAMES, k)]), (F.col("ml_cluster") + 1).cast("int"))
    out = scored.crossJoin(F.broadcast(dmax))
    return out.select(
        "customer_key", "customer_name", "nation_key", "account_balance", "balance_percentile",
        "balance_rank_in_nation", "customer_segment", "market_segment", "ml_cluster",
        name.alias("cluster_name"),
        F.round("__d", 4).alias("distance_to_cluster_center"),
        F.coalesce(F.col("__d") > 2.0, F.lit(False)).alias("is_cluster_outlier"),
        F.round(1.0 - F.least(F.col("__d") / F.nullif(F.col("__dmax"), F.lit(0.0)), F.lit(1.0)), 4)
         .alias("ml_confidence_score"),
        F.lit("1.0").alias("ml_model_version"),
        F.lit("KMeans_NTILE_approx").alias("clustering_algorithm"),
        F.lit(k).alias("n_clusters_used"),
        F.lit(CLUSTER_FEATURES).alias("features_used"))


# Pivoted order statuses and priorities of the order facts.
ORDER_STATUSES = ("O", "F", "P")
PRIORITY_LEVELS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def order_facts(cat, ctx: RunContext = RunContext(), orders: DataFrame | None = None) -> DataFrame:
    """A2-A4: daily order facts by customer/status/priority with generated
    conditional aggregates (one pass, one hash aggregate).  Sums run in
    exact decimal and are returned as double, so results do not depend on
    the order partial sums are combined in.  Few orders share customer and
    day, so they are dealt into tasks of a bounded number of orders before
    the hash aggregates."""
    from strata.operators.tasks import dealt
    o = orders if orders is not None else staging.stg_orders_incremental(cat, ctx)
    n = (orders if orders is not None else cat.orders).count()  # from the files' footers
    o = o.where(F.col("processing_type").isin("RECENT", "FULL_LOAD")).select(
        F.to_date("o_orderdate").alias("order_date"), F.col("o_custkey").alias("customer_key"),
        F.col("o_orderstatus").alias("order_status"), F.col("o_orderpriority").alias("order_priority"), "o_totalprice")
    o = dealt(o, n, "customer_key", "order_date", "order_status", "order_priority")
    price = F.col("o_totalprice")
    aggs = [F.count(F.lit(1)).alias("order_count"),
            money_sum(price).alias("total_order_value"),
            (money_sum(price) / F.count(price)).alias("avg_order_value"),
            F.min(price).alias("min_order_value"), F.max(price).alias("max_order_value"),
            F.round(F.stddev_samp(price), 6).alias("order_value_stddev"),
            # A group has one customer: no distinct count is needed.
            F.count(F.lit(1)).alias("unique_customers"), money_sum(price).alias("revenue_per_customer")]
    for s in ORDER_STATUSES:
        aggs.append(money_sum(F.when(F.col("order_status") == s, price).otherwise(F.lit(0.0)))
                    .alias(f"revenue_{s.lower()}_status"))
        aggs.append(F.count(F.when(F.col("order_status") == s, 1)).alias(f"count_{s.lower()}_status"))
    for i, p in enumerate(PRIORITY_LEVELS, start=1):
        aggs.append(money_sum(F.when(F.col("order_priority") == p, price).otherwise(F.lit(0.0)))
                    .alias(f"revenue_priority_{i}"))
    keys = ["order_date", F.year("order_date").alias("order_year"), F.month("order_date").alias("order_month"),
            F.quarter("order_date").alias("order_quarter"), F.dayofweek("order_date").alias("day_of_week"),
            "customer_key", "order_status", "order_priority"]
    known = F.col("customer_key").isNotNull()
    return (o.groupBy(*keys).agg(*aggs)
            .withColumn("unique_customers", F.when(known, F.lit(1)).otherwise(F.lit(0)).cast("long"))
            .withColumn("revenue_per_customer", F.when(known, F.col("revenue_per_customer")))
            .withColumn("last_updated", ctx.now()))


def int_fx_rates_daily(cat, ctx: RunContext = RunContext(), rates: DataFrame | None = None,
                       base: str = "USD", open_end: str = "2099-12-31") -> DataFrame:
    """W6 forward fill: a rate is valid from its date to the day before the
    next one; the last is open to ``open_end``.  Window per currency pair
    (rows per pair = number of rate dates, small)."""
    fx = rates if rates is not None else staging.stg_fx_rates(cat, ctx)
    w = Window.partitionBy("base_currency", "quote_currency").orderBy("rate_date")
    nxt = F.lead("rate_date").over(w)
    return fx.where(F.col("base_currency") == base).select(
        F.col("rate_date").alias("day_dt"), F.col("base_currency").alias("from_currency"),
        F.col("quote_currency").alias("to_currency"), F.col("exchange_rate").alias("conversion_rate"),
        F.coalesce(F.date_sub(nxt, 1), F.to_date(F.lit(open_end))).alias("end_date"),
        ctx.now().alias("_loaded_at"))


def fx_backward_intervals(rates: DataFrame, today_col: str, base: str = "USD",
                          quotes=("EUR",), floor: str = "1900-01-01") -> DataFrame:
    """W7 backward fill of the legacy lookup: a rate covers (previous date,
    date]; the first starts at ``floor``; the last stays open to today + 100
    years.  Adds a USD identity row.  ``rates`` must carry ``today_col``."""
    fx = rates.where((F.col("base_currency") == base) & F.col("quote_currency").isin(*quotes))
    w = Window.partitionBy("quote_currency").orderBy("rate_date")
    far = F.add_months(F.col(today_col), 1200)
    iv = fx.select(
        F.col("quote_currency").alias("currency"),
        F.col("exchange_rate").cast("double").alias("from_usd"),
        (F.lit(1.0) / F.col("exchange_rate").cast("double")).alias("to_usd"),
        F.coalesce(F.date_add(F.lag("rate_date").over(w), 1), F.to_date(F.lit(floor))).alias("start_date"),
        F.when(F.lead("rate_date").over(w).isNull(), far).otherwise(F.col("rate_date")).alias("end_date"))
    # The identity row stands even if there are no rates.
    ident = rates.agg(F.coalesce(F.max(today_col), F.current_date()).alias(today_col)).select(
        F.lit(base).alias("currency"), F.lit(1.0).alias("from_usd"), F.lit(1.0).alias("to_usd"),
        F.to_date(F.lit(floor)).alias("start_date"), far.alias("end_date"))
    return iv.unionByName(ident)


def lookup_exchange_rates(cat, ctx: RunContext = RunContext(), calendar: DataFrame | None = None,
                          quotes=("EUR",)) -> DataFrame:
    """Every calendar day x every (from, to) currency pair valid that day.
    Both validity-range joins become equi joins on the day: intervals are
    expanded to days inside the calendar span (bounded by calendar length x
    currencies) and joined to the calendar; the cross-rate is a self equi
    join on the day."""
    from strata.operators.interval_join import expand_to_days, DAY
    from strata.plans.calendar import dim_calendar_day
    from strata.session import today_frame
    spark = cat.spark
    orders = cat.orders
    today = today_frame(ctx, orders)
    cal = calendar if calendar is not None else dim_calendar_day(spark, ctx, ghost=False)
    cal = cal.select("day_dt")
    span = cal.agg(F.min("day_dt").alias("__lo"), F.max("day_dt").alias("__hi"))
    rates = staging.stg_fx_rates(cat, ctx).crossJoin(F.broadcast(today))
    iv = fx_backward_intervals(rates, "__today", quotes=quotes).crossJoin(F.broadcast(span))
    days = expand_to_days(iv, "start_date", "end_date", F.col("__lo"), F.col("__hi")).drop("__lo", "__hi")
    days = days.select(F.col(DAY).alias("day_dt"), "currency", "from_usd", "to_usd")
    # The output is the cross-rate table itself: every (from, to) pair per
    # day, so its size is days x currencies^2, fixed by configuration and the
    # calendar, never by data volume.
    first, second = days.alias("__f"), days.alias("__s")
    pairs = first.join(second, "day_dt")
    priced = cal.join(pairs, "day_dt")
    return priced.select(
        "day_dt", F.col("__f.currency").alias("from_currency"), F.col("__s.currency").alias("to_currency"),
        (F.col("__f.to_usd") * F.col("__s.from_usd")).alias("exchange_rate"),
        (F.col("__f.from_usd") * F.col("__s.to_usd")).alias("inverse_conversion_rate"))


# Government-type labels of the nation classifier (M3), in
# order; a name takes the first label whose word it contains, else OTHER.
GOVERNMENT_TYPES = ("FEDERAL", "REPUBLIC", "KINGDOM", "EMPIRE", "CONFEDERATION", "UNION", "FEDERATION",
                    "PRINCIPALITY", "DUCHY", "SULTANATE", "EMIRATE", "OTHER")


def classify_label(text_col, labels=GOVERNMENT_TYPES, default: str = "OTHER"):
    """M3 re-aimed: keyword rule over the upper-cased text (JVM-side).  A
    model can replace it via a pandas UDF returning one of ``labels``."""
    t = F.upper(F.coalesce(text_col, F.lit("")))
    expr = None
    for lab in labels:
        if lab == default:
            continue
        cond = t.contains(lab)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def model_classifier(predict, labels=GOVERNMENT_TYPES, default: str = "OTHER"):
    """M3 hook for a user's model: ``predict`` maps a pandas Series of texts
    to a Series of labels and runs inside Arrow-batched pandas UDF tasks (the
    model is shipped to the executors once per task, never to the driver's
    data).  Labels outside ``labels`` become ``default``."""
    import pandas as pd
    from pyspark.sql.functions import pandas_udf
    allowed = set(labels)

    def _classify(texts):
        out = pd.Series(predict(texts.fillna("")), index=texts.index).astype(object)
        return out.where(out.isin(allowed), default)

    # Real annotation objects: this module postpones annotations to strings.
    _classify.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return pandas_udf(_classify, "string")


def clean_nations(cat, ctx: RunContext = RunContext(), existing: DataFrame | None = None,
                  classifier=None) -> DataFrame:
    """Trim/upper nation names, name length, government type; on later runs
    only nations not yet present (left_anti, J11), to be merged by key."""
    n = staging.stg_nations(cat, ctx)
    out = n.select("nation_key", F.upper(F.trim("nation_name")).alias("nation_name"), "region_key",
                   F.length("nation_name").alias("name_length"),
                   (classifier(F.col("nation_name")) if classifier is not None
                    else classify_label(F.col("nation_name"))).alias("government_type"),
                   ctx.now().alias("processed_at"))
    if existing is not None:
        out = out.join(existing.select("nation_key"), "nation_key", "left_anti")
    return out
