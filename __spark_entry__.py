"""

Registered queries drop wall-clock audit columns (they cannot match an
independent run) and fix run parameters (``RunContext``) so both sides see
the same "today".  Nothing else differs from the library functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.plans import gold, history, later_runs, ml, reports, runlog, second_runs, silver, staging, tpch
from strata.plans.calendar import data_calendar
from strata.plans.model_tests import model_test_summary
from strata.sources.logs import text_lines
from strata.session import RunContext, ensure_checkpoint_dir, without_audit
from strata.sources.tables import Catalog

try:
    import corpus_pipeline
    from strata.llm import registry as llm
except ModuleNotFoundError as e:  # the llm folders and the pipeline may be absent
    if e.name != "corpus_pipeline" and not str(e.name).startswith("strata.llm"):
        raise
    corpus_pipeline = llm = None

SMOKE_DIR = "/root/testdata/sf0.001"
CTX = RunContext(data_clock=True)


def _cat(spark: SparkSession, sf_dir: str) -> Catalog:
    ensure_checkpoint_dir(spark)
    return Catalog(spark, sf_dir)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: customer insights (scan, global ranking, window stats,
    CASE binning, dimension join, ordered output) on sf0.001."""
    return without_audit(gold.customer_insights(_cat(spark, SMOKE_DIR), CTX))


def _q(fn) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return without_audit(fn(_cat(spark, sf_dir), CTX))
    run.__name__ = getattr(fn, "__name__", "query")
    return run


def _drop(*cols):
    def wrap(fn):
        def run(cat, ctx):
            return fn(cat, ctx).drop(*cols)
        run.__name__ = fn.__name__
        return run
    return wrap


def _sales_loader(cat, ctx):
    import datetime as dt
    from pyspark.sql import functions as F
    from strata.plans.calendar import dim_calendar_day
    dim, _ = _dim_from_load2(cat)
    products = cat.part.select(F.col("p_partkey").alias("product_business_key"), F.col("p_partkey").alias("product_key"))
    cal = dim_calendar_day(cat.spark, ctx, ghost=False)

    def load(fact, rows):
        return history.load_fact_sales(fact, rows, cal, dim, dt.date(1900, 1, 1),
                                       product_dim=products, load_ts=F.lit(history.LOAD_TS[0]).cast("timestamp_ntz"))
    return load


def _sales_fact(cat, ctx):
    return _sales_loader(cat, ctx)(None, history.staging_sales_order(cat))


def _sales_fact_second(cat, ctx):
    load = _sales_loader(cat, ctx)
    return second_runs.sales_second_load(cat, ctx, load(None, history.staging_sales_order(cat)), load)


def _dim_from_load2(cat):
    from pyspark.sql import functions as F
    from strata.operators.scd import hybrid_dimension_load
    return hybrid_dimension_load(None, history.staging_customer(cat, 2), "customer_business_key",
                                 ["customer_name", "customer_segment", "region", "country"], ["account_balance"],
                                 F.lit(history.LOAD_TS[0]).cast("timestamp_ntz"))


def _orphans(cat, ctx):
    from pyspark.sql import functions as F
    dim, _ = _dim_from_load2(cat)
    return history.fact_load_orphans(history.staging_sales_order(cat), dim,
                                     load_ts=F.lit(history.LOAD_TS[0]).cast("timestamp_ntz"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_library_queries(), **({**llm.QUERIES, "pipeline": corpus_pipeline.run} if llm else {})}


def _library_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "stg_regions": _q(staging.stg_regions),
        "stg_nations": _q(staging.stg_nations),
        "stg_customers": _q(staging.stg_customers),
        "stg_orders": _q(staging.stg_orders),
        "stg_lineitem": _q(staging.stg_lineitem),
        "stg_customers_with_tests": _q(staging.stg_customers_with_tests),
        "stg_fx_rates": _q(staging.stg_fx_rates),
        "stg_orders_incremental": _q(staging.stg_orders_incremental),
        "int_customers_with_orders": _q(silver.int_customers_with_orders),
        "customer_segments": _q(silver.customer_segments),
        "customer_insights": _q(gold.customer_insights),
        "customer_clustering_ntile": _q(silver.customer_clustering_ntile),
        "order_facts": _q(silver.order_facts),
        # Second loads into an older version of the table.
        "stg_orders_incremental_second_run": _q(second_runs.orders_second_run),
        "dim_customers_hashed_second_run": _q(_drop("cdc_hash_key")(second_runs.customers_second_run)),
        "fact_order_line_second_reload": _q(second_runs.order_lines_second_reload),
        "sales_fact_second_load": _q(_sales_fact_second),
        "order_lines_merged": _q(second_runs.order_lines_merged),
        "dim_customers_increment": _q(second_runs.new_customers),
        "dim_orders_increment": _q(second_runs.new_orders),
        "fct_order_lines_increment": _q(second_runs.new_order_lines),
        "clean_nations": _q(silver.clean_nations),
        "nation_summary": _q(gold.nation_summary),
        "int_fx_rates_daily": _q(silver.int_fx_rates_daily),
        "lookup_exchange_rates": _q(silver.lookup_exchange_rates),
        "dim_customers": _q(gold.dim_customers),
        "dim_orders": _q(gold.dim_orders),
        "dim_current_year_orders": _q(gold.dim_current_year_orders),
        "dim_current_year_open_orders": _q(gold.dim_current_year_open_orders),
        "fct_order_lines": _q(gold.fct_order_lines),
        "fct_order_lines_by_supplier_month": _q(gold.fct_order_lines_by_supplier_month),
        "fact_order_line_pivot": _q(gold.fact_order_line_pivot),
        "fact_order_line_full_reload": _q(gold.fact_order_line_full_reload),
        "executive_dashboard": _q(gold.executive_dashboard),
        "dim_customers_hashed": _q(_drop("cdc_hash_key")(history.dim_customers_hashed)),
        "dim_customers_scd1_changes": _q(_drop("cdc_hash_key")(history.dim_customers_scd1_changes)),
        "dim_customers_macro_example": _q(_drop("cdc_hash_key")(history.dim_customers_macro_example)),
        "dim_orders_macro_example": _q(_drop("cdc_hash_key")(history.dim_orders_macro_example)),
        "customer_cdc_stream": _q(history.customer_cdc_stream),
        "customer_change_feed": _q(history.customer_change_feed),
        "dim_customer_changes": _q(history.dim_customer_changes),
        "customers_snapshot_scd2": _q(history.customers_snapshot),
        "customers_snapshot_three_loads": _q(lambda cat, ctx: history.customers_snapshot(cat, ctx, loads=3)),
        "customers_snapshot_new_record": _q(lambda cat, ctx: history.customers_snapshot(cat, ctx,
                                                                                      hard_deletes="new_record")),
        "customers_stream_snapshot": _q(history.customers_stream_snapshot),
        "customer_dim_load": _q(lambda cat, ctx: history.customer_dim_load(cat, ctx)[0]),
        "customer_dim_load_counts": _q(lambda cat, ctx: history.customer_dim_load(cat, ctx)[1]),
        "sales_fact_load": _q(_sales_fact),
        "fact_load_orphans": _q(_orphans),
        "tpch_q1": _q(tpch.q1_pricing_summary),
        "tpch_q2": _q(tpch.q2_minimum_cost_supplier),
        "tpch_q3": _q(tpch.q3_shipping_priority),
        "tpch_q4": _q(tpch.q4_order_priority),
        "query_history": _q(runlog.query_history),
        "capacity_assignment": _q(runlog.capacity_assignment),
        "training_history": _q(runlog.training_history),
        "scan_forecast": _q(runlog.scan_forecast),
        "quality_summary": _q(reports.quality_summary),
        "lineitem_duplicate_keys": _q(reports.lineitem_duplicate_keys),
        "customer_balance_distribution": _q(reports.customer_balance_distribution),
        "segment_distribution": _q(reports.segment_distribution),
        "top_customers": _q(reports.top_customers),
        "calendar_range": _q(reports.calendar_range),
        "cdc_change_mix": _q(reports.cdc_change_mix),
        "e2e_assertions": _q(reports.e2e_assertions),
        "dim_calendar_day": _q(data_calendar),
        "dim_customers_share": _q(gold.dim_customers_share),
        "model_test_summary": _q(model_test_summary),
        "document_log_lines": _q(lambda cat, ctx: text_lines(cat.documents, "doc_id", "text")),
        "segment_statements": _q(reports.segment_statements),
        # Point in time, sketches, digests, leases, checks in the write, later runs.
        "order_customer_versions": _q(later_runs.order_customer_versions),
        "event_last_purchase": _q(later_runs.event_last_purchase),
        "supplier_orders_by_sketch": _q(later_runs.supplier_orders_by_sketch),
        "customer_change_feed_by_digest": _q(later_runs.customer_change_feed_by_digest),
        "leased_order_keys": _q(later_runs.leased_order_keys),
        "isolated_statements": _q(later_runs.isolated_statements),
        "order_lines_checked": _q(later_runs.order_lines_checked),
        "orders_freshness": _q(later_runs.orders_freshness),
        "negative_balance_share": _q(later_runs.negative_balance_share),
        "customers_share_developer": _q(later_runs.customers_share_developer),
        "line_surrogate_keys": _q(later_runs.line_surrogate_keys),
        "orders_open_or_recent": _q(later_runs.orders_open_or_recent),
        "customer_clustering_kmeans": _q(ml.customer_clustering_kmeans),
    }


_SEGMENTS_SQL = """
WITH c AS (
  SELECT c_custkey AS customer_key, c_name AS customer_name, c_nationkey AS nation_key,
         c_acctbal AS account_balance, c_mktsegment AS market_segment
  FROM customer),
m AS (
  SELECT *,
    row_number() OVER (PARTITION BY nation_key ORDER BY account_balance DESC, customer_key) AS balance_rank_in_nation,
    percent_rank() OVER (ORDER BY account_balance) AS balance_percentile,
    avg(account_balance) OVER (PARTITION BY nation_key) AS avg_nation_balance,
    stddev_samp(account_balance) OVER (PARTITION BY nation_key) AS stddev_nation_balance,
    sum(CAST(round(account_balance * 100) AS BIGINT)) OVER (PARTITION BY nation_key) AS s_c,
    count(account_balance) OVER (PARTITION BY nation_key) AS n_c,
    CAST(round(account_balance * 100) AS BIGINT) AS b_c
  FROM c),
s AS (
  SELECT customer_key, customer_name, nation_key, account_balance, market_segment,
    CASE WHEN balance_percentile >= 0.9 THEN 'PREMIUM' WHEN balance_percentile >= 0.7 THEN 'HIGH_VALUE'
         WHEN balance_percentile >= 0.3 THEN 'STANDARD' WHEN balance_percentile >= 0.1 THEN 'BASIC'
         ELSE 'LOW_VALUE' END AS customer_segment,
    CASE WHEN balance_rank_in_nation <= 10 THEN 'TOP_10_IN_NATION'
         WHEN balance_rank_in_nation <= 100 THEN 'TOP_100_IN_NATION' ELSE 'STANDARD_IN_NATION' END AS nation_ranking,
    CASE WHEN account_balance > avg_nation_balance + stddev_nation_balance THEN 'ABOVE_AVERAGE'
         WHEN account_balance < avg_nation_balance - stddev_nation_balance THEN 'BELOW_AVERAGE'
         ELSE 'AVERAGE' END AS statistical_class,
    balance_percentile, balance_rank_in_nation,
    (CASE WHEN s_c < 0 THEN -((abs(s_c) * 2 + n_c) // (n_c * 2)) ELSE (s_c * 2 + n_c) // (n_c * 2) END) / 100
      AS avg_nation_balance,
    (CASE WHEN b_c * n_c - s_c < 0 THEN -((abs(b_c * n_c - s_c) * 2 + n_c) // (n_c * 2))
          ELSE ((b_c * n_c - s_c) * 2 + n_c) // (n_c * 2) END) / 100 AS balance_vs_nation_avg
  FROM m)
"""


_FX = """
fx_days AS (
  SELECT CAST(unnest(generate_series(CAST(d0 AS TIMESTAMP), CAST(d1 AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS rate_date, d0
  FROM (SELECT min(CAST(o_orderdate AS DATE)) AS d0, max(CAST(o_orderdate AS DATE)) AS d1 FROM orders)),
fx AS (
  SELECT rate_date, 'USD' AS base_currency, q.quote_currency,
         CAST(CAST(q.b AS DECIMAL(18,6)) + CAST(((CAST(datediff('day', d0, rate_date) / 7 AS BIGINT) * q.m) % 100) AS DECIMAL(18,6)) / 1000 AS DECIMAL(18,6)) AS exchange_rate
  FROM fx_days, (VALUES ('EUR', 0.8, 37), ('GBP', 0.6, 53)) q(quote_currency, b, m)),
fx_daily AS (
  SELECT rate_date AS day_dt, base_currency AS from_currency, quote_currency AS to_currency,
         exchange_rate AS conversion_rate,
         coalesce(CAST(lead(rate_date) OVER (PARTITION BY base_currency, quote_currency ORDER BY rate_date) - INTERVAL 1 DAY AS DATE),
                  DATE '2099-12-31') AS end_date
  FROM fx WHERE base_currency = 'USD')"""

_LINES = """
li AS (
  SELECT *, CAST(l_shipdate AS DATE) + CAST(((l_orderkey * 7 + l_linenumber * 3) % 21) - 10 AS INTEGER) AS l_commitdate,
         CAST(l_shipdate AS DATE) + CAST(1 + ((l_orderkey + l_linenumber * 5) % 30) AS INTEGER) AS l_receiptdate
  FROM lineitem)"""

_ORDERS_INC = """
oi AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
    CASE WHEN o_orderstatus = 'O' THEN 'OPEN' WHEN o_orderstatus = 'F' THEN 'FULFILLED'
         WHEN o_orderstatus = 'P' THEN 'PARTIAL' ELSE 'UNKNOWN' END AS order_status_desc,
    CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month,
    CAST(year(o_orderdate) AS INTEGER) AS order_year, CAST(quarter(o_orderdate) AS INTEGER) AS order_quarter,
    'FULL_LOAD' AS processing_type
  FROM orders)"""

_DIM_CUSTOMERS = """
oc AS (
  SELECT o_custkey AS customer_key, count(*) AS order_count,
         CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS open_order_count
  FROM orders GROUP BY o_custkey),
dc AS (
  SELECT c.c_custkey AS customer_key, c.c_name AS customer_name, c.c_acctbal AS account_balance,
    c.c_mktsegment AS market_segment, c.c_nationkey AS nation_key, n.n_name AS nation_name, n.n_regionkey AS region_key,
    coalesce(oc.order_count, 0) AS total_orders, coalesce(oc.open_order_count, 0) AS open_orders,
    CASE WHEN coalesce(oc.order_count, 0) > 0 THEN 'Y' ELSE 'N' END AS has_orders_flag,
    CASE WHEN coalesce(oc.open_order_count, 0) > 0 THEN 'Y' ELSE 'N' END AS has_open_orders_flag,
    CASE WHEN c.c_acctbal >= 5000 THEN 'High Value' WHEN c.c_acctbal >= 1000 THEN 'Medium Value' ELSE 'Standard' END AS value_segment
  FROM customer c LEFT JOIN oc ON c.c_custkey = oc.customer_key LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

_DIM_ORDERS = _DIM_CUSTOMERS + """,
dord AS (
  SELECT o.o_orderkey AS order_key, o.o_custkey AS customer_key, o.o_orderstatus AS order_status,
    o.o_totalprice AS total_price, o.o_orderdate AS order_date, o.o_orderpriority AS order_priority,
    dc.customer_name, dc.nation_key, dc.value_segment,
    CASE WHEN o.o_orderstatus = 'O' THEN 'Open' WHEN o.o_orderstatus = 'F' THEN 'Fulfilled'
         WHEN o.o_orderstatus = 'P' THEN 'Partial' ELSE 'Unknown' END AS order_status_desc,
    CAST(year(o.o_orderdate) AS INTEGER) AS order_year, CAST(quarter(o.o_orderdate) AS INTEGER) AS order_quarter,
    CAST(month(o.o_orderdate) AS INTEGER) AS order_month
  FROM orders o LEFT JOIN dc ON o.o_custkey = dc.customer_key)"""

_FOL = "WITH " + _FX + "," + _LINES + "," + _DIM_ORDERS + """,
fol AS (
  SELECT li.l_orderkey AS order_key, li.l_linenumber AS line_number, li.l_partkey AS part_key,
    li.l_suppkey AS supplier_key, d.customer_key, li.l_quantity AS quantity, li.l_extendedprice AS extended_price,
    li.l_discount AS discount, li.l_tax AS tax,
    li.l_extendedprice * (1 - li.l_discount) AS discounted_price,
    li.l_extendedprice * (1 - li.l_discount) * (1 + li.l_tax) AS final_price,
    coalesce(fx.conversion_rate, CAST(1.0 AS DECIMAL(18,6))) AS eur_conversion_rate,
    li.l_extendedprice * (1 - li.l_discount) * (1 + li.l_tax) * CAST(coalesce(fx.conversion_rate, 1.0) AS DOUBLE) AS final_price_eur,
    li.l_returnflag AS return_flag, li.l_linestatus AS line_status, li.l_shipdate AS ship_date,
    li.l_commitdate AS commit_date, li.l_receiptdate AS receipt_date, d.order_date, d.order_status_desc
  FROM li JOIN dord d ON li.l_orderkey = d.order_key
  LEFT JOIN fx_daily fx ON fx.from_currency = 'USD' AND fx.to_currency = 'EUR'
       AND CAST(d.order_date AS DATE) BETWEEN fx.day_dt AND fx.end_date)
"""

_ORDER_FACTS = "WITH " + _ORDERS_INC + """,
of AS (
  SELECT CAST(o_orderdate AS DATE) AS order_date, CAST(year(o_orderdate) AS INTEGER) AS order_year,
    CAST(month(o_orderdate) AS INTEGER) AS order_month, CAST(quarter(o_orderdate) AS INTEGER) AS order_quarter,
    CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS day_of_week,
    o_custkey AS customer_key, o_orderstatus AS order_status, o_orderpriority AS order_priority,
    count(*) AS order_count,
    CAST(sum(CAST(o_totalprice AS DECIMAL(38,6))) AS DOUBLE) AS total_order_value,
    CAST(sum(CAST(o_totalprice AS DECIMAL(38,6))) AS DOUBLE) / count(o_totalprice) AS avg_order_value,
    min(o_totalprice) AS min_order_value, max(o_totalprice) AS max_order_value,
    round(stddev_samp(o_totalprice), 6) AS order_value_stddev,
    count(DISTINCT o_custkey) AS unique_customers,
    CAST(sum(CAST(o_totalprice AS DECIMAL(38,6))) AS DOUBLE) / count(DISTINCT o_custkey) AS revenue_per_customer,
    CAST(sum(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(38,6)) ELSE 0 END) AS DOUBLE) AS revenue_o_status,
    count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS count_o_status,
    CAST(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(38,6)) ELSE 0 END) AS DOUBLE) AS revenue_f_status,
    count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS count_f_status,
    CAST(sum(CASE WHEN o_orderstatus = 'P' THEN CAST(o_totalprice AS DECIMAL(38,6)) ELSE 0 END) AS DOUBLE) AS revenue_p_status,
    count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS count_p_status,
    CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(o_totalprice AS DECIMAL(38,6)) ELSE 0 END) AS DOUBLE) AS revenue_priority_1,
    CAST(sum(CASE WHEN o_orderpriority = '2-HIGH' THEN CAST(o_totalprice AS DECIMAL(38,6)) ELSE 0 END) AS DOUBLE) AS revenue_priority_2,
    CAST(sum(CASE WHEN o_orderpriority = '3-MEDIUM' THEN CAST(o_totalprice AS DECIMAL(38,6)) ELSE 0 END) AS DOUBLE) AS revenue_priority_3,
    CAST(sum(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN CAST(o_totalprice AS DECIMAL(38,6)) ELSE 0 END) AS DOUBLE) AS revenue_priority_4,
    CAST(sum(CASE WHEN o_orderpriority = '5-LOW' THEN CAST(o_totalprice AS DECIMAL(38,6)) ELSE 0 END) AS DOUBLE) AS revenue_priority_5
  FROM oi WHERE processing_type IN ('RECENT', 'FULL_LOAD')
  GROUP BY ALL)
"""

_GOV = """CASE WHEN upper(n_name) LIKE '%FEDERAL%' THEN 'FEDERAL' WHEN upper(n_name) LIKE '%REPUBLIC%' THEN 'REPUBLIC'
  WHEN upper(n_name) LIKE '%KINGDOM%' THEN 'KINGDOM' WHEN upper(n_name) LIKE '%EMPIRE%' THEN 'EMPIRE'
  WHEN upper(n_name) LIKE '%CONFEDERATION%' THEN 'CONFEDERATION' WHEN upper(n_name) LIKE '%UNION%' THEN 'UNION'
  WHEN upper(n_name) LIKE '%FEDERATION%' THEN 'FEDERATION' WHEN upper(n_name) LIKE '%PRINCIPALITY%' THEN 'PRINCIPALITY'
  WHEN upper(n_name) LIKE '%DUCHY%' THEN 'DUCHY' WHEN upper(n_name) LIKE '%SULTANATE%' THEN 'SULTANATE'
  WHEN upper(n_name) LIKE '%EMIRATE%' THEN 'EMIRATE' ELSE 'OTHER' END"""

_CAL_FX = "WITH " + _FX + """,
today AS (SELECT max(CAST(o_orderdate AS DATE)) AS t FROM orders),
cal AS (SELECT CAST(DATE '1992-01-01' + CAST(i AS INTEGER) AS DATE) AS day_dt FROM range(18250) r(i)),
ex AS (
  SELECT quote_currency AS currency, CAST(exchange_rate AS DOUBLE) AS from_usd, 1.0 / CAST(exchange_rate AS DOUBLE) AS to_usd,
    coalesce(CAST(lag(rate_date) OVER (PARTITION BY quote_currency ORDER BY rate_date) + INTERVAL 1 DAY AS DATE), DATE '1900-01-01') AS start_date,
    CASE WHEN lead(rate_date) OVER (PARTITION BY quote_currency ORDER BY rate_date) IS NULL
         THEN CAST((SELECT t FROM today) + INTERVAL 100 YEAR AS DATE) ELSE rate_date END AS end_date
  FROM fx WHERE base_currency = 'USD' AND quote_currency IN ('EUR')
  UNION ALL
  SELECT 'USD', 1.0, 1.0, DATE '1900-01-01', CAST((SELECT t FROM today) + INTERVAL 100 YEAR AS DATE)),
lkp AS (
  SELECT cal.day_dt, a.currency AS from_currency, b.currency AS to_currency,
         a.to_usd * b.from_usd AS exchange_rate, a.from_usd * b.to_usd AS inverse_conversion_rate
  FROM cal JOIN ex a ON cal.day_dt BETWEEN a.start_date AND a.end_date
           JOIN ex b ON cal.day_dt BETWEEN b.start_date AND b.end_date)
"""


_SCD_SRC = """
oc AS (SELECT o_custkey AS customer_key, count(*) AS order_count,
              CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS open_order_count
       FROM orders GROUP BY o_custkey),
src AS (
  SELECT c.c_custkey AS customer_key, c.c_name AS customer_name, c.c_nationkey AS nation_key,
    c.c_acctbal AS account_balance, c.c_mktsegment AS market_segment,
    CASE WHEN oc.order_count > 0 THEN 'Y' ELSE 'N' END AS has_orders_flag,
    CASE WHEN oc.open_order_count > 0 THEN 'Y' ELSE 'N' END AS has_open_orders_flag,
    oc.order_count, oc.open_order_count, coalesce(CAST(c.c_custkey AS VARCHAR), '') AS integration_id,
    row_number() OVER (ORDER BY c.c_custkey) AS customer_surrogate_key
  FROM customer c LEFT JOIN oc ON c.c_custkey = oc.customer_key)"""

_LOADS = """
l1 AS (SELECT c_custkey AS customer_key, c_name AS customer_name, c_acctbal AS account_balance,
              c_mktsegment AS market_segment, c_nationkey AS nation_key FROM customer),
l2 AS (
  SELECT customer_key, customer_name,
    CASE WHEN customer_key % 10 = 1 THEN account_balance + 100 ELSE account_balance END AS account_balance,
    CASE WHEN customer_key % 10 = 2 THEN (CASE WHEN market_segment = 'HOUSEHOLD' THEN 'BUILDING' ELSE 'HOUSEHOLD' END)
         ELSE market_segment END AS market_segment, nation_key
  FROM l1 WHERE customer_key % 10 <> 3
  UNION ALL
  SELECT customer_key + (SELECT max(customer_key) FROM l1) + 1, customer_name || '-new', account_balance, market_segment, nation_key
  FROM l1 WHERE customer_key % 10 = 4),
chg AS (
  SELECT l1.customer_key FROM l1 JOIN l2 USING (customer_key)
  WHERE l1.customer_name IS DISTINCT FROM l2.customer_name OR l1.account_balance IS DISTINCT FROM l2.account_balance
     OR l1.market_segment IS DISTINCT FROM l2.market_segment OR l1.nation_key IS DISTINCT FROM l2.nation_key),
feed AS (
  SELECT *, 'INSERT' AS cdc_change_type FROM l2 WHERE customer_key NOT IN (SELECT customer_key FROM l1)
  UNION ALL SELECT *, 'DELETE' FROM l1 WHERE customer_key NOT IN (SELECT customer_key FROM l2)
  UNION ALL SELECT *, 'UPDATE_BEFORE' FROM l1 WHERE customer_key IN (SELECT customer_key FROM chg)
  UNION ALL SELECT *, 'UPDATE_AFTER' FROM l2 WHERE customer_key IN (SELECT customer_key FROM chg))"""

_STG_CUST = """
geo AS (SELECT n_nationkey, n_name AS country, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey),
s1 AS (SELECT l1.customer_key AS customer_business_key, customer_name, market_segment AS customer_segment, region, country, account_balance
       FROM l1 LEFT JOIN geo ON l1.nation_key = geo.n_nationkey),
s2 AS (SELECT l2.customer_key AS customer_business_key, customer_name, market_segment AS customer_segment, region, country, account_balance
       FROM l2 LEFT JOIN geo ON l2.nation_key = geo.n_nationkey)"""

_T1, _T2 = "TIMESTAMP '2024-01-01 00:00:00'", "TIMESTAMP '2024-01-02 00:00:00'"

_DIM_LOAD = "WITH " + _LOADS + "," + _STG_CUST + f""",
d1 AS (SELECT row_number() OVER (ORDER BY customer_business_key) AS customer_key, *,
              DATE '2024-01-01' AS effective_start_date, DATE '9999-12-31' AS effective_end_date, true AS is_current,
              {_T1} AS created_date, 'ETL' AS created_by, CAST(NULL AS TIMESTAMP) AS updated_date, CAST(NULL AS VARCHAR) AS updated_by
       FROM s1),
j AS (
  SELECT coalesce(d1.customer_business_key, s2.customer_business_key) AS bk, d1.customer_key AS dk,
    CASE WHEN d1.customer_business_key IS NOT NULL AND s2.customer_business_key IS NOT NULL AND (
              d1.customer_name IS DISTINCT FROM s2.customer_name OR d1.customer_segment IS DISTINCT FROM s2.customer_segment
              OR d1.region IS DISTINCT FROM s2.region OR d1.country IS DISTINCT FROM s2.country) THEN 't2'
         WHEN d1.customer_business_key IS NOT NULL AND s2.customer_business_key IS NOT NULL
              AND d1.account_balance IS DISTINCT FROM s2.account_balance THEN 't1'
         WHEN d1.customer_business_key IS NOT NULL AND s2.customer_business_key IS NOT NULL THEN 'same'
         WHEN s2.customer_business_key IS NOT NULL THEN 'new' ELSE 'absent' END AS st
  FROM d1 FULL OUTER JOIN s2 ON d1.customer_business_key = s2.customer_business_key),
dim AS (
  SELECT d1.* FROM d1 JOIN j ON d1.customer_key = j.dk WHERE st IN ('same', 'absent')
  UNION ALL
  SELECT customer_key, customer_business_key, customer_name, customer_segment, region, country, account_balance,
    effective_start_date, DATE '2024-01-01', false, created_date, created_by, {_T2}, 'ETL'
  FROM d1 JOIN j ON d1.customer_key = j.dk WHERE st = 't2'
  UNION ALL
  SELECT d1.customer_key, d1.customer_business_key, d1.customer_name, d1.customer_segment, d1.region, d1.country, s2.account_balance,
    d1.effective_start_date, d1.effective_end_date, d1.is_current, d1.created_date, d1.created_by, {_T2}, 'ETL'
  FROM d1 JOIN j ON d1.customer_key = j.dk JOIN s2 ON s2.customer_business_key = j.bk WHERE st = 't1'
  UNION ALL
  SELECT (SELECT max(customer_key) FROM d1) + row_number() OVER (ORDER BY s2.customer_business_key), s2.*,
    DATE '2024-01-02', DATE '9999-12-31', true, {_T2}, 'ETL', CAST(NULL AS TIMESTAMP), CAST(NULL AS VARCHAR)
  FROM s2 JOIN j ON s2.customer_business_key = j.bk WHERE st IN ('t2', 'new'))
"""

_SALES = "WITH " + _LOADS + "," + _STG_CUST + f""",
dim AS (SELECT row_number() OVER (ORDER BY customer_business_key) AS customer_key, customer_business_key FROM s2),
cal AS (SELECT CAST(DATE '1992-01-01' + CAST(i AS INTEGER) AS DATE) AS d,
               CAST(strftime(CAST(DATE '1992-01-01' + CAST(i AS INTEGER) AS DATE), '%Y%m%d') AS BIGINT) AS dk FROM range(18250) r(i)),
so AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS source_order_id, l_orderkey AS order_number,
    l_linenumber AS order_line_number, CAST(o_orderdate AS DATE) AS order_date, CAST(l_shipdate AS DATE) AS ship_date,
    o_custkey AS customer_id, l_partkey AS product_id, l_quantity AS quantity,
    l_extendedprice / nullif(l_quantity, 0) AS unit_price, l_extendedprice / nullif(l_quantity, 0) * 0.7 AS unit_cost,
    l_extendedprice * l_discount AS discount_amount, 1 AS batch_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


_RUNLOG = """
rl AS (
  SELECT event_id AS query_id, ts AS start_time,
    CAST(floor(value * 1000) AS BIGINT) AS total_elapsed_time, CAST(floor(value * 100) AS BIGINT) AS compilation_time,
    CAST(floor(value * 900) AS BIGINT) AS execution_time,
    CASE WHEN user_id % 4 = 0 THEN 'x-small' WHEN user_id % 4 = 1 THEN 'Small' WHEN user_id % 4 = 2 THEN 'MEDIUM'
         ELSE 'large' END AS warehouse_size,
    CAST(floor(value * 1000000) AS BIGINT) AS bytes_scanned, CAST(floor(value) AS BIGINT) AS partitions_scanned,
    '{"app": "' || CASE WHEN event_type = 'error' THEN 'other' ELSE 'build' END
      || '", "target_name": "db.analytics.model_' || CAST(user_id % 25 AS VARCHAR)
      || '", "module_name": "' || event_type
      || '", "module_details": {"is_incremental": "'
      || CASE WHEN event_type IN ('click', 'view') THEN 'true' WHEN event_type = 'signup' THEN 'false' ELSE 'maybe' END
      || '"}, "run_id": "run_' || strftime(ts, '%Y%m%d') || '", "props": ' || props || '}' AS query_tag,
    '[{"objectName": "db.analytics.model_' || CAST(user_id % 25 AS VARCHAR) || '", "objectDomain": "table"}]'
      AS objects_modified
  FROM events),
ws AS (
  SELECT * FROM (VALUES ('X-SMALL', 1, 8), ('SMALL', 2, 16), ('MEDIUM', 4, 32), ('LARGE', 8, 64),
    ('X-LARGE', 16, 128), ('2X-LARGE', 32, 256), ('3X-LARGE', 64, 512), ('4X-LARGE', 128, 1024),
    ('5X-LARGE', 256, 2048), ('6X-LARGE', 512, 4096)) v(warehouse_size, warehouse_nodes, warehouse_vcpu)),
qhist AS (
  SELECT qh.query_id, qh.start_time, qh.total_elapsed_time / 1000 AS total_elapsed_sec,
    upper(json_extract_string(qh.query_tag, '$.target_name')) AS target_name,
    TRY_CAST(json_extract_string(qh.query_tag, '$.module_details.is_incremental') AS BOOLEAN) AS is_incremental,
    json_extract_string(qh.query_tag, '$.app') AS app, json_extract_string(qh.query_tag, '$.module_name') AS module_name,
    json_extract_string(qh.query_tag, '$.run_id') AS run_id,
    qh.compilation_time / 1000 AS compilation_sec, qh.execution_time / 1000 AS execution_sec,
    coalesce(qh.execution_time / (1000 * 60 * 60) * ws.warehouse_nodes, 0) AS relative_performance_cost,
    ws.warehouse_size, ws.warehouse_nodes, ws.warehouse_vcpu, qh.warehouse_size AS query_warehouse_size,
    qh.bytes_scanned, qh.partitions_scanned
  FROM rl qh LEFT JOIN ws ON ws.warehouse_size = upper(qh.warehouse_size)
  WHERE json_extract_string(qh.query_tag, '$.app') = 'build')"""

_TRAINING = "WITH " + _RUNLOG + """,
lt AS (SELECT CAST(max(start_time) AS DATE) AS d FROM rl),
q AS (
  SELECT query_id, start_time, partitions_scanned,
    upper(json_extract_string(query_tag, '$.target_name')) AS target_name,
    TRY_CAST(json_extract_string(query_tag, '$.module_details.is_incremental') AS BOOLEAN) AS is_incremental
  FROM rl, lt WHERE start_time >= CAST(lt.d - 7 AS TIMESTAMP) AND partitions_scanned > 0),
ah AS (
  SELECT query_id AS ah_query_id, start_time AS query_start_time, upper(w.objectName) AS ah_target_name
  FROM (SELECT query_id, start_time,
          unnest(from_json(objects_modified, '[{"objectName": "VARCHAR", "objectDomain": "VARCHAR"}]')) AS w
        FROM rl, lt WHERE start_time >= CAST(lt.d - 7 AS TIMESTAMP))),
th AS (
  SELECT coalesce(q.target_name, ah.ah_target_name) AS target_name, coalesce(q.is_incremental, false) AS is_incremental,
    CAST(q.start_time AS DATE) AS query_date, max(q.partitions_scanned) AS partitions_scanned
  FROM q LEFT JOIN ah ON ah.ah_query_id = q.query_id AND ah.query_start_time = q.start_time
  WHERE q.is_incremental IS NOT NULL OR ah.ah_target_name IS NOT NULL
  GROUP BY ALL)"""

_RUNLOG_SQL = {
    "query_history": "WITH " + _RUNLOG + " SELECT * FROM qhist",
    "capacity_assignment": "WITH " + _RUNLOG + """,
        dwao AS (SELECT upper('DB.SCHEMA.TABLE') AS target_name, 'my_warehouse' AS full_refresh_warehouse,
                        'my_warehouse' AS incremental_warehouse),
        caps AS (SELECT * FROM (VALUES ('xsmall_wh', 10000000), ('small_wh', 100000000), ('medium_wh', 200000000),
                  ('large_wh', 400000000), ('xlarge_wh', 800000000), ('xxlarge_wh', 100000000000))
                  v(warehouse_name, capacity)),
        lt AS (SELECT CAST(max(start_time) AS DATE) AS d FROM qhist),
        q AS (SELECT target_name, is_incremental, bytes_scanned FROM qhist, lt
              WHERE target_name IS NOT NULL AND is_incremental IS NOT NULL AND bytes_scanned > 0
                AND start_time > CAST(lt.d - 30 AS TIMESTAMP)
                AND NOT EXISTS (SELECT 1 FROM dwao WHERE dwao.target_name = qhist.target_name)),
        mm AS (SELECT target_name, max(bytes_scanned) AS max_bytes_scanned,
                 coalesce(max(CASE WHEN is_incremental THEN bytes_scanned END), max(bytes_scanned))
                   AS max_incremental_bytes_scanned
               FROM q GROUP BY target_name),
        best AS (SELECT m.target_name, f.warehouse_name AS full_refresh_warehouse,
                   i.warehouse_name AS incremental_warehouse
                 FROM mm m JOIN caps f ON m.max_bytes_scanned < f.capacity
                   JOIN caps i ON m.max_incremental_bytes_scanned < i.capacity
                 QUALIFY row_number() OVER (PARTITION BY m.target_name ORDER BY f.capacity, i.capacity) = 1),
        comb AS (SELECT * FROM dwao UNION ALL SELECT * FROM best)
        SELECT target_name AS model_name, coalesce(full_refresh_warehouse, incremental_warehouse) AS recommended_warehouse,
               CAST(0.85 AS DOUBLE) AS confidence_score
        FROM comb""",
    "training_history": _TRAINING + " SELECT * FROM th",
    "scan_forecast": _TRAINING + """,
        pts AS (SELECT target_name, is_incremental, query_date,
                  CAST(date_diff('day', DATE '1970-01-01', query_date) AS DOUBLE) AS x,
                  CAST(partitions_scanned AS DOUBLE) AS y FROM th),
        g AS (SELECT target_name, is_incremental, max(query_date) AS last_date, count(*) AS n_points,
                regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, avg(y) AS mean_y, max(x) AS last_x
              FROM pts GROUP BY target_name, is_incremental)
        SELECT target_name, is_incremental, CAST(last_date + 1 AS DATE) AS forecast_date, n_points,
               round(slope, 6) AS slope,
               round(CASE WHEN slope IS NOT NULL THEN intercept + slope * (last_x + 1) ELSE mean_y END, 4)
                 AS forecast_partitions_scanned
        FROM g""",
}


_INSIGHTS_SELECT = """
  SELECT customer_key, customer_name, n.n_name AS country, account_balance,
    avg_nation_balance AS country_average_balance, balance_vs_nation_avg AS balance_vs_country_average,
    customer_segment AS customer_tier, market_segment, nation_ranking AS country_ranking,
    statistical_class AS statistical_classification,
    round(balance_percentile * 100, 1) AS balance_percentile_score,
    balance_rank_in_nation AS rank_in_country,
    CASE WHEN customer_segment = 'PREMIUM' AND nation_ranking = 'TOP_10_IN_NATION' THEN 'VIP Customer'
         WHEN customer_segment IN ('PREMIUM', 'HIGH_VALUE') THEN 'High Value Customer'
         WHEN statistical_class = 'ABOVE_AVERAGE' THEN 'Above Average Customer'
         ELSE 'Standard Customer' END AS customer_classification,
    CASE WHEN account_balance < 0 THEN 'Credit Risk' WHEN customer_segment = 'LOW_VALUE' THEN 'Retention Risk'
         WHEN balance_vs_nation_avg < -1000 THEN 'Performance Risk' ELSE 'Low Risk' END AS risk_category
  FROM s LEFT JOIN nation n ON s.nation_key = n.n_nationkey"""

_QUALITY = """
WITH c AS (SELECT c_custkey AS customer_key, min(c_name) AS customer_name, min(c_nationkey) AS nation_key,
                  min(c_acctbal) AS account_balance, min(c_mktsegment) AS market_segment
           FROM customer GROUP BY c_custkey),
o AS (SELECT o_orderkey AS order_key, o_custkey AS customer_key, o_orderstatus AS order_status,
             o_totalprice AS total_price FROM orders),
li AS (SELECT l_orderkey AS order_key, l_linenumber AS line_number, l_quantity AS quantity, l_discount AS discount,
              l_returnflag AS return_flag, l_linestatus AS line_status FROM lineitem),
n AS (SELECT n_nationkey AS nation_key, n_name AS nation_name FROM nation),
r AS (
  SELECT 'customers_key_not_null' AS check_name, 'stg_customers' AS model, 'customer_key' AS column_name,
         'error' AS severity, count(*) FILTER (WHERE customer_key IS NULL) AS failures FROM c
  UNION ALL SELECT 'customers_key_unique', 'stg_customers', 'customer_key', 'error',
         (SELECT count(*) FROM (SELECT customer_key FROM c GROUP BY 1 HAVING count(*) > 1))
  UNION ALL SELECT 'customers_segment_accepted', 'stg_customers', 'market_segment', 'error',
         count(*) FILTER (WHERE market_segment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'))
         FROM c
  UNION ALL SELECT 'customers_name_not_empty', 'stg_customers', 'customer_name', 'error',
         count(*) FILTER (WHERE trim(customer_name) = '') FROM c
  UNION ALL SELECT 'customers_balance_range', 'stg_customers', 'account_balance', 'warn',
         count(*) FILTER (WHERE NOT (account_balance >= -999.99 AND account_balance <= 9999.99)) FROM c
  UNION ALL SELECT 'customers_nation_fk', 'stg_customers', 'nation_key', 'error',
         count(*) FILTER (WHERE nation_key IS NOT NULL AND nation_key NOT IN (SELECT nation_key FROM n
                                                                             WHERE nation_key IS NOT NULL)) FROM c
  UNION ALL SELECT 'orders_key_not_null', 'stg_orders', 'order_key', 'error',
         count(*) FILTER (WHERE order_key IS NULL) FROM o
  UNION ALL SELECT 'orders_key_unique', 'stg_orders', 'order_key', 'error',
         (SELECT count(*) FROM (SELECT order_key FROM o GROUP BY 1 HAVING count(*) > 1))
  UNION ALL SELECT 'orders_status_accepted', 'stg_orders', 'order_status', 'error',
         count(*) FILTER (WHERE order_status NOT IN ('O', 'F', 'P')) FROM o
  UNION ALL SELECT 'orders_price_non_negative', 'stg_orders', 'total_price', 'error',
         count(*) FILTER (WHERE NOT (total_price >= 0)) FROM o
  UNION ALL SELECT 'orders_customer_fk', 'stg_orders', 'customer_key', 'error',
         count(*) FILTER (WHERE customer_key IS NOT NULL AND customer_key NOT IN (SELECT customer_key FROM c
                                                                                 WHERE customer_key IS NOT NULL)) FROM o
  UNION ALL SELECT 'lineitem_key_unique_combination', 'stg_lineitem', 'order_key,line_number', 'warn',
         (SELECT count(*) FROM (SELECT order_key, line_number FROM li GROUP BY 1, 2 HAVING count(*) > 1))
  UNION ALL SELECT 'lineitem_order_fk', 'stg_lineitem', 'order_key', 'error',
         count(*) FILTER (WHERE order_key IS NOT NULL AND order_key NOT IN (SELECT order_key FROM o
                                                                           WHERE order_key IS NOT NULL)) FROM li
  UNION ALL SELECT 'lineitem_quantity_positive', 'stg_lineitem', 'quantity', 'error',
         count(*) FILTER (WHERE quantity <= 0) FROM li
  UNION ALL SELECT 'lineitem_discount_range', 'stg_lineitem', 'discount', 'error',
         count(*) FILTER (WHERE NOT (discount >= 0 AND discount <= 1)) FROM li
  UNION ALL SELECT 'lineitem_return_flag_accepted', 'stg_lineitem', 'return_flag', 'error',
         count(*) FILTER (WHERE return_flag NOT IN ('A', 'N', 'R')) FROM li
  UNION ALL SELECT 'lineitem_line_status_accepted', 'stg_lineitem', 'line_status', 'error',
         count(*) FILTER (WHERE line_status NOT IN ('F', 'O')) FROM li
  UNION ALL SELECT 'nations_primary_key', 'stg_nations', 'nation_key', 'error',
         (SELECT count(*) FROM (SELECT nation_key FROM n GROUP BY 1 HAVING nation_key IS NULL OR count(*) > 1))
  UNION ALL SELECT 'nations_name_not_empty', 'stg_nations', 'nation_name', 'error',
         count(*) FILTER (WHERE trim(nation_name) = '') FROM n)
SELECT *, CASE WHEN severity = 'error' AND failures > 0 THEN 'fail' WHEN failures > 0 THEN 'warn' ELSE 'pass' END
          AS status
FROM r"""

_SPAN = """
sp AS (
  SELECT CAST(date_trunc('year', least(a, c)) AS DATE) AS d0, make_date(year(greatest(b, d)), 12, 31) AS d1
  FROM (SELECT min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS b FROM orders),
       (SELECT min(CAST(l_shipdate AS DATE)) AS c, max(CAST(l_shipdate AS DATE)) AS d FROM lineitem))"""

_CALENDAR = "WITH " + _SPAN + """,
td AS (SELECT max(CAST(o_orderdate AS DATE)) AS t FROM orders),
days AS (SELECT CAST(unnest(generate_series(CAST(d0 AS TIMESTAMP), CAST(d1 AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE)
                AS day_dt, d0 FROM sp),
cal AS (
  SELECT CAST(date_diff('day', d0, day_dt) + 1 AS BIGINT) AS day_seq, day_dt,
    CAST(strftime(day_dt, '%Y%m%d') AS INTEGER) AS day_key, strftime(day_dt, '%Y-%m-%d') AS day_text,
    strftime(day_dt, '%d.%m.%Y') AS day_eu_text, strftime(day_dt, '%d') AS day_of_month,
    dayname(day_dt) AS day_of_week, monthname(day_dt) AS month, strftime(day_dt, '%Y') AS year,
    'Q' || CAST(quarter(day_dt) AS VARCHAR) AS quarter,
    CASE quarter(day_dt) WHEN 1 THEN 'First' WHEN 2 THEN 'Second' WHEN 3 THEN 'Third' ELSE 'Fourth' END AS quarter_name,
    CAST(dayofmonth(day_dt) AS INTEGER) AS day_of_month_num, CAST(dayofweek(day_dt) + 1 AS INTEGER) AS day_of_week_num,
    CAST(isodow(day_dt) AS INTEGER) AS day_of_week_iso_num,
    CAST(floor((dayofyear(day_dt) - 1 + dayofweek(CAST(date_trunc('year', day_dt) AS DATE))) / 7) + 1 AS INTEGER)
      AS week_num,
    CAST(week(day_dt) AS INTEGER) AS week_iso_num, CAST(month(day_dt) AS INTEGER) AS month_num,
    CAST(quarter(day_dt) AS INTEGER) AS quarter_num, CAST(year(day_dt) AS INTEGER) AS year_num,
    CAST(isoyear(day_dt) AS INTEGER) AS year_of_week_iso_num,
    CAST(date_trunc('year', day_dt) AS DATE) AS year_start_dt, make_date(year(day_dt), 12, 31) AS year_end_dt,
    CAST(date_trunc('month', day_dt) AS DATE) AS month_start_dt, last_day(day_dt) AS month_end_dt,
    CAST(day_dt - CAST(dayofweek(day_dt) AS INTEGER) AS DATE) AS week_start_dt,
    CAST(day_dt - CAST(dayofweek(day_dt) AS INTEGER) + 6 AS DATE) AS week_end_dt,
    CAST(day_dt - INTERVAL 12 MONTH AS DATE) AS year_ago_dt, CAST(day_dt - INTERVAL 1 MONTH AS DATE) AS month_ago_dt,
    CAST(day_dt - 7 AS DATE) AS week_ago_dt,
    CAST(date_diff('day', CAST(date_trunc('year', day_dt) AS DATE), make_date(year(day_dt), 12, 31)) + 1 AS INTEGER)
      AS days_in_year,
    CAST(date_diff('day', CAST(date_trunc('month', day_dt) AS DATE), last_day(day_dt)) + 1 AS INTEGER) AS days_in_month,
    CASE WHEN day_dt = td.t THEN 'Y' ELSE 'N' END AS current_day_flag,
    CASE WHEN day_dt - CAST(dayofweek(day_dt) AS INTEGER) = td.t - CAST(dayofweek(td.t) AS INTEGER)
         THEN 'Y' ELSE 'N' END AS current_week_flag,
    CASE WHEN date_trunc('month', day_dt) = date_trunc('month', td.t) THEN 'Y' ELSE 'N' END AS current_month_flag,
    CASE WHEN year(day_dt) = year(td.t) THEN 'Y' ELSE 'N' END AS current_year_flag
  FROM days, td)"""

_STREAM_SNAP = "WITH " + _LOADS + f""",
v AS (
  SELECT customer_key AS c_custkey, customer_name AS c_name, account_balance AS c_acctbal, 'INSERT' AS cdc_action,
         {_T1} AS c_last_update_date, 'N' AS delete_flag, {_T1} AS valid_from, {_T1} AS row_updated_at,
         CASE WHEN customer_key IN (SELECT customer_key FROM feed WHERE cdc_change_type <> 'UPDATE_BEFORE')
              THEN {_T2} END AS valid_to,
         CAST(customer_key AS VARCHAR) || '|2024-01-01 00:00:00' AS scd_id
  FROM l1
  UNION ALL
  SELECT customer_key, customer_name, account_balance, cdc_change_type, {_T2},
         CASE WHEN cdc_change_type = 'DELETE' THEN 'Y' ELSE 'N' END, {_T2}, {_T2}, CAST(NULL AS TIMESTAMP),
         CAST(customer_key AS VARCHAR) || '|2024-01-02 00:00:00'
  FROM feed WHERE cdc_change_type <> 'UPDATE_BEFORE')
SELECT * FROM v"""

_SCD1_CHANGES = "WITH " + _LOADS + """,
oc AS (SELECT o_custkey AS customer_key, count(*) AS order_count,
              CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS open_order_count
       FROM orders GROUP BY o_custkey),
s1 AS (SELECT l1.customer_key, customer_name, nation_key, account_balance, market_segment,
              CASE WHEN order_count > 0 THEN 'Y' ELSE 'N' END AS has_orders_flag,
              CASE WHEN open_order_count > 0 THEN 'Y' ELSE 'N' END AS has_open_orders_flag,
              order_count, open_order_count, CAST(l1.customer_key AS VARCHAR) AS integration_id
       FROM l1 LEFT JOIN oc ON l1.customer_key = oc.customer_key),
d1 AS (SELECT *, row_number() OVER (ORDER BY customer_key) AS customer_surrogate_key FROM s1),
s2 AS (SELECT l2.customer_key, customer_name, nation_key, account_balance, market_segment,
              CASE WHEN order_count > 0 THEN 'Y' ELSE 'N' END AS has_orders_flag,
              CASE WHEN open_order_count > 0 THEN 'Y' ELSE 'N' END AS has_open_orders_flag,
              order_count, open_order_count, CAST(l2.customer_key AS VARCHAR) AS integration_id
       FROM l2 LEFT JOIN oc ON l2.customer_key = oc.customer_key),
ins AS (SELECT s2.*, (SELECT max(customer_surrogate_key) FROM d1) + row_number() OVER (ORDER BY customer_key)
                     AS customer_surrogate_key
        FROM s2 WHERE integration_id NOT IN (SELECT integration_id FROM d1)),
upd AS (SELECT s2.*, d1.customer_surrogate_key
        FROM s2 JOIN d1 ON s2.integration_id = d1.integration_id
        WHERE s2.customer_name IS DISTINCT FROM d1.customer_name OR s2.nation_key IS DISTINCT FROM d1.nation_key
           OR s2.account_balance IS DISTINCT FROM d1.account_balance
           OR s2.market_segment IS DISTINCT FROM d1.market_segment)
SELECT * FROM ins UNION ALL SELECT * FROM upd"""

_REPORT_SQL = {
    "quality_summary": _QUALITY,
    "segment_statements": """
        SELECT c_mktsegment AS market_segment, count(*) AS customers,
               CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS total_balance,
               min(c_acctbal) AS min_balance, max(c_acctbal) AS max_balance
        FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment""",
    "document_log_lines": """
        SELECT row_number() OVER (ORDER BY doc_id, line_no) AS row_num, doc_id, CAST(line_no AS INTEGER) AS line_no,
               log_text
        FROM (SELECT doc_id, generate_subscripts(parts, 1) AS line_no, unnest(parts) AS log_text
              FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))
        WHERE trim(log_text) <> ''""",
    "dim_customers_scd1_changes": _SCD1_CHANGES,
    "stg_fx_rates": "WITH " + _FX + " SELECT rate_date, base_currency, quote_currency, exchange_rate FROM fx",
    "customers_stream_snapshot": _STREAM_SNAP,
    "lineitem_duplicate_keys": """
        SELECT l_orderkey AS order_key, l_linenumber AS line_number, count(*) AS n_records
        FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "customer_balance_distribution": """
        SELECT 'negative_balance_check' AS test_name, count(*) AS negative_balance_customers,
               (SELECT count(*) FROM customer) AS total_customers,
               round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM customer) * 100, 2) AS negative_balance_percentage
        FROM customer WHERE c_acctbal < 0
        HAVING round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM customer) * 100, 2) > 10""",
    "segment_distribution": _SEGMENTS_SQL + """
        SELECT customer_segment, count(*) AS customer_count,
               round(CAST(count(*) AS DOUBLE) * 100.0 / CAST(sum(count(*)) OVER () AS DOUBLE), 1) AS pct
        FROM s GROUP BY 1""",
    "top_customers": _SEGMENTS_SQL + ", ins AS (" + _INSIGHTS_SELECT + """)
        SELECT customer_key, customer_name, customer_tier, risk_category, country, account_balance
        FROM ins ORDER BY account_balance DESC, customer_key LIMIT 10""",
    "calendar_range": "WITH " + _SPAN + """
        SELECT d0 AS start_date, d1 AS end_date, CAST(date_diff('day', d0, d1) + 1 AS BIGINT) AS total_days FROM sp""",
    "cdc_change_mix": "WITH " + _LOADS + """
        SELECT cdc_change_type, count(*) AS change_count FROM feed GROUP BY 1""",
    "e2e_assertions": _SEGMENTS_SQL + ", ins AS (" + _INSIGHTS_SELECT + "), " + _FX + """,
        a AS (
        SELECT 'customers_staged' AS assertion, (SELECT count(*) FROM (SELECT c_custkey FROM customer GROUP BY 1)) AS actual,
               '==' AS op, (SELECT count(DISTINCT c_custkey) FROM customer) AS expected
        UNION ALL SELECT 'orders_staged', (SELECT count(*) FROM orders), '==', (SELECT count(*) FROM orders)
        UNION ALL SELECT 'customer_segments_distinct', (SELECT count(DISTINCT customer_segment) FROM s), '==', 5
        UNION ALL SELECT 'fx_usd_rows', (SELECT count(*) FROM fx WHERE base_currency = 'USD'), '>', 0
        UNION ALL SELECT 'fx_intervals_usd', (SELECT count(*) FROM fx_daily WHERE from_currency = 'USD'), '==',
                         (SELECT count(*) FROM fx WHERE base_currency = 'USD')
        UNION ALL SELECT 'null_customer_classifications',
                         (SELECT count(*) FROM ins WHERE customer_classification IS NULL), '==', 0)
        SELECT *, CASE op WHEN '==' THEN actual = expected WHEN '>' THEN actual > expected
                          ELSE actual >= expected END AS passed FROM a""",
    "dim_calendar_day": _CALENDAR + """
        SELECT * FROM cal
        UNION ALL BY NAME
        SELECT 0 AS day_key, CAST(0 AS BIGINT) AS day_seq, DATE '1900-01-01' AS day_dt, '1900-01-01' AS day_text,
               'January' AS month, 'First' AS quarter_name, 1900 AS year_num""",
    "dim_customers_share": "WITH " + _DIM_CUSTOMERS + """
        SELECT customer_key, '**********' AS customer_name, market_segment, nation_key, nation_name, region_key,
               value_segment, has_orders_flag FROM dc""",
}


#: Every round of all ten starts by recursion: a start stops when it is still.
_KMEANS_SQL = "WITH RECURSIVE" + _SEGMENTS_SQL.strip()[4:] + """,
raw AS (SELECT *, CAST(round(account_balance * 100) AS HUGEINT) AS r0, CAST(round_even(balance_percentile * 1000000, 0) AS HUGEINT) AS r1,
  CAST(balance_rank_in_nation AS HUGEINT) AS r2 FROM s),
st AS (SELECT count(*) AS rows, count(r0) AS n0, sum(r0) AS s0, sum(r0 * r0) AS q0, count(r1) AS n1, sum(r1) AS s1, sum(r1 * r1) AS q1,
  count(r2) AS n2, sum(r2) AS s2, sum(r2 * r2) AS q2 FROM raw),
x AS MATERIALIZED (SELECT raw.* EXCLUDE (r0, r1, r2),
  CAST(round_even((coalesce(CAST(r0 AS DOUBLE), CAST(s0 AS DOUBLE) / n0) - CAST(s0 AS DOUBLE) / n0) / sqrt(CAST(q0 * n0 - s0 * s0 AS DOUBLE) / CAST(n0 * rows AS DOUBLE)) * 65536, 0) AS BIGINT) AS x0,
  CAST(round_even((coalesce(CAST(r1 AS DOUBLE), CAST(s1 AS DOUBLE) / n1) - CAST(s1 AS DOUBLE) / n1) / sqrt(CAST(q1 * n1 - s1 * s1 AS DOUBLE) / CAST(n1 * rows AS DOUBLE)) * 65536, 0) AS BIGINT) AS x1,
  CAST(round_even((coalesce(CAST(r2 AS DOUBLE), CAST(s2 AS DOUBLE) / n2) - CAST(s2 AS DOUBLE) / n2) / sqrt(CAST(q2 * n2 - s2 * s2 AS DOUBLE) / CAST(n2 * rows AS DOUBLE)) * 65536, 0) AS BIGINT) AS x2
  FROM raw, st),
draws AS (SELECT i AS start, row_number() OVER (PARTITION BY i ORDER BY md5((42 + i) || ':' || customer_key), x0, x1, x2) - 1 AS k, x0, x1, x2 FROM x, range(10) g(i)),
rec(it, start, k, c0, c1, c2, moves) AS (
  SELECT 0, start, k, x0, x1, x2, true FROM draws WHERE k < 5
  UNION ALL
  SELECT it + 1, start, k, d0, d1, d2, sum((d0 - c0) * (d0 - c0) + (d1 - c1) * (d1 - c1) + (d2 - c2) * (d2 - c2)) OVER (PARTITION BY start) > 429496 FROM (
    SELECT it, start, k, c0, c1, c2,
      coalesce((t0 - ((t0 % n + n) % n)) // n, c0) AS d0, coalesce((t1 - ((t1 % n + n) % n)) // n, c1) AS d1, coalesce((t2 - ((t2 % n + n) % n)) // n, c2) AS d2 FROM (
      SELECT it, start, k, c0, c1, c2, nullif(count(*) FILTER (mine), 0) AS n, CAST(sum(x0) FILTER (mine) AS BIGINT) AS t0,
        CAST(sum(x1) FILTER (mine) AS BIGINT) AS t1, CAST(sum(x2) FILTER (mine) AS BIGINT) AS t2 FROM (
        SELECT rec.*, x0, x1, x2, row_number() OVER (PARTITION BY start, customer_key
          ORDER BY (x0 - c0) * (x0 - c0) + (x1 - c1) * (x1 - c1) + (x2 - c2) * (x2 - c2), k) = 1 AS mine
        FROM rec, x WHERE moves AND it < 300) GROUP BY ALL))),
last AS MATERIALIZED (SELECT start, k, c0, c1, c2 FROM rec QUALIFY it = max(it) OVER (PARTITION BY start)),
near AS MATERIALIZED (SELECT start, customer_key, min({'d': (x0 - c0) * (x0 - c0) + (x1 - c1) * (x1 - c1) + (x2 - c2) * (x2 - c2), 'k': k}) AS m
  FROM x, last GROUP BY start, customer_key),
best AS (SELECT start FROM near GROUP BY start ORDER BY sum(m.d), start LIMIT 1),
own AS (SELECT x.*, m.k AS k, sqrt(CAST(m.d AS DOUBLE)) / 65536.0 AS d FROM near JOIN best USING (start) JOIN x USING (customer_key)),
named AS (SELECT k, CAST(row_number() OVER (ORDER BY sum(CAST(round(account_balance * 100) AS BIGINT)) / count(account_balance) DESC, k) - 1 AS INTEGER) AS ml_cluster FROM own GROUP BY k)
SELECT customer_key, customer_name, nation_key, account_balance, balance_percentile, balance_rank_in_nation, customer_segment, market_segment,
  ml_cluster, ['Premium Elite', 'High Value Stable', 'Growth Potential', 'Standard Base', 'At Risk'][ml_cluster + 1] AS cluster_name,
  d AS distance_to_cluster_center, d > (SELECT quantile_cont(d, 0.95) FROM own) AS is_cluster_outlier,
  1.0 - d / (SELECT max(d) FROM own) AS ml_confidence_score, '1.0' AS ml_model_version, 'KMeans' AS clustering_algorithm,
  5 AS n_clusters_used, '[''account_balance'', ''balance_percentile'', ''balance_rank_in_nation'']' AS features_used
FROM own JOIN named USING (k)"""


def _model_tests_sql(sqls: dict[str, str]) -> str:
    """The declared model tests evaluated by DuckDB over its own versions of
    the datasets (the oracle SQL above), one materialized CTE per dataset."""
    from strata.plans.model_tests import MODEL_TESTS, check_name, row_predicate_sql
    needed = set(MODEL_TESTS) | {arg[0] for tests in MODEL_TESTS.values() for _, k, arg in tests if k == "fk"}
    ctes = [f"m_{n} AS MATERIALIZED ({sqls[n]})" for n in sorted(needed)]
    parts = []
    for model, tests in MODEL_TESTS.items():
        for column, kind, arg in tests:
            pred = row_predicate_sql(column, kind, arg)
            if pred is not None:
                cnt = f"SELECT count(*) FROM m_{model} WHERE {pred}"
            elif kind in ("unique", "unique_combination"):
                cols = column if kind == "unique" else ", ".join(arg)
                cnt = f"SELECT count(*) FROM (SELECT {cols} FROM m_{model} GROUP BY {cols} HAVING count(*) > 1)"
            elif kind == "primary_key":
                cnt = (f"SELECT count(*) FROM (SELECT {column} FROM m_{model} GROUP BY {column} "
                       f"HAVING {column} IS NULL OR count(*) > 1)")
            else:  # fk
                parent, pcol = arg
                cnt = (f"SELECT count(*) FROM m_{model} WHERE {column} IS NOT NULL AND {column} NOT IN "
                       f"(SELECT {pcol} FROM m_{parent} WHERE {pcol} IS NOT NULL)")
            col = column if column is not None else (",".join(arg) if kind == "unique_combination" else None)
            col_sql = f"'{col}'" if col is not None else "CAST(NULL AS VARCHAR)"
            parts.append(f"SELECT '{check_name(model, column, kind, arg)}' AS check_name, '{model}' AS model, "
                         f"{col_sql} AS column_name, 'error' AS severity, CAST(({cnt}) AS BIGINT) AS failures")
    return ("WITH " + ",\n".join(ctes) + "\nSELECT *, CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END AS status"
            " FROM (" + "\nUNION ALL ".join(parts) + ")")


def oracle_sql() -> dict[str, str]:
    llm_sql = {**llm.ORACLE, **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})} if llm else {}
    return {**_library_sql(), **llm_sql}


def _library_sql() -> dict[str, str]:
    sqls = {
        "stg_regions": "SELECT r_regionkey AS region_key, r_name AS region_name FROM region",
        "stg_nations": "SELECT n_nationkey AS nation_key, n_name AS nation_name, n_regionkey AS region_key FROM nation",
        "stg_customers": """
            SELECT c_custkey AS customer_key, min(c_name) AS customer_name, min(c_nationkey) AS nation_key,
                   min(c_acctbal) AS account_balance, min(c_mktsegment) AS market_segment
            FROM customer GROUP BY c_custkey""",
        "customer_segments": _SEGMENTS_SQL + "SELECT * FROM s",
        "customer_insights": _SEGMENTS_SQL + """
            SELECT customer_key, customer_name, n.n_name AS country, account_balance,
              avg_nation_balance AS country_average_balance, balance_vs_nation_avg AS balance_vs_country_average,
              customer_segment AS customer_tier, market_segment, nation_ranking AS country_ranking,
              statistical_class AS statistical_classification,
              round(balance_percentile * 100, 1) AS balance_percentile_score,
              balance_rank_in_nation AS rank_in_country,
              CASE WHEN customer_segment = 'PREMIUM' AND nation_ranking = 'TOP_10_IN_NATION' THEN 'VIP Customer'
                   WHEN customer_segment IN ('PREMIUM', 'HIGH_VALUE') THEN 'High Value Customer'
                   WHEN statistical_class = 'ABOVE_AVERAGE' THEN 'Above Average Customer'
                   ELSE 'Standard Customer' END AS customer_classification,
              CASE WHEN account_balance < 0 THEN 'Credit Risk' WHEN customer_segment = 'LOW_VALUE' THEN 'Retention Risk'
                   WHEN balance_vs_nation_avg < -1000 THEN 'Performance Risk' ELSE 'Low Risk' END AS risk_category
            FROM s LEFT JOIN nation n ON s.nation_key = n.n_nationkey""",
        "stg_orders": """SELECT o_orderkey AS order_key, o_custkey AS customer_key, o_orderstatus AS order_status,
            o_totalprice AS total_price, o_orderdate AS order_date, o_orderpriority AS order_priority FROM orders""",
        "stg_lineitem": "WITH " + _LINES + """
            SELECT l_orderkey AS order_key, l_linenumber AS line_number, l_partkey AS part_key, l_suppkey AS supplier_key,
              l_quantity AS quantity, l_extendedprice AS extended_price, l_discount AS discount, l_tax AS tax,
              l_returnflag AS return_flag, l_linestatus AS line_status, l_shipdate AS ship_date,
              l_commitdate AS commit_date, l_receiptdate AS receipt_date FROM li""",
        "stg_customers_with_tests": """
            SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
              CASE WHEN c_name IS NULL OR trim(c_name) = '' THEN 'INVALID_NAME'
                   WHEN c_acctbal < 0 THEN 'NEGATIVE_BALANCE' ELSE 'VALID' END AS data_quality_flag,
              'TPC_H' AS integration_source, 2 AS retention_days
            FROM customer WHERE c_custkey IS NOT NULL""",
        "stg_orders_incremental": "WITH " + _ORDERS_INC + " SELECT * FROM oi",
        "int_customers_with_orders": """
            SELECT o_custkey AS customer_key, count(*) AS order_count,
                   CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS open_order_count
            FROM orders GROUP BY o_custkey""",
        "customer_clustering_kmeans": _KMEANS_SQL,
        "order_customer_versions": """
            WITH v AS (SELECT c_custkey, i AS version, DATE '1995-01-01' + CAST(i * 400 + (c_custkey * 37) % 300 AS INTEGER) AS valid_from,
              CASE WHEN c_custkey % 5 = 0 THEN 389 ELSE 399 END AS days FROM customer, range(6) g(i))
            SELECT o_orderkey AS order_key, o_custkey AS customer_key, CAST(o_orderdate AS DATE) AS order_date,
              CAST(version AS INTEGER) AS customer_version, valid_from AS customer_valid_from
            FROM orders LEFT JOIN v ON c_custkey = o_custkey AND CAST(o_orderdate AS DATE) >= valid_from
              AND (version = 5 OR CAST(o_orderdate AS DATE) <= valid_from + CAST(days AS INTEGER))""",
        "event_last_purchase": """
            SELECT e.event_id, e.user_id, e.ts, e.event_type, p.event_id AS last_purchase, p.value AS last_amount, p.ts AS last_at
            FROM events e ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p ON e.user_id = p.user_id AND e.ts >= p.ts""",
        "supplier_orders_by_sketch": _FOL + """
            SELECT supplier_key, CAST(y AS INTEGER) AS order_year, count(*) AS total_order_lines, count(DISTINCT order_key) AS total_orders, true AS sketch_within_error
            FROM (SELECT *, unnest([year(order_date), 0]) AS y FROM fol) GROUP BY ALL""",
        "customer_change_feed_by_digest": "WITH " + _LOADS + " SELECT *, '2' AS cdc_version FROM feed",
        "leased_order_keys": """
            SELECT count(*) AS new_rows, count(*) AS different_keys, true AS all_above_the_mark
            FROM orders WHERE o_orderkey > (SELECT max(o_orderkey) * 9 // 10 FROM orders)""",
        "isolated_statements": """
            SELECT c_mktsegment AS market_segment, CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN count(*) END AS customers,
              CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN max(c_custkey) END AS last_key, c_mktsegment = 'AUTOMOBILE' AS failed
            FROM customer GROUP BY c_mktsegment""",
        "order_lines_checked": """
            WITH f AS (SELECT l_quantity, list_filter([CASE WHEN l_quantity > 45 THEN 'quantity_over_45' END, CASE WHEN l_discount >= 0.08 THEN 'discounted' END,
              CASE WHEN l_returnflag NOT IN ('A', 'N') THEN 'flag_known' END], lambda x: x IS NOT NULL) AS c FROM lineitem),
            per AS (SELECT len(c) > 0 AS quarantined, unnest(CASE WHEN len(c) > 0 THEN c ELSE [NULL] END) AS check_name, l_quantity FROM f)
            SELECT quarantined, check_name, count(*) AS rows_written, CAST(sum(CAST(l_quantity AS DECIMAL(38,6))) AS DOUBLE) AS quantity,
              CASE WHEN check_name IS NULL THEN (SELECT count(*) FROM lineitem) ELSE count(*) END AS rows_counted FROM per GROUP BY 1, 2""",
        "orders_freshness": """
            SELECT o_orderstatus AS order_status, max(o_orderdate) AS max_loaded_at,
              CAST(datediff('second', max(o_orderdate), (SELECT max(o_orderdate) FROM orders)) AS BIGINT) AS age_seconds,
              CASE WHEN datediff('second', max(o_orderdate), (SELECT max(o_orderdate) FROM orders)) > 86400 THEN 'error'
                   WHEN datediff('second', max(o_orderdate), (SELECT max(o_orderdate) FROM orders)) > 0 THEN 'warn' ELSE 'pass' END AS status
            FROM orders WHERE o_orderstatus IN ('F', 'O', 'P') GROUP BY 1""",
        "negative_balance_share": """
            SELECT 'negative_balance_check' AS test_name, count(*) AS negative_balance_customers, (SELECT count(*) FROM customer) AS total_customers,
              round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM customer) * 100, 2) AS negative_balance_percentage
            FROM customer WHERE c_acctbal < 0 HAVING round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM customer) * 100, 2) > 1""",
        "customers_share_developer": "WITH " + _DIM_CUSTOMERS + """
            SELECT customer_key, sha256(customer_name) AS customer_name, market_segment, nation_key, nation_name, region_key,
              value_segment, has_orders_flag FROM dc""",
        "line_surrogate_keys": """
            SELECT l_orderkey, l_linenumber, md5(l_orderkey || '-' || l_linenumber || '-' || coalesce(nullif(l_returnflag, 'N'), '_null_')) AS line_key,
              CASE WHEN l_returnflag = 'R' THEN CAST(l_shipdate AS DATE) + 9 ELSE greatest(CAST(l_shipdate AS DATE), DATE '1900-01-01') END AS last_date FROM lineitem""",
        "orders_open_or_recent": """
            SELECT o_orderkey, o_orderstatus, o_custkey AS o_cust_wid, CASE WHEN o_orderstatus = 'O' OR CAST(o_orderdate AS DATE) >=
              (SELECT max(CAST(o_orderdate AS DATE)) - 90 FROM orders) THEN o_totalprice ELSE o_totalprice + 1 END AS o_totalprice FROM orders""",
        "customer_clustering_ntile": _SEGMENTS_SQL + """,
            cl AS (SELECT *, CAST(ntile(5) OVER (ORDER BY balance_percentile DESC, customer_key) - 1 AS INTEGER) AS ml_cluster FROM s),
            st AS (SELECT ml_cluster, avg(account_balance) AS center_balance, stddev_samp(account_balance) AS stddev_balance
                   FROM cl GROUP BY ml_cluster),
            sc AS (SELECT cl.*, abs(cl.account_balance - st.center_balance) / nullif(st.stddev_balance, 0) AS d
                   FROM cl JOIN st USING (ml_cluster))
            SELECT customer_key, customer_name, nation_key, account_balance, balance_percentile, balance_rank_in_nation,
              customer_segment, market_segment, ml_cluster,
              CASE ml_cluster WHEN 0 THEN 'Premium Elite' WHEN 1 THEN 'High Value Stable' WHEN 2 THEN 'Growth Potential'
                   WHEN 3 THEN 'Standard Base' WHEN 4 THEN 'At Risk' END AS cluster_name,
              round(d, 4) AS distance_to_cluster_center,
              coalesce(d > 2.0, false) AS is_cluster_outlier,
              round(1.0 - least(d / nullif(max(d) OVER (), 0), 1.0), 4) AS ml_confidence_score,
              '1.0' AS ml_model_version, 'KMeans_NTILE_approx' AS clustering_algorithm, 5 AS n_clusters_used,
              '["ACCOUNT_BALANCE", "BALANCE_PERCENTILE", "BALANCE_RANK_IN_NATION"]' AS features_used
            FROM sc""",
        "order_facts": _ORDER_FACTS + " SELECT * FROM of",
        "clean_nations": f"""
            SELECT n_nationkey AS nation_key, upper(trim(n_name)) AS nation_name, n_regionkey AS region_key,
                   CAST(length(n_name) AS INTEGER) AS name_length, {_GOV} AS government_type FROM nation""",
        "nation_summary": f"""
            WITH cn AS (SELECT upper(trim(n_name)) AS nation_name, length(n_name) AS name_length, {_GOV} AS government_type
                        FROM nation)
            SELECT nation_name, government_type, CAST(name_length AS INTEGER) AS name_length,
              CASE WHEN name_length <= 5 THEN 'SHORT' WHEN name_length <= 10 THEN 'MEDIUM' ELSE 'LONG' END AS name_category,
              upper(substr(nation_name, 1, 1)) || lower(substr(nation_name, 2)) AS display_name
            FROM cn""",
        "int_fx_rates_daily": "WITH " + _FX + " SELECT * FROM fx_daily",
        "lookup_exchange_rates": _CAL_FX + " SELECT * FROM lkp",
        "dim_customers": "WITH " + _DIM_CUSTOMERS + " SELECT * FROM dc",
        "dim_orders": "WITH " + _DIM_ORDERS + " SELECT * FROM dord",
        "dim_current_year_orders": "WITH " + _DIM_ORDERS + """
            SELECT * FROM dord WHERE order_date >= (SELECT CAST(max(order_date) AS DATE) - INTERVAL 1 YEAR FROM dord)""",
        "dim_current_year_open_orders": "WITH " + _DIM_ORDERS + """
            SELECT * FROM dord WHERE order_date >= (SELECT CAST(max(order_date) AS DATE) - INTERVAL 1 YEAR FROM dord)
              AND order_status = 'O'""",
        "fct_order_lines": _FOL + " SELECT * FROM fol",
        "dim_customers_increment": "WITH " + _DIM_CUSTOMERS + """
            SELECT * FROM dc WHERE customer_key > (SELECT max(c_custkey) * 9 // 10 FROM customer)""",
        "dim_orders_increment": "WITH " + _DIM_ORDERS + """
            SELECT * FROM dord WHERE order_date > (SELECT max(o_orderdate) FROM orders
              WHERE CAST(o_orderdate AS DATE) <= (SELECT max(CAST(o_orderdate AS DATE)) - 30 FROM orders))""",
        "fct_order_lines_increment": _FOL + """
            SELECT * FROM fol WHERE order_date > (SELECT max(o_orderdate) FROM orders
              WHERE CAST(o_orderdate AS DATE) <= (SELECT max(CAST(o_orderdate AS DATE)) - 30 FROM orders))""",
        "fct_order_lines_by_supplier_month": _FOL + """
            SELECT supplier_key, CAST(year(order_date) AS INTEGER) AS order_year, CAST(month(order_date) AS INTEGER) AS order_month,
              make_date(CAST(year(order_date) AS INTEGER), CAST(month(order_date) AS INTEGER), 1) AS month_start_date,
              count(*) AS total_order_lines, count(DISTINCT order_key) AS total_orders,
              CAST(sum(CAST(quantity AS DECIMAL(38,6))) AS DOUBLE) AS total_quantity,
              CAST(sum(CAST(extended_price AS DECIMAL(38,6))) AS DOUBLE) AS total_extended_price,
              CAST(sum(CAST(discounted_price AS DECIMAL(38,6))) AS DOUBLE) AS total_discounted_price,
              CAST(sum(CAST(final_price AS DECIMAL(38,6))) AS DOUBLE) AS total_final_price,
              CAST(sum(CAST(final_price AS DECIMAL(18,6)) * CAST(eur_conversion_rate AS DECIMAL(18,6))) AS DOUBLE) AS total_final_price_eur,
              CAST(sum(CAST(quantity AS DECIMAL(38,6))) AS DOUBLE) / count(quantity) AS avg_quantity_per_line,
              CAST(sum(CAST(final_price AS DECIMAL(38,6))) AS DOUBLE) / count(final_price) AS avg_final_price_per_line,
              CAST(sum(CAST(discount AS DECIMAL(38,6))) AS DOUBLE) / count(discount) AS avg_discount_rate,
              min(ship_date) AS earliest_ship_date, max(ship_date) AS latest_ship_date,
              CAST(count(*) AS DOUBLE) / count(DISTINCT order_key) AS avg_lines_per_order
            FROM fol GROUP BY ALL""",
        "fact_order_line_pivot": """
            SELECT l_suppkey AS supplier_key, l_partkey AS part_key,
              sum(CASE WHEN year(l_shipdate) = 1995 THEN l_quantity END) AS shipped_1995,
              sum(CASE WHEN year(l_shipdate) = 1996 THEN l_quantity END) AS shipped_1996,
              sum(CASE WHEN year(l_shipdate) = 1997 THEN l_quantity END) AS shipped_1997,
              sum(CASE WHEN year(l_shipdate) = 1998 THEN l_quantity END) AS shipped_1998,
              sum(CASE WHEN year(l_shipdate) = 1999 THEN l_quantity END) AS shipped_1999,
              sum(CASE WHEN year(l_shipdate) = 2000 THEN l_quantity END) AS shipped_2000,
              sum(CASE WHEN year(l_shipdate) = 2001 THEN l_quantity END) AS shipped_2001
            FROM lineitem GROUP BY ALL""",
        "fact_order_line_full_reload": _CAL_FX + "," + _DIM_ORDERS + """
            SELECT 'UNKNOWN' AS source_system_code, coalesce(d.order_key, -1) AS l_order_wid,
              coalesce(d.customer_key, -1) AS l_cust_wid, l.*, x.exchange_rate AS eur_conversion_rate,
              coalesce(CAST(l.l_orderkey AS VARCHAR), '') || '~' || coalesce(CAST(l.l_linenumber AS VARCHAR), '') AS integration_id
            FROM lineitem l LEFT JOIN dord d ON l.l_orderkey = d.order_key
            LEFT JOIN lkp x ON x.from_currency = 'USD' AND x.to_currency = 'EUR' AND x.day_dt = CAST(d.order_date AS DATE)""",
        "executive_dashboard": _ORDER_FACTS + """,
            dm AS (
              SELECT order_date, order_year, order_month, order_quarter,
                CAST(sum(CAST(total_order_value AS DECIMAL(38,6))) AS DOUBLE) AS daily_revenue,
                CAST(sum(order_count) AS BIGINT) AS daily_orders, CAST(sum(unique_customers) AS BIGINT) AS daily_active_customers,
                avg(CAST(avg_order_value AS DECIMAL(38,10))) AS daily_avg_order_value,
                CAST(sum(CAST(revenue_o_status AS DECIMAL(38,6))) AS DOUBLE) AS open_revenue,
                CAST(sum(CAST(revenue_f_status AS DECIMAL(38,6))) AS DOUBLE) AS fulfilled_revenue,
                CAST(sum(CAST(revenue_p_status AS DECIMAL(38,6))) AS DOUBLE) AS partial_revenue
              FROM of GROUP BY ALL),
            w AS (SELECT *, lag(daily_revenue) OVER (ORDER BY order_date) AS prev_day_revenue,
                    avg(daily_revenue) OVER (ORDER BY order_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS seven_day_avg_revenue
                  FROM dm)
            SELECT order_date AS metric_date, daily_revenue AS total_revenue, daily_orders AS total_orders,
              CAST(round(CAST(daily_avg_order_value AS DECIMAL(38,10)), 2) AS DOUBLE) AS avg_order_value, daily_active_customers AS active_customers,
              CAST(round(CAST(seven_day_avg_revenue AS DECIMAL(38,10)), 6) AS DOUBLE) AS "7-Day Average Revenue",
              CASE WHEN prev_day_revenue > 0 THEN CAST(round(CAST((daily_revenue - prev_day_revenue) / prev_day_revenue * 100 AS DECIMAL(38,10)), 2) AS DOUBLE) END AS "Daily Revenue Growth %",
              CAST(round(CAST(daily_revenue / nullif(CAST(daily_orders AS DOUBLE), 0) AS DECIMAL(38,10)), 2) AS DOUBLE) AS "Revenue per Order",
              CAST(round(CAST(daily_revenue / nullif(CAST(daily_active_customers AS DOUBLE), 0) AS DECIMAL(38,10)), 2) AS DOUBLE) AS "Revenue per Customer",
              CAST(round(CAST(fulfilled_revenue / nullif(daily_revenue, 0) * 100 AS DECIMAL(38,10)), 1) AS DOUBLE) AS "Fulfillment Rate %",
              CAST(round(CAST(open_revenue / nullif(daily_revenue, 0) * 100 AS DECIMAL(38,10)), 1) AS DOUBLE) AS "Open Orders %",
              CAST(round(CAST(partial_revenue / nullif(daily_revenue, 0) * 100 AS DECIMAL(38,10)), 1) AS DOUBLE) AS "Partial Orders %",
              CASE WHEN daily_revenue > seven_day_avg_revenue * 1.2 THEN 'Excellent'
                   WHEN daily_revenue > seven_day_avg_revenue * 1.1 THEN 'Good'
                   WHEN daily_revenue > seven_day_avg_revenue * 0.9 THEN 'Average' ELSE 'Below Average' END AS "Performance Rating",
              CASE WHEN daily_revenue > prev_day_revenue THEN '↗️ Increasing'
                   WHEN daily_revenue < prev_day_revenue THEN '↘️ Decreasing' ELSE '➡️ Stable' END AS "Trend",
              order_year AS "Year", order_quarter AS "Quarter", order_month AS "Month"
            FROM w WHERE order_date >= (SELECT max(CAST(o_orderdate AS DATE)) - INTERVAL 2 YEAR FROM orders)""",
        "dim_customers_hashed": "WITH " + _SCD_SRC + " SELECT * FROM src",
        "dim_customers_macro_example": "WITH " + _SCD_SRC + """ SELECT * FROM src UNION ALL
            SELECT 0, 'Unknown', NULL, NULL, NULL, 'N', 'N', NULL, NULL, NULL, 0""",
        "dim_orders_macro_example": "WITH " + _DIM_CUSTOMERS + """
            SELECT o.*, coalesce(dc.customer_key, -1) AS o_cust_wid, coalesce(CAST(o.o_orderkey AS VARCHAR), '') AS integration_id,
                   row_number() OVER (ORDER BY o.o_orderkey) AS o_order_wid
            FROM orders o LEFT JOIN dc ON dc.customer_key = o.o_custkey
            UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, 0, NULL, 0""",
        "customer_cdc_stream": """SELECT c_custkey AS customer_key, c_name AS customer_name, c_acctbal AS account_balance,
            'INSERT' AS cdc_change_type, CAST(c_custkey AS VARCHAR) AS cdc_version FROM customer""",
        "customer_change_feed": "WITH " + _LOADS + " SELECT *, '2' AS cdc_version FROM feed",
        "dim_customer_changes": "WITH " + _LOADS + """
            SELECT row_number() OVER (ORDER BY customer_key) AS log_id, *, '2' AS cdc_version,
                   CASE WHEN cdc_change_type = 'DELETE' THEN 'Y' ELSE 'N' END AS delete_flag
            FROM feed WHERE cdc_change_type <> 'UPDATE_BEFORE'""",
        "customers_snapshot_scd2": "WITH " + _LOADS + f"""
            SELECT l1.*, {_T1} AS valid_from, {_T1} AS row_updated_at, CAST(NULL AS TIMESTAMP) AS valid_to,
              CAST(customer_key AS VARCHAR) || '|2024-01-01 00:00:00' AS scd_id, true AS current_flag
            FROM l1 WHERE customer_key IN (SELECT customer_key FROM l2) AND customer_key NOT IN (SELECT customer_key FROM chg)
            UNION ALL
            SELECT l1.*, {_T1}, {_T1}, {_T2}, CAST(customer_key AS VARCHAR) || '|2024-01-01 00:00:00', false
            FROM l1 WHERE customer_key IN (SELECT customer_key FROM chg) OR customer_key NOT IN (SELECT customer_key FROM l2)
            UNION ALL
            SELECT l2.*, {_T2}, {_T2}, CAST(NULL AS TIMESTAMP), CAST(customer_key AS VARCHAR) || '|2024-01-02 00:00:00', true
            FROM l2 WHERE customer_key IN (SELECT customer_key FROM chg) OR customer_key NOT IN (SELECT customer_key FROM l1)""",
        "customers_snapshot_new_record": "WITH " + _LOADS + f"""
            SELECT l1.*, {_T1} AS valid_from, {_T1} AS row_updated_at, false AS is_deleted,
              CAST(NULL AS TIMESTAMP) AS valid_to,
              CAST(customer_key AS VARCHAR) || '|2024-01-01 00:00:00' AS scd_id, true AS current_flag
            FROM l1 WHERE customer_key IN (SELECT customer_key FROM l2) AND customer_key NOT IN (SELECT customer_key FROM chg)
            UNION ALL
            SELECT l1.*, {_T1}, {_T1}, false, {_T2}, CAST(customer_key AS VARCHAR) || '|2024-01-01 00:00:00', false
            FROM l1 WHERE customer_key IN (SELECT customer_key FROM chg) OR customer_key NOT IN (SELECT customer_key FROM l2)
            UNION ALL
            SELECT l2.*, {_T2}, {_T2}, false, CAST(NULL AS TIMESTAMP),
              CAST(customer_key AS VARCHAR) || '|2024-01-02 00:00:00', true
            FROM l2 WHERE customer_key IN (SELECT customer_key FROM chg) OR customer_key NOT IN (SELECT customer_key FROM l1)
            UNION ALL
            SELECT l1.*, {_T2}, {_T2}, true, CAST(NULL AS TIMESTAMP),
              CAST(customer_key AS VARCHAR) || '|2024-01-02 00:00:00', true
            FROM l1 WHERE customer_key NOT IN (SELECT customer_key FROM l2)""",
        "customers_snapshot_three_loads": "WITH " + _LOADS + f"""
            SELECT l1.*, {_T1} AS valid_from, {_T1} AS row_updated_at, CAST(NULL AS TIMESTAMP) AS valid_to,
              CAST(customer_key AS VARCHAR) || '|2024-01-01 00:00:00' AS scd_id, true AS current_flag
            FROM l1 WHERE customer_key IN (SELECT customer_key FROM l2) AND customer_key NOT IN (SELECT customer_key FROM chg)
            UNION ALL
            SELECT l1.*, {_T1}, {_T1}, {_T2}, CAST(customer_key AS VARCHAR) || '|2024-01-01 00:00:00', false
            FROM l1 WHERE customer_key IN (SELECT customer_key FROM chg) OR customer_key NOT IN (SELECT customer_key FROM l2)
            UNION ALL
            SELECT l2.*, {_T2}, {_T2}, CAST(NULL AS TIMESTAMP), CAST(customer_key AS VARCHAR) || '|2024-01-02 00:00:00', true
            FROM l2 WHERE customer_key IN (SELECT customer_key FROM chg) OR customer_key NOT IN (SELECT customer_key FROM l1)
            UNION ALL
            SELECT l1.*, TIMESTAMP '2024-01-03 00:00:00', TIMESTAMP '2024-01-03 00:00:00', CAST(NULL AS TIMESTAMP),
              CAST(customer_key AS VARCHAR) || '|2024-01-03 00:00:00', true
            FROM l1 WHERE customer_key NOT IN (SELECT customer_key FROM l2)""",
        "customer_dim_load": _DIM_LOAD + " SELECT * FROM dim",
        "customer_dim_load_counts": _DIM_LOAD + """
            SELECT CAST(sum(CASE WHEN st = 't2' THEN 1 ELSE 0 END) AS BIGINT) AS rows_expired,
                   CAST(sum(CASE WHEN st = 't2' THEN 1 ELSE 0 END) AS BIGINT) AS rows_inserted_new_version,
                   CAST(sum(CASE WHEN st = 'new' THEN 1 ELSE 0 END) AS BIGINT) AS rows_inserted_new_key,
                   CAST(sum(CASE WHEN st = 't1' THEN 1 ELSE 0 END) AS BIGINT) AS rows_type1_updated FROM j""",
        "sales_fact_second_load": _SALES + f""",
            last AS (SELECT max(CAST(o_orderdate AS DATE)) - 60 AS d FROM orders),
            batch AS (SELECT * FROM so WHERE order_line_number = 1 AND order_date >= (SELECT d FROM last)),
            bounds AS (SELECT min(order_date) AS lo, max(order_date) AS hi FROM batch),
            now AS (SELECT * FROM so WHERE NOT coalesce(order_date BETWEEN (SELECT lo FROM bounds) AND (SELECT hi FROM bounds), false)
                    UNION ALL SELECT * REPLACE (2 AS batch_id) FROM batch)
            SELECT coalesce(co.dk, -1) AS order_date_key, coalesce(cs.dk, -1) AS ship_date_key,
              coalesce(dim.customer_key, -1) AS customer_key, coalesce(part.p_partkey, -1) AS product_key,
              order_number, order_line_number, quantity, unit_price, unit_cost, discount_amount,
              quantity * unit_price - coalesce(discount_amount, 0.0) AS sales_amount, quantity * unit_cost AS cost_amount,
              (quantity * unit_price - coalesce(discount_amount, 0.0)) - quantity * unit_cost AS gross_profit,
              source_order_id AS source_system_key, order_date, {_T1} AS load_date, batch_id
            FROM now LEFT JOIN cal co ON now.order_date = co.d LEFT JOIN cal cs ON now.ship_date = cs.d
            LEFT JOIN dim ON now.customer_id = dim.customer_business_key LEFT JOIN part ON now.product_id = part.p_partkey""",
        "stg_orders_incremental_second_run": "WITH " + _ORDERS_INC + """,
            b AS (SELECT max(o_orderkey) * 9 // 10 AS upto, max(CAST(o_orderdate AS DATE)) AS today FROM orders),
            f AS (SELECT max(o_orderkey) AS seen FROM orders WHERE o_orderkey <= (SELECT upto FROM b))
            SELECT * EXCLUDE (recent, fresh) REPLACE (
              CASE WHEN recent OR fresh THEN o_totalprice ELSE o_totalprice + 1 END AS o_totalprice,
              CASE WHEN recent THEN 'RECENT' WHEN fresh THEN 'HISTORICAL' ELSE 'FULL_LOAD' END AS processing_type)
            FROM (SELECT oi.*, CAST(o_orderdate AS DATE) >= (SELECT today - 2 FROM b) AS recent,
                         o_orderkey > (SELECT seen FROM f) AS fresh FROM oi)""",
        "dim_customers_hashed_second_run": "WITH " + _SCD_SRC + """
            SELECT * REPLACE (CASE WHEN customer_key % 10 <> 4 THEN row_number() OVER (PARTITION BY customer_key % 10 = 4 ORDER BY customer_key)
              ELSE (SELECT count(*) FROM src WHERE customer_key % 10 <> 4) + row_number() OVER (PARTITION BY customer_key % 10 = 4 ORDER BY customer_key)
              END AS customer_surrogate_key) FROM src""",
        "fact_order_line_second_reload": _CAL_FX + "," + _DIM_ORDERS + """,
            lines AS (SELECT 'UNKNOWN' AS source_system_code, coalesce(d.order_key, -1) AS l_order_wid,
              coalesce(d.customer_key, -1) AS l_cust_wid, l.*, x.exchange_rate AS eur_conversion_rate,
              coalesce(CAST(l.l_orderkey AS VARCHAR), '') || '~' || coalesce(CAST(l.l_linenumber AS VARCHAR), '') AS integration_id
            FROM lineitem l LEFT JOIN dord d ON l.l_orderkey = d.order_key
            LEFT JOIN lkp x ON x.from_currency = 'USD' AND x.to_currency = 'EUR' AND x.day_dt = CAST(d.order_date AS DATE))
            SELECT * FROM lines UNION ALL SELECT * REPLACE ('LEGACY' AS source_system_code) FROM lines WHERE l_linenumber = 1""",
        "order_lines_merged": """
            SELECT * EXCLUDE (rn) REPLACE (CASE WHEN l_linenumber = 1 THEN 0.0 ELSE l_tax END AS l_tax) FROM (
              SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity,
                l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn FROM lineitem) WHERE rn = 1""",
        "sales_fact_load": _SALES + f"""
            SELECT coalesce(co.dk, -1) AS order_date_key, coalesce(cs.dk, -1) AS ship_date_key,
              coalesce(dim.customer_key, -1) AS customer_key, coalesce(part.p_partkey, -1) AS product_key,
              order_number, order_line_number, quantity, unit_price, unit_cost, discount_amount,
              quantity * unit_price - coalesce(discount_amount, 0.0) AS sales_amount, quantity * unit_cost AS cost_amount,
              (quantity * unit_price - coalesce(discount_amount, 0.0)) - quantity * unit_cost AS gross_profit,
              source_order_id AS source_system_key, order_date, {_T1} AS load_date, batch_id
            FROM so LEFT JOIN cal co ON so.order_date = co.d LEFT JOIN cal cs ON so.ship_date = cs.d
            LEFT JOIN dim ON so.customer_id = dim.customer_business_key LEFT JOIN part ON so.product_id = part.p_partkey
            WHERE order_date >= DATE '1900-01-01'""",
        "fact_load_orphans": _SALES + f"""
            SELECT DISTINCT 'FactSales' AS table_name, source_order_id AS source_key, 'Customer' AS orphan_type,
              CAST(customer_id AS VARCHAR) AS orphan_value, {_T1} AS load_date
            FROM so WHERE customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_business_key FROM dim)""",
        "tpch_q1": """
            SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(38,6))) AS DOUBLE) AS sum_base_price,
              CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(38,6))) AS DOUBLE) AS sum_disc_price,
              CAST(sum(CAST(l_extendedprice * (1 - l_discount) * (1 + l_tax) AS DECIMAL(38,6))) AS DOUBLE) AS sum_charge,
              CAST(sum(CAST(l_quantity AS DECIMAL(38,6))) AS DOUBLE) / count(l_quantity) AS avg_qty,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(38,6))) AS DOUBLE) / count(l_extendedprice) AS avg_price,
              CAST(sum(CAST(l_discount AS DECIMAL(38,6))) AS DOUBLE) / count(l_discount) AS avg_disc, count(*) AS count_order
            FROM lineitem WHERE l_shipdate <= DATE '1998-12-01' - INTERVAL 90 DAY
            GROUP BY l_returnflag, l_linestatus ORDER BY l_returnflag, l_linestatus""",
        "tpch_q2": """
            WITH ps AS (SELECT l_partkey AS ps_partkey, l_suppkey AS ps_suppkey, min(l_extendedprice / l_quantity) AS ps_supplycost
                        FROM lineitem WHERE l_quantity > 0 GROUP BY ALL),
            offers AS (
              SELECT s_acctbal, s_name, n_name, p_partkey, ps_supplycost
              FROM part, supplier, ps, nation, region
              WHERE p_partkey = ps_partkey AND s_suppkey = ps_suppkey AND p_size = 15
                AND s_nationkey = n_nationkey AND n_regionkey = r_regionkey AND r_name = 'EUROPE')
            SELECT * FROM offers o
            WHERE ps_supplycost = (SELECT min(ps_supplycost) FROM offers i WHERE i.p_partkey = o.p_partkey)
            ORDER BY s_acctbal DESC, n_name, s_name, p_partkey LIMIT 100""",
        "tpch_q3": """
            SELECT l_orderkey, o_orderdate,
              CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(38,6))) AS DOUBLE) AS revenue
            FROM customer, orders, lineitem
            WHERE c_mktsegment = 'BUILDING' AND c_custkey = o_custkey AND l_orderkey = o_orderkey
              AND o_orderdate < DATE '1995-03-15' AND l_shipdate > DATE '1995-03-15'
            GROUP BY l_orderkey, o_orderdate ORDER BY revenue DESC, o_orderdate, l_orderkey LIMIT 10""",
        "tpch_q4": "WITH " + _LINES + """
            SELECT o_orderpriority, count(*) AS order_count FROM orders
            WHERE o_orderdate >= DATE '1996-07-01' AND o_orderdate < DATE '1996-07-01' + INTERVAL 3 MONTH
              AND EXISTS (SELECT 1 FROM li WHERE li.l_orderkey = orders.o_orderkey AND li.l_commitdate < li.l_receiptdate)
            GROUP BY o_orderpriority ORDER BY o_orderpriority""",
        **_RUNLOG_SQL,
        **_REPORT_SQL,
    }
    sqls["model_test_summary"] = _model_tests_sql(sqls)
    return sqls
