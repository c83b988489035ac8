"""Expose datasets to SQL: ``register_views`` builds the named datasets and
registers each as a temporary view, so report SQL written against the
warehouse tables runs unchanged through ``spark.sql``."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame

from strata.session import RunContext


def dataset_builders() -> dict[str, Callable]:
    from strata.plans import calendar, gold, history, reports, runlog, silver, staging, tpch
    return {
        "stg_regions": staging.stg_regions, "stg_nations": staging.stg_nations,
        "stg_customers": staging.stg_customers, "stg_orders": staging.stg_orders,
        "stg_lineitem": staging.stg_lineitem, "stg_fx_rates": staging.stg_fx_rates,
        "stg_customers_with_tests": staging.stg_customers_with_tests,
        "stg_orders_incremental": staging.stg_orders_incremental,
        "int_customers_with_orders": silver.int_customers_with_orders,
        "customer_segments": silver.customer_segments, "customer_clustering": silver.customer_clustering_ntile,
        "order_facts_dynamic": silver.order_facts, "clean_nations": silver.clean_nations,
        "int_fx_rates_daily": silver.int_fx_rates_daily, "lookup_exchange_rates": silver.lookup_exchange_rates,
        "nation_summary": gold.nation_summary, "dim_customers": gold.dim_customers, "dim_orders": gold.dim_orders,
        "dim_current_year_orders": gold.dim_current_year_orders, "customer_insights": gold.customer_insights,
        "fct_order_lines": gold.fct_order_lines, "executive_dashboard": gold.executive_dashboard,
        "fct_order_lines_by_supplier_month": gold.fct_order_lines_by_supplier_month,
        "dim_calendar_day": calendar.data_calendar, "customer_cdc_stream": history.customer_cdc_stream,
        "dim_customer_changes": history.dim_customer_changes, "query_history": runlog.query_history,
        "quality_summary": reports.quality_summary,
        "tpch_q1": tpch.q1_pricing_summary, "tpch_q2": tpch.q2_minimum_cost_supplier,
        "tpch_q3": tpch.q3_shipping_priority, "tpch_q4": tpch.q4_order_priority,
    }


def register_views(cat, ctx: RunContext, names: Iterable[str]) -> dict[str, DataFrame]:
    """Build and register the named datasets (building may run the size
    checks and checkpoints a dataset needs; nothing else is computed until a
    query reads the view)."""
    builders = dataset_builders()
    out = {}
    for n in names:
        df = builders[n](cat, ctx)
        df.createOrReplaceTempView(n)
        out[n] = df
    return out
