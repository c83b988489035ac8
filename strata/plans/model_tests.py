"""The reference's declared column and table tests, applied to our datasets.

``MODEL_TESTS`` is a declarative list per dataset; ``model_checks`` turns it
into ``quality.Check`` objects over the built datasets (each dataset is built
once and shared by its checks, so ``run_checks`` fuses its row-level tests
into one aggregate pass).  Tests on wall-clock audit columns are left out
(they hold the run time, not data), as are tests whose column the dataset
names differently.

Notation: (column, kind, argument) with kinds ``not_null``, ``unique``,
``primary_key`` (not null and unique),
``values`` (accepted values), ``expr`` (column-level expression appended to
the column), ``range`` (inclusive min, max), ``not_empty``, ``positive``,
``fk`` (dataset, column); table-level tests use column None with ``expr``
or ``unique_combination``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from strata.operators import quality as Q
from strata.plans import calendar, gold, silver
from strata.plans.reports import LINE_STATUSES, MARKET_SEGMENTS, ORDER_STATUSES, RETURN_FLAGS
from strata.session import RunContext

# Accepted values declared by the reference's model tests.
GOVERNMENT_TYPE_VALUES = ("FEDERAL", "REPUBLIC", "KINGDOM", "EMPIRE", "CONFEDERATION", "UNION", "FEDERATION",
                          "PRINCIPALITY", "DUCHY", "SULTANATE", "EMIRATE", "OTHER")
CLUSTER_NAME_VALUES = ("High Value Stable", "Premium Elite", "Growth Potential", "Standard Base", "At Risk")
NAME_CATEGORY_VALUES = ("SHORT", "MEDIUM", "LONG")
CLASSIFICATION_VALUES = ("VIP Customer", "High Value Customer", "Above Average Customer", "Standard Customer")
RISK_VALUES = ("Credit Risk", "Retention Risk", "Performance Risk", "Low Risk")
FLAG_VALUES = ("Y", "N")
VALUE_SEGMENT_VALUES = ("High Value", "Medium Value", "Standard")
STATUS_DESC_VALUES = ("Open", "Fulfilled", "Partial", "Unknown")

STAGED_STATUS_VALUES = ("OPEN", "FULFILLED", "PARTIAL", "UNKNOWN")
DATA_QUALITY_VALUES = ("VALID", "INVALID_NAME", "NEGATIVE_BALANCE")
CHANGE_ACTION_VALUES = ("INSERT", "UPDATE", "DELETE")

MODEL_TESTS: dict[str, list[tuple]] = {
    "stg_nations": [
        ("nation_key", "primary_key", None), ("nation_name", "not_null", None), ("nation_name", "unique", None),
        ("region_key", "not_null", None), ("region_key", "fk", ("stg_regions", "region_key"))],
    "stg_regions": [("region_name", "not_null", None), ("region_name", "unique", None)],
    "stg_customers": [
        ("customer_key", "primary_key", None), ("customer_name", "not_null", None), ("nation_key", "not_null", None),
        ("nation_key", "fk", ("stg_nations", "nation_key")), ("account_balance", "not_null", None),
        ("market_segment", "not_null", None), ("market_segment", "values", MARKET_SEGMENTS)],
    "stg_orders": [
        ("order_key", "primary_key", None), ("customer_key", "not_null", None),
        ("customer_key", "fk", ("stg_customers", "customer_key")), ("order_status", "not_null", None),
        ("order_status", "values", ORDER_STATUSES), ("total_price", "not_null", None),
        ("total_price", "expr", ">= 0"), ("order_date", "not_null", None), ("order_priority", "not_null", None)],
    "stg_customers_with_tests": [
        ("c_custkey", "primary_key", None), ("c_name", "not_null", None), ("data_quality_flag", "not_null", None),
        ("data_quality_flag", "values", DATA_QUALITY_VALUES)],
    "stg_lineitem": [
        ("order_key", "not_null", None), ("order_key", "fk", ("stg_orders", "order_key")),
        ("line_number", "not_null", None), ("line_number", "expr", ">= 1"), ("part_key", "not_null", None),
        ("supplier_key", "not_null", None), ("quantity", "not_null", None), ("quantity", "expr", "> 0"),
        ("extended_price", "not_null", None), ("extended_price", "expr", "> 0"), ("discount", "not_null", None),
        ("discount", "range", (0, 1)), ("tax", "not_null", None), ("tax", "expr", ">= 0"),
        ("return_flag", "not_null", None), ("return_flag", "values", RETURN_FLAGS),
        ("line_status", "not_null", None), ("line_status", "values", LINE_STATUSES),
        ("ship_date", "not_null", None), ("commit_date", "not_null", None), ("receipt_date", "not_null", None),
        (None, "unique_combination", ("order_key", "line_number"))],
    "stg_fx_rates": [
        ("rate_date", "not_null", None), ("base_currency", "not_null", None), ("base_currency", "not_empty", None),
        ("quote_currency", "not_null", None), ("quote_currency", "not_empty", None),
        ("exchange_rate", "not_null", None),
        (None, "unique_combination", ("rate_date", "base_currency", "quote_currency"))],
    "stg_orders_incremental": [
        ("o_orderkey", "primary_key", None), ("o_custkey", "not_null", None),
        ("o_custkey", "fk", ("stg_customers", "customer_key")), ("o_orderstatus", "not_null", None),
        ("o_orderstatus", "values", ORDER_STATUSES), ("o_totalprice", "not_null", None),
        ("o_totalprice", "expr", ">= 0"), ("o_orderdate", "not_null", None), ("order_status_desc", "not_null", None),
        ("order_status_desc", "values", STAGED_STATUS_VALUES), ("processing_type", "not_null", None)],
    "customer_cdc_stream": [
        ("customer_key", "primary_key", None), ("cdc_change_type", "not_null", None),
        ("cdc_change_type", "values", CHANGE_ACTION_VALUES)],
    "clean_nations": [
        ("nation_key", "not_null", None), ("nation_key", "unique", None), ("nation_name", "not_null", None),
        ("nation_name", "unique", None), ("region_key", "not_null", None), ("name_length", "not_null", None),
        ("name_length", "expr", "> 0"), ("government_type", "not_null", None),
        ("government_type", "values", GOVERNMENT_TYPE_VALUES)],
    "int_customers_with_orders": [
        ("customer_key", "not_null", None), ("customer_key", "unique", None), ("order_count", "not_null", None),
        ("order_count", "expr", ">= 0"), ("open_order_count", "not_null", None),
        ("open_order_count", "expr", ">= 0"), ("open_order_count", "expr", "<= order_count")],
    "customer_segments": [
        ("customer_key", "not_null", None), ("customer_key", "unique", None), ("customer_name", "not_null", None),
        ("account_balance", "not_null", None), ("balance_percentile", "not_null", None),
        ("balance_percentile", "range", (0, 1)), ("balance_rank_in_nation", "not_null", None),
        ("balance_rank_in_nation", "expr", ">= 1")],
    "lookup_exchange_rates": [
        ("from_currency", "not_null", None), ("to_currency", "not_null", None),
        ("exchange_rate", "not_null", None), ("exchange_rate", "expr", "> 0")],
    "int_fx_rates_daily": [
        ("day_dt", "not_null", None), ("from_currency", "not_null", None), ("from_currency", "not_empty", None),
        ("to_currency", "not_null", None), ("to_currency", "not_empty", None),
        ("conversion_rate", "not_null", None), ("conversion_rate", "expr", "> 0"), ("end_date", "not_null", None),
        ("end_date", "expr", ">= day_dt"),
        (None, "unique_combination", ("day_dt", "from_currency", "to_currency"))],
    "customer_clustering_ntile": [
        ("customer_key", "not_null", None), ("customer_key", "unique", None), ("ml_cluster", "not_null", None),
        ("ml_cluster", "values", (0, 1, 2, 3, 4)), ("cluster_name", "not_null", None),
        ("cluster_name", "values", CLUSTER_NAME_VALUES), ("ml_confidence_score", "not_null", None),
        ("ml_confidence_score", "range", (0, 1)), ("is_cluster_outlier", "not_null", None)],
    "order_facts": [
        ("order_date", "not_null", None), ("customer_key", "not_null", None), ("order_count", "positive", None),
        ("total_order_value", "positive", None)],
    "dim_current_year_orders": [
        ("order_key", "not_null", None), ("order_key", "unique", None), ("customer_key", "not_null", None),
        ("order_status", "not_null", None), ("total_price", "not_null", None), ("total_price", "expr", ">= 0"),
        ("order_date", "not_null", None)],
    "nation_summary": [
        ("nation_name", "not_null", None), ("government_type", "not_null", None), ("name_length", "not_null", None),
        ("name_length", "expr", "> 0"), ("name_category", "not_null", None),
        ("name_category", "values", NAME_CATEGORY_VALUES), ("display_name", "not_null", None)],
    "customer_insights": [
        ("customer_key", "not_null", None), ("customer_key", "unique", None), ("customer_name", "not_null", None),
        ("country", "not_null", None), ("account_balance", "not_null", None),
        ("country_average_balance", "not_null", None), ("balance_vs_country_average", "not_null", None),
        ("customer_tier", "not_null", None), ("market_segment", "not_null", None),
        ("country_ranking", "not_null", None), ("statistical_classification", "not_null", None),
        ("balance_percentile_score", "not_null", None), ("balance_percentile_score", "range", (0, 100)),
        ("rank_in_country", "not_null", None), ("customer_classification", "not_null", None),
        ("customer_classification", "values", CLASSIFICATION_VALUES), ("risk_category", "not_null", None),
        ("risk_category", "values", RISK_VALUES)],
    "dim_current_year_open_orders": [
        ("order_key", "not_null", None), ("order_key", "unique", None), ("customer_key", "not_null", None),
        ("order_status", "not_null", None), ("order_status", "values", ("O",)), ("total_price", "not_null", None),
        ("total_price", "expr", ">= 0"), ("order_date", "not_null", None)],
    "dim_customers": [
        ("customer_key", "not_null", None), ("customer_key", "unique", None), ("customer_name", "not_null", None),
        ("customer_name", "not_empty", None), ("account_balance", "not_null", None),
        ("market_segment", "not_null", None), ("market_segment", "values", MARKET_SEGMENTS),
        ("nation_key", "not_null", None), ("nation_key", "fk", ("stg_nations", "nation_key")),
        ("nation_name", "not_null", None), ("region_key", "not_null", None), ("total_orders", "not_null", None),
        ("total_orders", "expr", ">= 0"), ("open_orders", "not_null", None), ("open_orders", "expr", ">= 0"),
        ("has_orders_flag", "not_null", None), ("has_orders_flag", "values", FLAG_VALUES),
        ("has_open_orders_flag", "not_null", None), ("has_open_orders_flag", "values", FLAG_VALUES),
        ("value_segment", "not_null", None), ("value_segment", "values", VALUE_SEGMENT_VALUES),
        (None, "expr", "total_orders >= open_orders")],
    "dim_orders": [
        ("order_key", "not_null", None), ("order_key", "unique", None), ("customer_key", "not_null", None),
        ("customer_key", "fk", ("dim_customers", "customer_key")), ("order_status", "not_null", None),
        ("order_status", "values", ORDER_STATUSES), ("order_status_desc", "not_null", None),
        ("order_status_desc", "values", STATUS_DESC_VALUES), ("total_price", "not_null", None),
        ("total_price", "expr", ">= 0"), ("order_date", "not_null", None), ("order_priority", "not_null", None),
        ("customer_name", "not_null", None), ("nation_key", "not_null", None), ("value_segment", "not_null", None),
        ("order_year", "not_null", None), ("order_year", "range", (1990, 2030)),
        ("order_quarter", "not_null", None), ("order_quarter", "values", (1, 2, 3, 4)),
        ("order_month", "not_null", None), ("order_month", "range", (1, 12))],
    "dim_calendar_day": [
        ("day_key", "not_null", None), ("day_key", "unique", None), ("day_dt", "not_null", None),
        ("day_dt", "unique", None), ("day_text", "not_null", None), ("month", "not_null", None),
        ("quarter_name", "not_null", None), ("year_num", "not_null", None)],
    "dim_customers_share": [
        ("customer_key", "not_null", None), ("customer_key", "unique", None), ("customer_name", "not_null", None),
        ("has_orders_flag", "values", FLAG_VALUES)],
    "fct_order_lines_by_supplier_month": [
        ("supplier_key", "not_null", None), ("order_year", "not_null", None), ("order_year", "range", (1990, 2100)),
        ("order_month", "not_null", None), ("order_month", "range", (1, 12)), ("month_start_date", "not_null", None),
        ("total_order_lines", "not_null", None), ("total_order_lines", "expr", "> 0"),
        ("total_orders", "not_null", None), ("total_orders", "expr", "> 0"), ("total_quantity", "not_null", None),
        ("total_quantity", "expr", ">= 0"), ("total_extended_price", "not_null", None),
        ("total_extended_price", "expr", ">= 0"), ("total_discounted_price", "not_null", None),
        ("total_discounted_price", "expr", ">= 0"), ("total_final_price", "not_null", None),
        ("total_final_price", "expr", ">= 0"), ("total_final_price_eur", "not_null", None),
        ("total_final_price_eur", "expr", ">= 0"), ("avg_quantity_per_line", "not_null", None),
        ("avg_final_price_per_line", "not_null", None), ("avg_discount_rate", "not_null", None),
        ("avg_lines_per_order", "not_null", None), ("avg_lines_per_order", "expr", "> 0"),
        (None, "unique_combination", ("supplier_key", "order_year", "order_month"))],
    "fct_order_lines": [
        ("order_key", "not_null", None), ("order_key", "fk", ("dim_orders", "order_key")),
        ("line_number", "not_null", None), ("line_number", "expr", ">= 1"), ("part_key", "not_null", None),
        ("supplier_key", "not_null", None), ("customer_key", "not_null", None),
        ("customer_key", "fk", ("dim_customers", "customer_key")), ("quantity", "not_null", None),
        ("quantity", "expr", "> 0"), ("extended_price", "not_null", None), ("extended_price", "expr", "> 0"),
        ("discount", "not_null", None), ("discount", "range", (0, 1)), ("tax", "not_null", None),
        ("tax", "expr", ">= 0"), ("discounted_price", "not_null", None), ("discounted_price", "expr", "> 0"),
        ("discounted_price", "expr", "<= extended_price"), ("final_price", "not_null", None),
        ("final_price", "expr", "> 0"), ("eur_conversion_rate", "not_null", None),
        ("eur_conversion_rate", "expr", "> 0"), ("final_price_eur", "not_null", None),
        ("final_price_eur", "expr", "> 0"), ("return_flag", "not_null", None),
        ("return_flag", "values", RETURN_FLAGS), ("line_status", "not_null", None),
        ("line_status", "values", LINE_STATUSES), ("ship_date", "not_null", None),
        ("commit_date", "not_null", None), ("receipt_date", "not_null", None), ("order_date", "not_null", None),
        ("order_status_desc", "not_null", None),
        (None, "unique_combination", ("order_key", "line_number")),
        (None, "expr", "final_price >= 0"), (None, "expr", "discounted_price <= extended_price")],
    "executive_dashboard": [
        ("metric_date", "not_null", None), ("total_revenue", "not_null", None), ("total_revenue", "expr", ">= 0"),
        ("total_orders", "not_null", None), ("total_orders", "expr", ">= 0"), ("avg_order_value", "expr", "> 0"),
        ("active_customers", "not_null", None), ("active_customers", "expr", ">= 0")],
    "fact_order_line_full_reload": [
        ("l_order_wid", "not_null", None), ("l_cust_wid", "not_null", None), ("l_linenumber", "not_null", None),
        ("l_linenumber", "expr", ">= 1")],
    "fact_order_line_pivot": [("supplier_key", "not_null", None), ("part_key", "not_null", None)],
}


# Tables whose rows a dataset has, one for one: its keys are nearly all
# different, so they are dealt by this count before they are compared.
ROWS_OF = {"stg_orders": "orders", "stg_orders_incremental": "orders", "dim_orders": "orders",
           "stg_lineitem": "lineitem", "fct_order_lines": "lineitem"}
# Keys that a dataset's own join has brought together already.
TOGETHER = {("dim_orders", "customer_key"), ("fct_order_lines", "order_key")}
# Datasets of orders or lines; beyond what one pass holds they are tested one after another.
LARGE = ("stg_orders", "stg_orders_incremental", "stg_lineitem", "order_facts", "executive_dashboard", "dim_orders",
         "dim_current_year_orders", "dim_current_year_open_orders", "fct_order_lines",
         "fct_order_lines_by_supplier_month", "fact_order_line_full_reload", "fact_order_line_pivot")
# Wide ones, by slices of a column of which a failing row or key has one value: their row and key tests.
SLICED = {"fct_order_lines": "order_key", "fct_order_lines_by_supplier_month": "supplier_key"}
SLICE_ROWS = 75_000_000  # lines


def _builders():
    from strata.plans import history, staging
    return {
        "clean_nations": silver.clean_nations, "int_customers_with_orders": silver.int_customers_with_orders,
        "customer_segments": silver.customer_segments, "lookup_exchange_rates": silver.lookup_exchange_rates,
        "int_fx_rates_daily": silver.int_fx_rates_daily, "customer_clustering_ntile": silver.customer_clustering_ntile,
        "order_facts": silver.order_facts, "dim_current_year_orders": gold.dim_current_year_orders,
        "nation_summary": gold.nation_summary, "customer_insights": gold.customer_insights,
        "dim_current_year_open_orders": gold.dim_current_year_open_orders, "dim_customers": gold.dim_customers,
        "dim_orders": gold.dim_orders, "dim_calendar_day": calendar.data_calendar,
        "dim_customers_share": gold.dim_customers_share,
        "fct_order_lines_by_supplier_month": gold.fct_order_lines_by_supplier_month,
        "fct_order_lines": gold.fct_order_lines, "executive_dashboard": gold.executive_dashboard,
        "fact_order_line_full_reload": gold.fact_order_line_full_reload,
        "fact_order_line_pivot": gold.fact_order_line_pivot, "stg_nations": staging.stg_nations,
        "stg_regions": staging.stg_regions, "stg_customers": staging.stg_customers, "stg_orders": staging.stg_orders,
        "stg_customers_with_tests": staging.stg_customers_with_tests, "stg_lineitem": staging.stg_lineitem,
        "stg_fx_rates": staging.stg_fx_rates, "stg_orders_incremental": staging.stg_orders_incremental,
        "customer_cdc_stream": history.customer_cdc_stream,
    }


def check_name(model: str, column: str | None, kind: str, arg) -> str:
    """Stable, unique name: a digest of the argument tells same-kind tests apart."""
    import hashlib
    tail = "" if arg is None else f"_{hashlib.sha256(repr(arg).encode()).hexdigest()[:16]}"
    return f"{model}__{column or 'table'}__{kind}{tail}"


def row_predicate_sql(column: str | None, kind: str, arg) -> str | None:
    """SQL text that is TRUE on a failing row (shared by both engines' tests;
    the datasets themselves are computed independently)."""
    if kind == "not_null":
        return f"{column} IS NULL"
    if kind == "values":
        vals = ", ".join(repr(v) if isinstance(v, str) else str(v) for v in arg)
        return f"NOT ({column} IN ({vals}))"
    if kind == "expr":
        return f"NOT ({arg})" if column is None else f"NOT ({column} {arg})"
    if kind == "range":
        return f"NOT ({column} >= {arg[0]} AND {column} <= {arg[1]})"
    if kind == "not_empty":
        return f"trim({column}) = ''"
    if kind == "positive":
        return f"{column} <= 0"
    return None


def model_checks(cat, ctx: RunContext = RunContext(), models: list[str] | None = None) -> list[Q.Check]:
    from pyspark.sql import functions as F
    builders = _builders()
    frames: dict[str, DataFrame] = {}
    # Datasets built from other datasets reuse them, so shared inputs (the
    # ranked segments, the dimensions, the line facts) are planned once and
    # identical exchanges are reused inside the one summary query.
    derived = {
        "customer_insights": lambda: gold.customer_insights(cat, ctx, segments=frame("customer_segments")),
        "customer_clustering_ntile": lambda: silver.customer_clustering_ntile(
            cat, ctx, segments=frame("customer_segments")),
        "dim_orders": lambda: gold.dim_orders(cat, ctx, customers=frame("dim_customers")),
        "dim_current_year_orders": lambda: gold.dim_current_year_orders(cat, ctx, orders=frame("dim_orders")),
        "dim_current_year_open_orders": lambda: frame("dim_current_year_orders").where("order_status = 'O'"),
        "fct_order_lines": lambda: gold.fct_order_lines(cat, ctx, orders=frame("dim_orders")),
        "fct_order_lines_by_supplier_month": lambda: gold.fct_order_lines_by_supplier_month(
            cat, ctx, lines=frame("fct_order_lines")),
        "executive_dashboard": lambda: gold.executive_dashboard(cat, ctx, facts=frame("order_facts")),
        "fact_order_line_full_reload": lambda: gold.fact_order_line_full_reload(
            cat, ctx, orders=frame("dim_orders"), rates=frame("lookup_exchange_rates")),
    }

    def frame(name: str) -> DataFrame:
        if name not in frames:
            frames[name] = derived[name]() if name in derived else builders[name](cat, ctx)
        return frames[name]

    counted: dict[str, int] = {}

    def rows(model: str, keys) -> int | None:
        table = ROWS_OF.get(model)
        if table is None or any((model, k) in TOGETHER for k in keys):
            return None
        if table not in counted:
            counted[table] = getattr(cat, table).count()  # from the files' footers
        return counted[table]

    checks = []
    for model, tests in MODEL_TESTS.items():
        if models is not None and model not in models:
            continue
        df = frame(model)
        for column, kind, arg in tests:
            name = check_name(model, column, kind, arg)
            pred = row_predicate_sql(column, kind, arg)
            if pred is not None:
                checks.append(Q.row_check(name, model, df, F.expr(pred), column))
            elif kind == "unique":
                checks.append(Q.frame_check(name, model, df, lambda d, c=column, n=rows(model, (column,)): Q.unique(d, c, rows=n), column))
            elif kind == "primary_key":
                checks.append(Q.frame_check(name, model, df, lambda d, c=column, n=rows(model, (column,)): Q.primary_key(d, c, rows=n), column))
            elif kind == "unique_combination":
                checks.append(Q.frame_check(name, model, df, lambda d, cs=arg, n=rows(model, arg): Q.unique(d, *cs, rows=n), ",".join(arg)))
            elif kind == "fk":
                parent = frame(arg[0])
                checks.append(Q.frame_check(name, model, df,
                                            lambda d, c=column, p=parent, pc=arg[1], n=rows(model, (column,)):
                                            Q.relationships(d, c, p, pc, rows=n), column))
    return checks


def batches(checks: list[Q.Check], lines: int) -> list[list[Q.Check]]:
    """What is tested at a time: small datasets together, each large one by
    itself, the tests of line facts that need shuffles of their own apart, and
    wide ones in slices."""
    from dataclasses import replace

    from pyspark.sql import functions as F
    found: dict[tuple, list[Q.Check]] = {}
    for ch in checks:
        if ch.model not in LARGE:
            found.setdefault((), []).append(ch)
        elif ch.model == "fct_order_lines" and ch.predicate is None:
            found.setdefault((ch.model, ch.name), []).append(ch)
        else:
            found.setdefault((ch.model,), []).append(ch)
    out = []
    for key, batch in found.items():
        n = -(-lines // SLICE_ROWS) if len(key) == 1 and key[0] in SLICED else 1
        for i in range(n):
            # One frame for the batch, so its row tests stay one pass.
            part = batch[0].frame if n == 1 else batch[0].frame.where(F.pmod(F.xxhash64(SLICED[key[0]]), F.lit(n)) == i)
            out.append(batch if n == 1 else [replace(ch, frame=part) for ch in batch])
    return out


def model_test_summary(cat, ctx: RunContext = RunContext(), models: list[str] | None = None) -> DataFrame:
    """One row per declared model test: failures and pass/warn/fail.  In one
    query as long as its lines are few; beyond that the shuffle files of all
    tests at once would take many times the input."""
    from strata.operators.tasks import ROWS_PER_TASK
    checks = model_checks(cat, ctx, models)
    lines = cat.lineitem.count()  # from the files' footers
    if lines <= ROWS_PER_TASK * checks[0].frame.sparkSession.sparkContext.defaultParallelism:
        return Q.run_checks(checks)
    return Q.run_checks_in_turn(batches(checks, lines))
