"""Run-log analytics on literal logs: watermark increment (K6), smallest
capacity that fits (J7) with overrides, forecast line (M5)."""

import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL


def _log(spark, rows):
    return spark.createDataFrame(rows, "query_id long, start_time timestamp_ntz, total_elapsed_time long, "
                                       "compilation_time long, execution_time long, warehouse_size string, "
                                       "bytes_scanned long, partitions_scanned long, query_tag string, "
                                       "objects_modified string")


def _tag(target, incr, app="build"):
    return f'{{"app": "{app}", "target_name": "{target}", "module_details": {{"is_incremental": "{incr}"}}}}'


def test_query_history_increment_and_capacity(spark):
    from strata.plans.runlog import capacity_assignment, query_history
    from strata.session import RunContext
    from strata.sources.tables import Catalog
    cat = Catalog(spark, SF_SMALL)
    t = lambda d: dt.datetime(2024, 1, d)
    rows = [(1, t(1), 1000, 10, 900, "small", 50_000_000, 5, _tag("db.s.a", "false"), "[]"),
            (2, t(2), 1000, 10, 900, "Small", 5_000_000, 5, _tag("db.s.a", "true"), "[]"),
            (3, t(3), 1000, 10, 900, "x-small", 150_000_000, 5, _tag("db.s.b", "true"), "[]"),
            (4, t(3), 1000, 10, 900, "x-small", 1, 5, "not json", "[]"),
            (5, t(4), 1000, 10, 900, "x-small", 1, 5, _tag("db.s.c", "true", app="other"), "[]")]
    log = _log(spark, rows)
    ctx = RunContext(data_clock=True)
    qh = query_history(cat, ctx, log=log)
    assert sorted(r["query_id"] for r in qh.collect()) == [1, 2, 3]  # bad JSON and other apps dropped
    assert qh.where("query_id = 2").first()["warehouse_nodes"] == 2
    more = query_history(cat, ctx, existing=qh.where("query_id <= 2"), log=log)
    assert [r["query_id"] for r in more.collect()] == [3]
    # a: full scans 50M -> smallest capacity above is small_wh (100M); b: 150M -> medium_wh (200M)
    expected = {"DB.S.A": "small_wh", "DB.S.B": "medium_wh", "DB.SCHEMA.TABLE": "my_warehouse"}
    got = capacity_assignment(cat, ctx, history=qh).collect()
    assert {r["model_name"]: r["recommended_warehouse"] for r in got} == expected


def test_scan_forecast_line(spark):
    from strata.plans.runlog import scan_forecast
    from strata.session import RunContext
    from strata.sources.tables import Catalog
    hist = spark.createDataFrame([("A", True, dt.date(2024, 1, d), 10 * d) for d in (1, 2, 3)]
                                 + [("B", False, dt.date(2024, 1, 5), 7)],
                                 "target_name string, is_incremental boolean, query_date date, partitions_scanned long")
    got = {r["target_name"]: r for r in scan_forecast(Catalog(spark, SF_SMALL), RunContext(), history=hist).collect()}
    assert got["A"]["forecast_date"] == dt.date(2024, 1, 4) and abs(got["A"]["forecast_partitions_scanned"] - 40) < 1e-6
    assert got["B"]["forecast_partitions_scanned"] == 7.0 and got["B"]["slope"] is None


def test_query_history_table_keeps_history(spark):
    from strata.plans.runlog import query_history_table
    from strata.session import RunContext
    from strata.sources.tables import Catalog
    cat = Catalog(spark, SF_SMALL)
    t = lambda d: dt.datetime(2024, 1, d)
    log1 = _log(spark, [(1, t(1), 1000, 10, 900, "small", 5, 5, _tag("db.s.a", "true"), "[]")])
    log2 = _log(spark, [(2, t(2), 1000, 10, 900, "small", 5, 5, _tag("db.s.a", "true"), "[]")])
    v1 = query_history_table(cat, RunContext(), log=log1).checkpoint()
    v2 = query_history_table(cat, RunContext(), existing=v1, full_refresh=True, log=log2)
    assert sorted(r["query_id"] for r in v2.collect()) == [1, 2]  # full refresh ignored: history kept
    v3 = query_history_table(cat, RunContext(), existing=v1, full_refresh=True, allow_full_refresh=True, log=log2)
    assert [r["query_id"] for r in v3.collect()] == [2]


def test_cdc_stream_sample_on_later_runs(spark):
    from strata.plans.history import customer_cdc_stream
    from strata.session import RunContext
    from strata.sources.tables import Catalog
    cat = Catalog(spark, "/root/testdata/sf0.01")
    full = customer_cdc_stream(cat, RunContext()).count()
    part = customer_cdc_stream(cat, RunContext(), incremental=True).count()
    assert full == 1500 and 90 < part < 220
