"""Boundaries that once changed the answer: null keys, new columns, sizes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.functions.numeric import exact_product_sum
from strata.operators.cdc import change_feed
from strata.operators.interval_join import smallest_above
from strata.operators.merge import upsert
from strata.operators.scd import scd2_snapshot



def _ts(day):
    return F.lit(dt.datetime(2024, 1, day)).cast("timestamp_ntz")


def _rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


@pytest.mark.parametrize("limit", [0, 1, 10, None])
def test_upsert_is_the_same_on_both_sides_of_the_size_check(spark, limit):
    t = spark.createDataFrame([("a", 1, 1), ("b", 2, 2)], "v string, k int, n int")
    s = spark.createDataFrame([(2, "z", 9), (3, "n", 3)], "k int, v string, n int")
    got = upsert(t, s, ["k"], small_source_rows=limit)
    assert got.columns == ["v", "k", "n"] and got.schema["k"].dataType.simpleString() == "int"
    assert _rows(got, "k", "v", "n") == [(1, "a", 1), (2, "z", 9), (3, "n", 3)]


def test_smallest_above_keeps_nulls_and_native_types(spark):
    v = spark.createDataFrame([(1, 2 ** 53), (2, None), (3, 7)], "id int, v long")
    t = spark.createDataFrame([(2 ** 53 + 1, "big"), (8, "small")], "cap long, name string")
    assert _rows(smallest_above(v, "v", t, "cap", ["name"]), "id", "name") == [(1, "big"), (2, None), (3, "small")]


def test_product_sum_of_large_lines(spark):
    df = spark.createDataFrame([(1, 10_000_000.0, 1.0), (1, 9_000_000.0, 1.2), (2, -12.34, 1.1), (2, 0.01, -3.0), (3, 5e9, 1.25),
                                (4, None, 1.0)], "g int, a double, b double")
    got = {r.g: r.s for r in df.groupBy("g").agg(exact_product_sum("a", "b").alias("s")).collect()}
    assert got == {1: 20_800_000.0, 2: -13.604, 3: 6.25e9, 4: None}


@pytest.mark.parametrize("deletes", ["ignore", "invalidate", "new_record"])
def test_snapshot_with_null_keys_and_an_added_column(spark, deletes):
    one = spark.createDataFrame([(1, "a"), (None, "n"), (2, "b")], "k int, v string")
    two = spark.createDataFrame([(1, "a", None), (None, "m", "x"), (3, "c", None)], "k int, v string, extra string")
    h1 = scd2_snapshot(None, one, ["k"], run_ts=_ts(1), hard_deletes=deletes, current_flag="is_current").checkpoint()
    same = scd2_snapshot(h1, one, ["k"], run_ts=_ts(2), hard_deletes=deletes, current_flag="is_current")
    assert _rows(same, "k", "v", "valid_to") == _rows(h1, "k", "v", "valid_to")
    h2 = scd2_snapshot(h1, two, ["k"], run_ts=_ts(2), hard_deletes=deletes, current_flag="is_current").checkpoint()
    opened = {(r.k, r.v, r.extra) for r in h2.filter("valid_to is null and is_current").collect()}
    expected = {(1, "a", None), (None, "m", "x"), (3, "c", None)} | ({(2, "b", None)} if deletes != "invalidate" else set())
    assert opened == expected
    assert h2.filter("valid_to is not null and not is_current").count() == (1 if deletes == "ignore" else 2)
    if deletes == "new_record":
        assert _rows(h2.filter("is_deleted"), "k", "v") == [(2, "b")]
    assert h2.filter("k is null and v is null").count() == 0
    plan = scd2_snapshot(h1, two, ["k"], run_ts=_ts(2), hard_deletes=deletes)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1


def test_change_feed_with_null_keys_is_one_join(spark):
    before = spark.createDataFrame([(None, "x"), (1, "a"), (2, "b")], "k int, v string")
    after = spark.createDataFrame([(None, "y"), (1, "a"), (3, None)], "k int, v string")
    feed = change_feed(before, after, ["k"], _ts(1))
    assert _rows(feed, "k", "v", "cdc_change_type") == sorted(
        [(None, "x", "UPDATE_BEFORE"), (None, "y", "UPDATE_AFTER"), (2, "b", "DELETE"), (3, None, "INSERT")], key=str)
    assert feed._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1


def test_clusters_of_any_number_have_names(spark):
    from strata.plans.silver import CLUSTER_NAMES, cluster_names
    assert cluster_names(CLUSTER_NAMES, 5) == CLUSTER_NAMES and len(set(cluster_names(CLUSTER_NAMES, 8))) == 8


def test_identity_rate_without_rates(spark):
    from strata.plans.silver import fx_backward_intervals
    rates = spark.createDataFrame([], "rate_date date, base_currency string, quote_currency string, exchange_rate double, today date")
    assert [r.currency for r in fx_backward_intervals(rates, "today").collect()] == ["USD"]


def test_build_with_a_failing_step_keeps_its_audit_and_exits(spark, tmp_dir, monkeypatch):
    from strata.plans import layered_build
    text = "first line\n" + "x" * 3000

    def fail(cat, ctx, inputs):
        raise ValueError(text)
    steps = [("silver", "good", lambda cat, ctx, inputs: cat.spark.range(3), ()), ("silver", "bad", fail, ()),
             ("gold", "after", lambda cat, ctx, inputs: inputs["bad"], ("bad",))]
    monkeypatch.setattr(layered_build, "STEPS", steps)
    monkeypatch.setattr(layered_build.build, "__defaults__", (steps, None))
    with pytest.raises(SystemExit) as end:
        layered_build.main(["--data", "/root/testdata/sf0.001", "--out", tmp_dir, "--batch-id", "b"])
    assert end.value.code == 1
    rows = {r.step: r for r in spark.read.parquet(f"{tmp_dir}/_audit").collect()}
    assert {s: r.status for s, r in rows.items()} == {"good": "SUCCESS", "bad": "FAILED", "after": "SKIPPED"}
    assert rows["bad"].error_message == text and rows["good"].rows_written == 3
