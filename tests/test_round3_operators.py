"""As-of merge, bucket digests, isolated statements, leased keys, checked
writes, block samples, kept sketches and one-pass k-means, against plain
versions."""

import datetime as dt
import glob
import os
import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL

T0 = dt.datetime(2024, 1, 1)


def _plain_as_of(facts, versions):
    out = []
    for f, k, t in facts:
        best = None
        if k is not None and t is not None:
            for vk, s, e, name in versions:
                if vk == k and s is not None and s <= t and (best is None or (s, e or dt.datetime.max) > (best[0], best[1] or dt.datetime.max)):
                    best = (s, e, name)
        out.append((f, k, t, best[2] if best and (best[1] is None or t <= best[1]) else None))
    return out


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_as_of_merge_against_all_versions(spark, parts):
    from strata.operators.interval_join import as_of_merge
    rng = random.Random(parts)

    def when():
        return T0 + dt.timedelta(seconds=rng.randint(0, 400))
    keys = ["hot"] * 12 + ["a", "b", "c", None]  # one key holds most rows
    facts = [(i, rng.choice(keys), when() if rng.random() > 0.05 else None) for i in range(400)]
    facts += [(1000 + i, "no versions", T0) for i in range(40)]
    starts = {}
    versions = []
    for i in range(60):
        k, s = rng.choice(keys), when()
        if (k, s) in starts:
            continue
        starts[k, s] = True
        versions.append((k, s, s + dt.timedelta(seconds=rng.randint(0, 90)) if rng.random() > 0.3 else None, f"v{i}"))
    versions += [("hot", None, None, "no start"), ("early", T0 - dt.timedelta(days=1), None, "open")]
    facts += [(2000 + i, "early", T0 + dt.timedelta(days=i)) for i in range(30)]  # the version stands many partitions back
    f = spark.createDataFrame(facts, "f int, k string, t timestamp_ntz").repartition(3)
    v = spark.createDataFrame(versions, "vk string, s timestamp_ntz, e timestamp_ntz, name string")
    got = as_of_merge(f, "k", "t", v, "vk", "s", "e", payload=["name"], num_partitions=parts)
    assert got.columns == ["f", "k", "t", "name"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(_plain_as_of(facts, versions), key=repr)
    assert as_of_merge(f.limit(0), "k", "t", v, "vk", "s", "e", payload=["name"]).count() == 0
    assert as_of_merge(f, "k", "t", v.limit(0), "vk", "s", "e", payload=["name"]).where("name is not null").count() == 0


def test_digests_skip_equal_buckets(spark, tmp_dir):
    from strata.operators.cdc import change_feed
    from strata.operators.snapshots import changed_buckets, snapshot_change_feed, write_snapshot
    old = spark.createDataFrame([(i, f"v{i}", None if i % 3 else 1.5) for i in range(300)] + [(None, "null key", 1.0)], "k int, a string, b double")
    new = old.where("k is null or k not in (7, 8)").withColumn("a", F.when(F.col("k") == 20, F.lit(None)).otherwise(F.col("a"))).unionByName(
        spark.createDataFrame([(900, "new", 2.0)], old.schema))
    a, b, c = (os.path.join(tmp_dir, x) for x in "abc")
    write_snapshot(old, a, ["k"], buckets=64)
    write_snapshot(new.repartition(5), b, ["k"], buckets=64)
    write_snapshot(old.repartition(7).orderBy(F.col("a").desc()), c, ["k"], buckets=64)
    ts = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    got, want = snapshot_change_feed(spark, a, b, ["k"], ts), change_feed(old, new, ["k"], ts)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr) and want.count() == 5
    touched = changed_buckets(spark, a, b)
    assert 1 <= len(touched) <= 4
    assert changed_buckets(spark, a, c) == [] and snapshot_change_feed(spark, a, c, ["k"], ts).count() == 0
    # buckets that are equal are not read: lose one and nothing changes
    kept = {f"__bucket={t}" for t in touched}
    gone = next(p for p in sorted(os.listdir(f"{a}/rows")) if p.startswith("__bucket=") and p not in kept)
    for f in glob.glob(f"{a}/rows/{gone}/*.parquet"):
        with open(f, "wb") as out:
            out.write(b"not parquet")
    again = spark.read.schema("k int, a string, b double, __bucket int").parquet(f"{a}/rows").where(F.col("__bucket").isin(touched))
    assert again.count() > 0 and "PartitionFilters: [__bucket" in again._jdf.queryExecution().toString()


def test_statements_fail_alone(spark, tmp_dir):
    from strata.operators.bulk import run_statements
    good = ["SELECT 1 AS x", "SELECT id AS x FROM range(5)"]
    bad = ["SELECT id div (id - id) AS x FROM range(3)", "SELECT nothing FROM nowhere", "SELEC 1"]
    errors = run_statements(spark, good + bad, os.path.join(tmp_dir, "out"), workers=3)
    assert sorted(r.statement for r in errors.collect()) == sorted(bad)
    assert any("DIVIDE_BY_ZERO" in r.error for r in errors.collect())
    got = spark.read.schema("x long, statement_index int").option("mergeSchema", "false").parquet(
        *[p for p in glob.glob(os.path.join(tmp_dir, "out", "*")) if glob.glob(p + "/*.parquet") and "range(5)" in sorted(good + bad)[int(p.rsplit("=", 1)[1])]])
    assert sorted(r.x for r in got.collect()) == list(range(5))
    assert run_statements(spark, [], os.path.join(tmp_dir, "none")).count() == 0


def test_leased_keys(spark):
    from strata.operators.keys import lease_keys
    old = spark.createDataFrame([(1,), (57,)], "sk long")
    rows = spark.range(1000).repartition(7)
    got = lease_keys(rows, "sk", old, block=50)
    keys = [r.sk for r in got.collect()]
    assert len(set(keys)) == 1000 and min(keys) == 58
    assert max(keys) <= 57 + 50 * (1000 // 50 + 7)  # gaps: less than a block per partition
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, got.collect()))  # a repeated task gives the same keys
    assert "rangepartitioning" not in got._jdf.queryExecution().toString()
    assert lease_keys(rows.limit(0), "sk").count() == 0


def test_checked_write_is_one_scan(spark, tmp_dir):
    from strata.operators import quality as Q
    df = spark.createDataFrame([(1, 5.0, "A"), (None, -1.0, "B"), (3, None, "Z"), (4, -2.0, "Z")], "k int, v double, f string")
    checks = [("k_null", Q.null_pred("k")), ("v_negative", Q.range_pred("v", min_value=0)), ("f_known", Q.accepted_values_pred("f", ["A", "B"]))]
    seen = spark.sparkContext.accumulator(0)

    def count(it):
        for b in it:
            seen.add(b.num_rows)
            yield b
    counts = Q.write_checked(df.mapInArrow(count, df.schema), checks, os.path.join(tmp_dir, "out"))
    assert counts == {"rows": 4, "k_null": 1, "v_negative": 2, "f_known": 2} and seen.value == 4
    out = spark.read.parquet(os.path.join(tmp_dir, "out"))
    assert {(r.k, r.quarantined, tuple(r.failed_checks)) for r in out.select("k", F.col("quarantined").cast("string").alias("quarantined"), "failed_checks").collect()} == {
        (1, "false", ()), (None, "true", ("k_null", "v_negative")), (3, "true", ("f_known",)), (4, "true", ("v_negative", "f_known"))}


def test_block_sample_reads_only_chosen_blocks(spark, tmp_dir):
    from strata.operators.sampling import _draw, block_sample
    chosen = {}
    for f in range(4):
        path = os.path.join(tmp_dir, f"part {f}.parquet")
        table = pa.table({"id": pa.array(range(f * 1000, f * 1000 + 1000)), "s": pa.array([f"text {i % 7}" for i in range(1000)])})
        pq.write_table(table, path, row_group_size=100, compression="none", use_dictionary=False)
        with open(path, "r+b") as out:
            for g in range(10):
                column = pq.ParquetFile(path).metadata.row_group(g).column(0)
                if _draw(7, f"part%20{f}.parquet", g) < 0.3:
                    chosen[f, g] = True
                else:  # what is not chosen is unreadable
                    out.seek(column.data_page_offset)
                    out.write(b"\xff" * 60)
    got = block_sample(spark, tmp_dir, 30, seed=7)
    assert sorted(r.id for r in got.collect()) == sorted(f * 1000 + g * 100 + i for f, g in chosen for i in range(100))
    assert 4 <= len(chosen) <= 22
    assert block_sample(spark, tmp_dir, 30, seed=7, columns=["s"]).columns == ["s"]
    assert block_sample(spark, tmp_dir, 0).count() == 0


def test_sketches_merge_without_the_lines(spark):
    from strata.plans.later_runs import roll_up, supplier_month_sketches
    lines = spark.range(60_000).select((F.col("id") % 3).alias("supplier_key"), (F.col("id") % 20_000).alias("order_key"),
                                      F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 700).cast("int")).alias("order_date"))
    months = supplier_month_sketches(None, lines=lines)
    got = {r.supplier_key: r for r in roll_up(months, "supplier_key").select("*", F.hll_sketch_estimate("orders_sketch").alias("e")).collect()}
    exact = {r.supplier_key: r.n for r in lines.groupBy("supplier_key").agg(F.count_distinct("order_key").alias("n")).collect()}
    assert got[0].total_order_lines == 20_000
    assert all(abs(got[k].e - n) <= 0.065 * n for k, n in exact.items())


def test_kmeans_rounds_against_numpy(spark):
    from strata.plans.ml import lloyd
    rng = np.random.default_rng(2)
    x = rng.integers(-1000, 1000, (300, 2))
    starts = [x[i:i + 3].tolist() for i in (0, 50, 100)]
    best = None
    for i, c in enumerate(starts):
        c = np.array(c)
        for _ in range(40):
            own = ((x[:, None] - c) ** 2).sum(2).argmin(1)
            new = np.array([x[own == k].sum(0) // (own == k).sum() if (own == k).any() else c[k] for k in range(3)])
            shift, c = ((new - c) ** 2).sum(), new
            if shift <= 5:
                break
        cost = ((x[:, None] - c) ** 2).sum(2).min(1).sum()
        best = min(best or (cost, i, c.tolist()), (cost, i, c.tolist()))
    df = spark.createDataFrame(x.tolist(), "a long, b long")
    assert lloyd(df.repartition(5), ["a", "b"], starts, 40, 5) == best[2] == lloyd(df.coalesce(1), ["a", "b"], starts, 40, 5)


def test_upsert_takes_null_keys_as_keys(spark):
    from strata.operators.merge import upsert
    t = spark.createDataFrame([(None, "b"), (1, "x")], "k int, v string")
    s = spark.createDataFrame([(None, "d"), (2, "y")], "k int, v string")
    for rows in (1_000_000, None):
        got = sorted(map(tuple, upsert(t, s, ["k"], small_source_rows=rows).collect()), key=repr)
        assert got == sorted([(None, "d"), (1, "x"), (2, "y")], key=repr)
    wide = spark.createDataFrame([(1, "new")], "k int, v string")
    assert sorted(map(tuple, upsert(t, wide, ["k"], small_source_bytes=0).collect()), key=repr) == [(1, "new"), (None, "b")]


def test_two_loads_on_one_day_keep_ranges_in_order(spark):
    from strata.operators.scd import hybrid_dimension_load
    ts = F.lit("2024-03-05 08:00:00").cast("timestamp_ntz")
    later = F.lit("2024-03-05 18:00:00").cast("timestamp_ntz")
    d1, _ = hybrid_dimension_load(None, spark.createDataFrame([(1, "a")], "bk int, name string"), "bk", ["name"], [], ts)
    d2, _ = hybrid_dimension_load(d1, spark.createDataFrame([(1, "b")], "bk int, name string"), "bk", ["name"], [], later)
    assert d2.where("effective_end_date < effective_start_date").count() == 0 and d2.where("is_current").count() == 1


def test_queries_fail_without_their_operator(spark):
    """The as-of lookup bites: some orders have no version, most do."""
    from strata.plans.later_runs import order_customer_versions
    from strata.sources.tables import Catalog
    got = order_customer_versions(Catalog(spark, SF_SMALL))
    n = got.where("customer_version is null").count()
    assert 0 < n < got.count() / 2
