"""T1-T4 with file streams and availableNow: the refreshed aggregate equals a
batch recompute, reruns do nothing, new files refresh only their months."""

import os

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL


def _facts_equal(a, b):
    cols = sorted(c for c in a.columns if c not in ("last_updated", "order_month_start"))
    ra = sorted((tuple(r) for r in a.select(*cols).collect()), key=repr)
    rb = sorted((tuple(r) for r in b.select(*cols).collect()), key=repr)
    return ra == rb


def test_order_facts_refresh(spark, tmp_dir):
    from strata.session import RunContext
    from strata.streaming.refresh import order_facts_for, refresh_history, refresh_now
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    landing, target = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "facts")
    ckpt, hist = os.path.join(tmp_dir, "ckpt"), os.path.join(tmp_dir, "hist")
    ctx = RunContext(data_clock=True)
    early = orders.where(F.col("o_orderdate") < "1998-01-01")
    late = orders.where(F.col("o_orderdate") >= "1998-01-01")
    early.write.parquet(os.path.join(landing, "part=1"))
    refresh_now(spark, landing, target, ckpt, history_path=hist, ctx=ctx)
    assert _facts_equal(spark.read.parquet(target), order_facts_for(early, ctx))
    refresh_now(spark, landing, target, ckpt, history_path=hist, ctx=ctx)  # nothing new
    assert spark.read.parquet(hist).count() == 1
    late.write.parquet(os.path.join(landing, "part=2"))
    refresh_now(spark, landing, target, ckpt, history_path=hist, ctx=ctx)
    assert _facts_equal(spark.read.parquet(target), order_facts_for(orders, ctx))
    h = refresh_history(spark, hist).collect()
    assert [r["batch_id"] for r in h] == [1, 0]


def test_order_facts_refresh_counts_the_newest_image_once(spark, tmp_dir):
    from strata.session import RunContext
    from strata.streaming.refresh import order_facts_for, refresh_now
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").where("o_orderkey < 40")
    landing, target, ckpt = (os.path.join(tmp_dir, x) for x in ("landing", "facts", "ckpt"))
    ctx = RunContext(data_clock=True)
    alone = orders.where("o_orderkey = 1").withColumn("o_orderkey", F.lit(9001).cast("long")).withColumn(
        "o_orderdate", F.to_timestamp_ntz(F.lit("2031-05-01 00:00:00")))
    orders.unionByName(alone).write.parquet(os.path.join(landing, "part=1"))
    refresh_now(spark, landing, target, ckpt, ctx=ctx)
    # An order closes, one moves to another month, and the last one of a month leaves it.
    changed = (orders.where("o_orderkey = 2").withColumn("o_orderstatus", F.lit("X"))
               .unionByName(orders.where("o_orderkey = 3").withColumn("o_orderdate", F.col("o_orderdate") + F.expr("INTERVAL 70 DAYS")))
               .unionByName(alone.withColumn("o_orderdate", F.to_timestamp_ntz(F.lit("2031-07-01 00:00:00")))))
    changed.write.parquet(os.path.join(landing, "part=2"))
    refresh_now(spark, landing, target, ckpt, ctx=ctx)
    merged = orders.where("o_orderkey not in (2, 3)").unionByName(changed)
    assert _facts_equal(spark.read.parquet(target), order_facts_for(merged, ctx))


def test_change_consumer_reads_each_change_once(spark, tmp_dir):
    from strata.operators.cdc import change_feed
    from strata.streaming.changes import publish_changes, start_change_consumer
    changes_dir, log = os.path.join(tmp_dir, "changes"), os.path.join(tmp_dir, "log")
    s0 = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double")
    s1 = spark.createDataFrame([(1, 5.0), (3, 3.0)], "k int, v double")
    ts = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    feed1 = change_feed(None, s0, ["k"], ts)
    publish_changes(feed1, changes_dir)
    schema = feed1.schema
    for i in range(2):
        q = start_change_consumer(spark, changes_dir, schema, ["k"], log, os.path.join(tmp_dir, "ck"))
        q.awaitTermination()
    assert spark.read.parquet(log).count() == 2
    publish_changes(change_feed(s0, s1, ["k"], F.lit("2024-01-03 00:00:00").cast("timestamp_ntz")), changes_dir)
    q = start_change_consumer(spark, changes_dir, schema, ["k"], log, os.path.join(tmp_dir, "ck"))
    q.awaitTermination()
    got = spark.read.parquet(log).where("stream_batch_id = 1").orderBy("k").collect()
    assert [(r["k"], r["cdc_change_type"], r["delete_flag"]) for r in got] == [
        (1, "UPDATE_AFTER", "N"), (2, "DELETE", "Y"), (3, "INSERT", "N")]
    assert [r["log_id"] for r in got] == [3, 4, 5]


def test_refresh_with_processing_time_trigger(spark, tmp_dir):
    from strata.session import RunContext
    from strata.streaming.refresh import order_facts_for, start_order_facts_refresh
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    landing, target = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "facts")
    orders.write.parquet(landing)
    ctx = RunContext(data_clock=True)
    q = start_order_facts_refresh(spark, landing, target, os.path.join(tmp_dir, "ck"), ctx=ctx, every="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert _facts_equal(spark.read.parquet(target), order_facts_for(orders, ctx))


def _landing(tmp_dir):
    return {k: os.path.join(tmp_dir, k) for k in ("landing", "facts", "ckpt", "hist")}


def test_refresh_follows_updates_moves_and_restarts(spark, tmp_dir):
    """Every refresh is a restart of the stream; the facts equal a full build
    over the newest images after each."""
    import random
    from strata.session import RunContext
    from strata.streaming import order_deltas
    from strata.streaming.refresh import order_facts_for, refresh_history, refresh_now
    d, ctx, rng = _landing(tmp_dir), RunContext(data_clock=True), random.Random(4)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/orders.parquet").where("o_orderkey < 300").collect()]
    schema = spark.read.parquet(f"{SF_SMALL}/orders.parquet").schema
    at = {f.name: i for i, f in enumerate(schema.fields)}
    images = {r[at["o_orderkey"]]: list(r) for r in rows}

    def land(keys, name):
        spark.createDataFrame([tuple(images[k]) for k in keys], schema).write.parquet(os.path.join(d["landing"], f"part={name}"))
    land(images, "0")
    for step in range(1, 4):
        refresh_now(spark, d["landing"], d["facts"], d["ckpt"], history_path=d["hist"], ctx=ctx)
        want = spark.createDataFrame([tuple(r) for r in images.values()], schema)
        assert _facts_equal(spark.read.parquet(d["facts"]), order_facts_for(want, ctx)), step
        changed = rng.sample(sorted(images), 20)
        for k in changed:
            r = images[k]
            r[at["o_totalprice"]] = round(r[at["o_totalprice"]] * rng.choice([1, 0.5, 3]), 2)
            r[at["o_orderstatus"]] = rng.choice(["O", "F", "P", None])
            r[at["o_orderdate"]] = rng.choice([r[at["o_orderdate"]], r[at["o_orderdate"]].replace(year=2001 + step), None])
        land(changed, str(step))
        if step == 2:
            order_deltas.fold(spark, d["facts"] + ".partials")
            order_deltas.fold(spark, d["facts"] + ".partials")  # a second fold changes nothing
    refresh_now(spark, d["landing"], d["facts"], d["ckpt"], history_path=d["hist"], ctx=ctx)
    want = spark.createDataFrame([tuple(r) for r in images.values()], schema)
    assert _facts_equal(spark.read.parquet(d["facts"]), order_facts_for(want, ctx))
    assert [r["input_rows"] for r in refresh_history(spark, d["hist"], 1).collect()][0] <= 20
    # a batch reads its own months and none of the landed files
    order_deltas.fold(spark, d["facts"] + ".partials")
    partials = order_deltas.images(order_deltas.read_partials(spark, d["facts"] + ".partials"))
    assert _facts_equal(order_facts_for(partials, ctx), order_facts_for(want, ctx))
    plan = order_deltas.read_partials(spark, d["facts"] + ".partials", [rows[0][at["o_orderdate"]].date().replace(day=1)])._jdf.queryExecution().toString()
    assert "landing" not in plan and "PartitionFilters: [month" in plan.replace("isnotnull(month#", "month#").replace("PartitionFilters: [(", "PartitionFilters: [")


def test_refresh_replay_writes_the_same(spark, tmp_dir):
    from strata.session import RunContext
    from strata.streaming.refresh import order_facts_for, refresh_batch
    d, ctx = _landing(tmp_dir), RunContext(data_clock=True)
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").where("o_orderkey < 200")
    plus = orders.select("o_orderkey", F.lit(1).alias("sign"), "o_orderdate", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    moved = plus.where("o_orderkey < 20")
    second = moved.withColumn("sign", F.lit(-1)).unionByName(moved.withColumn("o_orderdate", F.col("o_orderdate") + F.expr("INTERVAL 40 DAYS")))
    where = {"target_path": d["facts"], "partials_path": d["facts"] + ".p", "history_path": d["hist"], "ctx": ctx}
    refresh_batch(plus, 0, **where)
    want = orders.withColumn("o_orderdate", F.when(F.col("o_orderkey") < 20, F.col("o_orderdate") + F.expr("INTERVAL 40 DAYS")).otherwise(F.col("o_orderdate")))
    for _ in range(3):  # the same micro-batch delivered three times
        refresh_batch(second, 1, **where)
        assert _facts_equal(spark.read.parquet(d["facts"]), order_facts_for(want, ctx))
    assert spark.read.parquet(d["hist"]).count() == 2


def test_older_versions_do_not_replace_newer_images(spark, tmp_dir):
    from strata.session import RunContext
    from strata.streaming.refresh import order_facts_for, refresh_now
    d, ctx = _landing(tmp_dir), RunContext(data_clock=True)
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").where("o_orderkey < 60")
    newer = orders.withColumn("o_totalprice", F.col("o_totalprice") * 2)
    newer.withColumn("seq", F.lit(5).cast("long")).write.parquet(os.path.join(d["landing"], "part=0"))
    refresh_now(spark, d["landing"], d["facts"], d["ckpt"], ctx=ctx, version="seq")
    orders.withColumn("seq", F.lit(4).cast("long")).write.parquet(os.path.join(d["landing"], "part=1"))  # late, or landed again
    refresh_now(spark, d["landing"], d["facts"], d["ckpt"], ctx=ctx, version="seq")
    assert _facts_equal(spark.read.parquet(d["facts"]), order_facts_for(newer, ctx))


def test_change_log_replay_replaces_its_batch(spark, tmp_dir):
    from strata.operators.cdc import change_feed
    from strata.streaming.changes import consume_batch
    log = os.path.join(tmp_dir, "log")
    ts = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    first = change_feed(None, spark.createDataFrame([(i, 1.0) for i in range(9)], "k int, v double"), ["k"], ts)
    second = change_feed(None, spark.createDataFrame([(i, 2.0) for i in range(20, 24)], "k int, v double"), ["k"], ts)
    consume_batch(first, 0, keys=["k"], log_path=log)
    consume_batch(second.where("k < 22"), 1, keys=["k"], log_path=log)  # an append that died half-way
    for _ in range(2):
        consume_batch(second, 1, keys=["k"], log_path=log)
        got = spark.read.parquet(log)
        assert got.count() == 13 and sorted(r.log_id for r in got.collect()) == list(range(1, 14))


def test_bucketed_merge(spark, tmp_dir):
    import pytest
    from strata.operators.bucketed import create_bucketed, merge_bucketed, merged_parts, read_bucketed, start_merge_stream
    from strata.operators.merge import DuplicateKeyError, upsert
    spark.sql("DROP TABLE IF EXISTS merge_target")
    target = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 7).alias("g"), F.lit("old").alias("v"), F.lit(1).alias("kept"))
    create_bucketed(target, "merge_target", ["k", "g"], buckets=4, parts=16)
    batch = spark.createDataFrame([(3, 3, "new", 9), (700, 1, "in", 9), (3, 4, "other group", 9)], "k long, g long, v string, kept int")
    new, touched = merged_parts(spark, "merge_target", batch, ["kept"])
    plan = new._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.splitlines() if "FileScan parquet" in x]
    assert len(touched) <= 3 and len(scans) == 1 and "Bucketed: true" in scans[0] and "__part" in scans[0]
    assert plan.count("Exchange hashpartitioning(") == 1  # the batch's; the target is read in its buckets
    want = upsert(target, batch, ["k", "g"], exclude=["kept"])
    for _ in range(2):  # a replay gives the same table
        assert merge_bucketed(spark, "merge_target", batch, ["kept"]) == len(touched)
        got = read_bucketed(spark, "merge_target")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(got.columns).collect()))
    assert merge_bucketed(spark, "merge_target", batch.limit(0)) == 0
    for bad in ([(1, 1, "a", 1), (1, 1, "b", 1)], [(None, 1, "a", 1)]):
        with pytest.raises(DuplicateKeyError):
            merge_bucketed(spark, "merge_target", spark.createDataFrame(bad, batch.schema))
    src = os.path.join(tmp_dir, "stream")
    for v in ("s1", "s2"):
        spark.createDataFrame([(3, 3, v, 2), (800, 0, v, 2)], batch.schema).write.mode("append").parquet(src)
        start_merge_stream(spark, src, batch.schema, "merge_target", os.path.join(tmp_dir, "ck"), exclude=["kept"]).awaitTermination()
        assert {tuple(r) for r in read_bucketed(spark, "merge_target").where("k in (3, 800)").collect()} == {
            (3, 3, v, 1), (3, 4, "other group", 9), (800, 0, v, 2)}
    spark.sql("DROP TABLE merge_target")
