"""Tasks of the line facts hold a bounded number of lines, and the results
stay those of plain aggregates."""

import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL


def _most_in_a_task(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def test_line_facts_are_dealt_by_rows(spark, monkeypatch):
    from strata.operators import tasks
    from strata.plans import gold
    from strata.sources.tables import Catalog
    cat = Catalog(spark, SF_SMALL)
    whole = gold.fct_order_lines_by_supplier_month(cat).drop("_updated_at").collect()
    monkeypatch.setattr(tasks, "ROWS_PER_TASK", 200)
    n = cat.lineitem.count()
    lines = gold.fct_order_lines(cat)
    assert n > 200 * 8 and _most_in_a_task(lines) <= 400  # Spark's own partitions hold a twelfth or more of them
    got = gold.fct_order_lines_by_supplier_month(cat).drop("_updated_at").collect()
    assert sorted(map(str, got)) == sorted(map(str, whole))


def test_sketch_roll_up_reads_dealt_lines(spark, monkeypatch):
    from strata.operators import tasks
    from strata.plans import later_runs
    from strata.sources.tables import Catalog
    cat = Catalog(spark, SF_SMALL)
    whole = later_runs.supplier_orders_by_sketch(cat).collect()
    monkeypatch.setattr(tasks, "ROWS_PER_TASK", 200)
    got = later_runs.supplier_orders_by_sketch(cat)
    n = -(-cat.lineitem.count() // 200)
    assert "order_key#" in got._jdf.queryExecution().toString() and f", {n})" in got._jdf.queryExecution().toString()
    assert sorted(map(str, got.collect())) == sorted(map(str, whole))


def test_pivot_tasks_and_frequent_pairs(spark, monkeypatch):
    """One pair (and one without keys) with many lines, null dates and null
    quantities beside single lines."""
    from strata.operators import tasks
    from strata.plans import gold
    day = dt.datetime(1996, 1, 1)
    rows = [(1, 1, day + dt.timedelta(days=i % 900), float(i % 50)) for i in range(1000)]
    rows += [(None, None, day, 2.0)] * 300 + [(i, i % 7, day if i % 3 else None, None if i % 5 == 0 else 1.5) for i in range(2000)]
    lines = spark.createDataFrame(rows, "supplier_key long, part_key long, ship_date timestamp_ntz, quantity double")
    monkeypatch.setattr(tasks, "ROWS_PER_TASK", 100)
    got = gold.fact_order_line_pivot(None, lines=lines)
    want = lines.groupBy("supplier_key", "part_key").agg(*[
        F.sum(F.when(F.year("ship_date") == y, F.col("quantity"))).alias(f"shipped_{y}") for y in (1996, 1997, 1998)])
    got = got.drop("last_update_ts")
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert "supplier_key#" in (plan := got._jdf.queryExecution().toString()) and plan.count(f", {-(-len(rows) // 100)})") >= 2


def test_a_cut_frees_the_shuffle_files_it_was_made_from(spark):
    """Files of a finished step do not wait for the driver's garbage collection."""
    import glob
    import time
    from strata.llm.graph import cut
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [str(d) for d in manager.localDirs()]

    def files():
        return {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*")}
    old = files()
    made = spark.range(5000).select((F.col("id") % 7).alias("k")).groupBy("k").count()
    kept = cut(made)
    end = time.time() + 20
    while (left := files() - old) and time.time() < end:
        time.sleep(0.2)
    assert not left
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, made.collect()))  # the frame itself can be used again
    assert sorted(map(tuple, cut(made).collect())) == sorted(map(tuple, kept.collect()))


def test_attribution_keeps_more_runs_than_the_other_coders(spark, monkeypatch):
    """A run is encoded once, though more runs than ``CACHE_RUNS`` come by."""
    from strata.llm import bpe_tree, token_attribution
    monkeypatch.setattr(bpe_tree, "CACHE_RUNS", 10)
    path, pattern = bpe_tree.default_vocabulary()
    taken = {}
    monkeypatch.setattr(bpe_tree, "_LOADED", taken)

    class Docs:
        def select(self, *_):
            return self

        def mapInArrow(self, run, schema):
            return run
    import pyarrow as pa
    run = token_attribution.section_tokens(Docs(), path=path, pattern=pattern)
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["a " + " ".join(f"w{i}" for i in range(100))] * 2})
    out = pa.Table.from_batches(list(run(iter([batch]))))
    assert out.num_rows == 2 and len(set(out["n_tokens"].to_pylist())) == 1
    known = taken[path, pattern]._spaced
    assert len(known) == 101  # emptied at 10 before
    assert bpe_tree.worker_bpe(path, pattern)._spaced.most == 10


def _plan(df):
    return df._jdf.queryExecution().toString()


def _some_orders(spark, n=2000):
    """Orders with a null customer, a customer of every third order, twice
    the same key and no key, and lines of them, some without an order."""
    day = dt.datetime(1996, 1, 1)
    orders = [(i or None, None if i % 50 == 0 else 7 if i % 3 == 0 else i, "FOP"[i % 3], i + 0.25, day + dt.timedelta(days=i % 40, hours=i % 24),
               f"{i % 5}-X" if i % 5 else "1-URGENT") for i in range(n)] + [(5, 7, "F", 1.0, day, "5-LOW")] * 2
    lines = [(i % (n + 9) or None, i % 7, i % 11, i % 4, 1.0, 10.0, 0.1, 0.1, "A", "F", day) for i in range(3 * n)] + [(5, 1, 1, 1, 2.0, 9.0, 0.0, 0.0, "R", "O", day)] * 300
    return (spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
            spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                                         "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"))


def test_model_tests_deal_the_keys(spark, monkeypatch):
    from strata.operators import tasks
    from strata.plans.model_tests import model_checks
    from strata.sources.tables import FrameCatalog
    orders, lines = _some_orders(spark)
    customer = spark.createDataFrame([(i, f"c{i}", 1, 1.0, "AUTOMOBILE") for i in range(1, 1500)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    cat = FrameCatalog(spark, {"orders": orders, "lineitem": lines, "customer": customer})

    def failing():
        return {c.name: c.failing_rows() for c in model_checks(cat, models=["stg_orders", "stg_orders_incremental", "stg_lineitem"]) if c.predicate is None}
    want = {k: sorted(map(str, d.drop("_loaded_at", "processed_at").collect())) for k, d in failing().items()}
    monkeypatch.setattr(tasks, "ROWS_PER_TASK", 100)
    got = failing()
    assert len(got) == 6 and all(want.values())
    for k, d in got.items():
        n = -(-(lines if k.startswith("stg_lineitem") else orders).count() // 100)
        assert f", {n})" in _plan(d), k
        assert sorted(map(str, d.drop("_loaded_at", "processed_at").collect())) == want[k], k


def test_order_facts_and_reload_are_dealt(spark, monkeypatch):
    from strata.operators import tasks
    from strata.plans import gold, silver
    from strata.sources.tables import FrameCatalog
    orders, lines = _some_orders(spark)
    cat = FrameCatalog(spark, {"orders": orders, "lineitem": lines})
    dim = orders.select(F.col("o_orderkey").alias("order_key"), F.col("o_custkey").alias("customer_key"), F.col("o_orderdate").alias("order_date"))
    rates = spark.createDataFrame([(dt.date(1996, 1, d), "USD", "EUR", d / 10) for d in range(1, 20)], "day_dt date, from_currency string, to_currency string, exchange_rate double")

    def both():
        return (silver.order_facts(cat).drop("last_updated"),
                gold.fact_order_line_full_reload(cat, orders=dim, rates=rates).drop("insert_ts", "last_update_ts"))
    want = [sorted(map(str, d.collect())) for d in both()]
    monkeypatch.setattr(tasks, "ROWS_PER_TASK", 100)
    facts, reload = both()
    assert f", {-(-orders.count() // 100)})" in _plan(facts) and _plan(facts.where("order_count > 0")).count("Exchange hashpartitioning") == 1
    assert f", {-(-lines.count() // 100)})" in _plan(reload)
    assert [sorted(map(str, d.collect())) for d in (facts, reload)] == want
    day = facts.where("customer_key = 7 and order_status = 'F'").agg(F.sum("order_count")).first()[0]
    assert day == orders.where("o_custkey = 7 and o_orderstatus = 'F'").count()
