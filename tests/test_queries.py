"""Every registered query against its DuckDB oracle SQL on the smallest
fixture (the driver runs the same comparison at sf0.01), plus the flagship
entry point."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.oracle_check import duck, rows_of, type_diffs

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "customer_tier" in df.columns


def test_every_query_has_oracle_or_is_listed():
    no_oracle = {q for q in set(QUERIES) - set(ORACLE) if not q.startswith("op") and q != "pipeline"}
    assert not no_oracle, no_oracle


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_cols, s_set = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(ORACLE[name])
    assert type_diffs(df.schema, rel.description) == []
    d_cols, d_set = rows_of([d[0] for d in rel.description], rel.fetchall())
    assert s_cols == d_cols
    assert s_set == d_set


def test_report_sql_over_registered_views(spark, con):
    from strata.session import RunContext
    from strata.sources.tables import Catalog
    from strata.views import register_views
    register_views(Catalog(spark, SF_SMALL), RunContext(data_clock=True), ["customer_segments"])
    got = spark.sql("""SELECT customer_segment, count(*) AS customer_count,
                              round(count(*) * 100.0 / sum(count(*)) OVER (), 1) AS pct
                       FROM customer_segments GROUP BY 1 ORDER BY 2 DESC""").collect()
    exp = QUERIES["segment_distribution"](spark, SF_SMALL).collect()
    assert sorted((r[0], r[1], float(r[2])) for r in got) == sorted((r[0], r[1], float(r[2])) for r in exp)
