"""Calendar dimension (S6, 2.8 dates, K5 ghost row)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.dates import (DAY_NAMES, MONTH_NAMES, QUARTER_NAMES, iso_dow, pick, week_dow,
                                    week_of_year, week_start)
from strata.session import RunContext


def calendar_days(spark: SparkSession, start: dt.date = dt.date(1992, 1, 1), n_days: int = 50 * 365,
                  ctx: RunContext = RunContext(), today=None) -> DataFrame:
    """``n_days`` rows from ``start``.  ``spark.range`` generates the rows in
    parallel (no single-row explode).  ``today`` (a Column) drives the
    current-period flags; default is ``ctx.today()``."""
    seq = spark.range(1, n_days + 1).withColumnRenamed("id", "day_seq")
    d = F.date_add(F.lit(start), (F.col("day_seq") - 1).cast("int"))
    return calendar_columns(seq.select("day_seq", d.alias("day_dt")), ctx, today)


def calendar_columns(base: DataFrame, ctx: RunContext = RunContext(), today=None) -> DataFrame:
    """All calendar attributes of a frame holding ``day_seq`` and ``day_dt``
    (a narrow projection: no shuffle)."""
    ws = ctx.week_start
    today = today if today is not None else ctx.today()
    dd = F.col("day_dt")
    year_start, year_end = F.trunc(dd, "year"), F.make_date(F.year(dd), F.lit(12), F.lit(31))
    month_start, month_end = F.trunc(dd, "month"), F.last_day(dd)
    wk_start = week_start(dd, ws)
    t = today
    return base.select(
        "day_seq", "day_dt",
        F.date_format(dd, "yyyyMMdd").cast("int").alias("day_key"),
        F.date_format(dd, "yyyy-MM-dd").alias("day_text"),
        F.date_format(dd, "dd.MM.yyyy").alias("day_eu_text"),
        F.date_format(dd, "dd").alias("day_of_month"),
        pick(DAY_NAMES, iso_dow(dd)).alias("day_of_week"),
        pick(MONTH_NAMES, F.month(dd)).alias("month"),
        F.date_format(dd, "yyyy").alias("year"),
        F.concat(F.lit("Q"), F.quarter(dd).cast("string")).alias("quarter"),
        pick(QUARTER_NAMES, F.quarter(dd)).alias("quarter_name"),
        F.dayofmonth(dd).alias("day_of_month_num"),
        week_dow(dd, ws).alias("day_of_week_num"),
        iso_dow(dd).alias("day_of_week_iso_num"),
        week_of_year(dd, ws).alias("week_num"),
        F.weekofyear(dd).alias("week_iso_num"),
        F.month(dd).alias("month_num"),
        F.quarter(dd).alias("quarter_num"),
        F.year(dd).alias("year_num"),
        F.expr("extract(YEAROFWEEK FROM day_dt)").cast("int").alias("year_of_week_iso_num"),
        year_start.alias("year_start_dt"), year_end.alias("year_end_dt"),
        month_start.alias("month_start_dt"), month_end.alias("month_end_dt"),
        wk_start.alias("week_start_dt"), F.date_add(wk_start, 6).alias("week_end_dt"),
        F.add_months(dd, -12).alias("year_ago_dt"),
        F.add_months(dd, -1).alias("month_ago_dt"),
        F.date_sub(dd, 7).alias("week_ago_dt"),
        (F.datediff(year_end, year_start) + 1).alias("days_in_year"),
        (F.datediff(month_end, month_start) + 1).alias("days_in_month"),
        F.when(dd == t, "Y").otherwise("N").alias("current_day_flag"),
        F.when(wk_start == week_start(t, ws), "Y").otherwise("N").alias("current_week_flag"),
        F.when(month_start == F.trunc(t, "month"), "Y").otherwise("N").alias("current_month_flag"),
        F.when(year_start == F.trunc(t, "year"), "Y").otherwise("N").alias("current_year_flag"),
        ctx.now().alias("insert_ts"), ctx.now().alias("last_update_ts"),
    )


# The calendar's ghost (unknown-day) row.
GHOST_DAY = {"day_key": 0, "day_seq": 0, "day_dt": dt.date(1900, 1, 1), "day_text": "1900-01-01",
             "month": "January", "quarter_name": "First", "year_num": 1900}


def dim_calendar_day(spark: SparkSession, ctx: RunContext = RunContext(), start: dt.date = dt.date(1992, 1, 1),
                     n_days: int = 50 * 365, ghost: bool = True, today=None) -> DataFrame:
    from strata.operators.keys import with_ghost_row
    cal = calendar_days(spark, start, n_days, ctx, today)
    return with_ghost_row(cal, "day_key", GHOST_DAY) if ghost else cal


def data_calendar(cat, ctx: RunContext = RunContext(), ghost: bool = True) -> DataFrame:
    """Calendar covering whole years of the order and ship dates, derived
    from the data.  The span is a one-row aggregate; its days (bounded by
    the date span, not the row count) are exploded and then carry the same
    columns as ``calendar_days``.  ``today`` follows ``ctx`` (with
    ``data_clock``: the latest order date)."""
    from strata.operators.keys import with_ghost_row
    from strata.session import today_frame
    o = cat.orders.agg(F.min(F.to_date("o_orderdate")).alias("a"), F.max(F.to_date("o_orderdate")).alias("b"))
    li = cat.lineitem.agg(F.min(F.to_date("l_shipdate")).alias("c"), F.max(F.to_date("l_shipdate")).alias("d"))
    span = o.crossJoin(li).select(F.trunc(F.least("a", "c"), "year").alias("__d0"),
                                  F.make_date(F.year(F.greatest("b", "d")), F.lit(12), F.lit(31)).alias("__d1"))
    days = span.select("__d0", F.explode(F.sequence("__d0", "__d1")).alias("day_dt"))
    base = days.select((F.datediff("day_dt", "__d0") + 1).cast("long").alias("day_seq"), "day_dt")
    base = base.crossJoin(F.broadcast(today_frame(ctx, cat.orders)))
    cal = calendar_columns(base, ctx, F.col("__today")).drop("__today")
    return with_ghost_row(cal, "day_key", GHOST_DAY) if ghost else cal
