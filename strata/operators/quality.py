"""Data-quality checks.

Every check returns its *failing rows* as a DataFrame, so a pass is an empty
frame and the failures can be written as they are (D16).  ``run_checks``
turns a list of checks into one summary frame; row-level checks on the same
input are fused into a single aggregate pass (one scan, map-side partial
sums) instead of one job per check.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.tasks import dealt

# ---------------------------------------------------------------- predicates
# Row-level checks are predicates that are TRUE on a failing row.  A null
# predicate counts as passing, as in the generic SQL tests (``where not(expr)``).


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_pred(col) -> Column:
    return _c(col).isNull()


def accepted_values_pred(col, values: Sequence) -> Column:
    return ~_c(col).isin(list(values))


def expression_pred(expr: str | Column) -> Column:
    return ~(F.expr(expr) if isinstance(expr, str) else expr)


def range_pred(col, min_value=None, max_value=None, inclusive: bool = True) -> Column:
    c = _c(col)
    ok = F.lit(True)
    if min_value is not None:
        ok = ok & ((c >= min_value) if inclusive else (c > min_value))
    if max_value is not None:
        ok = ok & ((c <= max_value) if inclusive else (c < max_value))
    return ~ok


def empty_string_pred(col) -> Column:
    return F.trim(_c(col)) == ""


def non_positive_pred(col) -> Column:
    return _c(col) <= 0


# ---------------------------------------------------------- failing-row frames


def not_null(df: DataFrame, col: str) -> DataFrame:
    """D1."""
    return df.where(null_pred(col))


def unique(df: DataFrame, *cols: str, rows: int | None = None) -> DataFrame:
    """Keys that occur more than once, with their count.  A hash
    aggregate with map-side combine: a hot key collapses before the shuffle.
    Of keys that are nearly all different nothing collapses and the maps of
    a task grow with its share of the file: with ``rows`` (the row count of
    ``df``) they are dealt first, and a task holds a bounded number."""
    if rows is not None:
        df = dealt(df.select(*cols), rows, *cols)
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1))


unique_combination_of_columns = unique


def duplicate_rows(df: DataFrame, *cols: str) -> DataFrame:
    """D2 as rows: every row whose key is duplicated (semi join back to the
    duplicated keys; that key set is usually tiny and AQE broadcasts it)."""
    return df.join(unique(df, *cols).drop("n_records"), list(cols), "left_semi")


def primary_key(df: DataFrame, *cols: str, rows: int | None = None) -> DataFrame:
    """Rows with a null key part, plus keys that repeat (as key rows)."""
    nulls = df.where(F.greatest(*[F.col(c).isNull() for c in cols]) if len(cols) > 1 else F.col(cols[0]).isNull())
    nulls = nulls.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records"))
    return nulls.unionByName(unique(df.where(F.least(*[F.col(c).isNotNull() for c in cols])
                                             if len(cols) > 1 else F.col(cols[0]).isNotNull()), *cols, rows=rows))


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """D5 (nulls pass; pair with not_null)."""
    return df.where(accepted_values_pred(col, values))


def relationships(df: DataFrame, cols: str | Sequence[str], parent: DataFrame,
                  parent_cols: str | Sequence[str] | None = None, rows: int | None = None) -> DataFrame:
    """D6 (also composite foreign keys): child rows with a non-null key that
    the parent lacks.  ``left_anti``: Catalyst picks broadcast or
    sort-merge from the parent's size, so a large parent is not broadcast.
    With ``rows`` (the row count of the longer side) both sides meet in
    tasks of a bounded number of rows."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    pcols = cols if parent_cols is None else ([parent_cols] if isinstance(parent_cols, str) else list(parent_cols))
    p = parent.select(*[F.col(pc).alias(f"__p{i}") for i, pc in enumerate(pcols)])
    if rows is not None:
        df, p = dealt(df, rows, *cols), dealt(p, rows, *p.columns)
    p = p.distinct()
    child = df.where(F.least(*[F.col(c).isNotNull() for c in cols]) if len(cols) > 1 else F.col(cols[0]).isNotNull())
    cond = [F.col(c) == F.col(f"__p{i}") for i, c in enumerate(cols)]
    return child.join(p, cond, "left_anti")


def expression_is_true(df: DataFrame, expr: str | Column) -> DataFrame:
    """D7, column or table level (the expression may name any columns)."""
    return df.where(expression_pred(expr))


def accepted_range(df: DataFrame, col: str, min_value=None, max_value=None, inclusive: bool = True) -> DataFrame:
    """D8."""
    return df.where(range_pred(col, min_value, max_value, inclusive))


def not_empty_string(df: DataFrame, col: str) -> DataFrame:
    """D9."""
    return df.where(empty_string_pred(col))


def positive_values(df: DataFrame, col: str) -> DataFrame:
    """Rows with a value <= 0."""
    return df.where(non_positive_pred(col))


def share_above(df: DataFrame, predicate: Column, threshold_pct: float, test_name: str,
                count_name: str = "matching_rows", total_name: str = "total_rows",
                pct_name: str = "matching_percentage") -> DataFrame:
    """One global aggregate (partial counts per task, one row at
    the end); the row is returned only when the share exceeds the threshold
    (SQL HAVING on a global aggregate)."""
    agg = df.agg(F.sum(F.when(predicate, 1).otherwise(0)).cast("long").alias(count_name),
                 F.count(F.lit(1)).alias(total_name))
    pct = F.round(F.col(count_name).cast("double") / F.col(total_name) * 100, 2)
    return (agg.select(F.lit(test_name).alias("test_name"), count_name, total_name, pct.alias(pct_name))
            .where(F.col(pct_name) > threshold_pct))


def freshness(df: DataFrame, ts_col: str, as_of: Column, warn_after: dt.timedelta | None = None,
              error_after: dt.timedelta | None = None) -> DataFrame:
    """One row: latest timestamp, age in seconds and pass/warn/error."""
    latest = df.agg(F.max(F.col(ts_col).cast("timestamp_ntz")).alias("max_loaded_at"))
    age = (F.unix_timestamp(as_of.cast("timestamp_ntz")) - F.unix_timestamp("max_loaded_at")).cast("long")
    status = F.lit("pass")
    if warn_after is not None:
        status = F.when(age > int(warn_after.total_seconds()), "warn").otherwise(status)
    if error_after is not None:
        status = F.when(age > int(error_after.total_seconds()), "error").otherwise(status)
    status = F.when(F.col("max_loaded_at").isNull(), "error").otherwise(status)
    return latest.select("max_loaded_at", age.alias("age_seconds"), status.alias("status"))


def schema_contract(df: DataFrame, expected: T.StructType, allow_extra: bool = False) -> list[str]:
    """Differences between the frame's schema and a contract (metadata
    only: no job runs).  Empty list = the contract holds."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for f in expected.fields:
        if f.name not in actual:
            problems.append(f"missing column {f.name}")
        elif actual[f.name] != f.dataType:
            problems.append(f"column {f.name}: {actual[f.name].simpleString()} != {f.dataType.simpleString()}")
    if not allow_extra:
        problems += [f"unexpected column {n}" for n in actual if n not in {f.name for f in expected.fields}]
    return problems


# ---------------------------------------------------------------- check suites


@dataclass(frozen=True)
class Check:
    """One named check.  ``predicate`` (True = failing row) makes it a
    row-level check that ``run_checks`` fuses with others on the same frame;
    otherwise ``failing`` builds the failing-row frame.  ``severity`` and the
    ``warn_if``/``error_if`` thresholds follow the usual test configs (D14):
    status is 'fail' when failures > error_if, 'warn' when > warn_if."""

    name: str
    model: str
    frame: DataFrame
    predicate: Column | None = None
    failing: Callable[[DataFrame], DataFrame] | None = None
    column: str | None = None
    severity: str = "error"
    warn_if: int = 0
    error_if: int = 0
    tags: Mapping[str, str] = field(default_factory=dict)

    def failing_rows(self) -> DataFrame:
        if self.predicate is not None:
            return self.frame.where(self.predicate)
        return self.failing(self.frame)


def row_check(name, model, frame, predicate, column=None, **kw) -> Check:
    return Check(name=name, model=model, frame=frame, predicate=predicate, column=column, **kw)


def frame_check(name, model, frame, failing, column=None, **kw) -> Check:
    return Check(name=name, model=model, frame=frame, failing=failing, column=column, **kw)


_SUMMARY = T.StructType([T.StructField("check_name", T.StringType()), T.StructField("failures", T.LongType())])


def _failures(checks: Sequence[Check]) -> DataFrame:
    """check_name, failures."""
    groups: dict[int, list[Check]] = {}
    counts: list[DataFrame] = []
    for ch in checks:
        if ch.predicate is not None:
            groups.setdefault(id(ch.frame), []).append(ch)
        else:
            counts.append(ch.failing(ch.frame).agg(F.count(F.lit(1)).alias("failures"))
                          .select(F.lit(ch.name).alias("check_name"), "failures"))
    for group in groups.values():
        frame = group[0].frame
        sums = frame.agg(*[F.sum(F.when(ch.predicate, 1).otherwise(0)).cast("long").alias(f"__f{i}")
                           for i, ch in enumerate(group)])
        pairs = F.array(*[F.struct(F.lit(ch.name).alias("check_name"),
                                   F.coalesce(F.col(f"__f{i}"), F.lit(0)).alias("failures"))
                          for i, ch in enumerate(group)])
        counts.append(sums.select(F.explode(pairs).alias("p")).select("p.check_name", "p.failures"))
    allc = counts[0]
    for c in counts[1:]:
        allc = allc.unionByName(c)
    return allc


def _summary(failures: DataFrame, checks: Sequence[Check]) -> DataFrame:
    meta = [(ch.name, ch.model, ch.column, ch.severity, ch.warn_if, ch.error_if) for ch in checks]
    meta_df = failures.sparkSession.createDataFrame(
        meta, "check_name string, model string, column_name string, severity string, warn_if long, error_if long")
    out = failures.join(F.broadcast(meta_df), "check_name")
    status = (F.when((F.col("severity") == "error") & (F.col("failures") > F.col("error_if")), "fail")
              .when(F.col("failures") > F.col("warn_if"), "warn").otherwise("pass"))
    return out.select("check_name", "model", "column_name", "severity", "failures", status.alias("status"))


def run_checks(checks: Sequence[Check]) -> DataFrame:
    """Summary: check_name, model, column_name, severity, failures, status.

    Row-level checks sharing one input frame become one ``agg`` of
    conditional sums (one scan); other checks are counted with one aggregate
    each.  All counts are unioned into a small frame; nothing is collected."""
    return _summary(_failures(checks), checks)


def run_checks_in_turn(batches: Sequence[Sequence[Check]]) -> DataFrame:
    """The summary of ``run_checks`` for checks on large inputs: each batch is
    counted by a job of its own and its shuffle files go before the next one
    begins, so disk holds those of one batch.  A check may stand in several
    batches, on frames that share no row that it fails; its failures add up."""
    from strata.llm.graph import cut
    counts = None
    for batch in batches:
        own = cut(_failures(batch))
        counts = own if counts is None else counts.unionByName(own)
    checks = {ch.name: ch for batch in batches for ch in batch}
    return _summary(counts.groupBy("check_name").agg(F.sum("failures").alias("failures")), list(checks.values()))


def write_checked(df: DataFrame, checks: Sequence[tuple[str, Column]], path: str, name: str = "checks") -> dict[str, int]:
    """D1-D16 in the write itself: ``checks`` are (name, predicate that is
    true on a failing row).  One scan computes the rows, writes those that
    pass to ``path/quarantined=false`` and the others, with the names of the
    checks they failed, to ``path/quarantined=true``, and counts rows and
    failures on the way (``DataFrame.observe``).  Returns the counts."""
    bad = [F.coalesce(p, F.lit(False)) for _, p in checks]
    failed = F.array_compact(F.array(*[F.when(b, F.lit(n)) for (n, _), b in zip(checks, bad)]))
    seen = Observation(name)
    flagged = df.withColumn("failed_checks", failed).observe(
        seen, F.count(F.lit(1)).alias("rows"), *[F.count(F.when(b, 1)).alias(n) for (n, _), b in zip(checks, bad)])
    (flagged.withColumn("quarantined", F.size("failed_checks") > 0)
     .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("quarantined").parquet(path))
    return dict(seen.get)


def store_failures(check: Check, path: str, run_ts: Column, mode: str = "append") -> None:
    """Write the failing rows with the check name and run time
    (one append per run; history accumulates in the folder)."""
    (check.failing_rows().select(F.lit(check.name).alias("check_name"), run_ts.alias("run_ts"),
                                 F.to_json(F.struct("*")).alias("failing_row"))
     .write.mode(mode).parquet(path))


def assert_counts(counts: Mapping[str, DataFrame], expectations: Mapping[str, tuple[str, int]]) -> DataFrame:
    """D15 row-count assertions: one row per named frame with its count, the
    operator (==, >=, >, <=, <), the expected value and whether it holds.
    Counts are one-row aggregates unioned together (no collect)."""
    parts = []
    for name, df in counts.items():
        op, val = expectations[name]
        n = F.col("actual")
        ok = {"==": n == val, ">=": n >= val, ">": n > val, "<=": n <= val, "<": n < val}[op]
        parts.append(df.agg(F.count(F.lit(1)).alias("actual")).select(
            F.lit(name).alias("assertion"), "actual", F.lit(op).alias("op"), F.lit(val).cast("long").alias("expected"),
            ok.alias("passed")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
