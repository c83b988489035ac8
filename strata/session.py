"""Session construction, checkpoint folder and per-run parameters."""

from __future__ import annotations

import datetime as _dt
import tempfile
from dataclasses import dataclass, field

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Settings that matter at scale: AQE re-plans joins from runtime sizes,
# splits skewed shuffle partitions and coalesces tiny ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Delete reliable checkpoint files once their DataFrame is unreachable.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Starting points for a large cluster (hundreds of executors, ~100 TB of
# Parquet).  The shuffle partition count is an upper bound that AQE coalesces
# down to ~256 MB partitions at run time; it is also the range-partition
# count of the ranking operator.  Skewed partitions over 5x the median and
# 256 MB are split by AQE.  Broadcasts stay at Spark's default threshold:
# plans hint only tables with a proven size bound.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",  # max(key) high-water marks from footers
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[8]", app: str = "strata",
                  shuffle_partitions: int = 8, driver_memory: str = "16g",
                  extra: dict | None = None) -> SparkSession:
    """Local/test session.  On a cluster, use the cluster's own builder and
    pass the session to the library; nothing here is required."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", driver_memory))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder.

    Uses the folder the cluster names in ``spark.checkpoint.dir``.  Only when
    nothing is configured *and* the master is local (tests) is a private
    temporary folder created; on a cluster that is an error, because a
    machine-local folder does not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if sc.master.startswith("local"):
        path = tempfile.mkdtemp(prefix="strata-ckpt-")
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir() or path
    raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")


@dataclass(frozen=True)
class RunContext:
    """Parameters of one build run.

    ``as_of`` replaces the warehouse's current_date(); ``run_ts`` replaces
    current_timestamp()/sysdate().  Leaving them None uses the session clock.
    """

    as_of: _dt.date | None = None
    run_ts: _dt.datetime | None = None
    prune_days: int = 2
    source_system_code: str = "UNKNOWN"
    integration_source: str = "TPC_H"
    week_start: str = "sunday"  # calendar weeks: 'sunday' or 'monday'
    data_clock: bool = False  # today = latest order date in the data (for fixtures)
    unknown_key: int = -1  # key given to facts whose dimension row is missing
    extras: dict = field(default_factory=dict)

    def today(self) -> Column:
        return F.lit(self.as_of) if self.as_of is not None else F.current_date()

    def now(self) -> Column:
        if self.run_ts is not None:
            return F.lit(self.run_ts).cast("timestamp_ntz")
        return F.localtimestamp()


def today_frame(ctx: "RunContext", orders=None):
    """One-row frame with column ``__today``: the run date.  With
    ``data_clock`` it is the latest order date, computed in-plan (a global
    max: partial aggregation, one row) and meant for ``crossJoin``."""
    if ctx.as_of is None and ctx.data_clock:
        if orders is None:
            raise ValueError("data_clock needs the orders frame")
        return orders.agg(F.max(F.to_date("o_orderdate")).alias("__today"))
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    return spark.range(1).select(ctx.today().alias("__today"))


AUDIT_COLUMNS = (
    "_loaded_at", "_updated_at", "processed_at", "last_updated", "extracted_at",
    "inserted_ts", "updated_ts", "insert_ts", "last_update_ts",
    "cdc_commit_ts", "_updated_ts",
)


def without_audit(df):
    """Drop wall-clock audit columns (for comparisons and reports)."""
    return df.drop(*[c for c in AUDIT_COLUMNS if c in df.columns])
