"""strata: layered table analytics (staging, dimensions, facts, history,
change capture, refreshed aggregates, quality checks) as Spark jobs.

Every public function takes and returns ``pyspark.sql.DataFrame`` objects and
leaves physical planning to Catalyst/AQE.
"""

from strata.session import RunContext, build_session, ensure_checkpoint_dir

__all__ = ["RunContext", "build_session", "ensure_checkpoint_dir"]
