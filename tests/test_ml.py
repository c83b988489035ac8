"""M1 k-means: invariants (cluster numbers are arbitrary, so no oracle)."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL


def test_kmeans_invariants(spark):
    from strata.plans.ml import customer_clustering_kmeans
    from strata.session import RunContext
    from strata.sources.tables import Catalog
    df = customer_clustering_kmeans(Catalog(spark, SF_SMALL), RunContext(data_clock=True), n_init=2).cache()
    assert df.count() == 150
    assert df.select("ml_cluster").distinct().count() == 5
    r = df.agg(F.min("distance_to_cluster_center").alias("dmin"), F.min("ml_confidence_score").alias("cmin"),
               F.max("ml_confidence_score").alias("cmax"),
               F.sum(F.col("is_cluster_outlier").cast("int")).alias("n_out")).first()
    assert r["dmin"] >= 0 and 0 <= r["cmin"] <= r["cmax"] <= 1
    assert 5 <= r["n_out"] <= 8  # above the 95th percentile of 150 distances
    means = df.groupBy("ml_cluster").agg(F.avg("account_balance").alias("m")).orderBy("ml_cluster").collect()
    assert [x["m"] for x in means] == sorted([x["m"] for x in means], reverse=True)
