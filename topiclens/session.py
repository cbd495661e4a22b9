"""Session settings the operators are planned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A post, session or term may hold a third of all rows: let AQE split it.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Also where what follows the join then needs a shuffle of its own.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}
# Settings of the context, which must be known when it starts.
STARTING = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true"}


def build_session(
    app: str = "topiclens",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the settings above; the cluster's own settings win elsewhere."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**RUNTIME, **STARTING, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def in_utc(spark: SparkSession) -> SparkSession:
    """The session, its times in UTC, as the tables' are; no other setting is touched."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
