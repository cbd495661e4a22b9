"""What outlives a job: the folder all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, or else one beside its tables."""
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    return folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"


def settle(df: DataFrame) -> DataFrame:
    """Compute a frame once and go on from its copy in the shared folder.

    For what is costly and read more than once, such as parsed text: a lost executor costs
    no second parse. Spark's cleaner removes the copy when nothing refers to it any more.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that was written for one use, wherever it is."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
