"""Session settings and the places where lineage is cut."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are tuned for. Partition counts are left to the
# cluster: AQE coalesces them from whatever spark.sql.shuffle.partitions says.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "texelframe", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as named in spark.checkpoint.dir or set on the context.

    There is no default: a folder of one machine would be of no use to the others.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")


def cut_lineage(df: DataFrame) -> DataFrame:
    """df written once, as a Parquet table in the shared folder, and read from there.

    Unlike a checkpoint this runs df once only, and readers get the columns and rows they ask for. The
    session's tables are removed when it ends.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/stored-{spark.sparkContext.applicationId}"
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    of_session = spark._jvm.org.apache.hadoop.fs.Path(folder)
    of_session.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(of_session)
    return spark.read.schema(df.schema).parquet(path)
