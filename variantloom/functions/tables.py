"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset: on one machine a folder of our own, which is set as checkpoint folder; on
    a cluster an error, as executors could not read what others write to their own disks."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="variantloom-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def run_dir(spark: SparkSession) -> str:
    """The folder of this application's tables below shared_dir."""
    return f"{shared_dir(spark).rstrip('/')}/variantloom-{spark.sparkContext.applicationId}"


def stored(df: DataFrame, name: str = "t") -> DataFrame:
    """Write df as a table in the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """df, dealt out over all cores where it comes in fewer partitions (a small table in one file, with much work a row)."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def dealt(df: DataFrame, *cols: str) -> DataFrame:
    """df by the values of cols, in as many partitions as the session shuffles to. A number that is given stays: partitions
    that Spark merges, up to 64 MB as they are sent, take many times that when they are sorted or hashed."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *cols)


def drop_stored(spark: SparkSession) -> None:
    """Delete the tables of this application: for the end of a job, when no DataFrame that reads them is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
