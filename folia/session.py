"""Session settings and the shared folder for intermediate tables."""

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks; on a cluster the submitter provides one."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("folia")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for an intermediate table, below the cluster's checkpoint folder.

    Executors of a cluster share only the folder the cluster names; without one this
    raises. A local session, as in tests, gets a folder of its own.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="folia-"))
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(frame: DataFrame, name: str) -> DataFrame:
    """Write a DataFrame to the scratch folder and read it back.

    For results used several times: they are computed once, readers fetch only the
    columns they need, and a lost executor only means reading again.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
