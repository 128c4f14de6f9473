"""Session settings and the shared folder that durable intermediates go to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = 8, app_name: str = "broadsheet") -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(cores if cores != "*" else 8))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master, where driver and executors are one process, may go without the setting.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="broadsheet-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def numbered(df: DataFrame, name: str = "_row") -> DataFrame:
    """``df`` with a number of its own for every row, stored so that all uses see the same numbers."""
    return durable(df.withColumn(name, F.monotonically_increasing_id()))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there: the rows are computed once, a lost executor cannot
    change them, and later passes read only the columns they need."""
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
