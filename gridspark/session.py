"""Session helpers: a local session for tests, and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "gridspark") -> SparkSession:
    """Local session for tests and bench; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own; on a cluster a
    machine-local path would be lost with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="gridspark-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)  # a folder of our own goes with the process
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()
