"""Session helpers: one place for the settings that results depend on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parents[1])


def reachable(spark: SparkSession) -> None:
    """Let the session's Python workers find this package where the driver found it.

    That is enough where they see the same folder; on a cluster the package is
    installed or sent with the job.
    """
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])


def get_session(app: str = "lexloom", master: str | None = None, **conf: str) -> SparkSession:
    """Return a session in UTC with adaptive execution; a cluster's own settings win."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table of a data folder through Spark's own reader."""
    reachable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """Return the folder for intermediate tables: the one that ``spark.checkpoint.dir`` names.

    Where the session names none a temporary folder is used, on a local master
    only: executors of a cluster could not read what others wrote there.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir")
        if named is None and not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the session's shared checkpoint folder, so that several uses don't compute it again."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to a new table in the shared folder and return it read back.

    Like :func:`cut_lineage`, but compressed and with pruned columns when read;
    the table goes when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(conf).deleteOnExit(place)
    return spark.read.parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Return ``df`` in at least as many partitions as there are cores.

    A small table in one file would be one task; larger ones keep their partitions
    and are not shuffled, and neither is what comes from a shuffle. Select the
    needed columns before.
    """
    reachable(df.sparkSession)
    if df.isStreaming or "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return df  # asking such a plan for its partitions would run it
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
