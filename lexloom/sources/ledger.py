"""The append-only ledger of visits as JSON lines, read in batch or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.operators.crawl import check_decisions

SCHEMA = "ts double, seed string, url string, decision string, reason string, via string, kind string"


def read(spark: SparkSession, path: str) -> DataFrame:
    """Return the rows of a ledger; cut-off or corrupt lines are left out, and a missing file has no rows."""
    from pyspark.errors import AnalysisException

    try:
        rows = spark.read.schema(SCHEMA).option("mode", "DROPMALFORMED").json(path)
        rows = rows.where("url IS NOT NULL")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        rows = spark.createDataFrame([], SCHEMA)
    return rows


def stream(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """Return a stream of the rows of a folder of rolled ledger files."""
    rows = spark.readStream.schema(SCHEMA).option("mode", "DROPMALFORMED").option("maxFilesPerTrigger", files_per_trigger).json(folder)
    return rows.where("url IS NOT NULL").withColumn("time", F.timestamp_seconds("ts"))


def append(rows: DataFrame, path: str) -> None:
    """Add rows to a ledger; one with an unknown decision fails the job and nothing is added."""
    checked = check_decisions(rows).withColumn("ts", F.round("ts", 3))
    checked.select(*[c.split(" ")[0] for c in SCHEMA.split(", ")]).write.mode("append").json(path)
