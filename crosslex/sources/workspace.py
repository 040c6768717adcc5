"""Written tables in the folder all executors share.

A result that several later jobs read is written once and read back. That cuts its
lineage, survives the loss of executors and gives the optimizer real sizes.
"""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Whether the shuffle files of an action are removed when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a scratch one only in local mode."""
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors can reach")
    scratch = tempfile.mkdtemp(prefix="crosslex-")
    spark.sparkContext.setCheckpointDir(scratch)
    return scratch


def new_path(spark: SparkSession, name: str) -> str:
    """Unused path for a table in the shared folder."""
    return f"{shared_dir(spark)}/crosslex-{uuid.uuid4().hex}/{name}"


@contextmanager
def freeing(spark: SparkSession) -> Iterator[None]:
    """Writes in here remove their shuffle files when they end.

    What was written is read from its files, never from the shuffles that led there. Otherwise
    these stay until the driver happens to collect garbage, and all steps' files add up.
    """
    former = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if former is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, former)


def settle(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table."""
    spark = df.sparkSession
    path = new_path(spark, name)
    with freeing(spark):
        df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
