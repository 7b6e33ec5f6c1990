"""Session helpers shared by every operator."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Read one parquet table of a data folder."""
    return spark.read.parquet(f"{base}/{name}.parquet")


def local_session(cores: str = "*", partitions: int = 8, app: str = "siftmill") -> SparkSession:
    """A local session for tests and benches; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; a temporary one only in local mode without a setting."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="siftmill-ck-")
    sc.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage of `df`: it is written as a table into the shared folder and read back.

    The table outlives lost executors, and unlike a checkpointed plan it carries no
    constraints of the plan it came from, which iterative plans would pile up.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tasks(spark: SparkSession, rows: int, each: int) -> int:
    """Tasks for compute-heavy work on so many rows, `each` to a task; all cores get some."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // each))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spread a small table over all cores for compute-heavy work.

    A table that fills the cores with file splits of its own is read where it lies: its
    texts are not shuffled. The results do not depend on which way is taken.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    return df if size >= 4 * cores * split else df.repartition(2 * cores, *keys)
