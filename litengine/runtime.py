"""What every operator needs of the session: tables, checkpoints, parallelism."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster in spark.checkpoint.dir; a folder of our own, removed at exit, only in a local session that names none."""
    sc = spark.sparkContext
    have = sc.getCheckpointDir()
    if have:
        return have
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="litengine-checkpoint-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Cuts the lineage through the shared folder; survives the loss of any executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def parallelism(spark: SparkSession) -> int:
    """Tasks for work that is dear for its size: as many as the session has cores, or more where it shuffles into more."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt evenly over parallelism() tasks: a small file is one split, and small shuffles are merged, however dear their rows are."""
    return df.repartition(parallelism(df.sparkSession))
