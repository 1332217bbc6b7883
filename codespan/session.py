"""Session helpers: cutting lineage reliably and the few settings operators rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory, the cluster's own when it names one.

    ``spark.checkpoint.dir`` wins.  Only a local master without that setting
    gets a scratch directory; on a cluster a machine-local folder would not
    survive the loss of an executor, so the absence is an error there.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    path = tempfile.mkdtemp(prefix="codespan-checkpoint-")
    sc.setCheckpointDir(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage reliably: written as Parquet into the checkpoint folder and read back.

    A checkpoint would carry on the constraints and the estimated size of the plan it
    cuts.  The estimates of joins multiply from cut to cut, and Spark's optimizer fails on
    constraints of columns that the plan renames; a file has its own size and no constraints.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


stored = cut  # the same, said of many rows


def settle(tables: dict[str, DataFrame], before: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Cut the lineage of the tables that a step has changed.

    Every step joins the tables of a project with each other; without the cut the
    plan would double at each of them.
    """
    return {name: df if before.get(name) is df else cut(df) for name, df in tables.items()}


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal a small table out over all cores before heavy work on each row.

    A scan of a small file is one task.  Only a table whose estimated size would
    give fewer scan splits than there are cores is moved, so what is shuffled
    here never exceeds one split per core; anything larger is left where it is.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    split = int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes", "134217728b")
    ))
    return df.repartition(cores, *keys) if size < split * cores else df
