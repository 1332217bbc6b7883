"""Tables that the operators share: inputs, and steps kept on the cluster's shared storage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codespan.session import ensure_checkpoint_dir

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame) -> DataFrame:
    """Write a step to the checkpoint folder and read it back, which cuts its lineage.

    Executors share that folder, so a lost one costs a retry of its tasks only.  The
    step's shuffle files have no use once it is written and are removed with it.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/step-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    kept = spark.read.schema(df.schema).parquet(path)
    kept.kept_at = path
    return kept


def drop(kept: DataFrame) -> None:
    """Delete the files of a step that nothing reads any more."""
    spark = kept.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(kept.kept_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_key(text: str = "text") -> Column:
    """64 bits of the text: beside ``doc_id`` they tell rows that share an id apart."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a variant of it that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def by_row(docs: DataFrame, found: DataFrame, how: str, *extra: str) -> DataFrame:
    """``docs`` joined with what was found for its rows (doc_id, text_key, extra columns).

    Nulls in doc_id meet; ``found`` has one row per (doc_id, text_key).
    """
    own, m_id, m_key = (fresh(docs, n) for n in ("_own_key", "_met_id", "_met_key"))
    right = found.select(F.col("doc_id").alias(m_id), F.col("text_key").alias(m_key), *extra)
    return docs.withColumn(own, text_key()).join(
        right, F.col("doc_id").eqNullSafe(F.col(m_id)) & (F.col(own) == F.col(m_key)), how
    )
