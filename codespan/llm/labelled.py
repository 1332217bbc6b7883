"""Bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codespan.llm.store import text_key


def fold(buckets: int) -> Column:
    """Which of ``buckets`` folds a document belongs to, from its doc_id alone."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % buckets


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, train: Column) -> DataFrame:
    """text, label, weight of at most ``per_class`` documents of each class.

    Those with the smallest hashes of their doc_id are taken, which is a random
    sample that is the same on every run.  ``weight`` is how many labelled rows of
    the class each stands for.  Labels other than 0 and 1 and null doc_ids are
    left out; of a doc_id's several labels the largest counts, and of its several
    texts that of the largest text key, in whatever order rows come.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where("doc_id is not null and label in (0, 1)").where(train)
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    )
    totals = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        weight = max(1.0, totals.get(value, 0) / per_class)
        part = part.withColumn("weight", F.lit(weight))
        chosen = part if chosen is None else chosen.union(part)
    chosen = F.broadcast(chosen.select(F.col("doc_id").alias("l_id"), "label", "weight"))  # 2 * per_class rows
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = texts.join(chosen, F.col("doc_id") == F.col("l_id"))
    one = F.max_by(F.struct("text", "label", "weight"), F.struct(text_key().alias("key"), F.col("text")))
    return found.groupBy("doc_id").agg(one.alias("row")).select("doc_id", "row.*")
