"""Exact duplicates by a tree of merges over sorted runs of digests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codespan.llm.store import keep

WHITE = r"[\x20\x09-\x0D]+"
FAN_IN = 8
KEY = ["text_sha256", "n_norm", "proof"]


def digests(docs: DataFrame) -> DataFrame:
    """One slim row per row of ``docs``: digest of the text without white space, and what ranks it.

    ``proof`` and ``n_norm`` are a second hash and the length of the same text: rows
    are copies only if all three agree.  ``run`` is the input partition.
    """
    text = F.coalesce("text", F.lit(""))
    bare = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.length(text).cast("long").alias("n_chars"),
        F.regexp_replace(text, WHITE, "").alias("bare"),
    )
    return keep(bare.select(
        "doc_id",
        "n_chars",
        F.sha2("bare", 256).alias("text_sha256"),
        F.length("bare").cast("long").alias("n_norm"),
        F.xxhash64("bare").alias("proof"),
        F.spark_partition_id().alias("run"),
        F.monotonically_increasing_id().alias("row"),
    ))


def merge_runs(rows: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """One row per digest: the row that stays, and how many there are.

    Each input partition is a run, sorted and combined where it lies.  In every
    round ``fan_in`` neighbouring runs are exchanged and merged into one, spread
    over tasks by digest; a digest comes at most once from each run, so that even
    one shared by a third of all rows costs ``fan_in`` rows a merge.
    """
    best = F.struct(
        (-F.col("n_chars")).alias("shorter"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"
    )
    last = rows.agg(F.max("run")).first()[0] or 0
    merged = rows.select("run", *KEY, best.alias("best"), F.lit(1).cast("long").alias("group_size"))
    while True:
        merged = (
            merged.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
            .groupBy("run", *KEY)
            .agg(F.min("best").alias("best"), F.sum("group_size").alias("group_size"))
        )
        last //= fan_in
        if not last:
            return merged.drop("run")


def exact_groups(docs: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of ``docs``.

    Null texts count as empty.  In a group the row with the longest original text
    stays, then the smallest doc_id (null last); of rows equal in both, exactly
    one is ``kept``.  ``keep_id`` is null where that row's doc_id is null.  Columns
    besides doc_id and text are ignored whatever their names.
    """
    rows = digests(docs)
    groups = merge_runs(rows, fan_in)
    return rows.join(groups, KEY).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
    )
