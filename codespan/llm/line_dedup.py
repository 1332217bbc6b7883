"""Cross-site boilerplate: lines that stand on many distinct sites.

HyperLogLog sketches of the sites, one per line hash, are merged by aggregation.
Their estimate decides far from the threshold; around it the sites are counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codespan.llm.store import by_row, fresh, keep, text_key

MIN_SITES = 10
LG_BUCKETS = 10
ERRORS = 5  # standard errors that count as near the threshold


def _lines(docs: DataFrame) -> DataFrame:
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"),
        F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("")).alias("site"),
        F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("at", "raw"),
    ).withColumn("line", F.trim("raw")).where("line <> ''")
    return rows.select(
        "doc_id", "text_key", "site", "at",
        F.xxhash64("line").alias("line_hash"), F.length("line").alias("line_size"),
    )


def boilerplate_places(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """doc_id, text_key, at: every place of a line found on ``min_sites`` sites, but its first.

    The first place is that in the smallest doc_id (null first), then text key.
    A line is what stands between line ends, without spaces around it; blank lines
    never count.  A null source is a site of its own.
    """
    error = 1.04 / 2 ** (LG_BUCKETS / 2)
    lines = _lines(docs)
    spread = lines.groupBy("line_hash", "line_size").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", LG_BUCKETS)).alias("sites")
    )
    likely = spread.where(F.col("sites") >= min_sites * (1 - ERRORS * error))
    places = keep(lines.join(likely, ["line_hash", "line_size"]))
    near = places.where(F.col("sites") < min_sites * (1 + ERRORS * error))
    counted = (
        near.select("line_hash", "line_size", "site").distinct()
        .groupBy("line_hash", "line_size").agg(F.count(F.lit(1)).alias("exact"))
        .where(F.col("exact") < min_sites)
    )
    spread_out = places.join(counted, ["line_hash", "line_size"], "left_anti")
    first = spread_out.groupBy("line_hash", "line_size").agg(
        F.min(F.struct("doc_id", "text_key", "at")).alias("first")
    )
    return spread_out.join(first, ["line_hash", "line_size"]).where(
        ~F.struct("doc_id", "text_key", "at").eqNullSafe(F.col("first"))
    ).select("doc_id", "text_key", "at")


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with boilerplate lines cut from ``text``, and n_lines, n_removed added.

    Every row stays; a text of nothing but boilerplate becomes empty.  Null texts
    stay null with one (blank) line.  Rows that repeat both doc_id and text are
    cut alike.  Needs doc_id, text, source; other columns pass through, and the
    added ones get other names where these are taken.
    """
    cut = fresh(docs, "_gone")
    gone = boilerplate_places(docs, min_sites).groupBy("doc_id", "text_key").agg(F.collect_set("at").alias(cut))
    columns = docs.columns
    joined = by_row(docs, gone, "left", cut)
    parts = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    kept = F.filter(parts, lambda line, i: ~F.array_contains(cut, i))
    text = F.when(F.col(cut).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return joined.select(
        *[text.alias(c) if c == "text" else F.col(c) for c in columns],
        F.size(parts).cast("long").alias(fresh(docs, "n_lines")),
        F.coalesce(F.size(cut), F.lit(0)).cast("long").alias(fresh(docs, "n_removed")),
    )
