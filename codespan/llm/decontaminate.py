"""Benchmark passages in documents, found by winnowed fingerprints.

Of every window of neighbouring k-word runs the smallest hash is a fingerprint.
Two texts that share a span as long as the window share its fingerprint, so no
shared span of that length can be missed.  Where a fingerprint meets one of the
benchmark, the hit is extended to the item windows around it and compared word
for word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codespan.llm.store import by_row, keep, text_key

SPAN = 10  # words of a window
RUN = 5  # words hashed together
BROADCAST_ROWS = 500_000  # fingerprints or windows sent to every executor; more are joined by shuffle
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Runs of letters, digits and characters beyond ASCII, with A-Z folded only."""
    text = F.coalesce(text, F.lit(""))
    folded = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _LOWER)
    )
    return F.array_remove(F.split(folded, SEPARATORS, -1), "")


def _runs(items: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words; none if there are fewer."""
    last = F.size(items) - size
    return F.when(
        last >= 0,
        F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(0)) + 1), lambda i: F.xxhash64(F.slice(items, i, size))),
    ).otherwise(F.expr("cast(array() as array<bigint>)"))


def fingerprints(hashes: Column, window: int) -> Column:
    """The distinct smallest hashes of all windows of ``window`` neighbours."""
    last = F.size(hashes) - window
    return F.when(
        last >= 0,
        F.array_distinct(F.transform(
            F.sequence(F.lit(1), F.greatest(last, F.lit(0)) + 1),
            lambda i: F.array_min(F.slice(hashes, i, window)),
        )),
    ).otherwise(F.expr("cast(array() as array<bigint>)"))


def item_windows(benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """item_id, passage: all runs of ``span`` words of an item, or all its words if fewer."""
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - span, F.lit(0)) + 1)
    return items.select(
        "item_id", F.explode(F.transform(starts, lambda i: F.slice(F.col("w"), i, span))).alias("passage")
    ).distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, run: int = RUN,
                 broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, text_key of every row.

    A word is hit if it lies in an occurrence of a window of an item.  Nulls have
    no words; items without words have no windows; repeated rows and items with
    equal texts count each.  An item with a null item_id hits words but is left
    out of ``n_items``.  Columns besides doc_id, item_id and text are ignored.
    """
    passages = keep(item_windows(benchmark, span))
    windows = keep(passages.select("passage").distinct().select(
        F.xxhash64("passage").alias("w_hash"), "passage", F.size("passage").alias("w_size")
    ))
    count, shortest = windows.agg(F.count(F.lit(1)), F.min("w_size")).first()
    sizes = [r[0] for r in windows.select("w_size").distinct().orderBy("w_size").collect()]  # span values at most
    shortest = shortest or span
    run = min(run, shortest)
    width = shortest - run + 1  # neighbours in a window of fingerprints
    small = count <= broadcast_rows
    sent = F.broadcast if small else (lambda df: df)

    marks = windows.select(F.explode(fingerprints(_runs(F.col("passage"), run), width)).alias("mark")).distinct()
    known = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"),
        words(F.col("text")).alias("w"),
    ).withColumn("n_words", F.size("w").cast("long"))
    hashed = known.withColumn("h", _runs(F.col("w"), run))
    own = fingerprints(F.col("h"), width)

    # Windows that hold a run at a place where the mark stands, for every size of window.
    def around(size: int) -> Column:
        spread = F.flatten(F.transform(
            F.filter(F.transform("h", lambda x, i: F.when(x == F.col("mark"), i)), lambda i: i.isNotNull()),
            lambda i: F.sequence(F.greatest(i - (size - run), F.lit(0)), i),
        ))
        fit = F.filter(F.array_distinct(spread), lambda s: s + size <= F.size("w"))
        return F.transform(fit, lambda s: F.struct(s.alias("at"), F.slice(F.col("w"), s + 1, size).alias("found")))

    near = F.flatten(F.array(*[around(s) for s in sizes])) if sizes else F.expr(
        "cast(array() as array<struct<at:int,found:array<string>>>)"
    )
    if small:
        # One row a document with a null mark, and one for each mark that the benchmark has too.
        first = F.expr("array(cast(null as bigint))")
        rows = hashed.withColumn("mark", F.explode(F.concat(first, own)))
        met = rows.join(F.broadcast(marks.withColumn("known", F.lit(True))), "mark", "left").where(
            "known or mark is null"
        )
        met = keep(met.select(
            "doc_id", "text_key", "n_words", "mark", F.when(F.col("mark").isNotNull(), near).alias("near")
        ))
        plain, hits = met.where("mark is null"), met.where("mark is not null")
    else:
        slim = hashed.select("doc_id", "text_key", F.explode(own).alias("mark")).join(marks, "mark").distinct()
        slim = slim.toDF("mark", "m_id", "m_key")
        plain = known
        hits = hashed.join(
            slim, F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("text_key") == F.col("m_key"))
        ).withColumn("near", near)

    places = (
        hits.select("doc_id", "text_key", F.explode("near").alias("near"))
        .select("doc_id", "text_key", "near.at", "near.found")
        .withColumn("w_hash", F.xxhash64("found"))
        .join(sent(windows), "w_hash").where("found = passage")
        .select("doc_id", "text_key", "at", "w_size", "w_hash", "passage")
        .distinct()
    )
    places = keep(places)
    cover = places.groupBy("doc_id", "text_key").agg(F.size(F.array_distinct(F.flatten(F.collect_list(
        F.sequence(F.col("at"), F.col("at") + F.col("w_size") - 1)
    )))).cast("long").alias("n_hit"))
    named = (
        places.select("doc_id", "text_key", "w_hash", "passage").distinct()
        .join(sent(passages.withColumn("w_hash", F.xxhash64("passage"))), ["w_hash", "passage"])
        .groupBy("doc_id", "text_key")
        .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    )
    hit = cover.join(
        named.toDF("i_id", "i_key", "items"),
        F.col("doc_id").eqNullSafe(F.col("i_id")) & (F.col("text_key") == F.col("i_key")), "left",
    ).select(F.col("doc_id").alias("h_id"), F.col("text_key").alias("h_key"), "n_hit", "items")
    joined = plain.join(
        hit, F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("text_key") == F.col("h_key")), "left"
    )
    none = F.expr("cast(array() as array<string>)")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        "text_key",
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that hold a window of a benchmark item."""
    bad = contaminated(docs, benchmark, **options).where("contaminated")
    return by_row(docs, bad.select("doc_id", "text_key").distinct(), "left_anti").select(*docs.columns)
