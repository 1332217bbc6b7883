"""Algebra of character spans: merging, intersecting, remapping.

Frames here carry ``Source``, ``start0`` (zero-based) and ``end0`` (exclusive).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codespan.functions import offsets as O
from codespan.session import spread

CELL_WIDTH = 256


def merge_spans(
    df: DataFrame,
    group: list[str],
    first: list[str] | None = None,
    tie: list[str] | None = None,
) -> DataFrame:
    """Join spans of a group that share a character; neighbours stay apart.

    ``first`` columns come from the span that begins the merged one (lowest
    start, then end, then ``tie``).

    Spans with the same start collapse to one row before the shuffle, so a
    group reaches its task with at most one row per character of one text,
    however many spans were laid over that text.  There one sort serves all
    windows, and the last row of a merged span tells it; nothing is hashed.
    """
    first = first or []
    begin = [F.min_by(F.struct(*first), F.struct("end0", *(tie or []))).alias("_first")] if first else []
    starts = df.groupBy(*group, "start0").agg(F.max("end0").alias("end0"), *begin)
    ordered = Window.partitionBy(*group).orderBy("start0")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, 0)
    reach = F.max("end0").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.col("_reach").isNull() | (F.col("start0") >= F.col("_reach"))
    islands = starts.withColumn("_reach", reach).withColumn("_fresh", fresh).withColumns({
        "_island": F.sum(F.when(F.col("_fresh"), 1).otherwise(0)).over(so_far),
        "_last": F.coalesce(F.lead("_fresh").over(ordered), F.lit(True)),
        # A start that is null comes first; what it is merged with says where both begin.
        "_begins": F.col("start0").isNotNull() & (F.col("_fresh") | F.lag("start0").over(ordered).isNull()),
    })
    at_begin = lambda value: F.last(F.when(F.col("_begins"), value), ignorenulls=True).over(so_far)
    told = islands.withColumns({
        "_start": at_begin(F.col("start0")),
        "_end": F.max(F.struct("_island", "end0")).over(so_far)["end0"],
        **({"_kept": at_begin(F.struct("_first"))["_first"]} if first else {}),
    })
    return told.filter("_last").select(
        *group, F.col("_start").alias("start0"), F.col("_end").alias("end0"),
        *[F.col("_kept")[c].alias(c) for c in first],
    )


def _cells(df: DataFrame, width: int) -> DataFrame:
    """One copy of a span per grid cell it touches."""
    low = F.floor(F.col("start0") / width)
    high = F.floor((F.col("end0") - 1) / width)
    return df.filter(F.col("end0") > F.col("start0")).withColumn("_cell", F.explode(F.sequence(low, high)))


def intersect_spans(
    a: DataFrame,
    b: DataFrame,
    a_columns: list[str],
    b_columns: list[str],
    width: int = CELL_WIDTH,
) -> DataFrame:
    """Overlaps of spans of ``a`` and ``b`` on the same source.

    Both sides are laid on a grid of text positions and meet per (source,
    cell), so a source holding a large share of all spans is spread over its
    cells.  A pair meeting in several cells counts only in the one where the
    overlap begins.  Merged inputs touch each cell border at most once per
    group, which bounds the copies by text length / ``width``.
    """
    left = _cells(a, width).select(
        "Source", "_cell", *a_columns, F.col("start0").alias("_s1"), F.col("end0").alias("_e1")
    )
    right = _cells(b, width).select(
        F.col("Source").alias("_source"), F.col("_cell").alias("_cell2"), *b_columns,
        F.col("start0").alias("_s2"), F.col("end0").alias("_e2"),
    )
    start = F.greatest("_s1", "_s2")
    meets = (
        (F.col("Source") == F.col("_source"))
        & (F.col("_cell") == F.col("_cell2"))
        & (F.col("_s1") < F.col("_e2"))
        & (F.col("_s2") < F.col("_e1"))
        & (F.col("_cell") == F.floor(start / width))
    )
    return left.join(right, meets).select(
        "Source", *a_columns, *b_columns,
        start.alias("start0"), F.least("_e1", "_e2").alias("end0"),
    )


def intersect_terms(terms: list[DataFrame], width: int = CELL_WIDTH) -> DataFrame:
    """Passages carrying every term, folded left to right.

    A term has ``Source``, ``Node`` (name), ``start0``, ``end0``.  The result
    names its nodes in ``Nodes``, the newest term first.  Merging each term
    before it is intersected gives the same passages as merging afterwards:
    three intervals that meet pairwise share a point.
    """
    def as_tuple(term):
        nodes = F.when(F.coalesce(F.col("Node"), F.lit("")) != "", F.array("Node")).otherwise(
            F.array().cast("array<string>")
        )
        return term.withColumn("Nodes", nodes)

    def step(found, term):
        fresh = merge_spans(term, ["Source", "Node"])
        pairs = intersect_spans(found, fresh, ["Nodes"], ["Node"], width)
        named = pairs.withColumn("Nodes", F.array_prepend("Nodes", F.col("Node"))).drop("Node")
        return merge_spans(named, ["Source", "Nodes"])

    head = merge_spans(as_tuple(terms[0]), ["Source", "Nodes"])
    return reduce(step, terms[1:], head)


def counts_before(spans: DataFrame, texts: DataFrame, steps, asked: dict) -> DataFrame:
    """``spans`` with how many of some places of their text lie before an offset, and whether one lies on it.

    ``texts``: Source, Text.  ``steps`` gives how far apart the places of a text lie.
    ``asked``: name -> (offset, whether it is asked for); each adds ``_n<name>`` and
    ``_at<name>``, null where the source has no text.  A text is gone through once
    and becomes an array in which every offset is looked up by its index.
    """
    # Both sides read the same arrays, so Spark makes them once.
    held = spread(texts.filter(F.col("Source").isNotNull() & F.col("Text").isNotNull())).select(
        F.col("Source").alias("_source"), O.ranks(steps(F.col("Text"))).alias("_ranks")
    ).hint("merge")  # Spark takes an array for a few bytes and would broadcast all of them
    for name, (k, wanted) in asked.items():
        n, after = O.rank_at(F.col("_ranks"), k), O.rank_at(F.col("_ranks"), k + 1)
        spans = spans.join(held, (F.col("Source") == F.col("_source")) & wanted, "left").select(
            *spans.columns, n.alias(f"_n{name}"), (after > n).alias(f"_at{name}")
        )
    return spans


def _translate(spans: DataFrame, texts: DataFrame, steps, sign: int, edged: bool = True) -> DataFrame:
    start, end = F.col("start0"), F.col("start0") + F.col("length")
    whole = start.isNotNull() & F.col("length").isNotNull()
    joined = counts_before(spans, texts, steps, {"1": (start, whole & (start >= 0)), "2": (end, whole & (end >= 0))})
    # A pair cut by the start of the span lies in neither part.
    straddling = (F.col("_at1") & (F.col("length") > 0)).cast("int") if edged else F.lit(0)
    inside = F.greatest(F.col("_n2") - F.col("_n1") - straddling, F.lit(0))
    moved = {
        "start0": start + sign * F.coalesce("_n1", F.lit(0)),
        "length": F.col("length") + sign * F.coalesce(inside, F.lit(0)),
    }
    return joined.select(*[moved[c].alias(c) if c in moved else F.col(c) for c in spans.columns])


def crlf_to_lf_spans(spans: DataFrame, texts: DataFrame) -> DataFrame:
    """Offsets into texts with two-character line ends -> into the cleaned texts.

    ``spans`` has Source, start0, length; a source without text moves nothing.
    """
    return _translate(spans, texts, O.crlf_ends, -1)


def lf_to_crlf_spans(spans: DataFrame, texts: DataFrame) -> DataFrame:
    """Inverse of :func:`crlf_to_lf_spans`, against the cleaned texts."""
    return _translate(spans, texts, O.bare_newlines, 1)


def char_to_nonspace_spans(spans: DataFrame, texts: DataFrame) -> DataFrame:
    """Plain offsets -> offsets that leave white space out."""
    return _translate(spans, texts, O.uncounted, -1, edged=False)


def nonspace_to_char(spans: DataFrame, texts: DataFrame) -> DataFrame:
    """Replace offsets that skip white space by plain character offsets.

    ``spans`` has ``Source``, ``StartText``, ``LengthText``; ``texts`` has
    ``Source``, ``PlainText``.  The j-th white space has its position less j
    counted characters before it, and the k-th counted character comes after
    every one that has k or fewer.  Past the last counted character, only the
    text's white space is skipped.  A source without text moves nothing.
    """
    start = F.col("StartText")
    last = start + F.greatest(F.col("LengthText"), F.lit(1)) - 1
    asked = {"1": (start, start.isNotNull()), "2": (last, last.isNotNull())}
    joined = counts_before(spans, texts.withColumnRenamed("PlainText", "Text"), O.counted, asked)
    return joined.select(
        *spans.columns,
        (start + F.coalesce("_n1", F.lit(0))).alias("StartX"),
        F.when(F.col("LengthText") <= 0, F.lit(0))
        .otherwise(F.coalesce(last + F.col("_n2") + 1 - start - F.col("_n1"), F.col("LengthText")))
        .cast("long").alias("LengthX"),
    )
