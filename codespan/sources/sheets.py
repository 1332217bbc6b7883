"""Sheets whose quoted cells hold line ends, cut into records by many tasks.

A line alone does not say whether it begins inside a quoted cell.  But it says
where it ends for either case, and such answers can be composed: those of a
range's lines make the answer of the range, and going over the ranges of a file,
a row each, tells how every range begins, and so every line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from codespan.functions.bind import let
from codespan.session import stored

# What a line can be in the middle of, and what a quote there leads to: inside a
# plain cell it is a character, at the start of a cell it opens one, inside a
# quoted cell it closes it, and after such it was one of a doubled pair.
PLAIN, FRESH, QUOTED, CLOSED = range(4)
AFTER_QUOTE = [PLAIN, QUOTED, CLOSED, QUOTED]
RANGE_BITS = 16  # a range holds 65,536 lines of a file split at most, however large splits are


def ends_quoted(line: Column, begins_quoted: bool) -> Column:
    """Whether a line ends inside a quoted cell, given how it begins."""
    def through(state: Column, piece: Column) -> Column:
        outside = F.when(piece.endswith(","), FRESH).otherwise(PLAIN)
        return F.when((piece == "") | (state == QUOTED), state).otherwise(outside)

    quoted = F.array(*[F.lit(s) for s in AFTER_QUOTE])

    def walked(pieces: Column) -> Column:
        begin = through(F.lit(QUOTED if begins_quoted else FRESH), F.get(pieces, F.lit(0)))
        return F.aggregate(
            F.slice(pieces, 2, F.size(pieces)), begin, lambda s, piece: through(F.get(quoted, s), piece)
        ) == QUOTED

    return F.when(F.contains(line, F.lit('"')), let(F.split(line, '"', -1), walked)).otherwise(begins_quoted)


def _carried(window, known: Column, flips: Column, begin: Column) -> Column:
    """The state before each row of a window: the last known one, turned by every flip since.

    ``known``: what a row's end is whatever its beginning, or null; ``flips``: whether
    it ends as the opposite of how it begins (a row that does neither ends as it
    begins); ``_flips_upto`` counts the flips so far.
    """
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    turned = F.coalesce(F.sum(flips.cast("int")).over(before), F.lit(0))
    last = F.last(known.cast("int"), ignorenulls=True).over(before)
    at = F.last(F.when(known.isNotNull(), F.col("_flips_upto")), ignorenulls=True).over(before)
    return F.when(last.isNull(), begin.cast("int") + turned).otherwise(last + turned - at) % 2 == 1


def _lines(spark: SparkSession, path: str, comments: str) -> DataFrame:
    """_file, _block (of the range), _at, value of every line below the comments at the top of its file."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"), "value",
    )
    # A line takes a byte at least, so ranges number from the split's first byte on and never reach the next split's.
    line = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    lines = lines.withColumn("_block", F.col("_block") + F.shiftright(line, RANGE_BITS))
    if comments != "top":
        return lines
    head = lines.filter(~F.col("value").startswith("#")).groupBy(F.col("_file").alias("_f")).agg(
        F.min(F.struct("_block", "_at")).alias("_head")
    )
    return lines.join(head, (F.col("_file") == F.col("_f")) & (F.struct("_block", "_at") >= F.col("_head"))).select(
        lines.columns
    )


def sheet_records(spark: SparkSession, path: str, comments: str = "anywhere") -> DataFrame:
    """file, number, record: every record of the sheets at ``path``, numbered from 0 in a file.

    Lines are read as splits of the files give them.  Only a range's own lines
    meet in a task; what passes between ranges is a row each.  Line ends inside
    cells become single line feeds.  Blank lines are no records.  Lines beginning
    with ``#`` are left out: everywhere outside quotes, or with ``comments="top"``
    only those before a file's first other line.
    """
    noted = (F.lit(comments != "top")) & F.col("value").startswith("#")
    inside = Window.partitionBy("_file", "_block").orderBy("_at")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    lines = (
        _lines(spark, path, comments)
        .withColumn("_open", F.when(noted, False).otherwise(ends_quoted(F.col("value"), False)))
        .withColumn("_stay", ends_quoted(F.col("value"), True))
        .withColumn("_known", F.when(F.col("_open") == F.col("_stay"), F.col("_open")))
        .withColumn("_flip", F.col("_open") & ~F.col("_stay"))
        .withColumn("_n", F.row_number().over(inside))
        .withColumn("_flips_upto", F.sum(F.col("_flip").cast("int")).over(upto))
    )

    # Of each range, for either beginning: how it ends, and how many records begin in it.
    both = lines
    for i, quoted in enumerate((False, True)):
        both = both.withColumn(f"_in{i}", _carried(inside, F.col("_known"), F.col("_flip"), F.lit(quoted)))
        first = ~F.col(f"_in{i}") & ~noted & (F.col("value") != "")
        both = both.withColumn(f"_first{i}", first).withColumn(f"_upto{i}", F.sum(first.cast("long")).over(upto))
    ends = lambda c: F.max_by(F.when(F.col(c), F.col("_stay")).otherwise(F.col("_open")), "_n")
    ranges = both.groupBy("_file", "_block").agg(*[
        f(i) for i in range(2) for f in (lambda i: ends(f"_in{i}").alias(f"_end{i}"), lambda i: F.max(f"_upto{i}").alias(f"_size{i}"))
    ])
    across = Window.partitionBy("_file").orderBy("_block")  # a row per range
    own = lambda c: F.when(F.col("_quoted"), F.col(f"{c}1")).otherwise(F.col(f"{c}0"))
    ranges = (
        ranges.withColumn("_known", F.when(F.col("_end0") == F.col("_end1"), F.col("_end0")))
        .withColumn("_flip", F.col("_end0") & ~F.col("_end1"))
        .withColumn("_flips_upto", F.sum(F.col("_flip").cast("int")).over(across.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_quoted", _carried(across, F.col("_known"), F.col("_flip"), F.lit(False)))
        .withColumn("_offset", F.coalesce(
            F.sum(own("_size")).over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .select(F.col("_file").alias("_rf"), F.col("_block").alias("_rb"), "_quoted", "_offset")
    )
    # The lines of a record share its number; a range's lines before its first record belong to the last one.
    # A line followed in its range by the beginning of another record is a record whole, and most are.
    follows = lambda i: F.lead(f"_first{i}").over(inside)
    ahead = both.withColumns({f"_next{i}": F.coalesce(follows(i), F.lit(False)) for i in range(2)})
    placed = ahead.join(ranges, (F.col("_file") == F.col("_rf")) & (F.col("_block") == F.col("_rb")))
    numbered = stored(placed.filter(own("_first") | own("_in")).select(
        F.col("_file").alias("file"), (own("_upto") + F.col("_offset") - 1).alias("number"), "_block", "_n", "value",
        (own("_first") & own("_next")).alias("_whole"),
    ))
    broken = numbered.filter(~F.col("_whole")).groupBy("file", "number").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_block", "_n", "value"))), lambda x: x["value"]), "\n")
        .alias("record")
    )
    return numbered.filter("_whole").select("file", "number", F.col("value").alias("record")).unionByName(broken)


def sheet_rows(spark: SparkSession, path: str, comments: str = "anywhere") -> DataFrame:
    """The cells of a sheet as strings under the names of its header, and ``Row`` from 1.

    Several files share the first one's header; each loses its own, and their rows
    are numbered one file after the other.
    """
    records = sheet_records(spark, path, comments)
    header = records.filter("number = 0").orderBy("file").first()
    if header is None:
        return spark.createDataFrame([], "Row long")
    names = cells_of(header["record"])
    schema = ", ".join("`{}` string".format(n.replace("`", "``")) for n in names)
    totals = records.groupBy("file").agg(F.max("number").alias("_rows"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    offsets = totals.select(
        F.col("file").alias("_f"), F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset")
    )
    cells = F.from_csv(F.col("record"), schema, {"escape": '"', "maxCharsPerColumn": "-1"})
    body = records.filter("number > 0").join(offsets, F.col("file") == F.col("_f"))
    return body.select(cells.alias("_c"), (F.col("number") + F.col("_offset")).alias("Row")).select("_c.*", "Row")


def cells_of(record: str) -> list[str]:
    """The cells of one record."""
    import csv
    import io

    return next(csv.reader(io.StringIO(record, newline="")))
