"""Row numbers, ordinals and fills that never sort a whole table in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codespan.functions.bind import let

BUCKET_DIGITS = 3  # 4,096 buckets
SMALL_GROUP = 100_000  # rows of a group that a task numbers alone
FEW_BORDERS = 32  # up to here a row is compared with every border, beyond by halving


def _null_safe(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


def number_rows(
    df: DataFrame,
    key: list[str],
    out: str,
    group: list[str] | None = None,
    start: int = 1,
    bucket_digits: int = BUCKET_DIGITS,
    small: bool = False,
) -> DataFrame:
    """Dense numbers ``start..`` within each group (or the whole table).

    ``key`` must be unique inside the group.  Rows are spread over hash buckets
    of the key, numbered inside their bucket, and shifted by the sizes of the
    buckets before it, so a group holding most of the table is numbered by many
    tasks.  The order is (digest prefix of the key, key): arbitrary but the same
    on every run.  ``small`` says that every group fits a task, which then
    numbers it alone, in the same order.
    """
    group = group or []
    text = F.concat_ws("\u001f", *[F.col(c).cast("string") for c in key])
    bucket = F.substring(F.md5(text), 1, bucket_digits)
    if small:
        inside = Window.partitionBy(*group).orderBy("_bucket", *key)
        numbered = df.withColumn("_bucket", bucket).withColumn("_n", F.row_number().over(inside).cast("long"))
        return numbered.select(*df.columns, (F.col("_n") + (start - 1)).alias(out))
    # Rows are numbered and shifted under one key, so they are dealt out once; structs of nulls are equal.
    parts = [f"g{i}" for i in range(len(group))]
    spread = df.withColumn("_slice", F.struct(*[F.col(c).alias(p) for c, p in zip(group, parts)], bucket.alias("b")))
    local = spread.withColumn("_n", F.row_number().over(Window.partitionBy("_slice").orderBy(*key)).cast("long"))
    sizes = spread.groupBy("_slice").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*[F.col("_slice")[p] for p in parts]).orderBy(F.col("_slice")["b"]).rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sizes.select(
        F.col("_slice").alias("_of"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    return local.join(offsets, F.col("_slice") == F.col("_of")).select(
        *df.columns, (F.col("_offset") + F.col("_n") + (start - 1)).alias(out)
    )


def fits_a_task(df: DataFrame, group: list[str], rows: int = SMALL_GROUP) -> bool:
    """Whether no group has more than so many rows; counts them."""
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows).isEmpty()


def range_runs(df: DataFrame, order: str, out: str, runs: int | None = None) -> DataFrame:
    """Deal rows into runs of about equal size that follow each other in ``order``.

    The borders are quantiles of the order itself, so it does not matter how far
    apart its values lie; rows of one value share a run, nulls the first one.
    ``runs`` defaults to the session's shuffle partitions.
    """
    runs = runs or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = [i / runs for i in range(1, runs)]
    found = df.agg(F.percentile_approx(order, at, 100 * runs).alias("b")).first()["b"] if at else None
    borders = sorted(set(found or []))  # a number per run
    if not borders:
        return df.withColumn(out, F.lit(0))
    if len(borders) <= FEW_BORDERS:
        return df.withColumn(out, reduce(lambda a, b: a + b, [
            F.when(F.col(order) > F.lit(b), 1).otherwise(0) for b in borders]))
    held = F.array(*[F.lit(b) for b in borders])

    def half(span: Column, values: Column) -> Column:
        middle = F.floor((span["low"] + span["high"]) / 2).cast("int")
        below = F.col(order) <= F.get(values, middle)
        open_ = span["low"] < span["high"]
        return F.struct(
            F.when(open_ & ~below, middle + 1).otherwise(span["low"]).alias("low"),
            F.when(open_ & below, middle).otherwise(span["high"]).alias("high"),
        )

    whole = F.struct(F.lit(0).alias("low"), F.lit(len(borders)).alias("high"))
    steps = F.sequence(F.lit(1), F.lit(len(borders).bit_length()))
    run = let(held, lambda values: F.aggregate(steps, whole, lambda span, _: half(span, values), lambda s: s["low"]))
    return df.withColumn(out, F.when(F.col(order).isNull(), 0).otherwise(run))


def forward_fill(
    df: DataFrame,
    order: str,
    columns: list[str],
    defaults: dict[str, str] | None = None,
    blank: bool = True,
    runs: int | None = None,
) -> DataFrame:
    """Blank cells take the last value above them in ``order``, else the default.

    ``order`` is a row position; gaps may be of any size.  The rows are cut into
    ranges of about equal size (``range_runs``) and every range is filled on its
    own; what it inherits from the ranges before is one small row per range.
    """
    defaults = defaults or {}

    def present(c):
        value = F.col(c)
        return F.when(value != "", value) if blank else value

    runs = range_runs(df, order, "_run", runs)
    inside = Window.partitionBy("_run").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    filled = runs
    for c in columns:
        filled = filled.withColumn(f"_f_{c}", F.last(present(c), ignorenulls=True).over(inside))
    ends = runs.groupBy("_run").agg(
        *[
            F.max_by(present(c), F.when(present(c).isNotNull(), F.col(order))).alias(f"_e_{c}")
            for c in columns
        ]
    )
    earlier = Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        F.col("_run").alias("_from"),
        *[F.last(f"_e_{c}", ignorenulls=True).over(earlier).alias(f"_c_{c}") for c in columns],
    )
    joined = filled.join(carried, F.col("_run") == F.col("_from"), "left")
    return joined.select(
        *[
            F.coalesce(F.col(f"_f_{c}"), F.col(f"_c_{c}"), F.lit(defaults.get(c))).alias(c)
            if c in columns
            else F.col(c)
            for c in df.columns
        ]
    )


def default_names(df: DataFrame, name: str, row_number: str, pad: bool = False) -> DataFrame:
    """A blank name becomes the row's number, for sources padded to equal width."""
    text = F.col(row_number).cast("string")
    if pad:
        total = df.select(F.length(F.count(F.lit(1)).cast("string")).alias("w")).scalar()
        text = F.lpad(text, total, "0")
    return df.withColumn(name, F.when(F.coalesce(F.col(name), F.lit("")) != "", F.col(name)).otherwise(text))


def first_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the lowest in ``order``.  Aggregates before shuffling."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    )
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def next_ordinals(
    new_rows: DataFrame,
    existing: DataFrame,
    group: list[str],
    key: list[str],
    ordinal: str,
) -> DataFrame:
    """Number new rows of a group after the highest ordinal the group already has."""
    highest = existing.groupBy(*group).agg(F.max(ordinal).alias("_max")).select(
        *[F.col(c).alias(f"_h_{c}") for c in group], "_max"
    )
    numbered = number_rows(new_rows, key, "_i", group=group, start=0)
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_h_{c}")) for c in group])
    return numbered.join(highest, on, "left").select(
        *new_rows.columns,
        (F.coalesce(F.col("_max"), F.lit(-1)) + 1 + F.col("_i")).cast("int").alias(ordinal),
    )
