"""Attribute tables: inferring types, unpivoting, conflicts, defaults."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codespan.functions.values import TYPE_ORDER, type_mask
from codespan.operators.numbering import first_by
from codespan.session import spread

SLICES = 128


def _type_of(mask: Column) -> Column:
    """The first type whose bit is set; no bit, or no value at all, is text."""
    out = None
    for i, name in enumerate(TYPE_ORDER):
        has = mask.bitwiseAND(F.lit(1 << i)) != 0
        out = F.when(has, name) if out is None else out.when(has, name)
    return out.otherwise("text")


def infer_attribute_types(df: DataFrame, columns: list[str], ignore_blank: bool = True) -> DataFrame:
    """Name, Type and Length of each wide column, in one pass over the table.

    The type is the first one every value satisfies; blanks are left out unless
    ``ignore_blank`` is off, in which case a single blank makes the column text.
    """
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns}

    def mask(c: str) -> Column:
        return F.when(text[c] != "", type_mask(text[c])) if ignore_blank else type_mask(text[c])

    # The masks are columns first, so that the aggregate does not work them out again.
    masked = spread(df.select(*columns)).select(
        *[F.length(text[c]).alias(f"n_{c}") for c in columns], *[mask(c).alias(f"m_{c}") for c in columns]
    )
    one = masked.agg(
        *[F.max(f"n_{c}").alias(f"n_{c}") for c in columns], *[F.bit_and(f"m_{c}").alias(f"m_{c}") for c in columns]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("Name"), _type_of(F.col(f"m_{c}")).alias("Type"),
                F.coalesce(F.col(f"n_{c}"), F.lit(0)).alias("Length"),
            )
            for c in columns
        ]
    )
    return one.select(F.inline(rows))


def infer_value_types(values: DataFrame, key: str = "Attribute", value: str = "Value") -> DataFrame:
    """The same for a long table of values: one row per attribute."""
    filled = spread(values.select(key, value)).filter(F.coalesce(F.col(value), F.lit("")) != "").select(
        key, F.length(value).alias("_length"), type_mask(F.col(value)).alias("_mask")
    )
    grouped = filled.groupBy(key).agg(F.max("_length").alias("Length"), F.bit_and("_mask").alias("_mask"))
    return grouped.select(key, _type_of(F.col("_mask")).alias("Type"), "Length")


def attribute_columns(
    columns: list[str],
    reserved: list[str],
    include: list[str] | None = None,
    exclude: list[str] | None = None,
    text: list[str] | None = None,
) -> list[str]:
    """Which columns of a sheet are attributes."""
    return [
        c
        for c in columns
        if c not in reserved
        and (include is None or c in include)
        and c not in (exclude or [])
        and c not in (text or [])
    ]


def parse_attribute_args(args: list[str]) -> dict[str, str | None]:
    """``name:value`` arguments; a missing value is null."""
    out = {}
    for arg in args:
        name, colon, value = arg.partition(":")
        if not name or not colon:
            raise ValueError(f"incorrect attribute format {arg!r}")
        out[name] = value or None
    return out


def with_attribute_args(df: DataFrame, args: list[str]) -> DataFrame:
    """Add argument values as columns, to rows that lack one."""
    for name, value in parse_attribute_args(args).items():
        given = F.lit(value).cast("string")
        df = df.withColumn(name, F.coalesce(F.col(name), given) if name in df.columns else given)
    return df


def unpivot_values(df: DataFrame, entity: str, columns: list[str]) -> DataFrame:
    """One row (entity, Name, Value) per cell that is not blank."""
    if not columns:
        return df.select(entity, F.lit("").alias("Name"), F.lit("").alias("Value")).limit(0)
    cells = F.array(
        *[F.struct(F.lit(c).alias("Name"), F.col(c).cast("string").alias("Value")) for c in columns]
    )
    filled = F.filter(cells, lambda x: F.coalesce(x["Value"], F.lit("")) != "")
    return df.select(entity, F.inline(filled))


def attribute_conflicts(attributes: DataFrame) -> DataFrame:
    """Attribute ids that come with more than one type or length."""
    variants = attributes.select("Id", "Type", "Length").distinct()
    return variants.groupBy("Id").agg(F.count(F.lit(1)).alias("Variants")).filter(F.col("Variants") > 1)


def distinct_attributes(rows: DataFrame) -> DataFrame:
    """One definition row per attribute id."""
    order = [c for c in ("Type", "Length", "Name") if c in rows.columns]
    return first_by(rows.distinct(), ["Id"], order)


def default_fill(members: DataFrame, defaults: DataFrame, existing: DataFrame) -> DataFrame:
    """Members of a category that lack a value of an attribute get its default.

    ``members``: Category, Item.  ``defaults``: Category, Attribute, Default.
    ``existing``: Item, Attribute.  Returns Item, Attribute, Default.
    """
    # What an item has goes to its members, so that the pairs, many times more, stay where
    # they are made.  A category is dealt out over slices, for there may be a few large ones.
    used = defaults.select("Attribute").distinct()
    has = existing.select("Item", "Attribute").join(used, "Attribute", "left_semi").groupBy("Item").agg(
        F.collect_set("Attribute").alias("_has"))
    slice_of = F.pmod(F.xxhash64("Item"), F.lit(SLICES)).cast("int")
    held = members.join(has, "Item", "left").select("Category", "Item", "_has", slice_of.alias("_slice"))
    # A fixed number of tasks: what they read is small beside what they make of it.
    held = held.repartition(SLICES, "Category", "_slice")
    dealt = defaults.select("Category", "Attribute", "Default", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))).alias("_slice"))
    lacks = ~F.coalesce(F.array_contains("_has", F.col("Attribute")), F.lit(False))
    # Spark takes the slices for no larger than the defaults and would send all of them to every task.
    return held.join(dealt.hint("merge"), ["Category", "_slice"]).filter(lacks).select("Item", "Attribute", "Default")


def members_without_value(members: DataFrame, existing: DataFrame, attribute: Column) -> DataFrame:
    """Members with no value of one attribute."""
    has = existing.filter(F.col("Attribute") == attribute).select("Item").distinct()
    return members.join(has, "Item", "left_anti")


def split_by_category(uses: DataFrame, new_id) -> DataFrame:
    """Give an attribute used in several categories one id per category.

    ``uses``: Attribute, Category (distinct).  The lowest category keeps the
    id, every other gets ``new_id(attribute, category)``.
    """
    lowest = uses.groupBy("Attribute").agg(F.min("Category").alias("_first"))
    own = F.col("Category").eqNullSafe(F.col("_first"))
    return uses.join(lowest, "Attribute").select(
        "Attribute", "Category",
        F.when(own, F.col("Attribute")).otherwise(new_id(F.col("Attribute"), F.col("Category"))).alias("NewId"),
        (~own).alias("Copied"),
    )


def value_counts(entities: DataFrame, values: DataFrame, entity: str) -> DataFrame:
    """Number of values per entity, zero included."""
    counts = values.groupBy(entity).agg(F.count(F.lit(1)).alias("_n"))
    return entities.join(counts, entities["Id"] == counts[entity], "left").select(
        entities["Id"], F.coalesce("_n", F.lit(0)).alias("ValueCount")
    )


def and_all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
