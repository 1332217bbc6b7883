"""Image-coding projects: codes on rectangles of pictures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codespan.functions.ids import deterministic_id
from codespan.functions.values import colour_to_int
from codespan.plans.common import Actions, copies, distinct_names
from codespan.schemas import CANONICAL, FORMAT_VERSION
from codespan.sources.project import conform

Project = dict[str, DataFrame]


def time_bounds(columns: list[tuple[DataFrame, str]]) -> DataFrame:
    """One row: earliest and latest time over several tables."""
    each = [
        df.agg(F.min(c).alias("First"), F.max(c).alias("Last")) for df, c in columns
    ]
    return reduce(DataFrame.unionByName, each).agg(F.min("First").alias("First"), F.max("Last").alias("Last"))


def import_imagecoding(
    raw: Project,
    title: str = "Image coding project",
    origin: str = "",
    category: str = "Image",
    actions: Actions | None = None,
) -> Project:
    """Images, codes and rectangles as sources, nodes and two-axis taggings."""
    actions = actions or Actions()
    owners = distinct_names([(raw["imageCoding"], "owner"), (raw["images"], "owner")])
    bounds = time_bounds([(raw["imageCoding"], "date"), (raw["images"], "date")])
    default = owners.select(deterministic_id("User", F.min("Name"))).scalar()
    audit = {
        "CreatedBy": default, "CreatedDate": bounds.select("First").scalar(),
        "ModifiedBy": default, "ModifiedDate": bounds.select("Last").scalar(),
    }
    stamped = lambda df: df.select("*", *[c.alias(k) for k, c in audit.items()])
    owner_id = deterministic_id("User", F.col("owner"))
    own = [
        owner_id.alias("CreatedBy"), F.col("date").alias("CreatedDate"),
        owner_id.alias("ModifiedBy"), F.col("date").alias("ModifiedDate"),
    ]
    source_id = lambda c: deterministic_id("Source", F.col(c))
    node_id = lambda c: deterministic_id("Node", F.col(c))
    attribute_id = lambda c: deterministic_id("SourceAttribute", F.col(c))
    category_id = deterministic_id("SourceCategory", F.lit(category))

    out: Project = {}
    if actions.wants("users"):
        out["User"] = owners.select(deterministic_id("User", F.col("Name")).alias("Id"), "Name")
    if actions.wants("project"):
        one = bounds.select(
            F.lit(FORMAT_VERSION).alias("Version"), F.lit(title).alias("Title"),
            F.lit(f"Exported from {origin}").alias("Description"),
        )
        out["Project"] = stamped(one)
    if actions.wants("nodes"):
        out["Node"] = stamped(
            raw["codes"].select(
                node_id("id").alias("Id"), F.col("name").alias("Name"),
                F.col("memo").alias("Description"), colour_to_int(F.col("color")).alias("Color"),
            )
        )
    if actions.wants("sources"):
        out["SourceCategory"] = stamped(bounds.select(category_id.alias("Id"), F.lit(category).alias("Name")))
        out["Source"] = raw["images"].select(
            source_id("id").alias("Id"), category_id.alias("Category"), F.col("name").alias("Name"),
            F.col("memo").alias("Description"), F.lit("JPEG").alias("ObjectType"), *own,
        )
    if actions.wants("source_attributes"):
        lengths = raw["imageAttributes"].groupBy("attributes_id").agg(F.max(F.length("value")).alias("Length"))
        out["SourceAttribute"] = stamped(
            raw["attributes"].join(lengths, F.col("id") == F.col("attributes_id")).select(
                attribute_id("id").alias("Id"), F.col("name").alias("Name"),
                F.col("memo").alias("Description"), F.lit("text").alias("Type"), "Length",
            )
        )
        out["SourceValue"] = stamped(
            raw["imageAttributes"].select(
                source_id("images_id").alias("Source"), attribute_id("attributes_id").alias("Attribute"),
                F.col("value").alias("Value"),
            )
        )
    if actions.wants("taggings"):
        text = lambda c: F.col(c).cast("string")
        place = ["images_id", "codes_id", "x1", "y1", "x2", "y2", "owner", "date", "memo"]
        counted = raw["imageCoding"].groupBy(*place).agg(F.count(F.lit(1)).alias("_times"))
        rows = copies(counted, "_times", "copy")  # equal rectangles are told apart by number
        out["Tagging"] = rows.select(
            deterministic_id("Tagging", *[F.col(c) for c in (*place, "copy")]).alias("Id"),
            source_id("images_id").alias("Source"), node_id("codes_id").alias("Node"),
            F.concat(text("x1"), F.lit(":"), text("x2"), F.lit(","), text("y1"), F.lit(":"), text("y2")).alias("Fragment"),
            F.col("memo").alias("Memo"), *own,
        )
    return conform(out or {"User": owners.limit(0)}, CANONICAL)
