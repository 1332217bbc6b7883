"""Legacy graph projects (items, typed edges, property bags) into canonical tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codespan.functions import xml as X
from codespan.functions.text import crlf_to_lf, shift_decode, shift_encode
from codespan.functions.values import data_type_name, is_zip_document, object_type_name
from codespan.operators import spans as S
from codespan.operators.attributes import distinct_attributes
from codespan.operators.merge import merge_table, put_project
from codespan.plans.common import Actions
from codespan.schemas import AUDIT_COLUMNS, CANONICAL, ITEM_TYPE, ROLE_TYPE
from codespan.sources.project import empty_project, shape

Project = dict[str, DataFrame]
WINDOWS, MAC = "windows", "mac"


def decoded(column: Column, platform: str) -> Column:
    """Names and descriptions are shifted on one platform only."""
    return crlf_to_lf(shift_decode(column)) if platform == WINDOWS else column


def edges(raw: Project, kind: str) -> DataFrame:
    """The edges of one kind."""
    return raw["Role"].filter(F.col("TypeId") == ROLE_TYPE[kind])


def items(raw: Project, *kinds: str) -> DataFrame:
    """The items of some kinds."""
    return raw["Item"].filter(F.col("TypeId").isin([ITEM_TYPE[k] for k in kinds]))


def major_version(raw: Project) -> Column:
    """The major version of the project, as a scalar."""
    return raw["Project"].select(F.max(F.substring_index("Version", ".", 1))).scalar()


def node_items(raw: Project) -> DataFrame:
    """Items that are nodes; from the eleventh version on, cases are too."""
    rows = items(raw, "node", "case").withColumn("_major", major_version(raw))
    return rows.filter((F.col("TypeId") == ITEM_TYPE["node"]) | (F.col("_major") != "10")).drop("_major")


def one_edge(role: DataFrame, key: str, other: str, out: str) -> DataFrame:
    """At most one edge per key: the lowest other end."""
    return role.groupBy(key).agg(F.min(other).alias(out)).withColumnRenamed(key, f"_{out}_key")


def legacy_nodes(raw: Project, platform: str = WINDOWS) -> DataFrame:
    """Nodes with category and parent from the edges, decoded names."""
    category = one_edge(edges(raw, "item_category"), "Item1_Id", "Item2_Id", "Category")
    parent = one_edge(edges(raw, "parent"), "Item2_Id", "Item1_Id", "Parent")
    return (
        node_items(raw)
        .join(category, F.col("Id") == F.col("_Category_key"), "left")
        .join(parent, F.col("Id") == F.col("_Parent_key"), "left")
        .select(
            "Id", "Parent", "Category", decoded(F.col("Name"), platform).alias("Name"),
            decoded(F.col("Description"), platform).alias("Description"),
            F.col("ColorArgb").alias("Color"), "Aggregate", *AUDIT_COLUMNS,
        )
    )


def legacy_categories(raw: Project, kind: str, platform: str = WINDOWS) -> DataFrame:
    return items(raw, kind).select(
        "Id", decoded(F.col("Name"), platform).alias("Name"),
        decoded(F.col("Description"), platform).alias("Description"), *AUDIT_COLUMNS,
    )


def project_label(raw: Project, column: str, platform: str) -> Column:
    """One of the project's labels as item names spell it, as a scalar."""
    one = raw["Project"].agg(F.max(column).alias("label"))
    return one.select(shift_encode(F.col("label")) if platform == WINDOWS else F.col("label")).scalar()


def value_dimension(raw: Project, platform: str = WINDOWS) -> DataFrame:
    """Assigned value items with the attribute they belong to.

    The project's label for "no value" is left out before any entity is joined,
    which is where most of the edges of a sparse attribute lead.
    """
    label = project_label(raw, "UnassignedLabel", platform)
    values = items(raw, "attribute_value").withColumn("_label", label).filter(
        ~F.col("Name").eqNullSafe(F.col("_label"))
    )
    names = items(raw, "attribute_name").select(
        F.col("Id").alias("Attribute"), decoded(F.col("Name"), platform).alias("AttributeName"),
        F.col("Description").alias("AttributeDescription"), *[F.col(c).alias(f"Attr{c}") for c in AUDIT_COLUMNS],
    )
    properties = raw["ExtendedItem"].select(F.col("Item_Id").alias("_x"), X.property_map(F.col("Properties")).alias("_bag"))
    owned = edges(raw, "attribute_value").select(F.col("Item1_Id").alias("_a"), F.col("Item2_Id").alias("_v"))
    return (
        values.select(F.col("Id").alias("ValueId"), decoded(F.col("Name"), platform).alias("Value"), *AUDIT_COLUMNS)
        .join(owned, F.col("ValueId") == F.col("_v"))
        .join(names, F.col("_a") == F.col("Attribute"))
        .join(properties, F.col("Attribute") == F.col("_x"))
        .select(
            "ValueId", "Value", *AUDIT_COLUMNS, "Attribute", "AttributeName", "AttributeDescription",
            *[f"Attr{c}" for c in AUDIT_COLUMNS],
            data_type_name(F.try_element_at("_bag", F.lit("DataType")).try_cast("int")).alias("Type"),
            X.property_length(F.col("_bag")).alias("Length"),
        )
    )


def legacy_values(raw: Project, entities: DataFrame, entity: str, platform: str = WINDOWS) -> tuple[DataFrame, DataFrame]:
    """(attribute definitions, values) of some entities (``Id``)."""
    assigned = edges(raw, "item_value").select(F.col("Item1_Id").alias(entity), F.col("Item2_Id").alias("_value"))
    rows = (
        assigned.join(value_dimension(raw, platform), F.col("_value") == F.col("ValueId"))
        .join(entities.select(F.col("Id").alias("_e")), F.col(entity) == F.col("_e"), "left_semi")
    )
    definitions = distinct_attributes(
        rows.select(
            F.col("Attribute").alias("Id"), F.col("AttributeName").alias("Name"),
            F.col("AttributeDescription").alias("Description"), "Type", "Length",
            *[F.col(f"Attr{c}").alias(c) for c in AUDIT_COLUMNS],
        )
    )
    return definitions, rows.select(entity, "Attribute", "Value", *AUDIT_COLUMNS)


def legacy_sources(raw: Project, platform: str = WINDOWS) -> DataFrame:
    """Sources with category, object bytes (from blob storage if any) and clean text."""
    category = one_edge(edges(raw, "item_category"), "Item1_Id", "Item2_Id", "Category")
    item = raw["Item"].select(
        F.col("Id").alias("_i"), F.col("Name").alias("_name"), F.col("Description").alias("_description"),
        F.col("ColorArgb").alias("Color"), F.col("TypeId").alias("SourceType"), *AUDIT_COLUMNS,
    )
    blobs = raw["BlobStorage"].select(F.col("Content_Id").alias("_b"), F.col("Object").alias("_blob"))
    rows = (
        raw["Source"]
        .join(item, F.col("Item_Id") == F.col("_i"))
        .join(category, F.col("Item_Id") == F.col("_Category_key"), "left")
        .join(blobs, F.col("ContentLocation") == F.col("_b"), "left")
        .withColumn("_bytes", F.coalesce("_blob", "Object"))
    )
    kind = object_type_name(F.col("TypeId"))
    return rows.select(
        F.col("Item_Id").alias("Id"), "Category", decoded(F.col("_name"), platform).alias("Name"),
        decoded(F.col("_description"), platform).alias("Description"), "Color",
        crlf_to_lf(F.col("PlainText")).alias("Content"),
        F.when((kind == "DOC") & is_zip_document(F.col("_bytes")), "ODT").otherwise(kind).alias("ObjectType"),
        "SourceType", F.col("_bytes").alias("Object"), "Thumbnail", *AUDIT_COLUMNS,
    )


def span_fragment(start: Column, length: Column, y: Column, y_length: Column) -> Column:
    """Stored fragment of a zero-based start and length, second axis when present."""
    first = F.concat((start + 1).cast("string"), F.lit(":"), (start + length).cast("string"))
    second = F.concat(
        F.lit(","), (y + 1).cast("string"),
        F.when(y_length > 0, F.concat(F.lit(":"), (y + y_length).cast("string"))).otherwise(""),
    )
    return F.concat(F.coalesce(first, F.lit("")), F.coalesce(second, F.lit("")))


def _remapped(rows: DataFrame, raw: Project, platform: str) -> DataFrame:
    """StartX and LengthX as offsets into the cleaned text."""
    texts = raw["Source"].select(F.col("Item_Id").alias("Source"), "PlainText")
    if platform == MAC:
        missing = rows.filter(F.col("StartX").isNull() & F.col("StartText").isNotNull()).drop("StartX", "LengthX")
        present = rows.filter(F.col("StartX").isNotNull() | F.col("StartText").isNull())
        found = S.nonspace_to_char(missing, texts)
        return present.unionByName(found.select(*present.columns))
    spans = rows.withColumnsRenamed({"StartX": "start0", "LengthX": "length"})
    moved = S.crlf_to_lf_spans(spans, texts.withColumnRenamed("PlainText", "Text"))
    return moved.withColumnsRenamed({"start0": "StartX", "length": "LengthX"})


def legacy_taggings(raw: Project, platform: str = WINDOWS) -> DataFrame:
    """References to nodes as taggings; those on a third axis are left out."""
    nodes = items(raw, "node").select(F.col("Id").alias("_n"))
    rows = raw["NodeReference"].filter(F.col("StartZ").isNull()).join(
        nodes, F.col("Node_Item_Id") == F.col("_n"), "left_semi"
    ).select(
        "Id", F.col("Source_Item_Id").alias("Source"), F.col("Node_Item_Id").alias("Node"),
        F.lit(None).cast("string").alias("Memo"), "StartX", "LengthX", "StartY", "LengthY", "StartText", "LengthText",
        *AUDIT_COLUMNS,
    )
    return _finish(_remapped(rows, raw, platform))


def legacy_annotations(raw: Project, platform: str = WINDOWS) -> DataFrame:
    """Annotations as taggings without node; the text is the memo."""
    null = F.lit(None).cast("long")
    x = [null.alias("StartX"), null.alias("LengthX")] if platform == MAC else [F.col("StartX"), F.col("LengthX")]
    rows = raw["Annotation"].select(
        "Id", F.col("Item_Id").alias("Source"), F.lit(None).cast("string").alias("Node"), F.col("Text").alias("Memo"),
        *x, "StartY", "LengthY", "StartText", "LengthText", *AUDIT_COLUMNS,
    )
    return _finish(_remapped(rows, raw, platform))


def _finish(rows: DataFrame) -> DataFrame:
    fragment = span_fragment(F.col("StartX"), F.col("LengthX"), F.col("StartY"), F.col("LengthY"))
    return rows.select("Id", "Source", "Node", fragment.alias("Fragment"), "Memo", *AUDIT_COLUMNS)


def import_legacy(
    raw: Project, platform: str = WINDOWS, base: Project | None = None, actions: Actions | None = None
) -> Project:
    """All of a legacy project, merged into ``base`` table by table."""
    actions = actions or Actions()
    p = dict(base or empty_project(raw["Item"].sparkSession))

    def bring(table: str, rows: DataFrame, keys: list[str], kind: str) -> None:
        p[table] = merge_table(p[table], shape(rows, CANONICAL[table]), keys, actions[kind])

    if actions.wants("users"):
        bring("User", raw["UserProfile"].select("Id", "Name"), ["Id"], "users")
    if actions.wants("project"):
        row = raw["Project"].select(
            (shift_decode(F.col("Title")) if platform == WINDOWS else F.col("Title")).alias("Title"),
            decoded(F.col("Description"), platform).alias("Description"), *AUDIT_COLUMNS,
        )
        p["Project"] = put_project(p["Project"], row, "replace")
    if actions.wants("node_categories"):
        bring("NodeCategory", legacy_categories(raw, "node_classification", platform), ["Id"], "node_categories")
    if actions.wants("nodes"):
        bring("Node", legacy_nodes(raw, platform), ["Id"], "nodes")
    if actions.wants("node_attributes"):
        carriers = items(raw, "node", "case").withColumn("_major", major_version(raw)).filter(
            F.when(F.col("_major") == "10", F.col("TypeId") == ITEM_TYPE["node"]).otherwise(
                F.col("TypeId") == ITEM_TYPE["case"]
            )
        )
        definitions, values = legacy_values(raw, carriers, "Node", platform)
        bring("NodeAttribute", definitions, ["Id"], "node_attributes")
        bring("NodeValue", values, ["Node", "Attribute"], "node_attributes")
    if actions.wants("source_categories"):
        bring("SourceCategory", legacy_categories(raw, "source_classification", platform), ["Id"], "source_categories")
    if actions.wants("sources"):
        bring("Source", legacy_sources(raw, platform), ["Id"], "sources")
    if actions.wants("source_attributes"):
        carriers = raw["Source"].select(F.col("Item_Id").alias("Id"))
        definitions, values = legacy_values(raw, carriers, "Source", platform)
        bring("SourceAttribute", definitions, ["Id"], "source_attributes")
        bring("SourceValue", values, ["Source", "Attribute"], "source_attributes")
    # Taggings and annotations share a table: replacing one kind keeps the other.
    for kind, rows, is_annotation in (
        ("taggings", legacy_taggings, False), ("annotations", legacy_annotations, True)
    ):
        if actions.wants(kind):
            same = F.col("Node").isNull() if is_annotation else F.col("Node").isNotNull()
            merged = merge_table(
                p["Tagging"].filter(same), shape(rows(raw, platform), CANONICAL["Tagging"]), ["Id"], actions[kind]
            )
            p["Tagging"] = p["Tagging"].filter(~same).unionByName(merged)
    return p
