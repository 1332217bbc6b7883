"""Canonical projects into the graph tables of an existing legacy project.

The base project brings the system folders and labels; the result is the new
state of its tables.  Everything is set-based: a vertex or an edge exists once
per distinct key, ordinals come from windows, defaults from an anti join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codespan.functions import fragments as FR
from codespan.functions import xml as X
from codespan.functions.ids import deterministic_id
from codespan.functions.text import (
    initials, lf_to_crlf, paragraphs, sanitise_name, shift_encode, strip_final_newline, text_length,
    truncate_description,
)
from codespan.functions.values import data_type_code, legacy_value, object_type_code
from codespan.operators import attributes as A
from codespan.operators import spans as S
from codespan.operators.merge import merge_table, put_project, reassign_users
from codespan.operators.nested import read_parts
from codespan.operators.numbering import next_ordinals, number_rows
from codespan.operators.tree import aggregate_pairs, tree_walk
from codespan.plans.common import Actions, union_all
from codespan.plans.legacy_import import MAC, WINDOWS, edges, items, one_edge, project_label
from codespan.schemas import (
    AUDIT_COLUMNS, ITEM_TYPE, LEGACY, OBJECT_TYPES, PROPERTIES_NAMESPACE, ROLE_TYPE, SYSTEM_FOLDERS,
)
from codespan.session import cut, settle
from codespan.sources.project import require_format, shape

Project = dict[str, DataFrame]
LAYOUT_ROWS = 10_000
DESCRIPTION_LENGTH = 512
TEXT_OBJECTS = ["TXT", "DOC", "DOCX", "ODT", "RTF"]


def encoded(column: Column, platform: str) -> Column:
    """Descriptions: carriage returns and shifted characters on one platform."""
    if platform == WINDOWS:
        return shift_encode(F.replace(column, F.lit("\n"), F.lit("\r\n")))
    return column


def _name(column: Column, platform: str) -> Column:
    return shift_encode(column) if platform == WINDOWS else column


def system_folder(raw: Project, folder: str, platform: str = WINDOWS) -> Column:
    """Id of a system folder, as a scalar; using it fails when there is none."""
    label = F.lit(SYSTEM_FOLDERS[folder])
    found = items(raw, "folder").filter((F.col("Name") == _name(label, platform)) & F.col("System"))
    one = found.agg(F.min("Id").alias("Id"))
    return one.select(
        F.when(F.col("Id").isNotNull(), F.col("Id")).otherwise(
            F.raise_error(F.lit(f"the base project has no folder {SYSTEM_FOLDERS[folder]}"))
        )
    ).scalar()


def _role(rows: DataFrame, one: Column, two: Column, kind: str, tag: Column | None = None) -> DataFrame:
    return rows.select(
        one.alias("Item1_Id"), two.alias("Item2_Id"), F.lit(ROLE_TYPE[kind]).alias("TypeId"),
        (F.lit(None) if tag is None else tag).cast("int").alias("Tag"),
    )


def _item(rows: DataFrame, kind: Column | str, **columns: Column) -> DataFrame:
    kind = F.lit(ITEM_TYPE[kind]) if isinstance(kind, str) else kind
    given = {
        "TypeId": kind, "ColorArgb": F.lit(0), "System": F.lit(False), "ReadOnly": F.lit(False),
        "InheritPermissions": F.lit(True),
    } | columns
    return shape(rows.select(*[c.alias(k) for k, c in given.items()]), LEGACY["Item"])


def _audit() -> dict[str, Column]:
    return {c: F.col(c) for c in AUDIT_COLUMNS}


def _new_only(rows: DataFrame, raw: Project, key: str = "Id") -> DataFrame:
    have = raw["Item"].select(F.col("Id").alias("_have"))
    return rows.join(have, F.col(key) == F.col("_have"), "left_anti")


def _add(raw: Project, **frames: list[DataFrame]) -> Project:
    out = dict(raw)
    for table, new in frames.items():
        for df in new:
            out[table] = out[table].unionByName(shape(df, LEGACY[table]))
    return out


def add_edges(raw: Project, *new: DataFrame) -> Project:
    """Add edges, each (ends, kind) once."""
    fresh = union_all(list(new)).dropDuplicates(["Item1_Id", "Item2_Id", "TypeId"])
    keys = ["Item1_Id", "Item2_Id", "TypeId"]
    return _add(raw, Role=[fresh.join(raw["Role"].select(*keys), keys, "left_anti")])


# ------------------------------------------------------------------ users


def export_users(p: Project, raw: Project, mode: str) -> Project:
    users = p["User"].withColumn("Initials", initials(F.col("Name")))
    if mode == "replace":
        removed = raw["UserProfile"].join(users.select("Id"), "Id", "left_anti").select("Id")
        others = {k: v for k, v in raw.items() if k != "UserProfile"}
        raw = raw | reassign_users(others, removed, p["Project"])
    return raw | {"UserProfile": merge_table(raw["UserProfile"], users, ["Id"], mode)}


# ------------------------------------------------------------- categories


def export_categories(p: Project, raw: Project, entity: str, mode: str, platform: str = WINDOWS) -> Project:
    """Categories as items under their folder, with an empty layout for now."""
    folder = {"Source": "source_category", "Case": "case_category"}.get(entity, "node_category")
    head = system_folder(raw, folder, platform)
    rows = p[f"{'Node' if entity == 'Case' else entity}Category"].withColumn(
        "Id", F.coalesce("Id", deterministic_id(f"{entity}Category", F.col("Name")))
    )
    kind = "source_classification" if entity == "Source" else "node_classification"
    label = _name(F.lit(SYSTEM_FOLDERS[folder]), platform)
    columns = {
        "Id": F.col("Id"), "Name": _name(F.col("Name"), platform),
        "Description": encoded(F.coalesce("Description", F.lit("")), platform), **_audit(),
    }
    if platform == MAC:
        columns["HierarchicalName"] = F.concat(label, F.lit("\\\\"), "Name")
    if mode in ("overwrite", "replace"):
        update = rows.select(*[c.alias(k) for k, c in columns.items()])
        old = update.join(items(raw, kind).select(F.col("Id").alias("_o")), F.col("Id") == F.col("_o"), "left_semi")
        raw = raw | {"Item": merge_table(raw["Item"], old, ["Id"], "overwrite")}
    new = _new_only(rows, raw)
    grown = _add(
        raw,
        Item=[_item(new, kind, **columns)],
        ExtendedItem=[new.select(
            F.col("Id").alias("Item_Id"), X.property_bag(("EndNoteReferenceType", "-1")).alias("Properties"))],
        Category=[new.select(F.col("Id").alias("Item_Id"), F.lit(0).alias("Part"), F.lit("").alias("Layout"))],
    )
    return add_edges(grown, _role(new.withColumn("_h", head), F.col("_h"), F.col("Id"), "member"))


# ------------------------------------------------------------------ nodes


def node_edges(
    nodes: DataFrame, walk: DataFrame, pairs: DataFrame, head_node: Column, head_case: Column, major: str
) -> DataFrame:
    """The six kinds of edges of nodes: member, index, category, parent, aggregate."""
    rows = nodes.join(
        walk.select(F.col("Id").alias("_w"), "TopParent", "RoleTag"), F.col("Id") == F.col("_w")
    ).withColumn("_node", head_node).withColumn("_case", head_case)
    is_node = F.lit(major == "10") | F.col("Category").isNull()
    wanted = pairs.join(nodes.select(F.col("Id").alias("_i")), F.col("Id") == F.col("_i"), "left_semi")
    return union_all([
        _role(rows, F.when(is_node, F.col("_node")).otherwise(F.col("_case")), F.col("Id"), "member"),
        _role(rows, F.col("TopParent"), F.col("Id"), "node_index", F.col("RoleTag")),
        _role(rows.filter(F.col("Category").isNotNull()), F.col("Id"), F.col("Category"), "item_category"),
        _role(rows.filter(F.col("Parent").isNotNull()), F.col("Parent"), F.col("Id"), "parent"),
        _role(wanted, F.col("Ancestor"), F.col("Id"), "node_aggregate"),
    ])


def export_nodes(p: Project, raw: Project, platform: str = WINDOWS, major: str = "10") -> Project:
    """New nodes and cases with their edges; nodes already there stay as they are."""
    nodes = p["Node"].withColumn("Id", F.coalesce("Id", deterministic_id("Node", F.col("Name")))).withColumn(
        "Name", sanitise_name(F.col("Name"))
    )
    slim = nodes.select("Id", "Parent", "Name", "Aggregate", "Category")
    walk = tree_walk(slim, folder=SYSTEM_FOLDERS["node"])
    pairs = aggregate_pairs(slim)
    new = _new_only(nodes, raw).join(walk.select(F.col("Id").alias("_w"), "HierarchicalName"), F.col("Id") == F.col("_w"))
    is_node = F.lit(major == "10") | F.col("Category").isNull()
    columns = {
        "Id": F.col("Id"), "Name": _name(F.col("Name"), platform),
        "Description": truncate_description(encoded(F.coalesce("Description", F.lit("")), platform), DESCRIPTION_LENGTH),
        "ColorArgb": F.coalesce("Color", F.lit(0)), "Aggregate": F.coalesce("Aggregate", F.lit(False)), **_audit(),
    }
    if platform == MAC:
        columns["HierarchicalName"] = F.col("HierarchicalName")
    kind = F.when(is_node, ITEM_TYPE["node"]).otherwise(ITEM_TYPE["case"])
    head_node = system_folder(raw, "node", platform)
    head_case = system_folder(raw, "case", platform) if int(major) > 10 else F.lit(None).cast("string")
    grown = _add(raw, Item=[_item(new, kind, **columns)])
    return add_edges(grown, node_edges(new.select("Id", "Parent", "Category"), walk, pairs, head_node, head_case, major))


# ------------------------------------------------------- attributes, values


def value_status(raw: Project, wanted: DataFrame) -> DataFrame:
    """For (Item, Attribute, Value): the id of that value and of the current one.

    Adds ``NewValueId`` and ``ExistingValueId``, null where there is none.
    """
    owned = edges(raw, "attribute_value").select(F.col("Item1_Id").alias("_a"), F.col("Item2_Id").alias("_v"))
    names = items(raw, "attribute_value").select(F.col("Id").alias("_i"), F.col("Name").alias("_name"))
    by_name = owned.join(names, F.col("_v") == F.col("_i")).groupBy("_a", "_name").agg(F.min("_v").alias("NewValueId"))
    current = (
        edges(raw, "item_value").select(F.col("Item1_Id").alias("_item"), F.col("Item2_Id").alias("_cur"))
        .join(owned.select(F.col("_a").alias("_attr"), F.col("_v").alias("_val")), F.col("_cur") == F.col("_val"))
        .groupBy("_item", "_attr").agg(F.min("_cur").alias("ExistingValueId"))
    )
    return (
        wanted.join(by_name, (F.col("Attribute") == F.col("_a")) & (F.col("Value") == F.col("_name")), "left")
        .join(current, (F.col("Item") == F.col("_item")) & (F.col("Attribute") == F.col("_attr")), "left")
        .select(*wanted.columns, "NewValueId", "ExistingValueId")
    )


def system_values(new: DataFrame, unassigned: Column, not_applicable: Column, platform: str) -> DataFrame:
    """The values every new attribute starts with: Attribute, Id, Name, Tag, IsDefault."""
    false, true = ("0", "1") if platform == MAC else ("False", "True")
    entry = lambda n, name, d: F.struct(F.lit(n).alias("Tag"), name.alias("Name"), F.lit(d).alias("IsDefault"))
    common = [entry(0, unassigned, "True"), entry(1, not_applicable, "False")]
    truth = [entry(2, _name(F.lit(false), platform), "False"), entry(3, _name(F.lit(true), platform), "False")]
    kinds = F.when(F.lower("Type") == "boolean", F.array(*common, *truth)).otherwise(F.array(*common))
    return new.select(F.col("Id").alias("Attribute"), F.inline(kinds)).withColumn(
        "Id", deterministic_id("SystemValue", F.col("Attribute"), F.col("Tag"))
    )


def export_attributes(
    p: Project, raw: Project, entity: str, mode: str, platform: str = WINDOWS
) -> Project:
    """Attributes as children of categories, their values as shared vertices.

    An attribute used in several categories is copied, one id per category.
    Items without a category cannot carry values; :func:`uncategorised_values`
    lists theirs.
    """
    unassigned = project_label(raw, "UnassignedLabel", platform)
    not_applicable = project_label(raw, "NotApplicableLabel", platform)
    definitions = p[f"{entity}Attribute"].select(
        "Id", sanitise_name(F.col("Name")).alias("Name"), F.lower("Type").alias("Type"), *AUDIT_COLUMNS
    )
    category = one_edge(edges(raw, "item_category"), "Item1_Id", "Item2_Id", "Category")
    values = (
        p[f"{entity}Value"].select(F.col(entity).alias("Item"), "Attribute", F.col("Value").alias("_text"))
        .join(definitions.select(F.col("Id").alias("_d"), "Type"), F.col("Attribute") == F.col("_d"))
        .join(category, F.col("Item") == F.col("_Category_key"))
        .withColumn("_unassigned", unassigned)
        .withColumn("Blank", F.coalesce(F.trim("_text"), F.lit("")) == "")
        .withColumn("Plain", legacy_value(F.col("_text"), F.col("Type"), platform, F.lit("")))
        .withColumn("Value", F.when(F.col("Blank"), F.col("_unassigned")).otherwise(_name(F.col("Plain"), platform)))
        .select("Item", "Category", "Attribute", "Type", "Value")
    )

    # Which (attribute, category) pairs exist, which are new, and under which id.
    uses = values.select("Attribute", "Category").distinct()
    copy_id = deterministic_id("AttributeCopy", F.col("Attribute"), F.col("Category"))
    links = edges(raw, "attribute_classification").select(F.col("Item1_Id").alias("_l"), F.col("Item2_Id").alias("_lc"))
    candidates = uses.withColumn("_id", F.explode(F.array(F.col("Attribute"), copy_id)))
    linked = candidates.join(
        links, (F.col("_id") == F.col("_l")) & (F.col("Category") == F.col("_lc"))
    ).groupBy("Attribute", "Category").agg(F.min("_l").alias("NewId"))
    open_uses = uses.join(linked, ["Attribute", "Category"], "left_anti")
    taken = raw["Item"].select(F.col("Id").alias("_t"))
    split = A.split_by_category(open_uses, lambda a, c: deterministic_id("AttributeCopy", a, c)).join(
        taken, F.col("Attribute") == F.col("_t"), "left"
    ).select(
        "Attribute", "Category", F.when(F.col("_t").isNull(), F.col("NewId")).otherwise(copy_id).alias("NewId")
    )
    split = cut(split)
    ids = linked.select("Attribute", "Category", "NewId").unionByName(split)

    fresh = split.join(definitions.withColumnRenamed("Id", "_d"), F.col("Attribute") == F.col("_d")).select(
        F.col("NewId").alias("Id"), "Category", "Name", "Type", *AUDIT_COLUMNS
    )
    tagged = next_ordinals(
        fresh, edges(raw, "attribute_classification").select(F.col("Item2_Id").alias("Category"), "Tag"),
        ["Category"], ["Id"], "Tag",
    )
    starters = system_values(
        fresh.withColumn("_u", unassigned).withColumn("_na", not_applicable), F.col("_u"), F.col("_na"), platform
    )
    is_default = lambda v: X.property_bag(("IsDefault", v))
    grown = _add(
        raw,
        Item=[
            _item(fresh, "attribute_name", Id=F.col("Id"), Name=_name(F.col("Name"), platform),
                  Description=F.lit(""), **_audit()),
            _item(starters, "attribute_value", Id=F.col("Id"), Name=F.col("Name"), Description=F.lit(""),
                  System=F.lit(True)),
        ],
        ExtendedItem=[
            fresh.select(F.col("Id").alias("Item_Id"), X.property_bag(
                ("DataType", data_type_code(F.col("Type"))), ("Length", "0"), ("EndNoteFieldTypeId", "-1")
            ).alias("Properties")),
            starters.select(F.col("Id").alias("Item_Id"), is_default(F.col("IsDefault")).alias("Properties")),
        ],
    )
    grown = settle(add_edges(
        grown,
        _role(tagged, F.col("Id"), F.col("Category"), "attribute_classification", F.col("Tag")),
        _role(starters, F.col("Attribute"), F.col("Id"), "attribute_value", F.col("Tag")),
    ), raw)

    assigned = values.join(ids, ["Attribute", "Category"]).select(
        "Item", "Category", F.col("NewId").alias("Attribute"), "Value"
    )
    grown = settle(assign_values(grown, assigned, mode), grown)
    members = edges(grown, "item_category").select(F.col("Item2_Id").alias("Category"), F.col("Item1_Id").alias("Item"))
    defaults = fresh.join(
        starters.filter(F.col("Tag") == 0).select(F.col("Attribute").alias("_s"), F.col("Id").alias("Default")),
        F.col("Id") == F.col("_s"),
    ).select("Category", F.col("Id").alias("Attribute"), "Default")
    filled = A.default_fill(members, defaults, assigned.select("Item", "Attribute"))
    return add_edges(grown, _role(filled, F.col("Item"), F.col("Default"), "item_value"))


def assign_values(raw: Project, assigned: DataFrame, mode: str) -> Project:
    """Give items their values: Item, Category, Attribute, Value (name).

    A value already assigned stays unless ``mode`` overwrites.  A value no
    vertex exists for gets one, numbered after the attribute's highest.
    """
    status = cut(value_status(raw, assigned))
    if mode not in ("overwrite", "replace"):
        status = status.filter(F.col("ExistingValueId").isNull())
    vertex = deterministic_id("AttributeValue", F.col("Attribute"), F.col("Value"))
    missing = status.filter(F.col("NewValueId").isNull()).select("Attribute", "Value").distinct().withColumn("Id", vertex)
    numbered = next_ordinals(
        missing, edges(raw, "attribute_value").select(F.col("Item1_Id").alias("Attribute"), "Tag"),
        ["Attribute"], ["Id"], "Tag",
    )
    grown = _add(
        raw,
        Item=[_item(missing, "attribute_value", Id=F.col("Id"), Name=F.col("Value"), Description=F.lit(""))],
        ExtendedItem=[missing.select(
            F.col("Id").alias("Item_Id"), X.property_bag(("IsDefault", "False")).alias("Properties"))],
    )
    changed = status.withColumn("_new", F.coalesce("NewValueId", vertex)).filter(
        ~F.col("ExistingValueId").eqNullSafe(F.col("_new"))
    )
    dropped = changed.filter(F.col("ExistingValueId").isNotNull()).select(
        F.col("Item").alias("Item1_Id"), F.col("ExistingValueId").alias("Item2_Id"),
        F.lit(ROLE_TYPE["item_value"]).alias("TypeId"),
    )
    kept = grown["Role"].join(dropped, ["Item1_Id", "Item2_Id", "TypeId"], "left_anti").select(*grown["Role"].columns)
    return add_edges(
        grown | {"Role": kept},
        _role(numbered, F.col("Attribute"), F.col("Id"), "attribute_value", F.col("Tag")),
        _role(changed, F.col("Item"), F.col("_new"), "item_value"),
    )


def uncategorised_values(p: Project, raw: Project, entity: str) -> DataFrame:
    """Values whose item has no category and so cannot be stored."""
    has = edges(raw, "item_category").select(F.col("Item1_Id").alias("_i")).distinct()
    return p[f"{entity}Value"].join(has, F.col(entity) == F.col("_i"), "left_anti").select(entity, "Attribute", "Value")


# ---------------------------------------------------------------- layouts


def layout_indexes(raw: Project, kind: str, member: str = "member") -> DataFrame:
    """Category, Tag (Row or Column), Item, Index (from 0) of a layout.

    ``member`` names the edge kind whose first end makes the rows.
    """
    categories = items(raw, kind).select(F.col("Id").alias("_c"))
    ends = lambda role: edges(raw, role).select(F.col("Item2_Id").alias("Category"), F.col("Item1_Id").alias("Item"))
    both = ends(member).withColumn("Tag", F.lit("Row")).unionByName(
        ends("attribute_classification").withColumn("Tag", F.lit("Column"))
    ).join(categories, F.col("Category") == F.col("_c"), "left_semi")
    return number_rows(both, ["Item"], "Index", group=["Category", "Tag"], start=0)


def category_layouts(raw: Project, kind: str, member: str = "member", rows_per_part: int = LAYOUT_ROWS) -> DataFrame:
    """Item_Id, Part, Layout: the layout documents, long ones in several parts.

    Parts of a document follow one another in order; the first opens it and the
    last closes it, so joining them gives the whole text.
    """
    indexes = layout_indexes(raw, kind, member)
    sizes = indexes.groupBy("Category", "Tag").agg(F.count(F.lit(1)).alias("_n"))
    wide = sizes.groupBy("Category").agg(
        F.coalesce(F.max(F.when(F.col("Tag") == "Row", F.col("_n"))), F.lit(0)).alias("_rows"),
        F.sum("_n").alias("_all"),
    ).withColumnRenamed("Category", "_cat")
    placed = indexes.join(wide, F.col("Category") == F.col("_cat")).withColumn(
        "_at", F.col("Index") + F.when(F.col("Tag") == "Column", F.col("_rows")).otherwise(0)
    )
    parts = placed.withColumn("Part", F.floor(F.col("_at") / rows_per_part).cast("int")).groupBy("Category", "Part").agg(
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.struct("_at", "Tag", "Item", "Index"))),
                lambda x: X.layout_element(x["Tag"], x["Item"], x["Index"]),
            ),
            "",
        ).alias("_body"),
        F.max("_all").alias("_all"),
    )
    last = F.floor((F.greatest(F.coalesce("_all", F.lit(0)), F.lit(1)) - 1) / rows_per_part)
    whole = items(raw, kind).select("Id").join(parts, F.col("Id") == F.col("Category"), "left").withColumn(
        "Part", F.coalesce("Part", F.lit(0))
    )
    return whole.select(
        F.col("Id").alias("Item_Id"), "Part",
        F.concat(
            F.when(F.col("Part") == 0, X.LAYOUT_HEAD).otherwise(""), F.coalesce("_body", F.lit("")),
            F.when(F.col("Part") == last, X.LAYOUT_TAIL).otherwise(""),
        ).alias("Layout"),
    )


def read_layouts(raw: Project) -> DataFrame:
    """Category, Place, Tag, Item, Index: the elements of all layout documents, whatever parts they lie in."""
    parts = raw["Category"].select(F.col("Item_Id").alias("Category"), "Part", X.layout_elements(F.col("Layout")).alias("_e"))
    return read_parts(parts, ["Category"], "_e")


def export_layouts(raw: Project, kind: str, member: str = "member") -> Project:
    layouts = category_layouts(raw, kind, member)
    kept = raw["Category"].join(layouts.select("Item_Id").distinct(), "Item_Id", "left_anti")
    return raw | {"Category": kept.unionByName(shape(layouts, LEGACY["Category"])).select(*raw["Category"].columns)}


# ---------------------------------------------------------------- sources


def paragraph_xml(text: Column, style: str) -> Column:
    """The paragraph index of a text as XML."""
    paras = F.transform(
        paragraphs(text),
        lambda x: F.concat(
            F.lit('<Para Pos="'), x["pos"].cast("string"), F.lit('" Len="'), x["len"].cast("string"),
            F.lit(f'" Style="{style}"/>'),
        ),
    )
    return F.concat(
        F.lit(f'<Paragraphs xmlns="{PROPERTIES_NAMESPACE}">'), F.array_join(paras, ""), F.lit("</Paragraphs>")
    )


def plain_text(content: Column, platform: str) -> Column:
    """Stored text: no final newline, two-character line ends on one platform."""
    text = strip_final_newline(content)
    return lf_to_crlf(text) if platform == WINDOWS else text


def source_rows(p: Project, platform: str = WINDOWS) -> DataFrame:
    """Source table rows of the canonical sources (text ones get their metadata)."""
    kind = F.upper("ObjectType")
    is_text = kind.isin(TEXT_OBJECTS)
    plain = F.when(is_text, plain_text(F.col("Content"), platform)).otherwise(F.col("Content"))
    settings = F.lit(f'<DisplaySettings xmlns="{PROPERTIES_NAMESPACE}" InputPosition="0"/>')
    code = F.when(is_text, F.lit(0)).otherwise(object_type_code(F.col("ObjectType")))
    return p["Source"].select(
        F.col("Id").alias("Item_Id"), code.alias("TypeId"), "Object", plain.alias("PlainText"), "Thumbnail",
        F.when(is_text, text_length(plain, platform)).otherwise(F.lit(0)).alias("LengthX"),
        F.when(is_text, F.concat(paragraph_xml(plain, "Text Body"), settings)).otherwise(F.lit("")).alias("MetaData"),
    )


def export_sources(p: Project, raw: Project, mode: str, platform: str = WINDOWS) -> Project:
    head = system_folder(raw, "source", platform)
    label = F.lit(SYSTEM_FOLDERS["source"])
    sources = p["Source"].withColumn("_name", sanitise_name(F.col("Name")))
    columns = {
        "Id": F.col("Id"), "Name": _name(F.col("_name"), platform),
        "Description": encoded(F.coalesce("Description", F.lit("")), platform),
        "ColorArgb": F.coalesce("Color", F.lit(0)), **_audit(),
    }
    if platform == MAC:
        columns["HierarchicalName"] = F.concat(label, F.lit("\\\\"), "_name")
    rows = source_rows(p, platform)
    held = raw["Source"].select(F.col("Item_Id").alias("_h"))
    new = sources.join(held, F.col("Id") == F.col("_h"), "left_anti")
    kind = F.coalesce("SourceType", F.lit(2))
    out = raw
    if mode in ("overwrite", "replace"):
        old = sources.join(held, F.col("Id") == F.col("_h"), "left_semi")
        item = old.select(kind.alias("TypeId"), *[c.alias(k) for k, c in columns.items()])
        out = out | {
            "Item": merge_table(out["Item"], item, ["Id"], "overwrite"),
            "Source": merge_table(
                out["Source"], rows.join(held, F.col("Item_Id") == F.col("_h"), "left_semi"), ["Item_Id"], "overwrite"
            ),
        }
    fresh = rows.join(held, F.col("Item_Id") == F.col("_h"), "left_anti")
    is_text = F.upper("ObjectType").isin(TEXT_OBJECTS)
    bag = F.when(is_text, X.property_bag(("MimeType", ""))).when(
        F.upper("ObjectType") == "PDF", X.property_bag(("PDFChecksum", "0"), ("PDFPassword", ""))
    )
    bags = new.select(F.col("Id").alias("Item_Id"), bag.alias("Properties")).filter(F.col("Properties").isNotNull())
    out = _add(out, Item=[_item(new, kind, **columns)], Source=[fresh], ExtendedItem=[bags])
    return add_edges(
        out,
        _role(new.withColumn("_head", head), F.col("_head"), F.col("Id"), "member"),
        _role(new.filter(F.col("Category").isNotNull()), F.col("Id"), F.col("Category"), "item_category"),
    )


# ----------------------------------------------------- taggings, annotations


def reference_rows(p: Project, platform: str = WINDOWS) -> DataFrame:
    """Taggings with the legacy offsets, for both references and annotations.

    Malformed fragments drop out; spans are forced inside their text.
    """
    span = FR.parse_fragment(F.col("Fragment"))
    texts = p["Source"].select(F.col("Id").alias("Source"), strip_final_newline(F.col("Content")).alias("Text"))
    about = p["Source"].select(
        F.col("Id").alias("_s"), F.upper("ObjectType").alias("_type"),
        F.length(strip_final_newline(F.col("Content"))).cast("long").alias("_size"),
    )
    clamped = FR.clamp_span(F.col("_span.start0"), F.col("_span.end0") - F.col("_span.start0"), F.col("_size"))
    rows = (
        p["Tagging"].filter(FR.is_fragment(F.col("Fragment")))
        .join(about, F.col("Source") == F.col("_s"))
        .withColumn("_span", span)
        .withColumn("_x", clamped)
        .withColumns({"start0": F.col("_x.start0"), "length": F.col("_x.length")})
    )
    if platform == WINDOWS:
        rows = S.lf_to_crlf_spans(rows, texts)
        null = F.lit(None).cast("long")
        x = [F.col("start0").alias("StartX"), F.col("length").alias("LengthX")]
        text_columns = [null.alias("StartText"), null.alias("LengthText")]
    else:
        rows = S.char_to_nonspace_spans(rows, texts)
        x = [F.col("_x.start0").alias("StartX"), F.col("_x.length").alias("LengthX")]
        text_columns = [F.col("start0").alias("StartText"), F.col("length").alias("LengthText")]
    y1, y2 = F.col("_span.y1"), F.col("_span.y2")
    picture = F.col("_type") == OBJECT_TYPES[8]
    return rows.select(
        "Id", "Source", "Node", "Memo", *x, (y1 - 1).alias("StartY"),
        F.when(y1.isNotNull(), F.coalesce(y2 - y1 + 1, F.lit(0))).alias("LengthY"), *text_columns,
        F.when(picture, 2).otherwise(0).alias("ReferenceTypeId"), F.when(picture, 0).alias("ClusterId"),
        *AUDIT_COLUMNS,
    )


def export_taggings(p: Project, raw: Project, actions: Actions, platform: str = WINDOWS) -> Project:
    rows = reference_rows(p, platform)
    out = dict(raw)
    if actions.wants("taggings"):
        references = rows.filter(F.col("Node").isNotNull()).withColumnRenamed("Node", "Node_Item_Id").withColumnRenamed(
            "Source", "Source_Item_Id"
        ).drop("Memo")
        out["NodeReference"] = merge_table(out["NodeReference"], references, ["Id"], actions["taggings"])
    if actions.wants("annotations"):
        notes = rows.filter(F.col("Node").isNull()).select(
            "Id", F.col("Source").alias("Item_Id"), F.coalesce("Memo", F.lit("")).alias("Text"),
            "StartX", "LengthX", "StartY", "LengthY", "StartText", "LengthText", *AUDIT_COLUMNS,
        )
        out["Annotation"] = merge_table(out["Annotation"], notes, ["Id"], actions["annotations"])
    return out


def export_legacy(
    p: Project, base: Project, platform: str = WINDOWS, major: str = "10", actions: Actions | None = None
) -> Project:
    """The base project's tables with the canonical project worked in."""
    actions = actions or Actions()
    p = require_format(p)
    raw = dict(base)

    def step(change) -> None:
        nonlocal raw
        raw = settle(change(raw), raw)

    if actions.wants("users"):
        step(lambda r: export_users(p, r, actions["users"]))
    if actions["project"] in ("overwrite", "replace"):
        row = p["Project"].select(
            _name(F.col("Title"), platform).alias("Title"),
            encoded(F.coalesce("Description", F.lit("")), platform).alias("Description"), *AUDIT_COLUMNS,
        )
        step(lambda r: r | {"Project": put_project(r["Project"], row, "overwrite")})
    if actions.wants("node_categories"):
        kind = "Node" if major == "10" else "Case"
        step(lambda r: export_categories(p, r, kind, actions["node_categories"], platform))
    if actions.wants("nodes"):
        step(lambda r: export_nodes(p, r, platform, major))
    if actions.wants("node_attributes"):
        step(lambda r: export_attributes(p, r, "Node", actions["node_attributes"], platform))
    if any(actions.wants(k) for k in ("node_categories", "nodes", "node_attributes")):
        step(lambda r: export_layouts(r, "node_classification"))
    if actions.wants("source_categories"):
        step(lambda r: export_categories(p, r, "Source", actions["source_categories"], platform))
    if actions.wants("sources"):
        step(lambda r: export_sources(p, r, actions["sources"], platform))
    if actions.wants("source_attributes"):
        step(lambda r: export_attributes(p, r, "Source", actions["source_attributes"], platform))
    if any(actions.wants(k) for k in ("source_categories", "sources", "source_attributes")):
        step(lambda r: export_layouts(r, "source_classification"))
    return export_taggings(p, raw, actions, platform)
