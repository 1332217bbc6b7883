"""Conversions between the canonical tables and the other layouts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from catalog.base import VIEWS, Data, query
from catalog.texts import _ON_CRLF, _count_crlf
from codespan.functions import text as T
from codespan.functions import xml as X
from codespan.functions.values import data_type_code
from codespan.operators import match, nested
from codespan.plans import flatcode, legacy_export, legacy_import
from codespan.plans.common import Actions, union_all
from codespan.plans.imagecoding import import_imagecoding
from codespan.schemas import FLATCODE, IMAGECODING, ITEM_TYPE, LEGACY, ROLE_TYPE, SYSTEM_FOLDERS
from codespan.sources.project import conform, empty_project

NOW = datetime(2024, 6, 1, 12, 0, 0)

# ------------------------------------------------------------ legacy graph


def legacy_raw(d: Data, platform: str = "windows") -> dict:
    """The views as a legacy project of the tenth version."""
    enc = T.shift_encode if platform == "windows" else (lambda c: c)
    stamp = {
        "CreatedBy": F.lit("u1"), "CreatedDate": F.lit(datetime(2020, 1, 1)),
        "ModifiedBy": F.lit("u1"), "ModifiedDate": F.lit(datetime(2020, 1, 2)),
    }

    def item(df, kind, name="Name", description=F.lit(""), **more):
        given = {
            "Id": F.col("Id"), "TypeId": F.lit(kind), "Name": enc(F.col(name)), "Description": enc(description),
        } | stamp | more
        return df.select(*[c.alias(k) for k, c in given.items()])

    values = d["v_nodevalue"].select(F.col("Node").alias("Item"), "Attribute", "Value").unionByName(
        d["v_srcvalue"].select(F.col("Source").alias("Item"), "Attribute", "Value")
    )
    vertices = values.select("Attribute", F.col("Value").alias("Name")).distinct().withColumn(
        "Id", F.concat_ws("/", "Attribute", "Name")
    )
    attributes = d["v_nodeattr"].unionByName(d["v_srcattr"])
    text = F.when(F.length("Description") > 0, F.col("Description")).otherwise("")
    own = {c: F.col(c) for c in stamp}
    role = lambda df, one, two, kind: df.select(
        F.col(one).alias("Item1_Id"), F.col(two).alias("Item2_Id"), F.lit(ROLE_TYPE[kind]).alias("TypeId"))
    raw = {
        "UserProfile": d["v_user"],
        "Project": d["v_project"].select(
            F.lit("10.1.2").alias("Version"), enc(F.col("Title")).alias("Title"),
            enc(F.col("Description")).alias("Description"), F.lit("Unassigned").alias("UnassignedLabel"),
            F.lit("Not Applicable").alias("NotApplicableLabel"),
            "CreatedBy", "CreatedDate", "ModifiedBy", "ModifiedDate"),
        "Item": union_all([
            item(d["v_node"], ITEM_TYPE["node"], description=text, ColorArgb=F.col("Color"), Aggregate=F.col("Aggregate"), **own),
            item(d["v_nodecat"], ITEM_TYPE["node_classification"], description=text, **own),
            item(d["v_srccat"], ITEM_TYPE["source_classification"], description=text),
            item(d["v_source"], 2, description=text, ColorArgb=F.col("Color"), **own),
            item(attributes, ITEM_TYPE["attribute_name"]),
            item(vertices, ITEM_TYPE["attribute_value"]),
        ]),
        "Role": union_all([
            role(d["v_node"].filter("Category IS NOT NULL"), "Id", "Category", "item_category"),
            role(d["v_source"], "Id", "Category", "item_category"),
            role(d["v_node"].filter("Parent IS NOT NULL"), "Parent", "Id", "parent"),
            role(vertices, "Attribute", "Id", "attribute_value"),
            role(values.withColumn("v", F.concat_ws("/", "Attribute", "Value")), "Item", "v", "item_value"),
        ]),
        "ExtendedItem": attributes.select(
            F.col("Id").alias("Item_Id"),
            X.property_bag(("DataType", data_type_code(F.col("Type"))), ("Length", F.col("Length"))).alias("Properties")),
        "Source": d["v_crlf"].select(F.col("Id").alias("Item_Id"), F.lit(0).alias("TypeId"), "PlainText",
                                     F.encode(F.substring("PlainText", 1, 4), "UTF-8").alias("Object")),
        "NodeReference": d["v_span"].select(
            "Id", F.col("Node").alias("Node_Item_Id"), F.col("Source").alias("Source_Item_Id"),
            (F.col("First_") - 1).alias("StartX"), (F.col("Last_") - F.col("First_") + 1).alias("LengthX"),
            F.when(F.col("First_") % 7 == 0, F.col("First_")).alias("StartY"), F.lit(3).alias("LengthY"),
            F.when(F.col("First_") % 13 == 0, 1).alias("StartZ"),
            "CreatedBy", "CreatedDate", "ModifiedBy", "ModifiedDate"),
        "Annotation": d["v_span"].filter(F.col("First_") % 10 == 0).select(
            F.concat(F.lit("a"), "Id").alias("Id"), F.col("Source").alias("Item_Id"), F.concat(F.lit("memo "), "Id").alias("Text"),
            (F.col("First_") - 1).alias("StartX"), (F.col("Last_") - F.col("First_") + 1).alias("LengthX"),
            "CreatedBy", "CreatedDate", "ModifiedBy", "ModifiedDate"),
    }
    return conform(raw, LEGACY)


@query(
    "legacy_nodes",
    """SELECT Id, Parent, Category, Name, coalesce(Description, '') AS Description, Color, Aggregate, CreatedBy, CreatedDate FROM {v_node}""",
)
def legacy_nodes(d):
    return legacy_import.legacy_nodes(legacy_raw(d)).drop("ModifiedBy", "ModifiedDate")


@query("legacy_categories", "SELECT Id, Name, Description FROM {v_srccat}")
def legacy_categories(d):
    return legacy_import.legacy_categories(legacy_raw(d), "source_classification").select("Id", "Name", "Description")


@query(
    "legacy_node_values",
    """SELECT v.Node, v.Attribute, v.Value FROM {v_nodevalue} v WHERE v.Value <> 'Unassigned'""",
)
def legacy_node_values(d):
    raw = legacy_raw(d)
    _, values = legacy_import.legacy_values(raw, legacy_import.node_items(raw).select("Id"), "Node")
    return values.select("Node", "Attribute", "Value")


@query(
    "legacy_attributes",
    """SELECT a.Id, a.Name, a.Type, CASE WHEN a.Length > 0 THEN a.Length END AS Length
       FROM {v_srcattr} a WHERE a.Id IN (SELECT Attribute FROM {v_srcvalue})""",
)
def legacy_attributes(d):
    raw = legacy_raw(d)
    definitions, _ = legacy_import.legacy_values(raw, raw["Source"].select(F.col("Item_Id").alias("Id")), "Source")
    return definitions.select("Id", "Name", "Type", "Length")


@query(
    "legacy_sources",
    """SELECT Id, Category, Name, Color, md5(Content) AS digest, 'DOC' AS ObjectType, 2 AS SourceType FROM {v_source}""",
)
def legacy_sources(d):
    rows = legacy_import.legacy_sources(legacy_raw(d))
    return rows.select("Id", "Category", "Name", "Color", F.md5("Content").alias("digest"), "ObjectType", "SourceType")


_LEGACY_SPANS = f"""
SELECT Id, start0 - {_count_crlf("substring(txt, 1, start0)")} AS s,
       len - {_count_crlf("substring(txt, start0 + 1, len)")} AS n FROM ({_ON_CRLF}) x"""


@query(
    "legacy_taggings",
    f"""SELECT t.Id, t.Source, t.Node, concat(CAST(s + 1 AS STRING), ':', CAST(s + n AS STRING),
          CASE WHEN First_ % 7 = 0 THEN concat(',', CAST(First_ + 1 AS STRING), ':', CAST(First_ + 3 AS STRING)) ELSE '' END) AS Fragment
        FROM {{v_span}} t JOIN ({_LEGACY_SPANS}) m ON m.Id = t.Id WHERE First_ % 13 <> 0""",
)
def legacy_taggings(d):
    return legacy_import.legacy_taggings(legacy_raw(d)).select("Id", "Source", "Node", "Fragment")


@query(
    "legacy_annotations",
    f"""SELECT concat('a', t.Id) AS Id, t.Source, concat('memo ', t.Id) AS Memo,
          concat(CAST(s + 1 AS STRING), ':', CAST(s + n AS STRING)) AS Fragment
        FROM {{v_span}} t JOIN ({_LEGACY_SPANS}) m ON m.Id = t.Id WHERE First_ % 10 = 0""",
)
def legacy_annotations(d):
    return legacy_import.legacy_annotations(legacy_raw(d)).select("Id", "Source", "Memo", "Fragment")


@query(
    "import_legacy",
    """SELECT 'User' AS Tab, count(*) AS n FROM {v_user} UNION ALL SELECT 'Node', count(*) FROM {v_node}
       UNION ALL SELECT 'NodeCategory', count(*) FROM {v_nodecat} UNION ALL SELECT 'Source', count(*) FROM {v_source}
       UNION ALL SELECT 'SourceValue', count(*) FROM {v_srcvalue} v JOIN {v_source} s ON s.Id = v.Source
       UNION ALL SELECT 'Tagging', sum(CASE WHEN First_ % 13 <> 0 THEN 1 ELSE 0 END) + sum(CASE WHEN First_ % 10 = 0 THEN 1 ELSE 0 END) FROM {v_span}""".replace(
        "sum(CASE WHEN First_ % 13 <> 0 THEN 1 ELSE 0 END) + sum(CASE WHEN First_ % 10 = 0 THEN 1 ELSE 0 END)",
        "CAST(sum(CASE WHEN First_ % 13 <> 0 THEN 1 ELSE 0 END) + sum(CASE WHEN First_ % 10 = 0 THEN 1 ELSE 0 END) AS BIGINT)",
    ),
)
def import_legacy(d):
    p = legacy_import.import_legacy(legacy_raw(d))
    tables = ["User", "Node", "NodeCategory", "Source", "SourceValue", "Tagging"]
    return union_all([p[t].select(F.lit(t).alias("Tab")).groupBy("Tab").agg(F.count(F.lit(1)).alias("n")) for t in tables])


def legacy_base(d: Data, platform: str = "windows") -> dict:
    """A base project: the system folders and the labels."""
    spark = d.spark
    enc = T.shift_encode if platform == "windows" else (lambda c: c)
    folders = spark.createDataFrame([(f"f_{k}", v) for k, v in SYSTEM_FOLDERS.items()], "Id string, N string")
    raw = empty_project(spark, LEGACY)
    return conform(raw | {
        "Item": folders.select("Id", F.lit(0).alias("TypeId"), enc(F.col("N")).alias("Name"), F.lit(True).alias("System")),
        "Project": spark.createDataFrame([("10.1.2", "Unassigned", "Not Applicable")],
                                         "Version string, UnassignedLabel string, NotApplicableLabel string"),
    }, LEGACY)


@query(
    "legacy_edges",
    """WITH RECURSIVE walk AS (
         SELECT Id, Parent, 0 AS Depth, Id AS Top FROM {v_node} WHERE Parent IS NULL
         UNION ALL SELECT n.Id, n.Parent, Depth + 1, Top FROM {v_node} n JOIN walk w ON w.Id = n.Parent),
       pairs AS (SELECT Id, Id AS Ancestor, Parent AS up FROM {v_node}
         UNION ALL SELECT p.Id, a.Id, a.Parent FROM pairs p JOIN {v_node} a ON a.Id = p.up WHERE a.Aggregate)
       SELECT 'f_node' AS Item1_Id, Id AS Item2_Id, 0 AS TypeId, NULL AS Tag FROM {v_node}
       UNION ALL SELECT Top, Id, 2, Depth * 65536 + row_number() OVER (PARTITION BY Parent ORDER BY substring(md5(Id), 1, 3), Id) - 1 FROM walk
       UNION ALL SELECT Id, Category, 14, NULL FROM {v_node} WHERE Category IS NOT NULL
       UNION ALL SELECT Parent, Id, 1, NULL FROM {v_node} WHERE Parent IS NOT NULL
       UNION ALL SELECT Ancestor, Id, 15, NULL FROM pairs""",
)
def legacy_edges(d):
    out = legacy_export.export_nodes(d.project("Node"), legacy_base(d))
    return out["Role"].withColumn("Tag", F.col("Tag").cast("long"))


@query(
    "legacy_node_items",
    """SELECT Id, 16 AS TypeId, Name, coalesce(Description, '') AS Description, Color AS ColorArgb, Aggregate FROM {v_node}""",
)
def legacy_node_items(d):
    out = legacy_export.export_nodes(d.project("Node"), legacy_base(d, "mac"), "mac")
    return out["Item"].filter(F.col("TypeId") == 16).select("Id", "TypeId", "Name", "Description", "ColorArgb", "Aggregate")


@query(
    "legacy_category_items",
    """SELECT Id, 51 AS TypeId, Name, concat('Source Classifications', chr(92), chr(92), Name) AS HierarchicalName, 'f_source_category' AS Folder FROM {v_srccat}""",
)
def legacy_category_items(d):
    out = legacy_export.export_categories(d.project("SourceCategory"), legacy_base(d, "mac"), "Source", "merge", "mac")
    role = out["Role"].select(F.col("Item1_Id").alias("Folder"), "Item2_Id")
    return out["Item"].join(role, F.col("Id") == F.col("Item2_Id")).select("Id", "TypeId", "Name", "HierarchicalName", "Folder")


_VALUE_ROUNDTRIP = """
SELECT v.Node, a.Name AS Attribute, CASE a.Type
    WHEN 'boolean' THEN CASE WHEN Value = 'yes' THEN 'True' ELSE 'False' END
    WHEN 'date' THEN concat(Value, ' 00:00:00Z') ELSE Value END AS Value
FROM {v_nodevalue} v JOIN {v_nodeattr} a ON a.Id = v.Attribute JOIN {v_node} n ON n.Id = v.Node"""


@query("legacy_values_roundtrip", _VALUE_ROUNDTRIP)
def legacy_values_roundtrip(d):
    """Values out to shared vertices and back."""
    p = d.project("Node", "NodeCategory", "NodeAttribute", "NodeValue")
    raw = legacy_export.export_categories(p, legacy_base(d), "Node", "merge")
    raw = legacy_export.export_nodes(p, raw)
    raw = legacy_export.settle(raw, {})
    raw = legacy_export.export_attributes(p, raw, "Node", "merge")
    raw = legacy_export.settle(raw, {})
    definitions, values = legacy_import.legacy_values(raw, legacy_import.node_items(raw).select("Id"), "Node")
    names = definitions.select("Id", "Name")
    return values.join(names, F.col("Attribute") == F.col("Id")).select("Node", F.col("Name").alias("Attribute"), "Value")


@query(
    "legacy_defaults",
    """SELECT a.Name AS Attribute, n.Id AS Item FROM {v_node} n
       JOIN (SELECT DISTINCT v.Attribute, n.Category FROM {v_nodevalue} v JOIN {v_node} n ON n.Id = v.Node WHERE n.Category IS NOT NULL) u
         ON u.Category = n.Category
       JOIN {v_nodeattr} a ON a.Id = u.Attribute
       WHERE NOT EXISTS (SELECT 1 FROM {v_nodevalue} v WHERE v.Node = n.Id AND v.Attribute = a.Id)""",
)
def legacy_defaults(d):
    """Which items end up unassigned, attribute by attribute."""
    p = d.project("Node", "NodeCategory", "NodeAttribute", "NodeValue")
    raw = legacy_export.export_categories(p, legacy_base(d, "mac"), "Node", "merge", "mac")
    raw = legacy_export.settle(legacy_export.export_nodes(p, raw, "mac"), {})
    raw = legacy_export.settle(legacy_export.export_attributes(p, raw, "Node", "merge", "mac"), {})
    item = raw["Item"].select("Id", "Name")
    owned = legacy_import.edges(raw, "attribute_value").select(F.col("Item1_Id").alias("a"), F.col("Item2_Id").alias("v"))
    unassigned = item.filter(F.col("Name") == "Unassigned").select(F.col("Id").alias("u"))
    attribute = item.select(F.col("Id").alias("i"), F.col("Name").alias("Attribute"))
    return (
        legacy_import.edges(raw, "item_value").select(F.col("Item1_Id").alias("Item"), "Item2_Id")
        .join(unassigned, F.col("Item2_Id") == F.col("u"))
        .join(owned, F.col("u") == F.col("v")).join(attribute, F.col("a") == F.col("i"))
        .select("Attribute", "Item")
    )


@query(
    "layout_indexes",
    """SELECT Category, 'Row' AS Tag, Id AS Item, row_number() OVER (PARTITION BY Category ORDER BY substring(md5(Id), 1, 3), Id) - 1 AS "Index"
       FROM {v_node} WHERE Category IS NOT NULL""",
)
def layout_indexes(d):
    raw = legacy_raw(d, "mac")
    return legacy_export.layout_indexes(raw, "node_classification", member="item_category")


@query(
    "category_layouts",
    """SELECT Category AS Item_Id, CAST(count(*) AS BIGINT) AS members, CAST((count(*) + 9) // 10 AS BIGINT) AS parts
       FROM {v_node} WHERE Category IS NOT NULL GROUP BY Category""",
)
def category_layouts(d):
    rows = legacy_export.category_layouts(
        legacy_raw(d, "mac"), "node_classification", member="item_category", rows_per_part=10
    )
    return rows.groupBy("Item_Id").agg(
        F.sum(F.regexp_count("Layout", F.lit("<Row "))).cast("long").alias("members"),
        F.count(F.lit(1)).alias("parts"),
    )


@query(
    "source_metadata",
    """SELECT Id AS Item_Id, 0 AS TypeId, CAST(length(rtrim_) AS BIGINT) AS chars,
         CAST(length(rtrim_) - length(replace(rtrim_, chr(10), '')) + CASE WHEN rtrim_ LIKE '%' || chr(10) THEN 0 ELSE 1 END AS BIGINT) AS paras
       FROM (SELECT Id, CASE WHEN Content LIKE '%' || chr(10) THEN substring(Content, 1, length(Content) - 1) ELSE Content END AS rtrim_
             FROM {v_source}) x""",
)
def source_metadata(d):
    rows = legacy_export.source_rows(d.project("Source"), "mac")
    return rows.select(
        "Item_Id", "TypeId", F.length("PlainText").cast("long").alias("chars"),
        F.regexp_count("MetaData", F.lit("<Para ")).cast("long").alias("paras"),
    )


_REFERENCES = """
SELECT t.Id, t.Source, t.Node, First_ - 1 AS StartX,
  CASE WHEN Last_ > n THEN n - (First_ - 1) ELSE Last_ - First_ + 1 END AS LengthX, 0 AS ReferenceTypeId
FROM (SELECT *, CAST(split_part(Fragment, ':', 1) AS BIGINT) AS First_, CAST(split_part(Fragment, ':', 2) AS BIGINT) AS Last_ FROM {v_tagging}) t
JOIN (SELECT Id, CASE WHEN Content LIKE '%' || chr(10) THEN length(Content) - 1 ELSE length(Content) END AS n FROM {v_source}) s ON s.Id = t.Source"""


@query("legacy_references", f"SELECT * FROM ({_REFERENCES}) r")
def legacy_references(d):
    rows = legacy_export.reference_rows(d.project("Source", "Tagging"), "mac")
    return rows.select("Id", "Source", "Node", "StartX", "LengthX", "ReferenceTypeId")


@query(
    "export_legacy",
    f"""SELECT 'NodeReference' AS Tab, count(*) AS n FROM ({_REFERENCES}) r WHERE Node IS NOT NULL
        UNION ALL SELECT 'Annotation', count(*) FROM ({_REFERENCES}) r WHERE Node IS NULL
        UNION ALL SELECT 'Source', count(*) FROM {{v_source}}
        UNION ALL SELECT 'UserProfile', count(*) FROM {{v_user}}""",
)
def export_legacy(d):
    out = legacy_export.export_legacy(d.project(), legacy_base(d), actions=Actions(project="overwrite"))
    return union_all([
        out[t].select(F.lit(t).alias("Tab")).groupBy("Tab").agg(F.count(F.lit(1)).alias("n"))
        for t in ("NodeReference", "Annotation", "Source", "UserProfile")
    ])


# --------------------------------------------------------------- flat code

_OWNED = "(SELECT * FROM {v_tagging} WHERE CreatedBy IN (SELECT Id FROM {v_user})) t"
_NUMBER = "row_number() OVER (ORDER BY substring(md5(Id), 1, 3), Id)"
_CODES = f"""SELECT Id, {_NUMBER} AS number, 'coding' AS Kind FROM {{v_node}} WHERE Id NOT IN (SELECT Node FROM {{v_nodevalue}})
  AND CreatedBy IN (SELECT Id FROM {{v_user}})
  UNION ALL SELECT Id, {_NUMBER}, 'caselinkage' FROM {{v_node}} WHERE Id IN (SELECT Node FROM {{v_nodevalue}})
  AND CreatedBy IN (SELECT Id FROM {{v_user}})"""
_FILES = f"SELECT Id, Content, {_NUMBER} AS fid FROM {{v_source}}"


@query(
    "route_taggings",
    f"""SELECT t.Id, CASE WHEN t.Node IS NULL THEN 'annotation' ELSE n.Kind END AS Kind, n.number
        FROM {_OWNED} LEFT JOIN ({_CODES}) n ON n.Id = t.Node""",
)
def route_taggings(d):
    p = d.project("User", "Node", "NodeValue", "Tagging")
    nodes = flatcode._owned(flatcode.split_codes_and_cases(p), p["User"])
    numbered = lambda rows: flatcode.number_rows(rows, ["Id"], "number").select(F.col("Id").alias("Node"), "number")
    tagged = p["Tagging"].join(p["User"].select(F.col("Id").alias("u")), F.col("CreatedBy") == F.col("u"), "left_semi")
    routed = flatcode.route_taggings(
        tagged, numbered(nodes.filter("ValueCount = 0")), numbered(nodes.filter("ValueCount > 0"))
    )
    return routed.select("Id", "Kind", "number")


def _flat(d, *wanted):
    return flatcode.export_flatcode(d.project(), NOW)


@query(
    "flatcode_coding",
    f"""SELECT n.number AS cid, s.fid, md5(substring(s.Content, a + 1, b - a + 1)) AS digest, CAST(a AS DOUBLE) AS selfirst,
          CAST(b AS DOUBLE) AS selend, u.Name AS owner, t.Memo AS memo
        FROM (SELECT *, CAST(split_part(Fragment, ':', 1) AS BIGINT) AS a, CAST(split_part(Fragment, ':', 2) AS BIGINT) AS b FROM {{v_tagging}}) t
        JOIN {{v_user}} u ON u.Id = t.CreatedBy JOIN ({_CODES}) n ON n.Id = t.Node AND n.Kind = 'coding'
        JOIN ({_FILES}) s ON s.Id = t.Source""",
)
def flatcode_coding(d):
    rows = _flat(d)["coding"]
    return rows.select("cid", "fid", F.md5("seltext").alias("digest"), "selfirst", "selend", "owner", "memo")


@query(
    "flatcode_caselinkage",
    f"""SELECT n.number AS caseid, s.fid, u.Name AS owner FROM {{v_tagging}} t JOIN {{v_user}} u ON u.Id = t.CreatedBy
        JOIN ({_CODES}) n ON n.Id = t.Node AND n.Kind = 'caselinkage' JOIN ({_FILES}) s ON s.Id = t.Source""",
)
def flatcode_caselinkage(d):
    return _flat(d)["caselinkage"].select("caseid", "fid", "owner")


@query(
    "flatcode_case_attributes",
    f"""SELECT 'Category' AS variable, c.Name AS value, n.number AS "caseID" FROM ({_CODES}) n JOIN {{v_node}} v ON v.Id = n.Id
        JOIN {{v_nodecat}} c ON c.Id = v.Category WHERE n.Kind = 'caselinkage'
        UNION ALL
        SELECT a.Name, CASE a.Type WHEN 'boolean' THEN CASE WHEN Value = 'yes' THEN '1' ELSE '0' END
          WHEN 'date' THEN replace(Value, '-', '') ELSE Value END, n.number
        FROM {{v_nodevalue}} v JOIN {{v_nodeattr}} a ON a.Id = v.Attribute JOIN ({_CODES}) n ON n.Id = v.Node""",
)
def flatcode_case_attributes(d):
    p = d.project()
    authored = lambda t: p[t].withColumn("CreatedBy", F.lit("u1")).withColumn("CreatedDate", F.lit(NOW)).withColumn("ModifiedDate", F.lit(NOW))
    p |= {t: authored(t) for t in ("NodeAttribute", "NodeValue")}
    return flatcode.export_flatcode(p, NOW)["caseAttr"].select("variable", "value", "caseID")


@query(
    "flatcode_files",
    f"""SELECT s.fid AS id, concat('doc ', substring(s.Id, 2)) AS name, length(s.Content) AS chars, 'Fri Jan  1 00:00:00 2021' AS date FROM ({_FILES}) s""",
)
def flatcode_files(d):
    return _flat(d)["source"].select("id", "name", F.length("file").cast("long").alias("chars"), "date")


def _raw_flat(d: Data) -> dict:
    """A flat-code project straight from the tables."""
    when = F.lit("Tue Mar  1 16:20:00 2016")
    tail = [F.lit("ann").alias("owner"), when.alias("date"), when.alias("dateM")]
    alive = lambda c: F.when(F.col(c) % 5 == 0, 0).otherwise(1).alias("status")
    line = d["lineitem"]
    first = (F.col("l_orderkey") % 400).cast("double").alias("selfirst")
    last = (F.col("l_orderkey") % 400 + F.col("l_quantity")).alias("selend")
    link = [first, last, alive("l_linenumber"), F.concat(F.lit("u"), (F.col("l_suppkey") % 3).cast("string")).alias("owner"),
            when.alias("date"), F.lit(None).cast("string").alias("memo")]
    files = d["documents"]
    n_files = files.select(F.count(F.lit(1))).scalar()
    fid = (F.col("l_partkey") % n_files).alias("fid")
    return conform({
        "project": d["region"].limit(1).select(F.lit("DBVersion:0.1").alias("databaseversion"), when.alias("date"),
                                               when.alias("dateM"), F.lit("about it").alias("memo"), F.lit("The title").alias("about")),
        "source": files.select(F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("name"), F.col("doc_id").alias("id"),
                               F.col("text").alias("file"), *tail, F.lit(1).alias("status")),
        "filecat": d["nation"].select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("catid"), *tail, F.lit(1).alias("status")),
        "treefile": files.select(F.col("doc_id").alias("fid"), F.explode(F.array((F.col("doc_id") * 7 % 25), (F.col("doc_id") % 25))).alias("catid"),
                                 F.lit(1).alias("status")),
        "freecode": d["supplier"].select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"), *tail, F.lit(1).alias("status")),
        "cases": d["nation"].select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("id"), *tail, F.lit(1).alias("status")),
        "attributes": d["nation"].limit(0).select(F.lit("").alias("name")).unionByName(
            d.spark.createDataFrame([("Category",), ("size",)], "name string")).select(
                "name", F.when(F.col("name") == "size", "numeric").otherwise("character").alias("class"), *tail, F.lit(1).alias("status")),
        "caseAttr": d["nation"].select(
            F.explode(F.array(F.struct(F.lit("Category").alias("variable"), F.concat(F.lit("cat "), F.col("n_regionkey").cast("string")).alias("value")),
                              F.struct(F.lit("size").alias("variable"), F.col("n_nationkey").cast("string").alias("value")))).alias("x"),
            F.col("n_nationkey").alias("caseID"), *tail, F.lit(1).alias("status")).select("x.*", "caseID", "owner", "date", "dateM", "status"),
        "annotation": line.filter("l_linenumber = 3").select(fid, F.col("l_orderkey").alias("position"), F.lit("note").alias("annotation"),
                                                             *tail, alive("l_orderkey")),
        "coding": line.filter("l_linenumber <> 3").select(F.col("l_suppkey").alias("cid"), fid, *link),
        "caselinkage": line.filter("l_linenumber = 1").select((F.col("l_suppkey") % 25).alias("caseid"), fid, *link),
    }, FLATCODE)


_COPIES = "(l_orderkey % 400)"
_LINKED = f"""SELECT concat('doc ', CAST(l_partkey % n AS STRING)) AS Source, s_name AS Node,
    concat(CAST({_COPIES} AS STRING), ':', CAST({_COPIES} + CAST(l_quantity AS BIGINT) AS STRING)) AS Fragment,
    concat('u', CAST(l_suppkey % 3 AS STRING)) AS Author
  FROM {{lineitem}} CROSS JOIN (SELECT count(*) AS n FROM {{documents}}) c JOIN {{supplier}} ON s_suppkey = l_suppkey
  WHERE l_linenumber <> 3 AND l_linenumber % 5 <> 0
  UNION ALL
  SELECT concat('doc ', CAST(l_partkey % n AS STRING)), n_name,
    concat(CAST({_COPIES} AS STRING), ':', CAST({_COPIES} + CAST(l_quantity AS BIGINT) AS STRING)), concat('u', CAST(l_suppkey % 3 AS STRING))
  FROM {{lineitem}} CROSS JOIN (SELECT count(*) AS n FROM {{documents}}) c JOIN {{nation}} ON n_nationkey = l_suppkey % 25
  WHERE l_linenumber = 1
  UNION ALL
  SELECT concat('doc ', CAST(l_partkey % n AS STRING)), NULL, concat(CAST(l_orderkey AS STRING), ':', CAST(l_orderkey AS STRING)), 'ann'
  FROM {{lineitem}} CROSS JOIN (SELECT count(*) AS n FROM {{documents}}) c WHERE l_linenumber = 3 AND l_orderkey % 5 <> 0"""


@query("union_spans", f"SELECT * FROM ({_LINKED}) u")
def union_spans(d):
    """The three span tables of a flat-code project as taggings."""
    p = flatcode.import_flatcode(_raw_flat(d))
    sources = p["Source"].select(F.col("Id").alias("s"), F.col("Name").alias("SourceName"))
    nodes = p["Node"].select(F.col("Id").alias("n"), F.col("Name").alias("NodeName"))
    users = p["User"].select(F.col("Id").alias("u"), F.col("Name").alias("Author"))
    return (
        p["Tagging"].join(sources, F.col("Source") == F.col("s")).join(nodes, F.col("Node") == F.col("n"), "left")
        .join(users, F.col("CreatedBy") == F.col("u"))
        .select(F.col("SourceName").alias("Source"), F.col("NodeName").alias("Node"), "Fragment", "Author")
    )


@query(
    "import_flatcode_sources",
    """SELECT concat('doc ', CAST(doc_id AS STRING)) AS Name, n_name AS Category, length(text) AS chars,
         TIMESTAMP '2016-03-01 16:20:00' AS CreatedDate
       FROM {documents} JOIN {nation} ON n_nationkey = least(doc_id * 7 % 25, doc_id % 25)""",
)
def import_flatcode_sources(d):
    p = flatcode.import_flatcode(_raw_flat(d))
    cats = p["SourceCategory"].select(F.col("Id").alias("c"), F.col("Name").alias("CategoryName"))
    return p["Source"].join(cats, F.col("Category") == F.col("c")).select(
        "Name", F.col("CategoryName").alias("Category"), F.length("Content").cast("long").alias("chars"), "CreatedDate")


@query(
    "promote_category",
    """SELECT n_name AS Name, concat('cat ', CAST(n_regionkey AS STRING)) AS Category, CAST(n_nationkey AS STRING) AS size FROM {nation}""",
)
def promote_category(d):
    p = flatcode.import_flatcode(_raw_flat(d))
    cats = p["NodeCategory"].select(F.col("Id").alias("c"), F.col("Name").alias("CategoryName"))
    values = p["NodeValue"].select(F.col("Node").alias("v"), F.col("Value").alias("size"))
    return p["Node"].join(cats, F.col("Category") == F.col("c")).join(values, F.col("Id") == F.col("v")).select(
        "Name", F.col("CategoryName").alias("Category"), "size")


@query(
    "single_category",
    """SELECT doc_id AS fid, least(doc_id * 7 % 25, doc_id % 25) AS catid,
         CAST(CASE WHEN doc_id * 7 % 25 = doc_id % 25 THEN 1 ELSE 2 END AS BIGINT) AS categories FROM {documents}""",
)
def single_category(d):
    return flatcode.single_category(_raw_flat(d)["treefile"], "fid")


# ------------------------------------------------------------ image coding


def _raw_images(d: Data) -> dict:
    colour = F.element_at(F.array(*[F.lit(c) for c in ("red", "teal", "navy")]), (F.col("s_suppkey") % 3 + 1).cast("int"))
    return conform({
        "codes": d["supplier"].select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), colour.alias("color")),
        "images": d["part"].select(F.col("p_partkey").alias("id"), F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("name"),
                                   F.col("p_brand").alias("owner"), F.lit(datetime(1990, 1, 1)).alias("date")),
        "imageCoding": d["lineitem"].select(
            F.col("l_partkey").alias("images_id"), F.col("l_suppkey").alias("codes_id"), F.col("l_linenumber").alias("x1"),
            F.lit(5).alias("y1"), (F.col("l_orderkey") % 1000).cast("int").alias("x2"), F.lit(9).alias("y2"),
            F.lit("zoe").alias("owner"), F.col("l_shipdate").alias("date")),
        "attributes": d["region"].select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name")),
        "imageAttributes": d["part"].select(F.col("p_partkey").alias("images_id"), (F.col("p_size") % 5).alias("attributes_id"),
                                            F.col("p_type").alias("value")),
    }, IMAGECODING)


@query(
    "imagecoding_taggings",
    """SELECT concat('p', CAST(l_partkey AS STRING)) AS Source, s_name AS Node,
         CASE l_suppkey % 3 WHEN 0 THEN 16711680 WHEN 1 THEN 32896 ELSE 128 END AS Color,
         concat(CAST(l_linenumber AS STRING), ':', CAST(l_orderkey % 1000 AS STRING), ',5:9') AS Fragment,
         'zoe' AS Author, l_shipdate AS CreatedDate
       FROM {lineitem} JOIN {supplier} ON s_suppkey = l_suppkey JOIN {part} ON p_partkey = l_partkey""",
)
def imagecoding_taggings(d):
    p = import_imagecoding(_raw_images(d))
    sources = p["Source"].select(F.col("Id").alias("s"), F.col("Name").alias("SourceName"))
    nodes = p["Node"].select(F.col("Id").alias("n"), F.col("Name").alias("NodeName"), "Color")
    users = p["User"].select(F.col("Id").alias("u"), F.col("Name").alias("Author"))
    return (
        p["Tagging"].join(sources, F.col("Source") == F.col("s")).join(nodes, F.col("Node") == F.col("n"))
        .join(users, F.col("CreatedBy") == F.col("u"))
        .select(F.col("SourceName").alias("Source"), F.col("NodeName").alias("Node"), "Color", "Fragment", "Author", "CreatedDate")
    )


@query(
    "imagecoding_owners",
    "SELECT DISTINCT p_brand AS Name FROM {part} UNION SELECT 'zoe'",
)
def imagecoding_owners(d):
    return import_imagecoding(_raw_images(d))["User"].select("Name")


@query(
    "imagecoding_attributes",
    """SELECT r_name AS Name, 'text' AS Type, max(length(p_type)) AS Length FROM {part} JOIN {region} ON r_regionkey = p_size % 5 GROUP BY r_name""",
)
def imagecoding_attributes(d):
    rows = import_imagecoding(_raw_images(d))["SourceAttribute"]
    return rows.select("Name", "Type", F.col("Length").cast("long").alias("Length"))


# ----------------------------------------------------- matching, comparing

VIEWS["v_items1"] = """
SELECT concat('a', CAST(c_custkey AS STRING)) AS Id, c_nationkey AS TypeId, c_name AS Name,
       concat('Nodes/', c_name) AS HierarchicalName, c_mktsegment AS Description FROM {customer}"""
VIEWS["v_items2"] = """
SELECT concat(CASE WHEN c_custkey % 3 = 0 THEN 'a' ELSE 'b' END, CAST(c_custkey AS STRING)) AS Id, c_nationkey AS TypeId,
       CASE WHEN c_custkey % 10 = 9 THEN concat(c_name, ' new') ELSE c_name END AS Name,
       concat('Nodes/', CASE WHEN c_custkey % 10 = 9 THEN concat(c_name, ' new') ELSE c_name END) AS HierarchicalName,
       CASE WHEN c_custkey % 4 = 0 THEN 'other' ELSE c_mktsegment END AS Description
FROM {customer} WHERE c_custkey % 13 <> 0"""

_ITEM_RULE = [("Item", ["TypeId", "Name", "HierarchicalName"], [])]


@query(
    "matched_records",
    """SELECT a.Id AS Id1, b.Id AS Id2 FROM {v_items1} a JOIN {v_items2} b
       ON a.TypeId = b.TypeId AND a.Name = b.Name AND a.HierarchicalName = b.HierarchicalName""",
)
def matched_records(d):
    c1, c2 = match.match_entities({"Item": d["v_items1"]}, {"Item": d["v_items2"]}, _ITEM_RULE)
    return c1.withColumnRenamed("Id", "Id1").join(c2.withColumnRenamed("Id", "Id2"), "Class").select("Id1", "Id2")


@query(
    "zero_matches",
    """SELECT Id FROM {v_items1} a WHERE NOT EXISTS (SELECT 1 FROM {v_items2} b
       WHERE a.TypeId = b.TypeId AND a.Name = b.Name AND a.HierarchicalName = b.HierarchicalName)""",
)
def zero_matches(d):
    c1, c2 = match.match_entities({"Item": d["v_items1"]}, {"Item": d["v_items2"]}, _ITEM_RULE)
    return match.zero_matches(c1, c2).select("Id")


@query(
    "column_diffs",
    """WITH pairs AS (SELECT a.Id AS Key1, coalesce(b.Id, c.Id) AS Key2 FROM {v_items1} a
         LEFT JOIN {v_items2} b ON a.TypeId = b.TypeId AND a.Name = b.Name AND a.HierarchicalName = b.HierarchicalName
         LEFT JOIN {v_items2} c ON c.Id = a.Id)
       SELECT 'Item' AS "Table", Key1, Key2, 'only in 1' AS Status, NULL AS "Column", NULL AS Value1, NULL AS Value2 FROM pairs WHERE Key2 IS NULL
       UNION ALL SELECT 'Item', NULL, Id, 'only in 2', NULL, NULL, NULL FROM {v_items2} WHERE Id NOT IN (SELECT Key2 FROM pairs WHERE Key2 IS NOT NULL)
       UNION ALL SELECT 'Item', Key1, Key2, 'differs', k, v1, v2 FROM (
         SELECT Key1, Key2, unnest(['Description', 'Name', 'HierarchicalName']) AS k,
           unnest([a.Description, a.Name, a.HierarchicalName]) AS v1, unnest([b.Description, b.Name, b.HierarchicalName]) AS v2
         FROM pairs JOIN {v_items1} a ON a.Id = Key1 JOIN {v_items2} b ON b.Id = Key2) x WHERE v1 IS DISTINCT FROM v2""",
)
def column_diffs(d):
    return match.compare_projects({"Item": d["v_items1"]}, {"Item": d["v_items2"]}, ["Item"], rules=_ITEM_RULE)


# Natural keys that many records share: all of a nation and segment look alike.
VIEWS["v_alike1"] = """
SELECT concat('a', CAST(c_custkey AS STRING)) AS Id, c_nationkey AS TypeId, c_mktsegment AS Name,
       concat('Nodes/', c_mktsegment) AS HierarchicalName, c_name AS Description FROM {customer}"""
VIEWS["v_alike2"] = """
SELECT concat('b', CAST(c_custkey AS STRING)) AS Id, c_nationkey AS TypeId, c_mktsegment AS Name,
       concat('Nodes/', c_mktsegment) AS HierarchicalName,
       CASE WHEN c_nationkey % 2 = 1 AND c_custkey % 3 = 1 THEN concat(c_name, ' edited') ELSE c_name END AS Description
FROM {customer} WHERE c_nationkey % 2 = 1 OR c_custkey % 13 <> 0"""


@query(
    "refined_matches",
    """SELECT a.Id, count(b.Id) AS Partners FROM {v_items1} a
       LEFT JOIN {v_items2} b ON a.TypeId = b.TypeId AND a.Description = b.Description GROUP BY a.Id""",
)
def refined_matches(d):
    """Two rules for one table: records match when they agree under both."""
    rules = [("Item", ["TypeId"], []), ("Item", ["Description"], [])]
    c1, c2 = match.match_entities({"Item": d["v_items1"]}, {"Item": d["v_items2"]}, rules)
    sizes = c2.groupBy("Class").agg(F.count(F.lit(1)).alias("n"))
    return c1.join(sizes, "Class", "left").select("Id", F.coalesce("n", F.lit(0)).cast("long").alias("Partners"))


@query(
    "shared_key_diffs",
    """SELECT Id AS Key1, c_nationkey AS TypeId, 'only in 1' AS Status, NULL AS "Column", CAST(1 AS BIGINT) AS n
       FROM (SELECT concat('a', CAST(c_custkey AS STRING)) AS Id, c_nationkey FROM {customer}
             WHERE c_nationkey % 2 = 0 AND c_custkey % 13 = 0) x
       UNION ALL
       SELECT NULL, TypeId, 'differs', 'Description', count(*) FROM {v_alike2}
       WHERE Description LIKE '% edited' GROUP BY TypeId, Name""",
)
def shared_key_diffs(d):
    """Projects whose records share natural keys: equal ones pair up, the rest by rank."""
    found = match.compare_projects({"Item": d["v_alike1"]}, {"Item": d["v_alike2"]}, ["Item"], rules=_ITEM_RULE)
    own = d["v_alike1"].select(F.col("Id").alias("Key1"), "TypeId", "Name")
    key = F.when(F.col("Status") != "differs", F.col("Key1")).alias("Shown")
    return found.join(own, "Key1", "left").groupBy(key, "TypeId", "Name", "Status", "Column").agg(
        F.count(F.lit(1)).alias("n")
    ).select(F.col("Shown").alias("Key1"), "TypeId", "Status", "Column", "n")


@query(
    "reference_matches",
    """WITH refs AS (
         SELECT o_orderkey, CAST(o_orderstatus AS STRING) AS status, o_custkey,
                concat('a', CAST(o_custkey AS STRING)) AS one, concat(CASE WHEN o_custkey % 3 = 0 THEN 'a' ELSE 'b' END, CAST(o_custkey AS STRING)) AS two
         FROM {orders}),
       c1 AS (SELECT o_orderkey, coalesce(concat(CAST(TypeId AS STRING), '/', Name, '/', HierarchicalName), one) || '|' || status AS Class
              FROM refs LEFT JOIN {v_items1} i ON i.Id = one),
       c2 AS (SELECT o_orderkey, coalesce(concat(CAST(TypeId AS STRING), '/', Name, '/', HierarchicalName), two) || '|' || status AS Class
              FROM refs LEFT JOIN {v_items2} i ON i.Id = two)
       SELECT CAST(c1.o_orderkey AS STRING) AS Id, coalesce(n, 0) AS Partners FROM c1
       LEFT JOIN (SELECT Class, count(*) AS n FROM c2 GROUP BY Class) x ON x.Class = c1.Class""",
)
def reference_matches(d):
    """Records matched through what they refer to: how many partners each has in the other project."""
    items = {1: "v_items1", 2: "v_items2"}
    prefix = {1: F.lit("a"), 2: F.when(F.col("o_custkey") % 3 == 0, "a").otherwise("b")}
    rules = _ITEM_RULE + [("NodeReference", [], ["Node_Item_Id", "Source_Item_Id"])]
    projects = [
        {
            "Item": d[items[n]],
            "NodeReference": d["orders"].select(
                F.col("o_orderkey").cast("string").alias("Id"),
                F.concat(prefix[n], F.col("o_custkey").cast("string")).alias("Node_Item_Id"),
                F.col("o_orderstatus").alias("Source_Item_Id"),
            ),
        }
        for n in (1, 2)
    ]
    c1, c2 = match.match_entities(*projects, rules)
    sizes = c2.join(projects[1]["NodeReference"].select("Id"), "Id").groupBy("Class").agg(F.count(F.lit(1)).alias("n"))
    mine = projects[0]["NodeReference"].select("Id").join(c1, "Id")
    return mine.join(sizes, "Class", "left").select("Id", F.coalesce("n", F.lit(0)).cast("long").alias("Partners"))


@query(
    "property_diffs",
    """SELECT Id AS Key1, Id AS Key2, CAST(1 AS BIGINT) AS Pos,
         concat('/Property[1]:Value="', CAST(c_nationkey AS STRING), '" != Value="7"') AS Difference
       FROM (SELECT concat('a', CAST(c_custkey AS STRING)) AS Id, c_nationkey FROM {customer}) x WHERE c_nationkey <> 7""",
)
def property_diffs(d):
    bag = lambda v: X.property_bag(("DataType", v), ("Length", "0"))
    rows = d["v_items1"].select(F.col("Id").alias("Key"), bag(F.col("TypeId")).alias("P1"), bag(F.lit("7")).alias("P2"))
    none = d["v_items1"].limit(0).select("Id", F.lit("").alias("Class"))
    out = match.xml_differences(
        rows.select(F.col("Key").alias("Key1"), F.col("Key").alias("Key2")),
        match.xml_elements(rows, "Key", "P1"), match.xml_elements(rows, "Key", "P2"), none, none,
    )
    return out.withColumn("Pos", F.col("Pos").cast("long"))


@query(
    "property_maps",
    """SELECT Id, CAST(CASE Type WHEN 'text' THEN 0 WHEN 'integer' THEN 1 WHEN 'decimal' THEN 2 WHEN 'date' THEN 4 ELSE 6 END AS STRING) AS Code,
         CASE WHEN Length > 0 THEN Length END AS Length
       FROM (SELECT v.Node || v.Attribute AS Id, a.Type, a.Length FROM {v_nodevalue} v JOIN {v_nodeattr} a ON a.Id = v.Attribute) x""",
)
def property_maps(d):
    a = d["v_nodeattr"].select(F.col("Id").alias("Attribute"), "Type", "Length")
    rows = d["v_nodevalue"].join(a, "Attribute").select(
        F.concat("Node", "Attribute").alias("Id"),
        X.property_bag(("DataType", data_type_code(F.col("Type"))), ("Length", F.col("Length"))).alias("xml"),
    )
    m = rows.select("Id", X.property_map(F.col("xml")).alias("m"))
    return m.select("Id", F.col("m")["DataType"].alias("Code"), X.property_length(F.col("m")).alias("Length"))


# ------------------------------------------------------------------ nested


@query(
    "nested_export",
    """SELECT s.Id, s.Name, 'txt' AS ObjectType, CAST(count(t.Id) AS BIGINT) AS taggings,
         CAST(coalesce(sum(CAST(split_part(Fragment, ':', 2) AS BIGINT) - CAST(split_part(Fragment, ':', 1) AS BIGINT) + 1), 0) AS BIGINT) AS length
       FROM {v_source} s LEFT JOIN (SELECT t.* FROM {v_tagging} t JOIN {v_user} u ON u.Id = t.ModifiedBy) t ON t.Source = s.Id
       GROUP BY s.Id, s.Name""",
)
def nested_export(d):
    """Nested documents, checked by their totals."""
    docs = nested.nested_documents(d.project("Source", "Tagging", "User"), rows_per_part=10)
    total = F.aggregate("Taggings", F.lit(0).cast("long"), lambda a, x: a + x["length"])
    return docs.groupBy("Id", "Name", "ObjectType").agg(
        F.sum(F.coalesce(F.size("Taggings"), F.lit(0))).cast("long").alias("taggings"),
        F.sum(F.coalesce(total, F.lit(0))).cast("long").alias("length"),
    )


@query(
    "nested_nodes",
    """SELECT n.Id, n.Name, coalesce(string_agg(a.Name || '=' || v.Value, ',' ORDER BY a.Name), '') AS attributes
       FROM {v_node} n LEFT JOIN {v_nodevalue} v ON v.Node = n.Id LEFT JOIN {v_nodeattr} a ON a.Id = v.Attribute GROUP BY n.Id, n.Name""",
)
def nested_nodes(d):
    rows = nested.nested_nodes(d.project("Node", "NodeAttribute", "NodeValue"))
    items = F.array_sort(F.transform("Attributes", lambda x: F.concat(x["name"], F.lit("="), x["value"])))
    return rows.select("Id", "Name", F.coalesce(F.array_join(items, ","), F.lit("")).alias("attributes"))
