"""Bulk loads, users, projects and the remaining graph operators."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from catalog.base import VIEWS, query
from catalog.layouts import legacy_base, legacy_raw
from codespan.functions import text as T
from codespan.operators import attributes as A
from codespan.operators import merge as M
from codespan.operators import query as Q
from codespan.plans import legacy_export, load
from codespan.schemas import DELETE_ORDER
from codespan.sources.project import truncate_tables

NOW = datetime(2024, 6, 1, 12, 0, 0)

# One node per part, in a tree over names; some names exist already.
VIEWS["v_node_sheet"] = """
SELECT p_partkey AS Row,
       CASE WHEN p_partkey % 50 = 0 THEN '' WHEN p_partkey < 25 THEN concat('NATION_', CAST(p_partkey AS STRING))
            ELSE concat('part ', CAST(p_partkey AS STRING)) END AS Name,
       CASE WHEN p_partkey % 3 = 0 THEN concat('part ', CAST(p_partkey + 1 AS STRING))
            WHEN p_partkey % 3 = 1 THEN concat('NATION_', CAST(p_partkey % 25 AS STRING))
            WHEN p_partkey % 7 = 0 THEN concat('made ', CAST(p_partkey % 5 AS STRING)) ELSE '' END AS Parent,
       CASE WHEN p_partkey % 2 = 0 THEN concat('category ', CAST(p_partkey % 8 AS STRING)) ELSE '' END AS Category,
       CAST(p_size AS STRING) AS size, p_brand AS brand,
       CASE WHEN p_partkey % 4 = 0 THEN '' ELSE 'true' END AS good
FROM {part}"""

_SHEET_NAMES = "(SELECT *, CASE WHEN Name = '' THEN CAST(Row AS STRING) ELSE Name END AS N FROM {v_node_sheet})"


@query(
    "load_nodes",
    f"""SELECT s.N AS Name, nullif(s.Parent, '') AS Parent, nullif(s.Category, '') AS Category, 'u9' AS ModifiedBy,
          CASE WHEN n.Id IS NULL THEN 'u9' ELSE n.CreatedBy END AS CreatedBy
        FROM {_SHEET_NAMES} s LEFT JOIN {{v_node}} n ON n.Name = s.N
        UNION ALL
        SELECT n.Name, q.Name, c.Name, n.ModifiedBy, n.CreatedBy FROM {{v_node}} n LEFT JOIN {{v_node}} q ON q.Id = n.Parent
          LEFT JOIN {{v_nodecat}} c ON c.Id = n.Category WHERE n.Name NOT IN (SELECT N FROM {_SHEET_NAMES} x)
        UNION ALL
        SELECT DISTINCT Parent, NULL, NULL, 'u9', 'u9' FROM {{v_node_sheet}}
        WHERE Parent <> '' AND Parent NOT IN (SELECT N FROM {_SHEET_NAMES} x) AND Parent NOT IN (SELECT Name FROM {{v_node}})""",
)
def load_nodes(d):
    p = load.load_nodes(
        d.project("Node", "NodeCategory"), d["v_node_sheet"].select("Row", "Name", "Parent", "Category"), "u9", NOW
    )
    parents = p["Node"].select(F.col("Id").alias("p"), F.col("Name").alias("ParentName"))
    cats = p["NodeCategory"].select(F.col("Id").alias("c"), F.col("Name").alias("CategoryName"))
    return (
        p["Node"].join(parents, F.col("Parent") == F.col("p"), "left").join(cats, F.col("Category") == F.col("c"), "left")
        .select("Name", F.col("ParentName").alias("Parent"), F.col("CategoryName").alias("Category"), "ModifiedBy", "CreatedBy")
    )


@query(
    "load_node_values",
    f"""SELECT N AS Name, k AS Attribute, v AS Value FROM (
          SELECT N, unnest(['size', 'brand', 'good']) AS k, unnest([size, brand, CASE WHEN good = 'true' THEN 'True' ELSE '' END]) AS v
          FROM {_SHEET_NAMES} s) x WHERE v <> ''""",
)
def load_node_values(d):
    p = load.load_nodes(d.project("Node"), d["v_node_sheet"], "u9", NOW)
    nodes = p["Node"].select(F.col("Id").alias("n"), "Name")
    names = p["NodeAttribute"].select(F.col("Id").alias("a"), F.col("Name").alias("AttributeName"))
    return p["NodeValue"].join(nodes, F.col("Node") == F.col("n")).join(names, F.col("Attribute") == F.col("a")).select(
        "Name", F.col("AttributeName").alias("Attribute"), "Value"
    )


@query(
    "load_node_attributes",
    """SELECT 'size' AS Name, 'integer' AS Type, max(length(CAST(p_size AS STRING))) AS Length FROM {part}
       UNION ALL SELECT 'brand', 'text', max(length(p_brand)) FROM {part} UNION ALL SELECT 'good', 'boolean', 4""",
)
def load_node_attributes(d):
    p = load.load_nodes(d.project("Node"), d["v_node_sheet"], "u9", NOW)
    return p["NodeAttribute"].select("Name", "Type", F.col("Length").cast("long").alias("Length"))


# One source per page, its text put together from two columns.
VIEWS["v_page_sheet"] = """
SELECT page_id AS Row, concat('page ', CAST(page_id AS STRING)) AS Name, url AS address,
       CASE WHEN page_id % 3 = 0 THEN 'web' ELSE '' END AS Category,
       CASE WHEN page_id % 5 = 0 THEN '' ELSE substring(html, 1, 40 + CAST(page_id % 60 AS INT)) END AS head,
       CASE WHEN page_id % 7 = 0 THEN '' ELSE html END AS body
FROM {pages}"""

_HEADED = """
SELECT Name, concat(CASE WHEN head <> '' THEN concat('head', chr(10), chr(10), head, chr(10)) ELSE '' END,
  CASE WHEN head <> '' AND body <> '' THEN concat(chr(10), chr(10)) ELSE '' END,
  CASE WHEN body <> '' THEN concat('body', chr(10), chr(10), body, chr(10)) ELSE '' END) AS Content,
  length(head) AS h, length(body) AS b FROM {v_page_sheet}"""
# The first piece begins after the heading and a blank line; the second after
# the whole first piece, another blank line and its own heading.


def _load_pages(d):
    return load.load_sources(d.project("Source"), d["v_page_sheet"], "u9", NOW, textcols=["head", "body"])


@query(
    "load_sources",
    f"SELECT Name, md5(Content) AS digest, 'TXT' AS ObjectType FROM ({_HEADED}) x UNION ALL SELECT Name, md5(Content), ObjectType FROM {{v_source}}",
)
def load_sources(d):
    return _load_pages(d)["Source"].select("Name", F.md5("Content").alias("digest"), "ObjectType")


@query(
    "load_text_columns",
    f"""SELECT Name, 'head' AS Node, concat('7:', CAST(7 + h AS STRING)) AS Fragment FROM ({_HEADED}) x WHERE h > 0
        UNION ALL
        SELECT Name, 'body', concat(CAST(s AS STRING), ':', CAST(s + b AS STRING)) FROM (
          SELECT *, CASE WHEN h > 0 THEN 6 + h + 1 + 2 ELSE 0 END + 6 + 1 AS s FROM ({_HEADED}) y WHERE b > 0) z""",
)
def load_text_columns(d):
    p = _load_pages(d)
    sources = p["Source"].select(F.col("Id").alias("s"), "Name")
    nodes = p["Node"].select(F.col("Id").alias("n"), F.col("Name").alias("NodeName"))
    return p["Tagging"].join(sources, F.col("Source") == F.col("s")).join(nodes, F.col("Node") == F.col("n")).select(
        "Name", F.col("NodeName").alias("Node"), "Fragment"
    )


@query(
    "load_source_values",
    """SELECT Name, 'address' AS Attribute, address AS Value FROM {v_page_sheet}""",
)
def load_source_values(d):
    p = _load_pages(d)
    sources = p["Source"].select(F.col("Id").alias("s"), "Name")
    names = p["SourceAttribute"].select(F.col("Id").alias("a"), F.col("Name").alias("AttributeName"))
    return p["SourceValue"].join(sources, F.col("Source") == F.col("s")).join(names, F.col("Attribute") == F.col("a")).select(
        "Name", F.col("AttributeName").alias("Attribute"), "Value"
    )


@query(
    "attribute_arguments",
    """SELECT Row, brand, 'given' AS extra, CASE WHEN good IS NULL THEN 'no' ELSE good END AS good FROM {v_node_sheet}""",
)
def attribute_arguments(d):
    return A.with_attribute_args(d["v_node_sheet"], ["extra:given", "good:no"]).select("Row", "brand", "extra", "good")


@query("resolve_user_from_project", "SELECT 'u2' AS Id FROM {v_project}")
def resolve_user_from_project(d):
    return M.resolve_user(d.project("Project", "User"), None, NOW)[1]


@query(
    "resolve_named_user",
    """SELECT Id, Name FROM {v_user} WHERE Name <> 'user 7' UNION ALL
       SELECT concat(substring(m, 1, 8), '-', substring(m, 9, 4), '-', substring(m, 13, 4), '-', substring(m, 17, 4), '-', substring(m, 21)), 'user 7'
       FROM (SELECT md5(concat('User', chr(31), 'user 7')) AS m) x""",
)
def resolve_named_user(d):
    p = d.project("Project", "User")
    without = p | {"User": p["User"].filter(F.col("Name") != "user 7")}
    return M.resolve_user(without, "user 7", NOW)[0]["User"]


@query("add_user", "SELECT Id, Name FROM {v_user} UNION ALL SELECT 'new', 'user 1'")
def add_user(d):
    return M.add_user(d.project("User")["User"], "new", "user 1")


@query(
    "put_project_replace",
    """SELECT '0.2' AS Version, 'T' AS Title, CAST(NULL AS STRING) AS Description, CreatedBy FROM {v_project}""",
)
def put_project_replace(d):
    row = d["v_project"].select(F.lit("9").alias("Version"), F.lit("T").alias("Title"), "CreatedBy")
    return M.put_project(d.project("Project")["Project"], row, "replace").select("Version", "Title", "Description", "CreatedBy")


@query("translate_names", "SELECT Id, Name, coalesce(Description, '') AS Description FROM {v_node}")
def translate_names(d):
    raw = legacy_raw(d, "windows")
    items = M.translate_names(raw)["Item"]
    return items.filter(F.col("TypeId") == 16).select("Id", "Name", "Description")


@query(
    "shift_project_dates",
    """SELECT Id, CreatedDate + INTERVAL '1' DAY AS CreatedDate, ModifiedDate + INTERVAL '1' DAY AS ModifiedDate FROM {v_node}""",
)
def shift_project_dates(d):
    moved = M.shift_project_dates(d.project("Node", "User"), datetime(2021, 1, 1), "1 day", NOW)
    return moved["Node"].select("Id", "CreatedDate", "ModifiedDate")


@query(
    "truncate_tables",
    "SELECT " + ", ".join(f"'{t}' AS \"{t}\"" for t in ("Tagging",)) + ", count(*) AS n FROM {v_tagging} WHERE FALSE",
)
def truncate(d):
    p = truncate_tables(d.project("Tagging"))
    assert list(p) == DELETE_ORDER
    return p["Tagging"].agg(F.lit("Tagging").alias("Tagging"), F.count(F.lit(1)).alias("n"))


@query(
    "value_status",
    """SELECT v.Node AS Item, v.Attribute, v.Value, concat(v.Attribute, '/', v.Value) AS NewValueId,
         concat(v.Attribute, '/', v.Value) AS ExistingValueId FROM {v_nodevalue} v
       UNION ALL
       SELECT v.Node, v.Attribute, 'unseen', NULL, concat(v.Attribute, '/', v.Value) FROM {v_nodevalue} v""",
)
def value_status(d):
    raw = legacy_raw(d, "mac")
    wanted = d["v_nodevalue"].select(F.col("Node").alias("Item"), "Attribute", "Value")
    both = wanted.unionByName(wanted.withColumn("Value", F.lit("unseen")))
    return legacy_export.value_status(raw, both)


@query(
    "system_values",
    """SELECT Id AS Attribute, t AS Tag, n AS Name, CASE WHEN t = 0 THEN 'True' ELSE 'False' END AS IsDefault FROM (
         SELECT concat('p', CAST(p_partkey AS STRING)) AS Id, unnest([0, 1]) AS t, unnest(['none', 'n/a']) AS n FROM {part}
         UNION ALL SELECT concat('p', CAST(p_partkey AS STRING)), unnest([2, 3]), unnest(['0', '1']) FROM {part} WHERE p_size % 2 = 0) x""",
)
def system_values(d):
    new = d["part"].select(
        F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("Id"),
        F.when(F.col("p_size") % 2 == 0, "Boolean").otherwise("text").alias("Type"),
    )
    rows = legacy_export.system_values(new, F.lit("none"), F.lit("n/a"), "mac")
    return rows.select("Attribute", "Tag", "Name", "IsDefault")


@query(
    "assign_values_overwrite",
    """SELECT Node AS Item1_Id, Attribute, CASE WHEN Attribute = 'na_label' THEN 'new label' ELSE Value END AS Value FROM {v_nodevalue}
       UNION ALL SELECT Source, Attribute, Value FROM {v_srcvalue}""",
)
def assign_values_overwrite(d):
    raw = legacy_raw(d, "mac")
    assigned = d["v_nodevalue"].select(
        F.col("Node").alias("Item"), F.lit("c").alias("Category"), "Attribute",
        F.when(F.col("Attribute") == "na_label", "new label").otherwise(F.col("Value")).alias("Value"),
    )
    out = legacy_export.assign_values(raw, assigned, "overwrite")
    names = out["Item"].select(F.col("Id").alias("i"), F.col("Name").alias("Value"))
    owned = out["Role"].filter("TypeId = 6").select(F.col("Item1_Id").alias("Attribute"), F.col("Item2_Id").alias("v"))
    return (
        out["Role"].filter("TypeId = 7").select("Item1_Id", "Item2_Id")
        .join(names, F.col("Item2_Id") == F.col("i")).join(owned, F.col("Item2_Id") == F.col("v"))
        .select("Item1_Id", "Attribute", "Value")
    )


@query(
    "uncategorised_values",
    """SELECT v.Node, v.Attribute, v.Value FROM {v_nodevalue} v""",
)
def uncategorised_values(d):
    return legacy_export.uncategorised_values(d.project("NodeValue"), legacy_base(d, "mac"), "Node")


@query(
    "tagging_counts",
    """SELECT Source, CAST(count(*) AS BIGINT) AS taggings, CAST(count(Node) AS BIGINT) AS coded FROM {v_tagging} GROUP BY Source""",
)
def tagging_counts(d):
    rows = Q.tagging_rows(d.project("Tagging", "Node"))
    return rows.groupBy("Source").agg(F.count(F.lit(1)).alias("taggings"), F.count("NodeId").alias("coded"))


@query(
    "limited_sources",
    "SELECT Id, Name FROM {v_source} ORDER BY Name, Id LIMIT 25",
)
def limited_sources(d):
    return Q.filter_sources(d.project("Source"), limit=25).select("Id", "Name")


@query(
    "nonblank_text_sources",
    "SELECT Id, length(Content) AS n FROM {v_source}",
)
def nonblank_text_sources(d):
    rows = Q.filter_sources(d.project("Source", "SourceCategory"))
    return rows.select("Id", F.length(T.strip_final_newline(F.concat("Content", F.lit("\n")))).cast("long").alias("n"))
