"""Reading, writing, publishing and reporting: what lies in a store is what was computed.

Every query writes to a new folder beside the session's checkpoints and answers
from what it reads back.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from catalog.base import VIEWS, query
from catalog.layouts import _LINKED, _raw_flat, _raw_images, legacy_raw
from codespan.operators import merge, nested, tagging
from codespan.operators.report import Report, watch_merge
from codespan.plans import flatcode, imagecoding, legacy_export
from codespan.plans.common import Actions
from codespan.plans.conversions import between
from codespan.schemas import FLATCODE
from codespan.session import ensure_checkpoint_dir
from codespan.sources import files, objects
from codespan.sources.project import (
    read_flatcode_project, read_imagecoding, read_legacy, read_project, write_flatcode, write_project,
)

NOW = datetime(2024, 6, 1, 12, 0, 0)


def place(d, name: str) -> str:
    return f"{ensure_checkpoint_dir(d.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# ----------------------------------------------------------------- order


@query(
    "ordered_taggings",
    """SELECT row_number() OVER (ORDER BY Source, First_, Last_, Id) AS Row, Source, First_, Id FROM {v_span}""",
)
def ordered_taggings(d):
    """Spans in order of source and start, read back with their places across file borders."""
    path = place(d, "ordered")
    files.write_ordered(d["v_span"].select("Source", "First_", "Last_", "Id"), ["Source", "First_", "Last_", "Id"], path)
    return files.read_ordered(d.spark, path).select("Row", "Source", "First_", "Id")


@query(
    "ordered_attributes",
    """SELECT row_number() OVER (ORDER BY Name, Node) AS Row, Node, Name, Value
       FROM (SELECT v.Node, a.Name, v.Value FROM {v_nodevalue} v JOIN {v_nodeattr} a ON a.Id = v.Attribute) x""",
)
def ordered_attributes(d):
    names = d["v_nodeattr"].select(F.col("Id").alias("Attribute"), "Name")
    path = place(d, "ordered")
    files.write_ordered(d["v_nodevalue"].join(names, "Attribute").select("Node", "Name", "Value"), ["Name", "Node"], path)
    return files.read_ordered(d.spark, path).select("Row", "Node", "Name", "Value")


# ---------------------------------------------------------- whole projects


@query(
    "project_roundtrip",
    """SELECT 'Tagging' AS Tab, Id, concat_ws('|', Source, coalesce(Node, '-'), Fragment, coalesce(Memo, '-')) AS Content FROM {v_tagging}
       UNION ALL SELECT 'Node', Id, concat_ws('|', coalesce(Parent, '-'), coalesce(Category, '-'), Name, CAST(Color AS STRING)) FROM {v_node}
       UNION ALL SELECT 'Source', Id, concat_ws('|', Category, Name, md5(Content)) FROM {v_source}""",
)
def project_roundtrip(d):
    """A project written as a whole, twice, and read through its manifest."""
    path = place(d, "project")
    write_project({k: v.limit(0) for k, v in d.project("User").items()}, path)
    write_project(d.project(), path)
    p = read_project(d.spark, path)
    line = lambda t, *cells: p[t].select(F.lit(t).alias("Tab"), "Id", F.concat_ws("|", *cells).alias("Content"))
    or_none = lambda c: F.coalesce(c, F.lit("-"))
    return line("Tagging", "Source", or_none("Node"), "Fragment", or_none("Memo")).union(
        line("Node", or_none("Parent"), or_none("Category"), "Name", F.col("Color").cast("string"))
    ).union(line("Source", "Category", "Name", F.md5("Content")))


@query(
    "emptied_project",
    """SELECT 'Node' AS Tab, count(*) AS before, CAST(0 AS BIGINT) AS after FROM {v_node}
       UNION ALL SELECT 'Source', count(*), 0 FROM {v_source} UNION ALL SELECT 'Tagging', count(*), 0 FROM {v_tagging}""",
)
def emptied_project(d):
    """The tables of a stored project before and after they are emptied."""
    from codespan.sources.project import truncate_tables

    path = place(d, "project")
    write_project(d.project(), path)
    full = read_project(d.spark, path)
    write_project(truncate_tables(full), path)
    bare = read_project(d.spark, path)
    count = lambda p, t: p[t].select(F.count(F.lit(1))).scalar()
    return d["v_project"].select(F.explode(F.array(*[F.lit(t) for t in ("Node", "Source", "Tagging")])).alias("Tab")).select(
        "Tab",
        *[F.coalesce(*[F.when(F.col("Tab") == t, count(p, t)) for t in ("Node", "Source", "Tagging")]).alias(n)
          for n, p in (("before", full), ("after", bare))],
    )


@query(
    "query_csv_roundtrip",
    """SELECT Id, Source, coalesce(Memo, '') AS Memo, '' AS Missing FROM {v_tagging}""",
)
def query_csv_roundtrip(d):
    path = place(d, "csv")
    files.write_query_csv(d["v_tagging"], ["Id", "Source", "Memo", "Missing"], path, order=["Source", "Id"])
    return files.read_table_csv(d.spark, path).select(
        "Id", "Source", *[F.coalesce(c, F.lit("")).alias(c) for c in ("Memo", "Missing")])


@query(
    "sheet_records",
    """SELECT CAST(doc_id AS STRING) AS Name, md5(coalesce(text, '')) AS digest FROM {documents}""",
)
def sheet_records(d):
    """Whole texts as cells of a sheet: line ends, commas and quotes inside, cut into records by many tasks."""
    path = place(d, "sheet")
    files.write_query_csv(d["documents"].select(F.col("doc_id").cast("string").alias("doc"), "text"), ["doc", "text"], path)
    rows = files.read_table_csv(d.spark, path, namecol="doc")
    return rows.select("Name", F.md5(F.coalesce("text", F.lit(""))).alias("digest"))


@query(
    "exported_objects",
    """SELECT CASE WHEN row_number() OVER (PARTITION BY Name ORDER BY substring(md5(Id), 1, 3), Id) = 1
              THEN concat(Name, '.txt') ELSE concat(Name, '~', md5(Id), '.txt') END AS file, md5(Content) AS digest
       FROM (SELECT Id, concat('doc_', lang) AS Name, Content FROM (SELECT concat('d', CAST(doc_id AS STRING)) AS Id, lang,
               coalesce(text, '') AS Content FROM {documents}) x) y WHERE Name LIKE 'doc%'""",
)
def exported_objects(d):
    """Objects that share a few names, as files of their own, read back."""
    path = place(d, "objects")
    sources = d["documents"].select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("Id"),
        F.concat(F.lit("doc/"), "lang").alias("Name"), F.lit("TXT").alias("ObjectType"),
        F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("Object"),
    )
    objects.export_objects(sources, "doc%", path)
    back = objects.read_objects(d.spark, path)
    return back.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.md5("content").alias("digest"))


# --------------------------------------------------------------- flat code


@query(
    "flatcode_appends",
    """SELECT 'source' AS Tab, 2 * count(*) AS n FROM {documents} UNION ALL SELECT 'freecode', 2 * count(*) FROM {supplier}
       UNION ALL SELECT 'filecat', 2 * count(*) FROM {nation} UNION ALL SELECT 'treefile', 4 * count(*) FROM {documents}
       UNION ALL SELECT 'coding', 2 * count(*) FROM {lineitem} WHERE l_linenumber <> 3
       UNION ALL SELECT 'annotation', 2 * count(*) FROM {lineitem} WHERE l_linenumber = 3
       UNION ALL SELECT 'image', 0""",
)
def flatcode_appends(d):
    """A flat-code project appended twice, as its manifest then shows it."""
    path = place(d, "flat")
    raw = _raw_flat(d)
    write_flatcode(raw, path)
    write_flatcode(raw, path)
    back = read_project(d.spark, path, FLATCODE)
    tables = ["source", "freecode", "filecat", "treefile", "coding", "annotation", "image"]
    counted = [back[t].agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("Tab"), "n") for t in tables]
    out = counted[0]
    for c in counted[1:]:
        out = out.unionByName(c)
    return out


@query("import_flatcode_again", f"SELECT * FROM ({_LINKED}) u")
def import_flatcode_again(d):
    """A stored flat-code project imported into a base that has it already: nothing doubles."""
    path = place(d, "flat")
    write_flatcode(_raw_flat(d), path)
    raw = read_flatcode_project(d.spark, path)
    p = flatcode.import_flatcode(raw, base=between(flatcode.import_flatcode(raw)))
    sources = p["Source"].select(F.col("Id").alias("s"), F.col("Name").alias("SourceName"))
    nodes = p["Node"].select(F.col("Id").alias("n"), F.col("Name").alias("NodeName"))
    users = p["User"].select(F.col("Id").alias("u"), F.col("Name").alias("Author"))
    return (
        p["Tagging"].join(sources, F.col("Source") == F.col("s")).join(nodes, F.col("Node") == F.col("n"), "left")
        .join(users, F.col("CreatedBy") == F.col("u"))
        .select(F.col("SourceName").alias("Source"), F.col("NodeName").alias("Node"), "Fragment", "Author")
    )


@query(
    "text_only_sources",
    """SELECT Name, md5(Content) AS digest FROM {v_source} WHERE substring(Id, 3, 1) <> '1'""",
)
def text_only_sources(d):
    """Sources without text have no place in the flat-code layout."""
    p = d.project()
    second = F.substring("Id", 3, 1) == "1"
    p["Source"] = p["Source"].withColumn("Content", F.when(~second, F.col("Content")))
    out = flatcode.export_flatcode(p, NOW, actions=Actions("skip", sources="merge", project="merge"))
    return out["source"].select(F.col("name").alias("Name"), F.md5("file").alias("digest"))


@query(
    "staged_export",
    """SELECT 'freecode' AS Tab, count(*) AS n FROM {v_node} WHERE Id NOT IN (SELECT Node FROM {v_nodevalue})
         AND CreatedBy IN (SELECT Id FROM {v_user})
       UNION ALL SELECT 'cases', count(*) FROM {v_node} WHERE Id IN (SELECT Node FROM {v_nodevalue})
         AND CreatedBy IN (SELECT Id FROM {v_user})
       UNION ALL SELECT t, 0 FROM (VALUES ('source'), ('coding'), ('codecat'), ('project'), ('caseAttr')) AS x(t)""",
)
def staged_export(d):
    """Only the stage that was asked for writes rows."""
    out = flatcode.export_flatcode(d.project(), NOW, actions=Actions("skip", nodes="merge"))
    tables = ["freecode", "cases", "source", "coding", "codecat", "project", "caseAttr"]
    counted = [out[t].agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("Tab"), "n") for t in tables]
    whole = counted[0]
    for c in counted[1:]:
        whole = whole.unionByName(c)
    return whole


# ------------------------------------------------------- other layouts, parts


@query(
    "read_legacy_layout",
    """SELECT 'Item' AS Tab, count(*) AS n FROM {v_node} UNION ALL SELECT 'Source', count(*) FROM {v_source}
       UNION ALL SELECT 'Thumbnail', count(*) FROM {v_source}""",
)
def read_legacy_layout(d):
    """Graph tables with the column names of a later version."""
    raw = legacy_raw(d)
    later = raw | {"Source": raw["Source"].drop("Thumbnail", "Waveform").withColumn(
        "ThumbnailLocation", F.encode(F.substring("PlainText", 1, 2), "UTF-8")).withColumn("WaveformLocation", F.lit(None).cast("binary"))}
    p = read_legacy(later)
    count = lambda df, t: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("Tab"), "n")
    return count(p["Item"].filter(F.col("TypeId") == 16), "Item").union(count(p["Source"], "Source")).union(
        count(p["Source"].filter(F.col("Thumbnail").isNotNull()), "Thumbnail"))


VIEWS["v_rectangle"] = """
SELECT l_partkey AS images_id, l_suppkey AS codes_id, l_linenumber AS x1, l_orderkey % 1000 AS x2, l_shipdate AS made
FROM {lineitem}"""


@query(
    "imagecoding_ids",
    """SELECT count(*) AS taggings, count(*) AS ids FROM {v_rectangle}""",
)
def imagecoding_ids(d):
    """Every rectangle has an id of its own, equal ones too."""
    raw = read_imagecoding(_raw_images(d))
    doubled = raw | {"imageCoding": raw["imageCoding"]}
    rows = imagecoding.import_imagecoding(doubled)["Tagging"]
    return rows.agg(F.count(F.lit(1)).alias("taggings"), F.count_distinct("Id").alias("ids"))


@query(
    "layout_elements",
    """SELECT Category, Place, 'Row' AS Tag, Id AS Item, Place AS "Index" FROM (
         SELECT Category, Id, row_number() OVER (PARTITION BY Category ORDER BY substring(md5(Id), 1, 3), Id) - 1 AS Place
         FROM {v_node} WHERE Category IS NOT NULL) x""",
)
def layout_elements(d):
    """Layout documents written in many parts and read back element by element."""
    raw = legacy_export.export_layouts(legacy_raw(d, "mac"), "node_classification", member="item_category")
    parts = legacy_export.category_layouts(raw, "node_classification", member="item_category", rows_per_part=3)
    return legacy_export.read_layouts({"Category": parts})


@query(
    "nested_roundtrip",
    """SELECT s.Id, u.Name AS author, coalesce(t.Node, '-') AS node, coalesce(t.Memo, '-') AS memo,
         CAST(split_part(Fragment, ':', 1) AS BIGINT) - 1 AS "offset",
         CAST(split_part(Fragment, ':', 2) AS BIGINT) - CAST(split_part(Fragment, ':', 1) AS BIGINT) + 1 AS length, t.CreatedDate AS created
       FROM {v_source} s JOIN {v_tagging} t ON t.Source = s.Id JOIN {v_user} u ON u.Id = t.ModifiedBy""",
)
def nested_roundtrip(d):
    """Nested documents in parts of ten taggings, written as JSON and read back, with all their content."""
    path = place(d, "nested")
    nested.export_nested(d.project(), path, rows_per_part=10)
    _, taggings = nested.read_nested(d.spark, path)
    dash = lambda c: F.coalesce(c, F.lit("-")).alias(c)
    return taggings.select("Id", "author", dash("node"), dash("memo"), "offset", "length", F.col("created").cast("timestamp_ntz").alias("created"))


# ---------------------------------------------------------------- reports


VIEWS["v_person"] = "SELECT CAST(c_custkey AS STRING) AS Id, c_name AS Name, c_mktsegment AS Segment FROM {customer}"
VIEWS["v_person2"] = """SELECT CAST(c_custkey + CASE WHEN c_custkey % 5 = 0 THEN 1000000 ELSE 0 END AS STRING) AS Id, c_name AS Name,
  CASE WHEN c_custkey % 7 = 0 THEN 'NEW' ELSE c_mktsegment END AS Segment FROM {customer} WHERE c_custkey % 3 = 0"""


@query(
    "merge_report",
    """SELECT 'merge' AS Operation, o AS Outcome, n FROM (SELECT unnest(['inserted', 'updated', 'kept']) AS o, unnest([i, u, k]) AS n FROM (
         SELECT CAST((SELECT count(*) FROM {v_person2} WHERE Id NOT IN (SELECT Id FROM {v_person})) AS BIGINT) AS i,
           CAST((SELECT count(*) FROM {v_person2} b JOIN {v_person} a USING (Id) WHERE a.Segment <> b.Segment) AS BIGINT) AS u,
           CAST((SELECT count(*) FROM {v_person}) - (SELECT count(*) FROM {v_person2} b JOIN {v_person} a USING (Id)
             WHERE a.Segment <> b.Segment) AS BIGINT) AS k) x) y""",
)
def merge_report(d):
    report = Report(d.spark)
    before = d["v_person"]
    after = merge.merge_table(before, d["v_person2"], ["Id"], "overwrite")
    watch_merge(report, "merge", before, after, ["Id"]).write.parquet(place(d, "merged"))
    return report.rows()


@query(
    "tagging_report",
    """SELECT 'taggings' AS Operation, o AS Outcome, CAST(n AS BIGINT) AS n FROM (SELECT unnest(['inserted', 'rejected']) AS o, unnest([a, b]) AS n FROM (
         SELECT count(*) FILTER (ok) AS a, count(*) FILTER (NOT ok) AS b FROM (
           SELECT regexp_matches(f.Fragment, '^[0-9]+:[0-9]+$') AND CAST(split_part(f.Fragment || ':', ':', 2) AS VARCHAR) <> '' AS ok
           FROM {v_fragment} f) x) y) z""",
)
def tagging_report(d):
    """How many rows of a sheet became taggings, counted by the job that writes them."""
    report = Report(d.spark)
    good = F.col("Fragment").rlike(r"^[0-9]+:[0-9]+$")
    rows = report.watch("taggings", d["v_fragment"], inserted=good, rejected=~good)
    rows.filter(good).write.parquet(place(d, "taggings"))
    return report.rows()


@query(
    "date_report",
    """SELECT 'dates' AS Operation, 'concerned' AS Outcome, count(*) AS n FROM {orders} WHERE o_orderdate <= TIMESTAMP '1995-01-01 00:00:00'
       UNION ALL SELECT 'dates', 'untouched', count(*) FROM {orders} WHERE NOT o_orderdate <= TIMESTAMP '1995-01-01 00:00:00'""",
)
def date_report(d):
    report = Report(d.spark)
    rows = d["orders"].select(
        F.col("o_orderkey").alias("Id"), F.col("o_orderdate").cast("timestamp").alias("CreatedDate"),
        F.col("o_orderdate").cast("timestamp").alias("ModifiedDate"))
    moved = merge.shift_dates(rows, datetime(1995, 1, 1), "1 day", NOW)
    watched = report.watch("dates", moved, concerned=F.col("Concerned"), untouched=~F.col("Concerned"))
    watched.write.parquet(place(d, "dates"))
    return report.rows()


@query(
    "speaker_report",
    """SELECT 'speakers' AS Operation, 'tagged' AS Outcome, count(*) FILTER (role = 'user') AS n FROM {conversations}
       UNION ALL SELECT 'speakers', 'unknown', count(*) FILTER (role <> 'user') FROM {conversations}""",
)
def speaker_report(d):
    """Lines by speakers that are nodes, and by others, counted while the taggings are written."""
    report = Report(d.spark)
    texts = d["conversations"].select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("Id"),
        F.concat("role", F.lit(": "), F.regexp_replace("text", "[:\n]", " ")).alias("Content"))
    lines = tagging.speaker_lines(texts)
    known = F.col("Speaker") == "user"
    watched = report.watch("speakers", lines, tagged=known, unknown=~known)
    watched.filter(known).write.parquet(place(d, "speakers"))
    return report.rows()
