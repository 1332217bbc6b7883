"""Bulk loading of nodes and sources from sheets."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codespan.functions.guard import demand
from codespan.functions.ids import deterministic_id
from codespan.functions.text import running_totals
from codespan.functions.values import canonical_value, value_error
from codespan.operators import attributes as A
from codespan.operators.merge import get_or_create, lowest_id_by_name, merge_table, upsert_values
from codespan.operators.numbering import default_names
from codespan.schemas import DEFAULT_DESCRIPTION
from codespan.session import cut, settle
from codespan.sources.project import shape

Project = dict[str, DataFrame]

NODE_RESERVED = ["Name", "Description", "Category", "Parent", "Aggregate", "Color", "Row"]
SOURCE_RESERVED = ["Name", "Description", "Category", "Color", "Text", "ObjectFile", "Row"]
TEXT_CATEGORY = "Text Columns"


def _blank_as_null(c: str) -> Column:
    return F.when(F.col(c) != "", F.col(c))


def _complete(sheet: DataFrame, defaults: dict[str, object]) -> DataFrame:
    for name, value in defaults.items():
        if name not in sheet.columns:
            sheet = sheet.withColumn(name, F.lit(value).cast("string"))
    return sheet


def _stamps(user: str, now: datetime) -> dict[str, Column]:
    return {"CreatedBy": F.lit(user), "CreatedDate": F.lit(now), "ModifiedBy": F.lit(user), "ModifiedDate": F.lit(now)}


def define_attributes(
    p: Project, entity: str, sheet: DataFrame, columns: list[str], user: str, now: datetime, ignore_blank: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(attribute table with new ones added, name -> Id, Type, Length)."""
    table = p[f"{entity}Attribute"]
    if not columns:
        return table, lowest_id_by_name(table).select("Name", "Id", F.lit("text").alias("Type"), F.lit(0).alias("Length")).limit(0)
    inferred = A.infer_attribute_types(sheet, columns, ignore_blank)
    lowest = lowest_id_by_name(table).select("Id")
    known = table.join(lowest, "Id", "left_semi").select("Name", "Id", F.lower("Type").alias("Type"), "Length")
    fresh = inferred.join(known, "Name", "left_anti").select(
        deterministic_id(f"{entity}Attribute", F.col("Name")).alias("Id"), "Name",
        F.lit(DEFAULT_DESCRIPTION).alias("Description"), "Type", "Length",
        *[c.alias(k) for k, c in _stamps(user, now).items()],
    )
    used = known.join(inferred.select("Name"), "Name", "left_semi")
    grown = table.unionByName(shape(fresh, table.schema))
    return grown, used.unionByName(fresh.select("Name", "Id", "Type", "Length"))


def _values(rows: DataFrame, entity: str, columns: list[str], attributes: DataFrame, user: str, now: datetime) -> DataFrame:
    """Canonical value rows; a value that does not fit its attribute fails the load."""
    cells = A.unpivot_values(rows.select(F.col("Id").alias(entity), *columns), entity, columns)
    known = attributes.select("Name", F.col("Id").alias("Attribute"), "Type", "Length")
    typed = cells.join(known, "Name").withColumn("_canonical", canonical_value(F.col("Value"), F.col("Type")))
    problem = value_error(F.col("Value"), F.col("Type"), F.col("Length"), F.col("_canonical"))
    message = F.concat(F.lit("value "), F.col("Value"), F.lit(" of "), F.col("Name"), F.lit(": "), problem)
    return demand(typed, problem.isNull(), message).select(
        entity, "Attribute", F.col("_canonical").alias("Value"), *[c.alias(k) for k, c in _stamps(user, now).items()]
    )


def _identify(rows: DataFrame, table: DataFrame, kind: str) -> DataFrame:
    """Ids for named sheet rows: ``Id``, ``IsNew``.

    An existing name keeps its id and, if the sheet repeats it, its last row
    counts.  A new name repeated makes as many new records.
    """
    known = lowest_id_by_name(table).select(F.col("Name").alias("_n"), F.col("Id").alias("_known"))
    ends = rows.groupBy("Name").agg(F.min("Row").alias("_first"), F.max("Row").alias("_last")).withColumnRenamed("Name", "_m")
    joined = rows.join(known, F.col("Name") == F.col("_n"), "left").join(ends, F.col("Name") == F.col("_m"))
    new_id = F.when(F.col("Row") == F.col("_first"), deterministic_id(kind, F.col("Name"))).otherwise(
        deterministic_id(kind, F.col("Name"), F.col("Row"))
    )
    kept = joined.filter(F.col("_known").isNull() | (F.col("Row") == F.col("_last")))
    return kept.select(
        *rows.columns, F.coalesce("_known", new_id).alias("Id"), F.col("_known").isNull().alias("IsNew"),
    )


def _upsert(table: DataFrame, rows: DataFrame, columns: list[str], user: str, now: datetime) -> DataFrame:
    stamps = _stamps(user, now)
    new = shape(rows.filter("IsNew").select("Id", *columns, *[c.alias(k) for k, c in stamps.items()]), table.schema)
    changed = rows.filter(~F.col("IsNew")).select(
        "Id", *columns, stamps["ModifiedBy"].alias("ModifiedBy"), stamps["ModifiedDate"].alias("ModifiedDate")
    )
    return merge_table(table, shape_some(changed, table), ["Id"], "overwrite").unionByName(new)


def shape_some(df: DataFrame, table: DataFrame) -> DataFrame:
    """Cast the columns of ``df`` to the types they have in ``table``."""
    return df.select(*[F.col(c).cast(table.schema[c].dataType).alias(c) for c in df.columns])


def resolve_parents(rows: DataFrame, table: DataFrame, user: str, now: datetime) -> tuple[DataFrame, DataFrame]:
    """Parent ids by name and the nodes made for unknown parents.

    A new row of that name comes first, then an existing node, then a new node.
    """
    named = rows.filter("IsNew").groupBy("Name").agg(F.min_by("Id", "Row").alias("Id"), F.lit(0).alias("rank"))
    known = lowest_id_by_name(table).select("Name", "Id", F.lit(1).alias("rank"))
    wanted = rows.select(_blank_as_null("Parent").alias("Name")).dropna().distinct()
    created = wanted.select("Name", deterministic_id("Node", F.col("Name")).alias("Id"), F.lit(2).alias("rank"))
    ids = named.unionByName(known).unionByName(created).groupBy("Name").agg(
        F.min_by("Id", "rank").alias("Id"), F.min("rank").alias("rank")
    )
    made = wanted.join(ids.filter("rank = 2"), "Name").select(
        "Id", "Name", F.lit(DEFAULT_DESCRIPTION).alias("Description"),
        *[c.alias(k) for k, c in _stamps(user, now).items()],
    )
    parents = ids.select(F.col("Name").alias("_p"), F.col("Id").alias("ParentId"))
    return rows.join(parents, F.col("Parent") == F.col("_p"), "left").drop("_p"), shape(made, table.schema)


def load_nodes(
    p: Project,
    sheet: DataFrame,
    user: str,
    now: datetime,
    defaults: dict[str, str] | None = None,
    attributes: list[str] | None = None,
    include: list[str] | None = None,
    exclude: list[str] | None = None,
    ignore_blank: bool = True,
) -> Project:
    """Insert or update nodes by name; further columns of the sheet are attributes.

    The sheet is parsed once, and the tables that change are written, as a load is a
    step of its own.
    """
    sheet = cut(sheet)
    defaults = {
        "Name": None, "Description": DEFAULT_DESCRIPTION, "Category": None, "Parent": None,
        "Aggregate": None, "Color": None,
    } | (defaults or {})
    full = A.with_attribute_args(_complete(sheet, defaults), attributes or [])
    columns = A.attribute_columns(full.columns, NODE_RESERVED, include, exclude)
    definitions, known = define_attributes(p, "Node", full, columns, user, now, ignore_blank)
    categories, category_ids = get_or_create(
        p["NodeCategory"], full.select(F.col("Category").alias("Name")), "NodeCategory", user, now
    )
    cats = category_ids.select(F.col("Name").alias("_c"), F.col("Id").alias("CategoryId"))
    named = default_names(full, "Name", "Row").join(cats, F.col("Category") == F.col("_c"), "left").drop("_c")
    rows, made = resolve_parents(_identify(named, p["Node"], "Node"), p["Node"], user, now)
    final = rows.select(
        "Id", "IsNew", "Name", "Description", F.col("CategoryId").alias("Category"), F.col("ParentId").alias("Parent"),
        _blank_as_null("Aggregate").try_cast("boolean").alias("Aggregate"),
        _blank_as_null("Color").try_cast("int").alias("Color"),
    )
    out = ["Name", "Description", "Category", "Parent", "Aggregate", "Color"]
    values = _values(rows, "Node", columns, known, user, now) if columns else None
    return settle(p | {
        "NodeCategory": categories,
        "NodeAttribute": definitions,
        "Node": _upsert(p["Node"], final, out, user, now).unionByName(made),
        "NodeValue": upsert_values(p["NodeValue"], values, "Node") if columns else p["NodeValue"],
    }, p)


def assemble_text(df: DataFrame, base: str, textcols: list[str]) -> DataFrame:
    """Join text columns into ``Content`` and list where each landed in ``Pieces``.

    Pieces are separated by a blank line and end with a newline.  With more
    than one column each piece has its column's name as heading and gives a
    fragment (one-based, end included) for the column's node.
    """
    headed = len(textcols) > 1
    start = F.coalesce(F.col(base), F.lit(""))
    bodies = F.filter(
        F.array(*[F.struct(F.lit(c).alias("Column"), F.concat(F.col(c), F.lit("\n")).alias("Text")) for c in textcols])
        if textcols else F.array().cast("array<struct<Column:string,Text:string>>"),
        lambda x: F.length(x["Text"]) > 1,
    )

    def lead(x, i):
        gap = F.when((i > 0) | (F.length(start) > 0), "\n\n").otherwise("")
        return F.concat(gap, x["Column"], F.lit("\n\n")) if headed else gap

    pieces = F.transform(
        bodies, lambda x, i: F.struct(x["Column"].alias("Column"), lead(x, i).alias("Lead"), x["Text"].alias("Text"))
    )
    staged = df.withColumn("_pieces", pieces)
    sizes = F.transform("_pieces", lambda x: (F.length(x["Lead"]) + F.length(x["Text"])).cast("long"))
    offsets = running_totals(sizes)
    text = F.concat(
        start, F.array_join(F.transform("_pieces", lambda x: F.concat(x["Lead"], x["Text"])), "")
    )
    placed = F.transform(
        F.arrays_zip(F.col("_pieces").alias("p"), offsets.alias("o")),
        lambda z: F.struct(
            z["p"]["Column"].alias("Column"),
            (F.length(start) + z["o"] + F.length(z["p"]["Lead"])).alias("start0"),
            (F.length(start) + z["o"] + F.length(z["p"]["Lead"]) + F.length(z["p"]["Text"])).alias("end0"),
        ),
    )
    return staged.withColumn("Content", text).withColumn("Pieces", placed).drop("_pieces")


def load_sources(
    p: Project,
    sheet: DataFrame,
    user: str,
    now: datetime,
    files: DataFrame | None = None,
    textcols: list[str] | None = None,
    defaults: dict[str, str] | None = None,
    attributes: list[str] | None = None,
    include: list[str] | None = None,
    exclude: list[str] | None = None,
    ignore_blank: bool = True,
) -> Project:
    """Insert or update sources by name, with text from cells, text columns or files.

    ``files`` is the output of ``read_source_files``; a sheet row picks one by
    ``ObjectFile``.  The sheet is parsed once, and the tables that change are
    written.
    """
    sheet = cut(sheet)
    textcols = textcols or []
    defaults = {
        "Name": None, "Description": None, "Category": None, "Color": None, "Text": None, "ObjectFile": None,
    } | (defaults or {})
    full = A.with_attribute_args(_complete(sheet, defaults), attributes or [])
    columns = A.attribute_columns(full.columns, SOURCE_RESERVED, include, exclude, textcols)
    definitions, known = define_attributes(p, "Source", full, columns, user, now, ignore_blank)
    categories, category_ids = get_or_create(
        p["SourceCategory"], full.select(F.col("Category").alias("Name")), "SourceCategory", user, now
    )
    cats = category_ids.select(F.col("Name").alias("_c"), F.col("Id").alias("CategoryId"))
    named = default_names(full, "Name", "Row", pad=True).join(cats, F.col("Category") == F.col("_c"), "left").drop("_c")
    rows = _identify(named, p["Source"], "Source")
    if files is not None:
        held = files.select(
            F.col("ObjectFile").alias("_f"), F.col("ObjectType").alias("_type"), F.col("Object").alias("_object"),
            F.col("Content").alias("_content"),
        )
        rows = rows.join(held, F.col("ObjectFile") == F.col("_f"), "left")
    else:
        rows = rows.withColumns({
            "_type": F.lit(None).cast("string"), "_object": F.lit(None).cast("binary"),
            "_content": F.lit(None).cast("string"),
        })
    kind = F.coalesce("_type", F.lit("TXT"))
    rows = rows.withColumn("_base", F.when(kind == "TXT", F.coalesce("_content", "Text", F.lit(""))))
    built = assemble_text(rows, "_base", textcols)
    content = F.when(kind == "TXT", F.col("Content"))
    final = built.select(
        "Id", "IsNew", "Name", F.coalesce(_blank_as_null("Description"), F.lit(DEFAULT_DESCRIPTION)).alias("Description"),
        F.col("CategoryId").alias("Category"), _blank_as_null("Color").try_cast("int").alias("Color"),
        kind.alias("ObjectType"), content.alias("Content"),
        F.when(kind == "TXT", F.encode(F.col("Content"), "UTF-8")).otherwise(F.col("_object")).alias("Object"),
    )
    out = ["Name", "Description", "Category", "Color", "ObjectType", "Content", "Object"]
    values = _values(rows, "Source", columns, known, user, now) if columns else None
    changed = {
        "SourceCategory": categories,
        "SourceAttribute": definitions,
        "Source": _upsert(p["Source"], final, out, user, now),
        "SourceValue": upsert_values(p["SourceValue"], values, "Source") if columns else p["SourceValue"],
    }
    tagged = _tag_text_columns(p, built, kind, textcols, user, now) if len(textcols) > 1 else {}
    return settle(p | changed | tagged, p)


def _tag_text_columns(
    p: Project, built: DataFrame, kind: Column, textcols: list[str], user: str, now: datetime
) -> Project:
    spark = p["Node"].sparkSession
    categories, ids = get_or_create(
        p["NodeCategory"], spark.createDataFrame([(TEXT_CATEGORY,)], "Name string"), "NodeCategory", user, now
    )
    category = ids.filter(F.col("Name") == TEXT_CATEGORY).select(F.min("Id")).scalar()
    inside = p["Node"].withColumn("_c", category).filter(F.col("Category") == F.col("_c")).drop("_c")
    grown, node_ids = get_or_create(
        inside, spark.createDataFrame([(c,) for c in textcols], "Name string"), f"Node:{TEXT_CATEGORY}", user, now
    )
    new = grown.join(p["Node"].select(F.col("Id").alias("_i")), F.col("Id") == F.col("_i"), "left_anti")
    pieces = built.filter(kind == "TXT").select(F.col("Id").alias("Source"), F.inline("Pieces"))
    tagged = pieces.join(node_ids.select(F.col("Name").alias("_n"), F.col("Id").alias("Node")), F.col("Column") == F.col("_n"))
    rows = tagged.select(
        deterministic_id("Tagging", F.lit("column"), F.col("Source"), F.col("Node")).alias("Id"), "Source", "Node",
        F.concat((F.col("start0") + 1).cast("string"), F.lit(":"), F.col("end0").cast("string")).alias("Fragment"),
        *[c.alias(k) for k, c in _stamps(user, now).items()],
    )
    return {
        "NodeCategory": categories,
        "Node": p["Node"].unionByName(shape(new.withColumn("Category", category), p["Node"].schema)),
        "Tagging": merge_table(p["Tagging"], shape(rows, p["Tagging"].schema), ["Id"], "overwrite"),
    }
