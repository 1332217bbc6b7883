"""Matching records of two projects whose keys differ, and comparing them.

Two records match when their natural columns agree, key-valued columns being
read through what they refer to.  That makes matching an equivalence: each
record gets a *class*, a digest of its natural values, and records match when
their classes are equal.  Every further rule for the same records refines the
partition.  A class shared by very many records on both sides costs one row per
record, never one per pair: inside it, records are paired by rank.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codespan.operators.numbering import number_rows
from codespan.schemas import LEGACY_KEYS
from codespan.session import cut

Project = dict[str, DataFrame]

# What identifies a record of the legacy graph, in order.
MATCH_RULES = [
    ("UserProfile", ["Name"], []),
    ("Project", [], []),
    ("Item", ["TypeId", "Name", "HierarchicalName"], []),
    ("NodeReference", [], ["Node_Item_Id", "Source_Item_Id"]),
]
IGNORED = ["CreatedBy", "CreatedDate", "ModifiedBy", "ModifiedDate", "RevisionId"]
KEY_VALUED = [
    "Id", "Item_Id", "Item1_Id", "Item2_Id", "Node_Item_Id", "Source_Item_Id", "CreatedBy", "ModifiedBy",
    "ContentLocation",
]
XML_COLUMNS = ["Properties", "Layout"]


def _digest(parts: list[Column]) -> Column:
    marked = [F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("-")) for p in parts]
    return F.md5(F.concat_ws("\u001f", F.lit(""), *marked))


def _through(df: DataFrame, column: str, classes: DataFrame) -> DataFrame:
    """Add ``_c_<column>``: the class a key stands for, or the key itself."""
    known = classes.select(F.col("Id").alias("_k"), F.col("Class").alias("_v"))
    return df.join(known, F.col(column) == F.col("_k"), "left").withColumn(
        f"_c_{column}", F.coalesce("_v", F.col(column).cast("string"))
    ).drop("_k", "_v")


def record_classes(df: DataFrame, columns: list[str], keys: list[str], classes: DataFrame | None = None) -> DataFrame:
    """Id and Class of each record.

    ``columns`` compare as they are, ``keys`` through ``classes`` (Id, Class).
    With neither, all records are alike.
    """
    for key in keys:
        df = _through(df, key, classes) if classes is not None else df.withColumn(f"_c_{key}", F.col(key))
    parts = [F.col(c) for c in columns] + [F.col(f"_c_{k}") for k in keys]
    return df.select("Id", _digest(parts).alias("Class"))


def refine(a: DataFrame, b: DataFrame) -> DataFrame:
    """Classes under both of two rules: a record that only one knows keeps its class there."""
    other = b.select(F.col("Id").alias("_i"), F.col("Class").alias("_b"))
    return a.join(other, F.col("Id") == F.col("_i"), "full").select(
        F.coalesce("Id", "_i").alias("Id"),
        F.when(F.col("_b").isNull(), F.col("Class")).when(F.col("Class").isNull(), F.col("_b"))
        .otherwise(F.md5(F.concat("Class", "_b"))).alias("Class"),
    )


def match_entities(p1: Project, p2: Project, rules=MATCH_RULES) -> tuple[DataFrame, DataFrame]:
    """Id and Class of every record of both projects, one class a record.

    Rules go in order; key-valued columns are read through the classes that the
    rules before have built.  Several rules for one table, or tables that share
    ids, meet in one class: records match when they agree under all of them.
    """
    def build(p: Project) -> DataFrame:
        out = None
        for table, columns, keys in rules:
            if table not in p or "Id" not in p[table].columns:
                continue
            fresh = record_classes(p[table], columns, keys, out)
            out = fresh if out is None else refine(out, fresh)
        return out

    return build(p1), build(p2)


def zero_matches(c1: DataFrame, c2: DataFrame) -> DataFrame:
    """Records of the first side whose class the second side lacks."""
    return c1.join(c2.select("Class"), "Class", "left_anti").select("Id", "Class")


def key_text(keys: list[str]) -> Column:
    """The values of a key as one text that no other values give: parts by ``|``, null as ``\\N``."""
    escaped = lambda k: F.replace(F.replace(F.col(k).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
    return F.concat_ws("|", *[F.coalesce(escaped(k), F.lit("\\N")) for k in keys]) if keys else F.lit("")


def _keyed(df: DataFrame, keys: list[str], classes: DataFrame) -> DataFrame:
    """Rows with ``_class`` (keys read through classes) and ``_key`` (as they are)."""
    for k in keys:
        if k in KEY_VALUED:
            df = _through(df, k, classes)
    parts = [F.col(f"_c_{k}") if k in KEY_VALUED else F.col(k) for k in keys]
    return df.withColumn("_class", _digest(parts)).withColumn("_key", key_text(keys))


def _meet(rows: DataFrame, group: list[str], shared: bool) -> tuple[DataFrame, DataFrame]:
    """Rows of the two sides paired by rank inside a group, and those left over.

    A group that many rows may share is ranked by bucketed numbering, so by many
    tasks; a (group, rank) then holds one row of a side at most.
    """
    if shared:
        ranked = number_rows(rows, ["_key", "_body"], "_rank", group=["_side", *group])
    else:
        order = Window.partitionBy("_side", *group).orderBy("_body")
        ranked = rows.withColumn("_rank", F.row_number().over(order))
    side = lambda n: F.first(F.when(F.col("_side") == n, F.struct("_key", "_class", "_body")), ignorenulls=True)
    met = cut(ranked.groupBy(*group, "_rank").agg(side(1).alias("_1"), side(2).alias("_2")).select("_1", "_2"))
    pairs = met.filter("_1 is not null and _2 is not null")
    rest = met.filter("_1 is null or _2 is null").select(
        F.when(F.col("_1").isNotNull(), 1).otherwise(2).alias("_side"), F.inline(F.array(F.coalesce("_1", "_2")))
    )
    return pairs, rest


def pair_rows(r1: DataFrame, r2: DataFrame) -> DataFrame:
    """Key1, Key2, _body1, _body2: every row of both sides with its partner's key, or null; no row has two.

    Partners are, as long as any are left: rows of one class and key; of one class
    and content (``_body``); of one class, by rank; of one key.
    """
    slim = lambda r, n: r.select(F.lit(n).alias("_side"), "_key", "_class", "_body")
    rest = slim(r1, 1).unionByName(slim(r2, 2))
    found = []
    for group, shared in (
        (["_class", "_key"], False), (["_class", "_body"], True), (["_class"], True), (["_key"], False)
    ):
        pairs, rest = _meet(rest, group, shared)
        found.append(pairs.select(
            F.col("_1._key").alias("Key1"), F.col("_2._key").alias("Key2"),
            F.col("_1._body").alias("_body1"), F.col("_2._body").alias("_body2"),
        ))
        if rest.isEmpty():
            break
    own = lambda n, c: F.when(F.col("_side") == n, F.col(c))
    found.append(rest.select(
        own(1, "_key").alias("Key1"), own(2, "_key").alias("Key2"),
        own(1, "_body").alias("_body1"), own(2, "_body").alias("_body2"),
    ))
    return reduce(DataFrame.unionByName, found)


def _compared(t1: DataFrame, t2: DataFrame, ignore: list[str]) -> list[str]:
    return [
        c for c in t1.columns
        if c in t2.columns and c not in ignore and c not in KEY_VALUED and c not in XML_COLUMNS
    ]


def _sides(
    t1: DataFrame, t2: DataFrame, keys: list[str], classes1: DataFrame, classes2: DataFrame, compared: list[str]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    body = _digest([F.col(c) for c in compared])
    r1, r2 = (_keyed(t, keys, c).withColumn("_body", body) for t, c in ((t1, classes1), (t2, classes2)))
    return r1, r2, pair_rows(r1, r2)


def _differences(r1: DataFrame, r2: DataFrame, pairs: DataFrame, compared: list[str]) -> DataFrame:
    """``only in`` rows and, for pairs whose contents differ, a row per differing column."""
    null = F.lit(None).cast("string")
    only = pairs.filter("Key1 is null or Key2 is null").select(
        "Key1", "Key2",
        F.when(F.col("Key2").isNull(), "only in 1").otherwise("only in 2").alias("Status"),
        null.alias("Column"), null.alias("Value1"), null.alias("Value2"),
    )
    if not compared:
        return only
    # Only differing pairs fetch their rows; of a key's repeated rows one per content.
    changed = pairs.filter("Key1 is not null and Key2 is not null and _body1 <> _body2")
    whole = lambda r, n: r.select(
        F.col("_key").alias(f"_k{n}"), F.col("_body").alias(f"_b{n}"), F.struct(*compared).alias(f"_r{n}")
    )
    wanted = lambda r, n: whole(r, n).join(
        changed.select(F.col(f"Key{n}").alias(f"_k{n}"), F.col(f"_body{n}").alias(f"_b{n}")), [f"_k{n}", f"_b{n}"], "left_semi"
    ).dropDuplicates([f"_k{n}", f"_b{n}"])
    both = changed.join(
        wanted(r1, 1), (F.col("Key1") == F.col("_k1")) & (F.col("_body1") == F.col("_b1"))
    ).join(wanted(r2, 2), (F.col("Key2") == F.col("_k2")) & (F.col("_body2") == F.col("_b2")))
    text = lambda c: c.cast("string")
    cells = F.array(*[
        F.struct(
            F.lit(c).alias("Column"), text(F.col("_r1")[c]).alias("Value1"), text(F.col("_r2")[c]).alias("Value2"),
            (~F.col("_r1")[c].eqNullSafe(F.col("_r2")[c])).alias("Differs"),
        )
        for c in compared
    ])
    differing = both.select("Key1", "Key2", F.inline(F.filter(cells, lambda x: x["Differs"]))).select(
        "Key1", "Key2", F.lit("differs").alias("Status"), "Column", "Value1", "Value2"
    )
    return only.unionByName(differing)


def compare_table(
    t1: DataFrame,
    t2: DataFrame,
    keys: list[str],
    classes1: DataFrame,
    classes2: DataFrame,
    ignore: list[str] = IGNORED,
) -> DataFrame:
    """Key1, Key2, Status, Column, Value1, Value2.

    ``only in 1`` and ``only in 2`` rows have no column; ``differs`` rows come
    one per differing column.  Key-valued columns are not compared.
    """
    compared = _compared(t1, t2, ignore)
    r1, r2, pairs = _sides(t1, t2, keys, classes1, classes2, compared)
    return _differences(r1, r2, pairs, compared)


def xml_elements(df: DataFrame, key: str, column: str) -> DataFrame:
    """Elements of an XML document in order: tag, attributes, Guid, text.

    Attributes are sorted by name and leave out ``Guid``, which refers to a
    record.
    """
    elements = F.regexp_extract_all(F.col(column), F.lit(r"<[A-Za-z][^>]*>[^<]*"), F.lit(0))
    rows = df.filter(F.col(column).isNotNull()).select(key, F.posexplode(elements).alias("Pos", "_e"))
    attributes = F.regexp_extract_all("_e", F.lit(r'[\w:]+\s*=\s*"[^"]*"'), F.lit(0))
    plain = F.filter(attributes, lambda a: ~a.startswith("Guid") & ~a.startswith("xmlns"))
    guid = F.regexp_extract("_e", r'Guid\s*=\s*"([^"]*)"', 1)
    return rows.select(
        key, "Pos", F.regexp_extract("_e", r"^<([\w:]+)", 1).alias("Tag"),
        F.array_sort(plain).alias("Attributes"),
        F.when(guid != "", F.lower(guid)).alias("Guid"),
        F.trim(F.regexp_extract("_e", r">([^<]*)$", 1)).alias("Text"),
    )


def xml_differences(
    pairs: DataFrame, x1: DataFrame, x2: DataFrame, classes1: DataFrame, classes2: DataFrame
) -> DataFrame:
    """First difference of each pair of documents: Key1, Key2, Pos, Difference.

    ``pairs``: Key1, Key2.  ``x1``/``x2``: output of :func:`xml_elements` with a
    column ``Key``.  Ids compare through the classes of what they refer to.
    """
    def side(x: DataFrame, classes: DataFrame, n: int) -> DataFrame:
        y = _through(x, "Guid", classes)
        return y.select(
            F.col("Key").alias(f"_k{n}"), F.col("Pos").alias(f"_p{n}"), F.col("Tag").alias(f"_t{n}"),
            F.col("Attributes").alias(f"_a{n}"), F.col("_c_Guid").alias(f"_g{n}"), F.col("Text").alias(f"_x{n}"),
        )

    known = pairs.filter(F.col("Key2").isNotNull())
    left = known.join(side(x1, classes1, 1), F.col("Key1") == F.col("_k1"))
    right = known.select(F.col("Key1").alias("_q1"), F.col("Key2").alias("_q2")).join(
        side(x2, classes2, 2), F.col("_q2") == F.col("_k2")
    )
    both = left.join(right, (F.col("Key1") == F.col("_q1")) & (F.col("_p1") == F.col("_p2")), "full")
    tag = F.coalesce("_t1", "_t2")
    where = F.concat(F.lit("/"), tag, F.lit("["), F.coalesce("_p1", "_p2").cast("string"), F.lit("]"))
    attribute = F.array_except("_a1", "_a2")
    other = F.array_except("_a2", "_a1")
    difference = (
        F.when(F.col("_t2").isNull(), F.concat(where, F.lit(" missing from 2")))
        .when(F.col("_t1").isNull(), F.concat(where, F.lit(" missing from 1")))
        .when(F.col("_t1") != F.col("_t2"), F.concat(where, F.lit(" != "), "_t2"))
        .when(
            F.col("_a1") != F.col("_a2"),
            F.concat(where, F.lit(":"), F.array_join(attribute, " "), F.lit(" != "), F.array_join(other, " ")),
        )
        .when(~F.col("_g1").eqNullSafe(F.col("_g2")), F.concat(where, F.lit(":Guid")))
        .when(F.col("_x1") != F.col("_x2"), F.concat(where, F.lit(" text differs")))
    )
    found = both.select(
        F.coalesce("Key1", "_q1").alias("Key1"), F.coalesce("Key2", "_q2").alias("Key2"),
        F.coalesce("_p1", "_p2").alias("Pos"), difference.alias("Difference"),
    ).filter(F.col("Difference").isNotNull())
    return found.groupBy("Key1", "Key2").agg(
        F.min("Pos").alias("Pos"), F.min_by("Difference", "Pos").alias("Difference")
    )


def compare_projects(
    p1: Project,
    p2: Project,
    tables: list[str] | None = None,
    ignore: list[str] = IGNORED,
    rules=MATCH_RULES,
    keys: dict[str, list[str]] = LEGACY_KEYS,
) -> DataFrame:
    """Table, Key1, Key2, Status, Column, Value1, Value2 over several tables."""
    classes1, classes2 = (cut(c) for c in match_entities(p1, p2, rules))
    out = []
    for table in tables or [t for t in keys if t in p1 and t in p2]:
        t1, t2 = p1[table], p2[table]
        compared = _compared(t1, t2, ignore)
        r1, r2, pairs = _sides(t1, t2, keys[table], classes1, classes2, compared)
        out.append(_differences(r1, r2, pairs, compared).withColumn("Table", F.lit(table)))
        for column in XML_COLUMNS:
            if column in t1.columns and column in t2.columns:
                x1, x2 = (xml_elements(r.withColumnRenamed("_key", "Key"), "Key", column) for r in (r1, r2))
                diff = xml_differences(pairs.filter("Key1 is not null").select("Key1", "Key2"), x1, x2, classes1, classes2)
                out.append(diff.select(
                    "Key1", "Key2", F.lit("differs").alias("Status"), F.lit(column).alias("Column"),
                    F.col("Difference").alias("Value1"), F.lit(None).cast("string").alias("Value2"),
                    F.lit(table).alias("Table"),
                ))
    return reduce(DataFrame.unionByName, out)
