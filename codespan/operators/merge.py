"""Merging, upserting and patching tables.

Every function returns the new state of a table; nothing is changed in place.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codespan.functions.guard import demand
from codespan.functions.ids import deterministic_id
from codespan.schemas import AUDIT_COLUMNS, DEFAULT_DESCRIPTION, DEFAULT_USER, FORMAT_VERSION
from codespan.sources.project import shape

Project = dict[str, DataFrame]
MODES = ("skip", "merge", "overwrite", "replace")


def null_safe_equal(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


def unique_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """The same rows; any action fails when a key occurs twice."""
    rest = [c for c in df.columns if c not in keys]
    text = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    grouped = df.groupBy(*keys).agg(
        F.any_value(F.struct(F.lit(0).alias("_"), *rest)).alias("_row"), F.count(F.lit(1)).alias("_n")
    )
    checked = demand(grouped, F.col("_n") == 1, F.concat(F.lit("duplicate key in data: "), text))
    return checked.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def merge_table(target: DataFrame, data: DataFrame, keys: list[str], mode: str = "merge") -> DataFrame:
    """Bring ``data`` into ``target``.

    ``skip`` leaves the target as it is; ``merge`` adds rows with new keys;
    ``overwrite`` also updates the supplied columns of rows already there;
    ``replace`` also drops rows whose key the data lacks.  One join does it all.
    With no key columns the table is a single row.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if mode == "skip":
        return target
    supplied = [c for c in data.columns if c in target.columns]
    if not keys:
        return shape(data, target.schema) if mode != "merge" else _first_row_of(target, shape(data, target.schema))
    old = target.select(F.struct(*target.columns).alias("_old"), *[F.col(k).alias(f"_k_{k}") for k in keys])
    fresh = unique_rows(data.select(*supplied), keys)
    new = fresh.select(F.struct(*supplied).alias("_new"), *[F.col(k).alias(f"_d_{k}") for k in keys])
    on = reduce(lambda a, b: a & b, [F.col(f"_k_{k}").eqNullSafe(F.col(f"_d_{k}")) for k in keys])
    both = old.join(new, on, "right" if mode == "replace" else "full")

    def column(name: str) -> Column:
        kind = target.schema[name].dataType
        before = F.col("_old")[name]
        after = F.col("_new")[name].cast(kind) if name in supplied else F.lit(None).cast(kind)
        if mode == "merge" or name not in supplied:
            return F.when(F.col("_old").isNotNull(), before).otherwise(after).alias(name)
        return F.when(F.col("_new").isNotNull(), after).otherwise(before).alias(name)

    return both.select(*[column(c) for c in target.columns])


def _first_row_of(*tables: DataFrame) -> DataFrame:
    """The one row of the first table that has one."""
    ranked = reduce(
        DataFrame.unionByName, [t.withColumn("_rank", F.lit(i)) for i, t in enumerate(tables)]
    )
    columns = tables[0].columns
    best = ranked.agg(F.min_by(F.struct(*columns), "_rank").alias("_row")).filter(F.col("_row").isNotNull())
    return best.select("_row.*")


def _audit(user: Column, now: datetime) -> dict[str, Column]:
    stamp = F.lit(now)
    return {"CreatedBy": user, "CreatedDate": stamp, "ModifiedBy": user, "ModifiedDate": stamp}


def lowest_id_by_name(table: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """One Id per name (and extra columns); the lowest id wins."""
    return table.groupBy("Name", *(extra or [])).agg(F.min("Id").alias("Id"))


def get_or_create(
    dim: DataFrame,
    names: DataFrame,
    kind: str,
    user: Column | str | None,
    now: datetime,
    description: str | None = DEFAULT_DESCRIPTION,
    extra: dict[str, Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Ids for a column ``Name``; returns (the table with missing rows added, name -> Id).

    Blank names have no id.  A new row's id is a digest of its name.
    """
    user = F.lit(user) if not isinstance(user, Column) else user
    wanted = names.select("Name").filter(F.coalesce(F.col("Name"), F.lit("")) != "").distinct()
    known = lowest_id_by_name(dim)
    missing = wanted.join(known, "Name", "left_anti")
    row = {"Id": deterministic_id(kind, F.col("Name")), "Name": F.col("Name"), "Description": F.lit(description)}
    row |= _audit(user, now) | (extra or {})
    created = shape(missing.select(*[c.alias(k) for k, c in row.items()]), dim.schema)
    table = dim.unionByName(created)
    ids = known.select("Name", "Id").unionByName(created.select("Name", "Id"))
    return table, ids


def add_user(users: DataFrame, user_id: str, name: str) -> DataFrame:
    """A plain insert: a second user of the same name is allowed."""
    row = users.sparkSession.createDataFrame([(user_id, name)], users.schema)
    return users.unionByName(row)


def resolve_user(p: Project, name: str | None, now: datetime) -> tuple[Project, DataFrame]:
    """The acting user as a one-row frame ``Id``, with the tables that now hold them.

    A name means that user, created when new; otherwise the project's last
    editor; otherwise a default user together with a project row.
    """
    spark = p["User"].sparkSession
    if name is not None:
        wanted = spark.createDataFrame([(name,)], "Name string")
        users, ids = get_or_create(p["User"], wanted, "User", None, now)
        return p | {"User": users}, ids.join(wanted, "Name", "left_semi").select("Id")
    editor = p["Project"].agg(F.max("ModifiedBy").alias("Id"))
    fallback = deterministic_id("User", F.lit(DEFAULT_USER))
    acting = editor.select(F.coalesce("Id", fallback).alias("Id"))
    needed = editor.filter(F.col("Id").isNull()).select(
        fallback.alias("Id"), F.lit(DEFAULT_USER).alias("Name")
    )
    project_row = needed.select(
        F.lit(FORMAT_VERSION).alias("Version"), F.lit("").alias("Title"),
        F.lit(DEFAULT_DESCRIPTION).alias("Description"),
        *[c.alias(k) for k, c in _audit(F.col("Id"), now).items()],
    )
    return (
        p
        | {
            "User": p["User"].unionByName(needed),
            "Project": p["Project"].unionByName(shape(project_row, p["Project"].schema)),
        },
        acting,
    )


def upsert_by_name(
    table: DataFrame, rows: DataFrame, kind: str, user: Column | str, now: datetime
) -> DataFrame:
    """Insert or update rows by name.

    A row already there keeps its Id and Created columns; Modified columns
    always move.  Where two rows share a name the one with the lowest id is it.
    """
    user = F.lit(user) if not isinstance(user, Column) else user
    values = [c for c in rows.columns if c in table.columns and c not in ("Id", *AUDIT_COLUMNS)]
    known = lowest_id_by_name(table).select("Name", F.col("Id").alias("_id"))
    stamped = (
        unique_rows(rows.select(*values), ["Name"])
        .join(known, "Name", "left")
        .select(
            F.coalesce("_id", deterministic_id(kind, F.col("Name"))).alias("Id"),
            *values,
            *[
                (F.when(F.col("_id").isNull(), c) if k.startswith("Created") else c).alias(k)
                for k, c in _audit(user, now).items()
            ],
        )
    )
    merged = merge_table(table, stamped, ["Id"], "overwrite")
    # A row already there must keep its Created columns, which came in as null.
    old = table.select(
        F.col("Id").alias("_o"), F.col("CreatedBy").alias("_cb"), F.col("CreatedDate").alias("_cd")
    )
    return merged.join(old, F.col("Id") == F.col("_o"), "left").select(
        *[
            F.coalesce(F.col(c), F.col("_cb")).alias(c) if c == "CreatedBy"
            else F.coalesce(F.col(c), F.col("_cd")).alias(c) if c == "CreatedDate"
            else F.col(c)
            for c in table.columns
        ]
    )


def upsert_values(values: DataFrame, rows: DataFrame, entity: str) -> DataFrame:
    """Replace the (entity, attribute) pairs supplied and keep the others."""
    keys = [entity, "Attribute"]
    kept = values.join(rows.select(*keys), keys, "left_anti").select(*values.columns)
    return kept.unionByName(shape(unique_rows(rows, keys), values.schema))


def reassign_users(tables: Project, removed: DataFrame, project: DataFrame) -> Project:
    """Hand the traces of removed users (``Id``) to the project's own users."""
    gone = removed.select(F.col("Id").alias("_gone")).distinct()
    out = {}
    for name, df in tables.items():
        for role in ("Created", "Modified"):
            by, date = f"{role}By", f"{role}Date"
            if by not in df.columns:
                continue
            hit = df.join(gone, F.col(by) == F.col("_gone"), "left")
            owner, when = project.select(F.max(by)).scalar(), project.select(F.max(date)).scalar()
            df = hit.select(
                *[
                    F.when(F.col("_gone").isNotNull(), owner).otherwise(F.col(c)).alias(c) if c == by
                    else F.when(F.col("_gone").isNotNull(), when).otherwise(F.col(c)).alias(c) if c == date
                    else F.col(c)
                    for c in df.columns
                ]
            )
        out[name] = df
    return out


def shift_dates(
    df: DataFrame,
    before: datetime,
    delta: str,
    now: datetime,
    repair: bool = False,
    dry_run: bool = False,
) -> DataFrame:
    """Move dates not after ``before`` by an interval such as ``'1 day'``.

    Rows in question are those created by then, or created after they were
    modified.  Two flags are added: a date in the future, and created after
    modified.  ``dry_run`` gives the changed rows only; ``repair`` lifts a
    modification date to the creation date.
    """
    concerned = (F.col("CreatedDate") <= F.lit(before)) | (F.col("CreatedDate") > F.col("ModifiedDate"))

    def moved(column):
        late = F.col(column) + F.expr(f"INTERVAL {delta}")
        return F.when(concerned & (F.col(column) <= F.lit(before)), late).otherwise(F.col(column))

    rows = df.filter(concerned) if dry_run else df
    out = rows.select(
        *[moved(c).alias(c) if c in ("CreatedDate", "ModifiedDate") else F.col(c) for c in df.columns],
        F.coalesce(concerned, F.lit(False)).alias("Concerned"),
    )
    if repair:
        out = out.withColumn("ModifiedDate", F.greatest("CreatedDate", "ModifiedDate"))
    late = (F.col("CreatedDate") > F.lit(now)) | (F.col("ModifiedDate") > F.lit(now))
    return out.withColumn("Future", F.col("Concerned") & F.coalesce(late, F.lit(False))).withColumn(
        "Inverted",
        F.col("Concerned") & F.coalesce(F.col("CreatedDate") > F.col("ModifiedDate"), F.lit(False)),
    )


def shift_project_dates(tables: Project, before: datetime, delta: str, now: datetime, **options) -> Project:
    """:func:`shift_dates` over every table that has both dates."""
    return {
        name: shift_dates(df, before, delta, now, **options)
        for name, df in tables.items()
        if {"CreatedDate", "ModifiedDate"} <= set(df.columns)
    }


def translate_names(raw: Project, reverse: bool = False) -> Project:
    """Shift the characters of project titles and item names (``reverse`` encodes)."""
    from codespan.functions.text import shift_decode, shift_encode

    code = shift_encode if reverse else shift_decode
    out = dict(raw)
    for table, columns in (("Project", ("Title", "Description")), ("Item", ("Name", "Description"))):
        for c in columns:
            out[table] = out[table].withColumn(c, code(F.col(c)))
    return out


def put_project(target: DataFrame, row: DataFrame, mode: str) -> DataFrame:
    """The single project row.

    ``replace`` takes the new row and stamps the format version; ``overwrite``
    updates the supplied columns of the row that is there; ``insert`` acts only
    on an empty table; ``skip`` does nothing.
    """
    if mode == "skip":
        return target
    if mode == "replace":
        return shape(row.withColumn("Version", F.lit(FORMAT_VERSION)), target.schema)
    if mode == "insert":
        return _first_row_of(target, shape(row, target.schema))
    if mode != "overwrite":
        raise ValueError("mode must be skip, insert, overwrite or replace")
    supplied = [c for c in target.columns if c in row.columns]
    one = row.agg(F.any_value(F.struct(*supplied)).alias("_row"))
    keep = [F.col(c) for c in target.columns if c not in supplied]
    new = one.select("_row").scalar()
    held = target.withColumn("_row", new)
    return held.select(
        *[F.col("_row")[c].cast(target.schema[c].dataType).alias(c) if c in supplied else F.col(c) for c in target.columns]
    ) if supplied or keep else target


def edit_project(
    p: Project, title: str | None, description: str | None, user: str | None, now: datetime
) -> Project:
    """Set title and description; the editor is the named or else the first user."""
    spark = p["User"].sparkSession
    users = p["User"]
    if user is not None:
        wanted = spark.createDataFrame([(user,)], "Name string")
        users, ids = get_or_create(users, wanted, "User", None, now)
        editor = ids.join(wanted, "Name", "left_semi").agg(F.min("Id").alias("Id"))
    else:
        editor = users.agg(F.min("Id").alias("Id")).select(
            F.when(F.col("Id").isNotNull(), F.col("Id"))
            .otherwise(F.raise_error(F.lit("no user named and none in the project")))
            .alias("Id")
        )
    old = _first_row_of(
        p["Project"].withColumn("_old", F.lit(True)),
        shape(
            editor.select(
                F.lit(FORMAT_VERSION).alias("Version"),
                *[c.alias(k) for k, c in _audit(F.col("Id"), now).items()],
            ),
            p["Project"].schema,
        ).withColumn("_old", F.lit(False)),
    )
    row = old.withColumn("_editor", editor.select("Id").scalar()).select(
        F.lit(FORMAT_VERSION).alias("Version"),
        (F.lit(title) if title else F.col("Title")).alias("Title"),
        (F.lit(description) if description else F.col("Description")).alias("Description"),
        "CreatedBy", "CreatedDate",
        F.col("_editor").alias("ModifiedBy"), F.lit(now).alias("ModifiedDate"),
    )
    return p | {"User": users, "Project": shape(row, p["Project"].schema)}
