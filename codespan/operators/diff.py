"""Differences between tables with the same columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codespan.schemas import FOREIGN_KEYS

Project = dict[str, DataFrame]


def subtract_table(a: DataFrame, b: DataFrame, ignore: list[str] | None = None) -> DataFrame:
    """Rows of ``a`` equal to no row of ``b``; copies in ``a`` survive.

    Ignored columns become null on both sides first and stay null.  Rows meet on
    a digest of all compared columns, so a value shared by many rows does not
    gather them in one task, and equality is then checked column by column.
    """
    ignore = ignore or []
    blank = lambda df: df.select(
        *[F.lit(None).cast(df.schema[c].dataType).alias(c) if c in ignore else F.col(c) for c in a.columns]
    )
    left, right = blank(a), blank(b).distinct()
    compared = [c for c in a.columns if c not in ignore]
    digest = F.xxhash64(*[F.col(c) for c in compared])
    left = left.withColumn("_digest", digest)
    right = right.select(F.xxhash64(*[F.col(c) for c in compared]).alias("_d"), *[F.col(c).alias(f"_r_{c}") for c in compared])
    same = reduce(
        lambda x, y: x & y,
        [F.col("_digest") == F.col("_d")] + [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in compared],
    )
    return left.join(right, same, "left_anti").drop("_digest")


def subtract(p1: Project, p2: Project, ignore: list[str] | None = None, reverse: bool = False) -> Project:
    """Table by table, what the first project has and the second has not."""
    if reverse:
        p1, p2 = p2, p1
    return {name: subtract_table(df, p2[name], ignore) for name, df in p1.items() if name in p2}


def foreign_key_parents(
    difference: Project,
    origin: Project,
    target: Project,
    keys: list[tuple[str, list[str], str, list[str]]] = FOREIGN_KEYS,
) -> Project:
    """The rows of the origin that a difference refers to and the target lacks.

    One level, composite keys allowed, each parent once.
    """
    out: Project = {}
    for child, columns, parent, referred in keys:
        if child not in difference or parent not in origin:
            continue
        used = difference[child].select(*[F.col(c).alias(f"_u_{i}") for i, c in enumerate(columns)])
        used = used.dropna().distinct()
        on = reduce(lambda a, b: a & b, [F.col(r) == F.col(f"_u_{i}") for i, r in enumerate(referred)])
        rows = origin[parent].join(used, on, "left_semi")
        out[parent] = out[parent].unionByName(rows) if parent in out else rows
    return {
        name: (rows.distinct().join(target[name], _key(name), "left_anti") if name in target else rows.distinct())
        for name, rows in out.items()
    }


def _key(table: str) -> list[str]:
    from codespan.schemas import PRIMARY_KEYS

    return PRIMARY_KEYS.get(table) or ["Id"]


def apply_difference(target: Project, difference: Project, parents: Project) -> Project:
    """The target with the missing parents and then the difference added."""
    out = dict(target)
    for rows_by_table in (parents, difference):
        for name, rows in rows_by_table.items():
            out[name] = out[name].unionByName(rows.select(*out[name].columns)) if name in out else rows
    return out


def validate_keys(p: Project, keys=FOREIGN_KEYS) -> DataFrame:
    """References that lead nowhere, as (Table, Column, Value, n).

    A reference over several columns is one value, its parts joined by ``|``; one
    with a null part refers to nothing.
    """
    found = []
    for child, columns, parent, referred in keys:
        if child not in p or parent not in p:
            continue
        used = p[child].dropna(subset=columns).groupBy(*[F.col(c).alias(f"_u{i}") for i, c in enumerate(columns)])
        there = p[parent].select(*[F.col(r).alias(f"_u{i}") for i, r in enumerate(referred)])
        on = [f"_u{i}" for i in range(len(columns))]
        orphans = used.agg(F.count(F.lit(1)).alias("n")).join(there, on, "left_anti")
        value = F.concat_ws("|", *[F.col(c).cast("string") for c in on])
        found.append(orphans.select(
            F.lit(child).alias("Table"), F.lit("|".join(columns)).alias("Column"), value.alias("Value"), "n"))
    return reduce(DataFrame.unionByName, found)
