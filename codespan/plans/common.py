"""Small pieces the conversions share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENTITIES = (
    "users", "project", "node_categories", "nodes", "cases", "node_attributes",
    "case_attributes", "source_categories", "sources", "source_attributes", "taggings",
    "annotations",
)


class Actions:
    """What to do per kind of thing: ``skip``, ``merge``, ``overwrite`` or ``replace``.

    One object serves every conversion step; node and case attributes go
    together unless set apart.
    """

    def __init__(self, default: str = "merge", **chosen: str):
        unknown = set(chosen) - set(ENTITIES)
        if unknown:
            raise ValueError(f"unknown kinds: {sorted(unknown)}")
        self._default = default
        self._chosen = chosen
        for a, b in (("node_attributes", "case_attributes"), ("nodes", "cases")):
            if a in chosen and b not in chosen:
                self._chosen[b] = chosen[a]
            elif b in chosen and a not in chosen:
                self._chosen[a] = chosen[b]

    def __getitem__(self, kind: str) -> str:
        return self._chosen.get(kind, self._default)

    def wants(self, kind: str) -> bool:
        return self[kind] != "skip"


def lookup(df: DataFrame, table: DataFrame, on: Column, how: str = "left", **columns: Column) -> DataFrame:
    """Join a dimension and keep only the named columns of it."""
    small = table.select(*[c.alias(n) for n, c in columns.items()])
    return df.join(small, on, how)


def copies(df: DataFrame, count: str, index: str, block: int = 65_536) -> DataFrame:
    """Repeat each row ``count`` times with an index, never building one huge array."""
    blocks = df.withColumn("_b", F.explode(F.sequence(F.lit(0), F.floor((F.col(count) - 1) / block))))
    low = F.col("_b") * block
    return blocks.withColumn(
        index, F.explode(F.sequence(low, F.least(low + block - 1, F.col(count) - 1)))
    ).drop("_b", count)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_names(frames: list[tuple[DataFrame, str]]) -> DataFrame:
    """Distinct non-null names over several tables, reduced before they meet."""
    parts = [df.select(F.col(c).alias("Name")).filter(F.col("Name").isNotNull()).distinct() for df, c in frames]
    return reduce(DataFrame.unionByName, parts).distinct()
