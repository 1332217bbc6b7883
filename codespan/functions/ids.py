"""Identifiers that come out the same on every evaluation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL = "\u0000"  # what stands for null in a key


def deterministic_id(kind: str, *parts: Column) -> Column:
    """A UUID-shaped digest of a table name and a natural key, in which null differs from blank.

    ``uuid()`` would give another value when a lost task is run again, so ids
    that two branches of a plan must agree on are digests instead.
    """
    text = F.concat_ws("\u001f", F.lit(kind), *[F.coalesce(p.cast("string"), F.lit(NULL)) for p in parts])
    return as_uuid(F.md5(text))


def as_uuid(hex32: Column) -> Column:
    """Lay 32 hex digits out as 8-4-4-4-12."""
    return F.regexp_replace(hex32, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", r"$1-$2-$3-$4-$5")


def canonical_uuid(value: Column) -> Column:
    """Lower-case 36-character form of a UUID given with or without dashes or braces."""
    digits = F.lower(F.regexp_replace(value, r"[{}\-\s]", ""))
    return F.when(digits.rlike(r"^[0-9a-f]{32}$"), as_uuid(digits))
