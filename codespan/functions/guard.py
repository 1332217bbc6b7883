"""Checks on data that no optimisation can take away."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def demand(df: DataFrame, good: Column, message: Column) -> DataFrame:
    """The same rows; every action fails that meets one where ``good`` is not true.

    The check is a filter, so it runs whichever columns are read, or none.
    """
    failed = F.raise_error(message).cast("boolean")
    return df.filter(F.when(F.coalesce(good, F.lit(False)), F.lit(True)).otherwise(failed))
