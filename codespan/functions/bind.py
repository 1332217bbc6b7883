"""Naming an intermediate value inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once.

    A sub-expression written inside a lambda is computed again for every array
    element; bound here it becomes a lambda variable and is computed per row.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
