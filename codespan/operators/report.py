"""What an operation did, counted in the job that writes its result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class Report:
    """Counts of rows by what happened to them, taken while the rows pass by.

    ``watch`` puts a counter on a frame; once a job has read the frame to its end,
    ``rows`` tells what it counted.  Nothing is computed a second time for that.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._seen: list[tuple[str, list[str], Observation]] = []

    def watch(self, operation: str, df: DataFrame, **conditions: Column) -> DataFrame:
        """The same rows; each condition becomes a count of the rows for which it holds."""
        seen = Observation(f"{operation}-{len(self._seen)}")
        self._seen.append((operation, list(conditions), seen))
        counts = [F.count(F.when(c, F.lit(1))).alias(name) for name, c in conditions.items()]
        return df.observe(seen, *counts)

    def rows(self) -> DataFrame:
        """Operation, Outcome, n: a row per counter; waits for the job that counts."""
        found = [(op, name, int(seen.get[name])) for op, names, seen in self._seen for name in names]
        return self.spark.createDataFrame(found, "Operation string, Outcome string, n long")


def watch_merge(report: Report, operation: str, before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """``after`` with counts of its rows that are new, changed or as they were in ``before``."""
    columns = [c for c in after.columns if c in before.columns]
    digest = lambda: F.xxhash64(*[F.to_json(F.struct(c)) for c in columns])
    old = before.select(*[F.col(k).alias(f"_k_{k}") for k in keys], digest().alias("_was"))
    on = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        on = same if on is None else on & same
    joined = after.withColumn("_is", digest()).join(old, on, "left")
    watched = report.watch(
        operation, joined,
        inserted=F.col("_was").isNull(), updated=F.col("_was") != F.col("_is"), kept=F.col("_was") == F.col("_is"),
    )
    return watched.select(*after.columns)
