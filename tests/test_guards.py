"""Checks that no plan can drop, and trees of any depth."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from codespan.functions.guard import demand
from codespan.operators import tree
from codespan.operators.merge import unique_rows
from codespan.sources.project import checked_project_row


def test_a_guard_holds_without_its_column(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "Id int, Value string")
    bad = demand(df, F.col("Value") == "a", F.lit("no a"))
    for action in (lambda: bad.count(), lambda: bad.select("Id").collect()):
        with pytest.raises(PySparkException, match="no a"):
            action()
    assert demand(df.filter("Id = 1"), F.col("Value") == "a", F.lit("no a")).count() == 1


def test_a_repeated_key_fails_a_count(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "Id int, Value string")
    with pytest.raises(PySparkException, match="duplicate key"):
        unique_rows(rows, ["Id"]).count()
    assert unique_rows(rows.filter("Value <> 'b'"), ["Id"]).count() == 2


def test_a_wrong_version_fails_a_count(spark):
    project = spark.createDataFrame([("0.1", "t")], "Version string, Title string")
    with pytest.raises(PySparkException, match="incompatible version"):
        checked_project_row(project, "Version", "0.2").select("Title").count()


def test_a_chain_of_any_depth_is_walked(spark):
    chain = spark.range(5000).select(
        F.col("id").cast("string").alias("Id"),
        F.when(F.col("id") > 0, (F.col("id") - 1).cast("string")).alias("Parent"),
        F.lit("").alias("Name"),
    )
    got = tree.tree_walk(chain).agg(F.count("*"), F.max("Depth"), F.countDistinct("TopParent")).first()
    assert tuple(got) == (5000, 4999, 1)


def test_cycles_are_reported_and_closed_once(spark):
    nodes = spark.createDataFrame(
        [("a", "c"), ("b", "a"), ("c", "b"), ("d", "a"), ("x", None), ("y", "x")], "Id string, Parent string"
    ).withColumn("Name", F.col("Id")).withColumn("Aggregate", F.lit(True))
    assert {r.Id for r in tree.tree_walk(nodes).collect()} == {"x", "y"}
    assert {tuple(r) for r in tree.unreachable(nodes).collect()} == {(c, "cycle") for c in "abcd"}
    pairs = [tuple(r) for r in tree.aggregate_pairs(nodes).collect()]
    want = {(i, j) for i in "abcd" for j in "abc"} | {("d", "d"), ("x", "x"), ("y", "y"), ("y", "x")}
    assert len(pairs) == len(set(pairs)) and set(pairs) == want
