"""Comparing projects: refined classes, pairing inside them, composite keys."""

import pytest
from pyspark.sql import functions as F

from codespan.operators import match

ITEM = "Id string, TypeId int, Name string, HierarchicalName string, Description string"
RULE = [("Item", ["TypeId", "Name", "HierarchicalName"], [])]


def items(spark, rows):
    return {"Item": spark.createDataFrame([(i, 1, n, f"/{n}", d) for i, n, d in rows], ITEM)}


def test_equal_projects_with_shared_names_do_not_differ(spark):
    one = items(spark, [(f"a{i}", "same", f"text {i % 7}") for i in range(60)] + [("x", None, None)])
    two = items(spark, [(f"b{i}", "same", f"text {i % 7}") for i in range(60)] + [("y", None, None)])
    assert match.compare_projects(one, one, rules=RULE).count() == 0
    assert match.compare_projects(one, two, rules=RULE).count() == 0


def test_pairing_inside_a_class(spark):
    one = items(spark, [("k", "n", "mine"), ("p", "n", "kept"), ("q", "n", "old"), ("r", "n", "extra"), ("s", "alone", "z")])
    two = items(spark, [("k", "n", "yours"), ("t", "n", "kept"), ("u", "n", "new"), ("s", "renamed", "z"), ("v", "other", "")])
    found = {tuple(r) for r in match.compare_projects(one, two, rules=RULE).select(
        "Key1", "Key2", "Status", "Column", "Value1", "Value2").collect()}
    # k keeps its key, p and t have one content, u goes to one of the two left, s is known by its key.
    first = {f for f in found if f[0] not in ("q", "r")}
    assert first == {("k", "k", "differs", "Description", "mine", "yours"), ("s", "s", "differs", "Name", "alone", "renamed"),
                     ("s", "s", "differs", "HierarchicalName", "/alone", "/renamed"), (None, "v", "only in 2", None, None, None)}
    assert sorted((f[1] or "", f[2]) for f in found - first) == [("", "only in 1"), ("u", "differs")]


def test_rules_for_one_table_meet_in_one_class(spark):
    p = items(spark, [("a", "n", "x"), ("b", "n", "y"), ("c", "m", "x"), ("d", "n", "x"), ("e", None, "x")])
    rules = [("Item", ["Name"], []), ("Item", ["Description"], [])]
    c1, c2 = match.match_entities(p, p, rules)
    classes = {}
    for r in c1.collect():
        assert r.Id not in classes
        classes[r.Id] = r.Class
    assert len(set(classes.values())) == 4 and classes["a"] == classes["d"]
    assert {tuple(r) for r in c2.collect()} == set(classes.items())


@pytest.mark.parametrize("columns", [["A", "B"], ["A"]])
def test_composite_keys_keep_their_parts_apart(spark, columns):
    rows = [("x|y", "z"), ("x", "y|z"), (None, "z"), ("", "z"), ("\\N", "z"), ("x\\", "|z"), ("x", "\\|z"), (None, None)]
    df = spark.createDataFrame(rows, "A string, B string").select(match.key_text(columns).alias("k"))
    keys = [r.k for r in df.collect()]
    assert len(set(keys)) == len({tuple(r[: len(columns)]) for r in rows}) and None not in keys


def test_tables_without_key_pair_by_rank(spark):
    rows = lambda *titles: {"Project": spark.createDataFrame([(t,) for t in titles], "Title string")}
    none = spark.createDataFrame([], "Id string, Class string")
    found = match.compare_table(rows("one")["Project"], rows("two")["Project"], [], none, none)
    assert [tuple(r) for r in found.collect()] == [("", "", "differs", "Title", "one", "two")]


def test_references_are_read_through_classes(spark):
    def project(prefix):
        named = spark.createDataFrame([(f"{prefix}{i}", 1, f"n{i}", "", "") for i in range(4)], ITEM)
        refs = spark.createDataFrame([(f"{prefix}r{i}", f"{prefix}{i % 3}", f"{prefix}3", i % 2) for i in range(6)],
                                     "Id string, Node_Item_Id string, Source_Item_Id string, StartX int")
        return {"Item": named, "NodeReference": refs}
    one, two = project("a"), project("b")
    assert match.compare_projects(one, two).count() == 0
    two["NodeReference"] = two["NodeReference"].withColumn("StartX", F.when(F.col("Id") == "br4", 9).otherwise(F.col("StartX")))
    found = match.compare_projects(one, two).collect()
    assert [(r.Table, r.Status, r.Column, r.Value2) for r in found] == [("NodeReference", "differs", "StartX", "9")]
