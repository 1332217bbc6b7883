import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from codespan.operators import diff as D
from codespan.operators import merge as M
from codespan.operators import numbering as N
from codespan.operators import query as Q
from codespan.operators import tagging as TG
from codespan.operators import tree
from codespan.sources.project import conform, empty_project

NOW = datetime(2024, 6, 1)


def project(spark):
    return conform({
        "User": spark.createDataFrame([("u1", "Ann")], "Id string, Name string"),
        "Project": spark.createDataFrame([("0.2", "T", "u1")], "Version string, Title string, ModifiedBy string"),
        "SourceCategory": spark.createDataFrame([("c1", "talk")], "Id string, Name string"),
        "Source": spark.createDataFrame(
            [("s1", "c1", "one", "Ann: hello\nBob:\n  there\nhi"), ("s2", None, "two", "abc")],
            "Id string, Category string, Name string, Content string"),
        "Node": spark.createDataFrame([("n1", "Ann"), ("n2", "Bob"), ("n3", "Ann")], "Id string, Name string"),
    })


def test_numbers_are_dense_in_a_hot_group(spark):
    df = spark.range(20_000).select(F.col("id"), F.when(F.col("id") % 3 > 0, "hot").alias("g"))
    rows = N.number_rows(df, ["id"], "n", group=["g"]).groupBy("g").agg(
        F.min("n"), F.max("n"), F.count_distinct("n"), F.count("*")).collect()
    assert all(tuple(r)[1:] == (1, r[4], r[4], r[4]) for r in rows) and len(rows) == 2


@pytest.mark.parametrize("spacing, runs", [(1, 30), (10**12, 30), (1, 1), (7, None)])
def test_forward_fill_across_runs(spark, spacing, runs):
    rng = random.Random(5)
    cells = [rng.choice(["", None, "", "a", "b"]) for _ in range(200)]
    rows = [(i * spacing + rng.randrange(spacing), c) for i, c in enumerate(cells)]
    df = spark.createDataFrame(rng.sample(rows, len(rows)), "Row long, c string").repartition(4)
    last, want = "first", []
    for c in cells:
        last = c or last
        want.append(last)
    got = N.forward_fill(df, "Row", ["c"], {"c": "first"}, runs=runs).orderBy("Row").collect()
    assert [r.c for r in got] == want


def test_runs_are_even_however_sparse(spark):
    df = spark.range(5000).select(F.expr("id * id * id").alias("Row"), F.lit("x").alias("c"))
    df = df.union(spark.createDataFrame([(10**17, "far"), (None, "none")], "Row long, c string"))
    sizes = N.range_runs(df, "Row", "run", 20).groupBy("run").agg(
        F.count("*").alias("n"), F.min("Row").alias("low"), F.max("Row").alias("high")).orderBy("run").collect()
    assert len(sizes) == 20 and max(r.n for r in sizes) < 300
    assert all(a.high < b.low for a, b in zip(sizes, sizes[1:]))


def test_merge_refuses_duplicate_keys(spark):
    t = spark.createDataFrame([("a", "1")], "Id string, v string")
    d = spark.createDataFrame([("b", "1"), ("b", "2")], "Id string, v string")
    with pytest.raises(Exception, match="duplicate key"):
        M.merge_table(t, d, ["Id"], "merge").collect()


def test_merge_keeps_columns_not_supplied(spark):
    t = spark.createDataFrame([("a", "1", "x"), ("b", "2", "y")], "Id string, v string, w string")
    d = spark.createDataFrame([("a", None), ("c", "3")], "Id string, v string")
    rows = lambda mode: sorted(map(tuple, M.merge_table(t, d, ["Id"], mode).collect()))
    assert rows("merge") == [("a", "1", "x"), ("b", "2", "y"), ("c", "3", None)]
    assert rows("overwrite") == [("a", None, "x"), ("b", "2", "y"), ("c", "3", None)]
    assert rows("replace") == [("a", None, "x"), ("c", "3", None)]
    assert rows("skip") == [("a", "1", "x"), ("b", "2", "y")]


def test_subtract_keeps_copies_and_compares_nulls(spark):
    a = spark.createDataFrame([("x", None), ("x", None), ("y", "1")], "p string, q string")
    b = spark.createDataFrame([("y", "1")], "p string, q string")
    assert D.subtract_table(a, b).count() == 2
    assert D.subtract_table(b, a).count() == 0
    ignored = D.subtract_table(a, b, ["q"]).collect()
    assert [tuple(r) for r in ignored] == [("x", None), ("x", None)]


def test_user_resolution(spark):
    p = project(spark)
    assert M.resolve_user(p, None, NOW)[1].first().Id == "u1"
    assert M.resolve_user(p, "Ann", NOW)[1].first().Id == "u1"
    grown, one = M.resolve_user(p, "Eve", NOW)
    assert one.count() == 1 and grown["User"].count() == 2
    fresh, default = M.resolve_user(empty_project(spark), None, NOW)
    assert default.count() == 1
    assert fresh["User"].first().Name == "Default User" and fresh["Project"].first().Version == "0.2"


def test_project_editor_needs_a_user(spark):
    with pytest.raises(Exception, match="no user"):
        M.edit_project(empty_project(spark), "t", None, None, NOW)["Project"].collect()
    row = M.edit_project(empty_project(spark), "t", "d", "Ann", NOW)["Project"].first()
    assert (row.Title, row.Description, row.Version) == ("t", "d", "0.2")


def test_tree_reports_cycles_and_orphans(spark):
    rows = [("a", None), ("b", "a"), ("c", "b"), ("x", "y"), ("y", "z"), ("z", "x"), ("o", "gone"), ("p", "o")]
    nodes = spark.createDataFrame([(i, p, i.upper(), True) for i, p in rows],
                                  "Id string, Parent string, Name string, Aggregate boolean")
    walked = {r.Id: (r.Depth, r.TopParent, r.HierarchicalName) for r in tree.tree_walk(nodes, "Nodes").collect()}
    assert walked == {"a": (0, "a", "Nodes\\\\A"), "b": (1, "a", "Nodes\\\\A\\B"), "c": (2, "a", "Nodes\\\\A\\B\\C")}
    lost = {r.Id: r.Reason for r in tree.unreachable(nodes).collect()}
    assert lost == {"x": "cycle", "y": "cycle", "z": "cycle", "o": "orphan", "p": "orphan"}


def test_aggregation_stops_at_an_unmarked_parent(spark):
    nodes = spark.createDataFrame(
        [("a", None, True), ("b", "a", False), ("c", "b", True), ("d", "c", None), ("e", "d", True)],
        "Id string, Parent string, Aggregate boolean")
    pairs = {tuple(r) for r in tree.aggregate_pairs(nodes).collect()}
    assert pairs == {(x, x) for x in "abcde"} | {("b", "a"), ("d", "c")}


def test_speaker_lines_equal_python(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choice("ab: \n\t") for _ in range(rng.randrange(0, 40))) for _ in range(1500)]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "Id string, Content string")
    got = {(r.Id, r.Speaker, r.start0, r.end0) for r in TG.speaker_lines(df).collect()}
    pattern = re.compile(r"^(.+?):\s*(.*?)$", re.MULTILINE)
    want = {(str(i), m.group(1), m.start(2), m.end(2)) for i, t in enumerate(texts) for m in pattern.finditer(t)}
    assert got == want


def test_tag_speakers(spark):
    rows = TG.tag_speakers(project(spark), "u1", NOW).collect()
    assert {(r.Source, r.Node, r.Fragment) for r in rows} == {("s1", "n1", "5:10"), ("s1", "n2", "18:23")}


def test_apply_taggings(spark):
    p = project(spark)
    sheet = spark.createDataFrame(
        [(1, "one", None, "Ann\nBob", "1:3", None), (2, None, None, None, "2:4", None), (3, "two", None, None, "1:3", "m")],
        "Row long, Source string, `Source Category` string, Node string, Fragment string, Memo string")
    rows = TG.apply_taggings(p, sheet, "u1", NOW, fill=False, strict=True).collect()
    assert sorted((r.Source, r.Node or "", r.Fragment) for r in rows) == [
        ("s1", "n1", "1:3"), ("s1", "n2", "1:3"), ("s2", "", "1:3")]
    filled = TG.apply_taggings(p, sheet, "u1", NOW, strict=True).collect()
    assert len(filled) == 6
    bad = spark.createDataFrame([(1, "two", "Ann", "2:9")], "Row long, Source string, Node string, Fragment string")
    with pytest.raises(Exception, match="illegal tagging"):
        TG.apply_taggings(p, bad, "u1", NOW).collect()
    assert TG.tagging_rejects(p, bad).first().Problem == "end past end of text"


def test_sheet_rows_reach_categories_and_everything(spark):
    p = project(spark)
    sheet = spark.createDataFrame([(1, "talk", "a"), (2, None, "b")], "Row long, `Source Category` string, Memo string")
    rows = TG.apply_taggings(p, sheet, "u1", NOW, defaults={"Fragment": "1:1"}, fill=True).collect()
    assert sorted((r.Source, r.Memo) for r in rows) == [("s1", "a"), ("s1", "b")]
    free = TG.apply_taggings(p, sheet, "u1", NOW, defaults={"Fragment": "1:1"}, fill=False).collect()
    assert sorted((r.Source, r.Memo) for r in free) == [("s1", "a"), ("s1", "b"), ("s2", "b")]


def test_tag_phrases_makes_nodes_once(spark):
    p = project(spark)
    texts = p["Source"].withColumn("Content", F.lit("Green tea. More green tea, and green tea!"))
    out = TG.tag_phrases(p | {"Source": texts}, "u1", NOW, threshold=4)
    again = TG.tag_phrases(out, "u1", NOW, threshold=4)
    names = [r.Name for r in again["Node"].filter("Category IS NOT NULL").collect()]
    assert names == ["green tea"]
    fragments = sorted(r.Fragment for r in out["Tagging"].filter("Source = 's1'").collect())
    assert fragments == ["0:9", "11:40", "11:40"]


def test_no_cartesian_product_in_passage_queries(spark):
    p = project(spark)
    plan = Q.query_taggings(p, nodes=["Ann", "Bob"])._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_project_editor_and_dates(spark):
    df = spark.createDataFrame(
        [("a", datetime(2020, 1, 1), datetime(2020, 1, 5)), ("b", datetime(2021, 1, 1), datetime(2020, 12, 1))],
        "Id string, CreatedDate timestamp, ModifiedDate timestamp")
    rows = {r.Id: r for r in M.shift_dates(df, datetime(2020, 1, 2), "3 days", NOW).collect()}
    assert rows["a"].CreatedDate == datetime(2020, 1, 4) and rows["a"].ModifiedDate == datetime(2020, 1, 5)
    assert rows["b"].Inverted and not rows["a"].Inverted
    fixed = {r.Id: r for r in M.shift_dates(df, datetime(2020, 1, 2), "3 days", NOW, repair=True).collect()}
    assert fixed["b"].ModifiedDate == datetime(2021, 1, 1)
