from codespan.operators import attributes as A


def test_default_fill_pairs_stay_where_they_are_made(spark):
    members = spark.createDataFrame([("c", "i"), ("c", "j"), ("c", "j"), ("d", "k"), ("c", None), (None, "x")], "Category string, Item string")
    defaults = spark.createDataFrame([("c", "a", "1"), ("c", "b", "2"), ("c", None, "3"), ("d", "a", "4")],
                                     "Category string, Attribute string, Default string")
    existing = spark.createDataFrame([("i", "a"), ("i", "a"), ("j", "z"), ("i", None), (None, "b")], "Item string, Attribute string")
    got = A.default_fill(members, defaults, existing)
    want = [("i", "b", "2"), ("i", None, "3"), ("k", "a", "4"), *[("j", *x) for x in [("a", "1"), ("b", "2"), (None, "3")] * 2],
            *[(None, *x) for x in [("a", "1"), ("b", "2"), (None, "3")]]]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    # No join asks for the pairs by item and attribute.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan


def test_default_fill_sends_no_slices_of_defaults_to_every_task(spark):
    members = spark.createDataFrame([("c", "i")], "Category string, Item string")
    defaults = spark.range(500).selectExpr("substring('cd', cast(id % 2 as int) + 1, 1) as Category", "id as Attribute", "cast(id as string) as Default")
    got = A.default_fill(members, defaults, spark.createDataFrame([("i", 8)], "Item string, Attribute long"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [Category" in plan and "BroadcastHashJoin [Category" not in plan
    assert got.count() == 249
