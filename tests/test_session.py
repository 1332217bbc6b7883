from pyspark.sql import functions as F

from codespan.session import cut, spread


def test_a_cut_table_keeps_neither_estimates_nor_constraints(spark):
    df = spark.createDataFrame([(i, f"n{i}") for i in range(5)], "a long, b string")
    for _ in range(4):
        other = df.withColumnsRenamed({"a": "a2", "b": "b2"}).filter(F.col("a2") > 0)
        df = cut(df.join(other, F.col("b") == F.col("b2")).select("a", "b").union(df.filter(F.col("b") > "")))
    plan = df._jdf.queryExecution().optimizedPlan()
    assert int(str(plan.stats().sizeInBytes())) < 1_000_000
    assert plan.constraints().isEmpty()
    assert df.filter("a = 0").count() == 1 and spread(df).count() == df.count()


def test_an_empty_table_and_nulls_survive_a_cut(spark):
    df = spark.createDataFrame([(1, None), (None, "")], "a int, b string")
    assert sorted(map(str, cut(df).collect())) == sorted(map(str, df.collect()))
    empty = cut(df.filter("a > 5"))
    assert empty.columns == ["a", "b"] and empty.count() == 0
