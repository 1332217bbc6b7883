from pyspark.sql import functions as F

from codespan.functions import fragments as FR


def test_code_of_fragment_checks_stays_small(spark):
    df = spark.range(1).select(F.col("id").cast("string").alias("f"))
    plan = df.filter(FR.is_fragment(F.col("f"))).select(FR.parse_fragment(F.col("f")).alias("p"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract(") <= 2, plan
