"""Few authors of many rows; tables without rows."""

from pyspark.sql import functions as F

from codespan.plans.flatcode import import_flatcode
from codespan.schemas import DEFAULT_USER, FLATCODE
from codespan.sources.project import conform, empty_project


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def flat(spark, codings: int = 40) -> dict:
    when = F.lit("Tue Mar  1 16:20:00 2016")
    return conform({
        "project": spark.range(1).select(F.lit("DBVersion:0.1").alias("databaseversion"), when.alias("date"), when.alias("dateM")),
        "coding": spark.range(codings).select(
            F.lit(1).alias("cid"), F.lit(2).alias("fid"), (F.col("id") % 7).cast("double").alias("selfirst"),
            (F.col("id") % 7 + 3).cast("double").alias("selend"), F.lit(1).alias("status"),
            F.concat(F.lit("u"), (F.col("id") % 2).cast("string")).alias("owner"), when.alias("date")),
    }, FLATCODE)


def test_rows_of_few_authors_are_not_dealt_out_by_author(spark):
    p = import_flatcode(flat(spark))
    users = p["User"].select(F.col("Id").alias("u"), F.col("Name").alias("Author"))
    rows = p["Tagging"].join(users, F.col("CreatedBy") == F.col("u"))
    assert "hashpartitioning(owner" not in plan(rows) and "hashpartitioning(CreatedBy" not in plan(rows)
    assert {r.Author: r["count"] for r in rows.groupBy("Author").count().collect()} == {"u0": 20, "u1": 20}
    assert {r.Name for r in p["User"].collect()} == {"u0", "u1", DEFAULT_USER}


def test_empty_tables_are_known_to_be_empty(spark):
    node = empty_project(spark)["Node"]
    rows = spark.range(3).select(F.col("id").cast("string").alias("Id")).join(node.select("Id"), "Id", "left_anti")
    assert "Join" not in plan(rows) and rows.count() == 3 and node.count() == 0
