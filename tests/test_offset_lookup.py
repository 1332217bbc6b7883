"""Offsets are looked up in an array made from each text."""

from pyspark.sql import functions as F

from codespan.operators import spans as S


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def brute(content: str, start: int, length: int) -> tuple[int, int]:
    counted = [i for i, c in enumerate(content) if not c.isspace()]
    last = start + max(length, 1) - 1
    at = lambda k: counted[k] if k < len(counted) else k + len(content) - len(counted)
    return at(start), (at(last) + 1 - at(start) if length > 0 else 0)


def test_offsets_are_looked_up_in_the_text(spark):
    content = " ab  c\n\nd e "
    texts = spark.createDataFrame([("s", content), ("e", ""), ("n", None)], "Source string, PlainText string")
    asked = [(k, n) for k in range(8) for n in (0, 1, 3)]
    spans = spark.createDataFrame([("s", k, n) for k, n in asked], "Source string, StartText long, LengthText long")
    found = S.nonspace_to_char(spans, texts)
    assert "collect_set" not in plan(found)
    files = spark.range(9).select(F.col("id").cast("string").alias("Source"), F.lit("a b").alias("PlainText"))
    assert "BroadcastHashJoin" not in plan(S.nonspace_to_char(spans, files))
    assert {(r.StartText, r.LengthText): (r.StartX, r.LengthX) for r in found.collect()} == {
        (k, n): brute(content, k, n) for k, n in asked}
    edges = spark.createDataFrame([("e", 0, 2), ("n", 1, 2), ("x", 1, 2), (None, 1, 2), ("s", None, 2), ("s", 3, None)],
                                  "Source string, start0 long, length long")
    moved = S.char_to_nonspace_spans(edges, texts.withColumnRenamed("PlainText", "Text"))
    assert sorted(map(str, moved.collect())) == sorted(map(str, edges.collect()))


def test_a_source_of_two_texts_answers_for_each(spark):
    texts = spark.createDataFrame([("s", "a\r\nb\r\nc"), ("s", "abcdef")], "Source string, Text string")
    spans = spark.createDataFrame([("s", 3, 4)], "Source string, start0 long, length long")
    got = S.crlf_to_lf_spans(spans, texts).collect()
    assert len(got) == 4 and ("s", 2, 3) in {tuple(r) for r in got} and ("s", 3, 4) in {tuple(r) for r in got}
