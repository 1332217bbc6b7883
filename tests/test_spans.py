import random

from pyspark.sql import functions as F

from codespan.functions import fragments as FR
from codespan.functions import offsets as O
from codespan.functions.text import paragraphs, running_totals
from codespan.operators import spans as S


def brute_merge(spans):
    """Inclusive sweep over (source, node) -> merged (start0, end0)."""
    out = {}
    for source, node, s, e in sorted(spans, key=lambda x: (x[0], str(x[1]), x[2], x[3])):
        runs = out.setdefault((source, node), [])
        if runs and runs[-1][1] > s:
            runs[-1][1] = max(runs[-1][1], e)
        else:
            runs.append([s, e])
    return {(k[0], k[1], s, e) for k, runs in out.items() for s, e in runs}


def random_spans(rng, n, sources=3, nodes=("x", "y", "z"), size=60):
    out = []
    for _ in range(n):
        s = rng.randrange(size)
        out.append((f"s{rng.randrange(sources)}", rng.choice(nodes), s, s + 1 + rng.randrange(12)))
    return out


def frame(spark, spans):
    return spark.createDataFrame(spans, "Source string, Node string, start0 long, end0 long")


def test_merge_matches_sweep(spark):
    rng = random.Random(1)
    for n in (0, 1, 40, 300):
        spans = random_spans(rng, n)
        got = {tuple(r) for r in S.merge_spans(frame(spark, spans), ["Source", "Node"]).collect()}
        assert got == brute_merge(spans)


def test_neighbours_stay_apart_and_first_memo_wins(spark):
    df = spark.createDataFrame(
        [("s", 0, 5, "b", "2"), ("s", 0, 5, "a", "1"), ("s", 4, 9, "c", "0"), ("s", 9, 12, "d", "0")],
        "Source string, start0 long, end0 long, Memo string, Id string",
    )
    rows = S.merge_spans(df, ["Source"], first=["Memo"], tie=["Id"]).orderBy("start0").collect()
    assert [(r.start0, r.end0, r.Memo) for r in rows] == [(0, 9, "a"), (9, 12, "d")]


def test_one_hot_group_collapses_before_the_window(spark):
    df = spark.range(200_000).select(
        F.lit("s").alias("Source"), F.lit("x").alias("Node"), (F.col("id") % 500).alias("start0"),
        (F.col("id") % 500 + 3).alias("end0"),
    )
    assert [tuple(r) for r in S.merge_spans(df, ["Source", "Node"]).collect()] == [("s", "x", 0, 502)]


def test_merging_holds_no_table_of_merged_spans(spark):
    spans = [("s", "x", 0, 4), ("s", "x", 2, 9), ("s", None, 3, 5), ("s", None, 4, 4), ("s", "x", 9, 12)]
    merged = S.merge_spans(frame(spark, spans), ["Source", "Node"])
    assert {tuple(r) for r in merged.collect()} == {("s", "x", 0, 9), ("s", "x", 9, 12), ("s", None, 3, 5)}
    # Only the spans of one start are aggregated; what is merged is read off the sorted rows.
    assert merged._jdf.queryExecution().optimizedPlan().toString().count("Aggregate ") == 1


def test_spans_without_a_start_or_an_end_merge_as_rows_in_order(spark):
    cells = [("a", None, 5, "n"), ("a", 2, 4, "p"), ("a", 7, 9, "q"), ("b", None, 3, "n"), ("b", 6, 8, "p"),
             ("c", 1, None, "p"), ("c", 2, 5, "q"), ("d", 4, 10, "p"), ("d", 12, 6, "q"), ("d", 13, 15, "r")]
    df = spark.createDataFrame(cells, "Source string, start0 long, end0 long, Memo string")
    rows = S.merge_spans(df, ["Source"], first=["Memo"]).collect()
    assert {tuple(r) for r in rows} == {
        ("a", 2, 5, "p"), ("a", 7, 9, "q"), ("b", None, 3, None), ("b", 6, 8, "p"), ("c", 1, None, "p"), ("c", 2, 5, "q"),
        ("d", 4, 10, "p"), ("d", 12, 6, "q"), ("d", 13, 15, "r")}


def test_terms_match_pairwise_fold(spark):
    rng = random.Random(2)
    spans = random_spans(rng, 250)
    terms = [[x for x in spans if x[1] in names] for names in (("x", "y"), ("z",), ("x",))]

    found = {(a, (b,), s, e) for a, b, s, e in brute_merge(terms[0])}
    for term in terms[1:]:
        pairs = [
            (src, (node, *tup), max(s1, s2), min(e1, e2))
            for src, tup, s1, e1 in found for src2, node, s2, e2 in term
            if src == src2 and min(e1, e2) > max(s1, s2)
        ]
        found = brute_merge(pairs)
    for width in (4, 256):
        got = S.intersect_terms([frame(spark, t) for t in terms], width)
        assert {(r.Source, tuple(r.Nodes), r.start0, r.end0) for r in got.collect()} == found


def test_fragments_round_trip(spark):
    texts = ["1:5", "10:12,3", "10:12,3:9"]
    df = spark.createDataFrame([(t,) for t in texts], "f string")
    for base in ("one_incl", "zero_incl", "zero_excl"):
        p = FR.parse_fragment(F.col("f"), base)
        back = df.select("f", FR.format_fragment(p["start0"], p["end0"], p["y1"], p["y2"], base).alias("g"))
        assert all(r.f == r.g for r in back.collect())


def test_fragment_errors(spark):
    df = spark.createDataFrame([("x",), ("0:4",), ("5:4",), ("11:12",), ("3:11",), (None,)], "f string")
    got = [r[0] for r in df.select(FR.fragment_error(F.col("f"), F.lit(10))).collect()]
    assert got == ["malformed", None, "end before start", "start past end of text", "end past end of text", "malformed"]


def random_text(rng, n, alphabet="ab \r\n\t é"):
    return "".join(rng.choice(alphabet) for _ in range(n))


def test_set_based_offsets_equal_row_functions(spark):
    rng = random.Random(3)
    texts = [(f"s{i}", random_text(rng, rng.randrange(1, 60)).replace("a\r", "a\r\n")) for i in range(40)]
    spans = []
    for source, text in texts:
        for _ in range(8):
            s = rng.randrange(len(text))
            spans.append((source, s, rng.randrange(0, len(text) - s + 1)))
    df = spark.createDataFrame(spans, "Source string, start0 long, length long")
    held = spark.createDataFrame(texts, "Source string, Text string")
    cases = [
        (S.crlf_to_lf_spans, O.span_crlf_to_lf), (S.lf_to_crlf_spans, O.span_lf_to_crlf),
        (S.char_to_nonspace_spans, O.char_to_nonspace_span),
    ]
    for by_set, by_row in cases:
        one = df.join(held, "Source").select(
            "Source", by_row(F.col("Text"), F.col("start0"), F.col("length")).alias("m")
        ).select("Source", "m.*")
        other = by_set(df, held).select("Source", "start0", "length")
        assert sorted(map(tuple, one.collect())) == sorted(map(tuple, other.collect()))


def test_offsets_of_empty_absent_and_long_texts(spark):
    long = "word \r\n" * 60_000
    texts = spark.createDataFrame([("empty", ""), ("null", None), ("long", long)], "Source string, Text string")
    spans = [("empty", 0, 0), ("null", 3, 4), ("absent", 3, 4), ("long", 0, len(long)), ("long", 7, 0),
             ("long", len(long) - 1, 1), ("long", None, 2), ("empty", 5, 2)]
    df = spark.createDataFrame(spans, "Source string, start0 long, length long")
    got = {tuple(r)[:1] + (i,): tuple(r)[1:] for i, r in enumerate(S.crlf_to_lf_spans(df, texts).collect())}
    assert sorted(got.values(), key=str) == sorted(
        [(0, 0), (3, 4), (3, 4), (0, 6 * 60_000), (6, 0), (6 * 60_000, 1), (None, 2), (5, 2)], key=str)
    packed = S.char_to_nonspace_spans(df.filter("Source = 'long' and length > 6"), texts).first()
    assert (packed.start0, packed.length) == (0, 4 * 60_000)
    back = S.nonspace_to_char(
        spark.createDataFrame([("long", 4 * 60_000 - 1, 1), ("long", 4, 4), ("absent", 2, 2)],
                              "Source string, StartText long, LengthText long"),
        texts.withColumnRenamed("Text", "PlainText")).collect()
    assert {(r.StartX, r.LengthX) for r in back} == {(7 * 60_000 - 4, 1), (7, 4), (2, 2)}


def test_texts_are_counted_once_for_both_ends(spark):
    df = spark.range(10).select(F.lit("a").alias("Source"), F.col("id").alias("start0"), F.lit(2).cast("long").alias("length"))
    texts = spark.createDataFrame([("a", "x \n" * 9)], "Source string, Text string").repartition(2)
    moved = S.lf_to_crlf_spans(df, texts)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved = S.lf_to_crlf_spans(df, texts)
        moved.collect()
        plan = moved._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "ReusedExchange" in plan


def test_nonspace_select(spark):
    rng = random.Random(4)
    cases = []
    for i in range(60):
        text = random_text(rng, rng.randrange(1, 40), "ab \n\t ")
        counted = [j for j, c in enumerate(text) if not (c.isspace() and c != " ")]
        for k in range(len(counted)):
            m = rng.randrange(0, len(counted) - k + 1)
            want = 0 if m == 0 else counted[k + m - 1] + 1 - counted[k]
            cases.append((f"s{i}", text, k, m, counted[k], want))
    df = spark.createDataFrame(cases, "Source string, PlainText string, StartText long, LengthText long, a long, b long")
    texts = df.select("Source", "PlainText").distinct()
    rows = S.nonspace_to_char(df.drop("PlainText"), texts).collect()
    assert len(rows) == len(cases)
    assert all((r.StartX, r.LengthX) == (r.a, r.b) for r in rows)


def test_running_totals(spark):
    for n in (0, 1, 2, 3, 10, 101):
        values = list(range(1, n + 1))
        df = spark.createDataFrame([(values,)], "v array<bigint>")
        got = df.select(running_totals(F.col("v"))).first()[0]
        assert got == [sum(values[:i]) for i in range(n)]


def test_paragraphs(spark):
    df = spark.createDataFrame([("ab\n\nc",), ("x\n",), ("",)], "t string")
    got = [[tuple(p) for p in r[0]] for r in df.select(paragraphs(F.col("t"))).collect()]
    assert got == [[(0, 3), (3, 1), (4, 1)], [(0, 2)], []]
