"""Fragments, spans and coded passages."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import query
from codespan.functions import fragments as FR
from codespan.operators import query as Q
from codespan.operators import spans as S

# Merging as the oracle states it: an island starts where no earlier span reaches.
MERGED = """
SELECT Source, Node, min(First_) AS First_, max(Last_) AS Last_ FROM (
  SELECT *, sum(CASE WHEN reach IS NULL OR First_ > reach THEN 1 ELSE 0 END)
    OVER (PARTITION BY Source, Node ORDER BY First_, Last_, Id ROWS UNBOUNDED PRECEDING) AS island
  FROM (SELECT *, max(Last_) OVER (PARTITION BY Source, Node ORDER BY First_, Last_, Id
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {v_span}) a) b
GROUP BY Source, Node, island"""


def _spans(d, node=None):
    df = d["v_span"].select(
        "Id", "Source", "Node", (F.col("First_") - 1).alias("start0"), F.col("Last_").alias("end0")
    )
    return df if node is None else df.filter(F.col("Node") == node)


@query(
    "span_text_by_node",
    """SELECT t.Id, s.Name AS Source, substring(s.Content, First_, Last_ - First_ + 1) AS Text
       FROM {v_span} t JOIN {v_source} s ON s.Id = t.Source WHERE t.Node = 'n3'""",
)
def span_text_by_node(d):
    rows = Q.with_text({"Source": d["v_source"]}, _spans(d, "n3"))
    return rows.select("Id", F.col("SourceName").alias("Source"), "Text")


@query("merge_spans", f"SELECT Source, Node, First_, Last_ FROM ({MERGED}) m")
def merge_spans(d):
    return S.merge_spans(_spans(d), ["Source", "Node"]).select(
        "Source", "Node", (F.col("start0") + 1).alias("First_"), F.col("end0").alias("Last_")
    )


@query(
    "merge_spans_first_memo",
    """SELECT Source, Node, First_, Last_, Memo FROM (
         SELECT Source, Node, island, min(First_) AS First_, max(Last_) AS Last_,
                arg_min(m, o) AS Memo FROM (
           SELECT *, sum(CASE WHEN reach IS NULL OR First_ > reach THEN 1 ELSE 0 END)
               OVER (PARTITION BY Source, Node ORDER BY First_, Last_, Id ROWS UNBOUNDED PRECEDING) AS island,
             row_number() OVER (PARTITION BY Source, Node ORDER BY First_, Last_, Id) AS o,
             concat('memo ', Id) AS m
           FROM (SELECT *, max(Last_) OVER (PARTITION BY Source, Node ORDER BY First_, Last_, Id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {v_span}) a) b
         GROUP BY Source, Node, island) x""",
)
def merge_spans_first_memo(d):
    rows = _spans(d).withColumn("Memo", F.concat(F.lit("memo "), "Id"))
    return S.merge_spans(rows, ["Source", "Node"], first=["Memo"], tie=["Id"]).select(
        "Source", "Node", (F.col("start0") + 1).alias("First_"), F.col("end0").alias("Last_"), "Memo"
    )


@query(
    "intersect_spans",
    """SELECT a.Id AS Id1, b.Id AS Id2, a.Source AS Source,
              greatest(a.First_, b.First_) AS First_, least(a.Last_, b.Last_) AS Last_
       FROM {v_span} a JOIN {v_span} b ON a.Source = b.Source
        AND a.First_ <= b.Last_ AND b.First_ <= a.Last_ WHERE a.Node = 'n3' AND b.Node = 'n7'""",
)
def intersect_spans(d):
    a = _spans(d, "n3").withColumnRenamed("Id", "Id1")
    b = _spans(d, "n7").withColumnRenamed("Id", "Id2")
    return S.intersect_spans(a, b, ["Id1"], ["Id2"]).select(
        "Id1", "Id2", "Source", (F.col("start0") + 1).alias("First_"), F.col("end0").alias("Last_")
    )


def _term(node):
    return f"SELECT Source, First_, Last_ FROM ({MERGED}) m WHERE Node = '{node}'"


def _pair(a, b):
    return f"""SELECT a.Source, greatest(a.First_, b.First_) AS First_, least(a.Last_, b.Last_) AS Last_
      FROM ({a}) a JOIN ({b}) b ON a.Source = b.Source AND a.First_ <= b.Last_ AND b.First_ <= a.Last_"""


@query("intersect_two_nodes", f"SELECT Source, First_, Last_ FROM ({_pair(_term('n3'), _term('n7'))}) x")
def intersect_two_nodes(d):
    return S.intersect_terms([_spans(d, "n3"), _spans(d, "n7")]).select(
        "Source", (F.col("start0") + 1).alias("First_"), F.col("end0").alias("Last_")
    )


@query(
    "intersect_three_nodes",
    f"SELECT Source, First_, Last_ FROM ({_pair(_pair(_term('n3'), _term('n7')), _term('n12'))}) x",
)
def intersect_three_nodes(d):
    return S.intersect_terms([_spans(d, n) for n in ("n3", "n7", "n12")]).select(
        "Source", (F.col("start0") + 1).alias("First_"), F.col("end0").alias("Last_")
    )


# The oracle's passages of one node over the whole project, annotations left out.
_TAGGED = """
SELECT t.Source, n.Name AS Node, n.Category,
       CAST(split_part(Fragment, ':', 1) AS BIGINT) AS First_,
       CAST(split_part(Fragment, ':', 2) AS BIGINT) AS Last_, Memo, t.Id
FROM {v_tagging} t JOIN {v_node} n ON n.Id = t.Node"""

_PASSAGES = """
SELECT Source, Node, min(First_) AS First_, max(Last_) AS Last_, arg_min(coalesce(Memo, ''), o) AS Memo FROM (
  SELECT *, sum(CASE WHEN reach IS NULL OR First_ > reach THEN 1 ELSE 0 END)
    OVER (PARTITION BY Source, Node ORDER BY First_, Last_, Id ROWS UNBOUNDED PRECEDING) AS island,
    row_number() OVER (PARTITION BY Source, Node ORDER BY First_, Last_, Id) AS o
  FROM (SELECT *, max(Last_) OVER (PARTITION BY Source, Node ORDER BY First_, Last_, Id
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM tagged) a) b
GROUP BY Source, Node, island"""


@query(
    "query_taggings_one_node",
    f"""WITH tagged AS (SELECT * FROM ({_TAGGED}) x WHERE Node = 'NATION_3'),
        p AS ({_PASSAGES})
        SELECT s.Name AS Source, Node, Memo, substring(s.Content, First_, Last_ - First_ + 1) AS Text,
               concat(CAST(First_ AS STRING), ':', CAST(Last_ AS STRING)) AS Fragment
        FROM p JOIN {{v_source}} s ON s.Id = p.Source""",
)
def query_taggings_one_node(d):
    return Q.query_taggings(d.project(), nodes=["NATION_3"]).withColumn(
        "Memo", F.coalesce("Memo", F.lit(""))
    )


@query(
    "query_taggings_category_and_node",
    f"""WITH tagged AS ({_TAGGED}), p AS ({_PASSAGES}),
        term1 AS (SELECT p.* FROM p JOIN (SELECT n.Name FROM {{v_node}} n JOIN {{v_nodecat}} c
                    ON c.Id = n.Category WHERE c.Name = 'category 1' AND n.Id LIKE 'n%') c ON c.Name = p.Node),
        term2 AS (SELECT * FROM p WHERE Node = 'NATION_3'),
        x AS (SELECT a.Source, a.Node AS N1, b.Node AS N2, greatest(a.First_, b.First_) AS First_,
                     least(a.Last_, b.Last_) AS Last_
              FROM term1 a JOIN term2 b ON a.Source = b.Source
               AND a.First_ <= b.Last_ AND b.First_ <= a.Last_)
        SELECT s.Name AS Source, concat(N2, chr(10), N1) AS Node,
               substring(s.Content, First_, Last_ - First_ + 1) AS Text,
               concat(CAST(First_ AS STRING), ':', CAST(Last_ AS STRING)) AS Fragment
        FROM x JOIN {{v_source}} s ON s.Id = x.Source""",
)
def query_taggings_category_and_node(d):
    return Q.query_taggings(d.project(), nodes=["NATION_3"], node_category="category 1").drop("Memo")


@query(
    "query_taggings_all",
    """WITH tagged AS (SELECT t.Source, coalesce(n.Name, '') AS Node,
         CAST(split_part(Fragment, ':', 1) AS BIGINT) AS First_,
         CAST(split_part(Fragment, ':', 2) AS BIGINT) AS Last_, Memo, t.Id
       FROM {v_tagging} t LEFT JOIN {v_node} n ON n.Id = t.Node),
       p AS (""" + _PASSAGES + """)
       SELECT s.Name AS Source, Node, Memo, substring(s.Content, First_, Last_ - First_ + 1) AS Text,
              concat(CAST(First_ AS STRING), ':', CAST(Last_ AS STRING)) AS Fragment
       FROM p JOIN {v_source} s ON s.Id = p.Source""",
)
def query_taggings_all(d):
    """Every passage of every source, without any term."""
    q = Q.query_taggings(d.project())
    return q.withColumn("Memo", F.coalesce("Memo", F.lit("")))


@query(
    "extract_taggings",
    """SELECT n.Name AS Node, s.Name AS Source, Fragment, TRUE AS Recognised,
         substring(s.Content, CAST(split_part(Fragment, ':', 1) AS BIGINT) + 1,
           CAST(split_part(Fragment, ':', 2) AS BIGINT) - CAST(split_part(Fragment, ':', 1) AS BIGINT) + 1) AS Text
       FROM {v_tagging} t JOIN {v_node} n ON n.Id = t.Node JOIN {v_source} s ON s.Id = t.Source
       WHERE n.Name = 'NATION_7'""",
)
def extract_taggings(d):
    return Q.extract_taggings(d.project(), node="NATION_7")


@query(
    "fragment_parse",
    r"""SELECT Id, Fragment,
          CAST(regexp_extract(Fragment, '^([0-9]+):([0-9]+)', 1) AS BIGINT) - 1 AS start0,
          CAST(regexp_extract(Fragment, '^([0-9]+):([0-9]+)', 2) AS BIGINT) AS end0,
          TRY_CAST(regexp_extract(Fragment, '^[0-9]+:[0-9]+,([0-9]+)', 1) AS BIGINT) AS y1,
          TRY_CAST(regexp_extract(Fragment, '^[0-9]+:[0-9]+,[0-9]+:([0-9]+)', 1) AS BIGINT) AS y2
        FROM {v_fragment} WHERE regexp_matches(Fragment, '^[0-9]+:[0-9]+')""",
)
def fragment_parse(d):
    rows = d["v_fragment"].filter(FR.is_fragment(F.col("Fragment")))
    return rows.select("Id", "Fragment", FR.parse_fragment(F.col("Fragment")).alias("f")).select(
        "Id", "Fragment", "f.*"
    )


@query(
    "fragment_roundtrip",
    "SELECT Id, Fragment AS Fragment FROM {v_fragment} WHERE regexp_matches(Fragment, '^[0-9]+:[0-9]+')",
)
def fragment_roundtrip(d):
    rows = d["v_fragment"].filter(FR.is_fragment(F.col("Fragment")))
    s = rows.select("Id", FR.parse_fragment(F.col("Fragment")).alias("f"))
    return s.select(
        "Id",
        FR.format_fragment(F.col("f.start0"), F.col("f.end0"), F.col("f.y1"), F.col("f.y2")).alias("Fragment"),
    )


@query(
    "fragment_rejects",
    "SELECT Id, Source, Fragment FROM {v_fragment} WHERE NOT regexp_matches(Fragment, '^[0-9]+:[0-9]+')",
)
def fragment_rejects(d):
    return Q.fragment_rejects({"Tagging": d["v_fragment"]})


@query(
    "fragment_errors",
    """SELECT Reason, count(*) AS n FROM (
         SELECT CASE WHEN NOT regexp_matches(Fragment, '^[0-9]+:[0-9]+') THEN 'malformed'
           WHEN a > len THEN 'start past end of text' WHEN b < a THEN 'end before start'
           WHEN b > len THEN 'end past end of text' ELSE 'fits' END AS Reason
         FROM (SELECT f.Fragment, 200 AS len,
             TRY_CAST(regexp_extract(f.Fragment, '^([0-9]+):', 1) AS BIGINT) AS a,
             TRY_CAST(regexp_extract(f.Fragment, '^[0-9]+:([0-9]+)', 1) AS BIGINT) AS b
           FROM {v_fragment} f) x) y GROUP BY Reason""",
)
def fragment_errors(d):
    reason = F.coalesce(FR.fragment_error(F.col("Fragment"), F.lit(200)), F.lit("fits"))
    return d["v_fragment"].groupBy(reason.alias("Reason")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "clamp_spans",
    """SELECT Id, start0, CASE WHEN start0 + len > n THEN n - start0 ELSE len END AS length FROM (
         SELECT t.Id, greatest(t.First_ - 40, 0) AS start0, t.Last_ - t.First_ + 60 AS len, length(s.Content) AS n
         FROM {v_span} t JOIN {v_source} s ON s.Id = t.Source) x""",
)
def clamp_spans(d):
    texts = d["v_source"].select(F.col("Id").alias("Source"), F.length("Content").alias("n"))
    c = FR.clamp_span(F.col("First_") - 40, F.col("Last_") - F.col("First_") + 60, F.col("n"))
    return d["v_span"].join(texts, "Source").select("Id", c.alias("c")).select("Id", "c.*")


@query(
    "source_by_category",
    """SELECT s.Name, s.Description, s.Content, c.Name AS Category, s.Color
       FROM {v_source} s LEFT JOIN {v_srccat} c ON c.Id = s.Category""",
)
def source_by_category(d):
    return Q.query_sources(d.project())


@query(
    "sources_like",
    "SELECT Id, Name FROM {v_source} WHERE Name LIKE 'doc 1%'",
)
def sources_like(d):
    return Q.filter_sources(d.project(), like="doc 1%").select("Id", "Name")


@query(
    "annotated_taggings",
    """SELECT t.Id, t.Source, n.Name AS Node, t.Memo,
         CAST(split_part(Fragment, ':', 1) AS BIGINT) - 1 AS start0,
         CAST(split_part(Fragment, ':', 2) AS BIGINT) AS end0
       FROM {v_tagging} t LEFT JOIN {v_node} n ON n.Id = t.Node""",
)
def annotated_taggings(d):
    return Q.tagging_rows(d.project()).select("Id", "Source", "Node", "Memo", "start0", "end0")


@query(
    "tagging_author",
    """SELECT t.Id, u.Name AS Author, t.CreatedDate, t.ModifiedDate
       FROM {v_tagging} t JOIN {v_user} u ON u.Id = t.ModifiedBy""",
)
def tagging_author(d):
    return Q.tagging_authors(d.project()).select("Id", "Author", "CreatedDate", "ModifiedDate")
