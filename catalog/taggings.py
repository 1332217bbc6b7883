"""Bulk tagging."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from catalog.base import VIEWS, query
from codespan.operators import tagging as TG

NOW = datetime(2024, 6, 1, 12, 0, 0)

# A sheet with one row per order: a document, sometimes a node or only a memo,
# and blanks that inherit from above.
VIEWS["v_orders_sheet"] = """
SELECT o_orderkey AS Row,
       CASE WHEN o_orderkey % 4 = 0 OR o_orderkey % 7 = 1 THEN concat('doc ', CAST(o_orderkey % 150 AS STRING)) END AS Source,
       CASE WHEN o_orderkey % 5 = 0 THEN concat('NATION_', CAST(o_orderkey % 25 AS STRING), chr(10), 'NATION_1') ELSE '' END AS Node,
       CASE WHEN o_orderkey % 3 = 0 THEN concat(CAST(1 + o_orderkey % 9 AS STRING), ':', CAST(1 + o_orderkey % 9 + o_orderkey % 30 AS STRING)) END AS Fragment,
       CASE WHEN o_orderkey % 6 = 0 THEN concat('m', CAST(o_orderkey AS STRING)) END AS Memo
FROM {orders}"""

_FILLED = """
SELECT Row, last_value(Source IGNORE NULLS) OVER w AS Source, last_value(nullif(Node, '') IGNORE NULLS) OVER w AS Node,
  coalesce(last_value(Fragment IGNORE NULLS) OVER w, '1:1') AS Fragment, last_value(Memo IGNORE NULLS) OVER w AS Memo
FROM {v_orders_sheet} WINDOW w AS (ORDER BY Row ROWS UNBOUNDED PRECEDING)"""

_RESOLVED = f"""
SELECT f.Row, s.Id AS Source, n.Id AS NodeId, nm AS NodeName, f.Fragment, f.Memo, length(s.Content) AS Length,
  CASE WHEN CAST(split_part(f.Fragment, ':', 1) AS BIGINT) > length(s.Content) THEN 'start past end of text'
       WHEN CAST(split_part(f.Fragment, ':', 2) AS BIGINT) > length(s.Content) THEN 'end past end of text' END AS Problem
FROM (SELECT *, unnest(string_split(Node, chr(10))) AS nm FROM ({_FILLED}) a WHERE Node IS NOT NULL
      UNION ALL SELECT *, NULL FROM ({_FILLED}) b WHERE Node IS NULL AND Memo IS NOT NULL) f
JOIN {{v_source}} s ON s.Name = f.Source LEFT JOIN {{v_node}} n ON n.Name = f.nm"""


@query(
    "apply_taggings",
    f"SELECT Source, NodeId AS Node, Fragment, Memo, 'u1' AS CreatedBy FROM ({_RESOLVED}) r WHERE Problem IS NULL",
)
def apply_taggings(d):
    out = TG.apply_taggings(
        d.project(), d["v_orders_sheet"], "u1", NOW, defaults={"Fragment": "1:1"}, strict=False
    )
    return out.select("Source", "Node", "Fragment", "Memo", "CreatedBy")


@query(
    "tagging_rejects",
    f"SELECT Row, NodeName, Fragment, CAST(Length AS BIGINT) AS Length, Problem FROM ({_RESOLVED}) r WHERE Problem IS NOT NULL",
)
def tagging_rejects(d):
    out = TG.tagging_rejects(d.project(), d["v_orders_sheet"], defaults={"Fragment": "1:1"})
    return out.select("Row", "NodeName", "Fragment", "Length", "Problem")


def first_word(source, row):
    """A user function: tag the first word, note its length."""
    text = source["Content"] or ""
    word = text.split(" ", 1)[0]
    return [{"Node": row["Node"], "Fragment": f"1:{len(word)}", "Memo": word}] if word else []


@query(
    "user_tagging_fn",
    """SELECT s.Id AS Source, n.Id AS Node, concat('1:', CAST(length(w) AS STRING)) AS Fragment, w AS Memo
       FROM (SELECT Id, Name, split_part(Content, ' ', 1) AS w FROM {v_source}) s
       JOIN (SELECT concat('doc ', CAST(c_custkey AS STRING)) AS doc, concat('NATION_', CAST(c_nationkey AS STRING)) AS nation FROM {customer}) c
         ON c.doc = s.Name JOIN {v_node} n ON n.Name = c.nation WHERE w <> ''""",
)
def user_tagging_fn(d):
    sheet = d["customer"].select(
        F.col("c_custkey").alias("Row"), F.concat(F.lit("doc "), F.col("c_custkey").cast("string")).alias("Source"),
        F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("Node"),
    )
    out = TG.apply_tagging_fn(d.project(), sheet, first_word, "u1", NOW)
    return out.select("Source", "Node", "Fragment", "Memo")


def _transcripts(d):
    roles = d["conversations"].select(F.col("role").alias("Name")).distinct()
    p = d.project()
    return p | {
        "Source": d["v_transcript"].withColumn("Name", F.col("Id")).withColumn("Category", F.lit(None).cast("string")),
        "Node": roles.select(F.concat(F.lit("role "), "Name").alias("Id"), "Name", F.lit("c0").alias("Category")),
    }


# Each turn begins with its role, so the tagged part is the first line said.
@query(
    "speaker_tags",
    r"""SELECT concat('t', CAST(conv_id AS STRING)) AS Source, concat('role ', role) AS Node,
          concat(CAST(b AS STRING), ':', CAST(b + length(regexp_extract(said, '^[^\n]*')) AS STRING)) AS Fragment
        FROM (SELECT conv_id, turn, role, ltrim(text, concat(' ', chr(10), chr(9))) AS said,
            CAST(coalesce(sum(length(role) + 2 + length(text) + 1) OVER (PARTITION BY conv_id ORDER BY turn
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) + length(role) + 2
              + length(text) - length(ltrim(text, concat(' ', chr(10), chr(9)))) AS b
          FROM {conversations}) x""",
)
def speaker_tags(d):
    return TG.tag_speakers(_transcripts(d), "u1", NOW, node_category="category 0").select("Source", "Node", "Fragment")


@query(
    "speaker_duplicates",
    "SELECT p_name AS Name, count(*) AS n FROM {part} GROUP BY p_name HAVING count(*) > 1",
)
def speaker_duplicates(d):
    return TG.duplicate_speakers(d["part"].select(F.col("p_name").alias("Name")))


_STOP = ", ".join(f"'{w}'" for w in TG.STOP_WORDS)
_SENTENCES = r"""
SELECT Id, n, lower(trim(t, concat(' ', chr(10)))) AS Sentence,
  off + length(t) - length(ltrim(t, concat(' ', chr(10)))) AS start0,
  off + length(t) - length(ltrim(t, concat(' ', chr(10)))) + length(trim(t, concat(' ', chr(10)))) AS end0
FROM (SELECT Id, n, t, lead_ + CAST(sum(length(t)) OVER (PARTITION BY Id ORDER BY n ROWS UNBOUNDED PRECEDING) AS BIGINT) - length(t) AS off
  FROM (SELECT Id, length(regexp_extract(Content, '^[.!?\n]*')) AS lead_,
          unnest(regexp_extract_all(Content, '[^.!?\n]+[.!?\n]*')) AS t,
          generate_subscripts(regexp_extract_all(Content, '[^.!?\n]+[.!?\n]*'), 1) AS n FROM {v_source}) x) y
WHERE length(trim(t, concat(' ', chr(10)))) > 0"""
_PAIRS = rf"""
SELECT Id AS Source, start0, end0, concat(words[k], ' ', words[k + 1]) AS Phrase
FROM (SELECT *, unnest(range(1, len(words))) AS k FROM (
  SELECT Id, start0, end0, list_filter(string_split(unnest(regexp_split_to_array(Sentence, '[^\p{{L}}\p{{M}} ]+')), ' '), lambda w: w <> '') AS words
  FROM ({_SENTENCES}) s) a) b
WHERE words[k] NOT IN ({_STOP}) AND words[k + 1] NOT IN ({_STOP})"""


@query("sentence_index", f"SELECT Id, CAST(start0 AS BIGINT) AS start0, CAST(end0 AS BIGINT) AS end0 FROM ({_SENTENCES}) s")
def sentence_index(d):
    return TG.sentences(d["v_source"]).select("Id", "start0", "end0")


@query(
    "phrase_frequency",
    f"SELECT Phrase, count(*) AS n FROM ({_PAIRS}) p GROUP BY Phrase HAVING count(*) >= 5",
)
def phrase_frequency(d):
    return TG.phrase_frequency(d["v_source"], threshold=5)


# Every run of one to four words without stop words, and those frequent.
_WORD = rf"""
word AS (
  SELECT Id AS Source, start0, end0, run, k, words[k] AS w FROM (
    SELECT *, unnest(range(1, len(words) + 1)) AS k FROM (
      SELECT Id, start0, end0, run, list_filter(string_split(piece, ' '), lambda w: w <> '') AS words FROM (
        SELECT Id, start0, end0, unnest(regexp_extract_all(Sentence, '[\p{{L}}\p{{M}} ]+')) AS piece,
               generate_subscripts(regexp_extract_all(Sentence, '[\p{{L}}\p{{M}} ]+'), 1) AS run
        FROM ({_SENTENCES}) s) a) b) c
  WHERE w NOT IN ({_STOP})),"""
_RUNS = rf"""{_WORD}
grown AS (
  SELECT a.Source, a.start0, a.end0, a.run, a.k, 1 AS size, a.w AS Phrase FROM word a
  UNION ALL
  SELECT a.Source, a.start0, a.end0, a.run, a.k, size, Phrase FROM (
    SELECT *, unnest([2, 3, 4]) AS size, unnest([w || ' ' || w2, w || ' ' || w2 || ' ' || w3, w || ' ' || w2 || ' ' || w3 || ' ' || w4]) AS Phrase
    FROM (SELECT *, CASE WHEN lead(k) OVER o = k + 1 THEN lead(w) OVER o END AS w2,
                 CASE WHEN lead(k, 2) OVER o = k + 2 THEN lead(w, 2) OVER o END AS w3,
                 CASE WHEN lead(k, 3) OVER o = k + 3 THEN lead(w, 3) OVER o END AS w4
          FROM word WINDOW o AS (PARTITION BY Source, start0, end0, run ORDER BY k)) x) a WHERE Phrase IS NOT NULL),
counted AS (SELECT Phrase, count(*) AS n FROM grown GROUP BY Phrase HAVING count(*) >= 12)"""


@query("phrase_runs", f"WITH {_RUNS} SELECT Phrase, n FROM counted")
def phrase_runs(d):
    return TG.run_frequency(d["v_source"].select("Id", "Content"), 12)


# Runs of any length that are frequent, a word longer each time, and of these the longest at a place.
_LONGEST = rf"""{_WORD}
grown AS (
  SELECT Source, start0, end0, run, k, 1 AS size, w AS Phrase FROM (SELECT *, count(*) OVER (PARTITION BY w) AS n FROM word) a WHERE n >= 12
  UNION ALL
  SELECT Source, start0, end0, run, k, size, Phrase FROM (
    SELECT *, count(*) OVER (PARTITION BY Phrase) AS n FROM (
      SELECT g.Source, g.start0, g.end0, g.run, g.k, size + 1 AS size, Phrase || ' ' || w AS Phrase
      FROM grown g JOIN word x ON x.Source = g.Source AND x.start0 = g.start0 AND x.end0 = g.end0 AND x.run = g.run AND x.k = g.k + size) b) c
  WHERE n >= 12),
longest AS (
  SELECT * FROM grown a WHERE NOT EXISTS (
    SELECT 1 FROM grown b WHERE b.Source = a.Source AND b.start0 = a.start0 AND b.end0 = a.end0 AND b.run = a.run
      AND b.size = a.size + 1 AND b.k IN (a.k, a.k - 1)))"""


@query(
    "phrase_run_tags",
    f"""WITH RECURSIVE {_LONGEST} SELECT Source, Phrase, concat(CAST(start0 AS STRING), ':', CAST(end0 - 1 AS STRING)) AS Fragment,
          CAST(count(*) AS BIGINT) AS n FROM longest GROUP BY Source, Phrase, start0, end0""",
)
def phrase_run_tags(d):
    """Phrases of any length as nodes, the longest at each place as taggings."""
    p = d.project()
    out = TG.tag_phrases(p, "u1", NOW, threshold=12, extractor=None)
    nodes = out["Node"].join(d["v_node"].select("Id"), "Id", "left_anti").select(F.col("Id").alias("Node"), F.col("Name").alias("Phrase"))
    return out["Tagging"].join(nodes, "Node").groupBy("Source", "Phrase", "Fragment").agg(F.count(F.lit(1)).alias("n"))


@query(
    "phrase_tags",
    f"""WITH p AS ({_PAIRS}), f AS (SELECT Phrase FROM p GROUP BY Phrase HAVING count(*) >= 20)
        SELECT Source, Phrase, concat(CAST(start0 AS STRING), ':', CAST(end0 - 1 AS STRING)) AS Fragment
        FROM p WHERE Phrase IN (SELECT Phrase FROM f)
        UNION ALL SELECT Source, Name, Fragment FROM {{v_tagging}} t JOIN {{v_node}} n ON n.Id = t.Node""",
)
def phrase_tags(d):
    """All taggings under the names of their nodes, those of phrases among them."""
    out = TG.tag_phrases(d.project(), "u1", NOW, threshold=20)
    nodes = out["Node"].select(F.col("Id").alias("Node"), F.col("Name").alias("Phrase"))
    return out["Tagging"].join(nodes, "Node").select("Source", "Phrase", "Fragment")
