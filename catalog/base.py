"""Fixture views on the given tables and the query registry.

A view is SQL that both engines read, with ``{name}`` for every table or view it
uses.  Spark gets DataFrames in those places; the oracle gets common table
expressions.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()

VIEWS: dict[str, str] = {}

VIEWS["v_user"] = """
SELECT DISTINCT concat('u', CAST(user_id AS STRING)) AS Id,
       concat('user ', CAST(user_id AS STRING)) AS Name FROM {events}"""

VIEWS["v_project"] = """
SELECT '0.2' AS Version, 'Test project' AS Title, 'made from orders' AS Description,
       'u1' AS CreatedBy, min(o_orderdate) AS CreatedDate,
       'u2' AS ModifiedBy, max(o_orderdate) AS ModifiedDate FROM {orders}"""

VIEWS["v_nodecat"] = """
SELECT concat('c', CAST(r_regionkey AS STRING)) AS Id,
       concat('category ', CAST(r_regionkey AS STRING)) AS Name, r_name AS Description,
       'u1' AS CreatedBy, TIMESTAMP '2020-01-01 00:00:00' AS CreatedDate,
       'u1' AS ModifiedBy, TIMESTAMP '2020-01-02 00:00:00' AS ModifiedDate FROM {region}"""

VIEWS["v_node"] = """
SELECT concat('r', CAST(r_regionkey AS STRING)) AS Id, CAST(NULL AS STRING) AS Parent,
       CAST(NULL AS STRING) AS Category, r_name AS Name, 'a region' AS Description,
       r_regionkey AS Color, r_regionkey % 2 = 0 AS Aggregate,
       'u1' AS CreatedBy, TIMESTAMP '2020-01-01 00:00:00' AS CreatedDate,
       'u1' AS ModifiedBy, TIMESTAMP '2020-01-02 00:00:00' AS ModifiedDate FROM {region}
UNION ALL
SELECT concat('n', CAST(n_nationkey AS STRING)), concat('r', CAST(n_regionkey AS STRING)),
       concat('c', CAST(n_regionkey AS STRING)), n_name, 'a nation', n_nationkey,
       n_nationkey % 3 = 0, 'u2', TIMESTAMP '2020-01-01 00:00:00', 'u2',
       TIMESTAMP '2020-01-03 00:00:00' FROM {nation}
UNION ALL
SELECT concat('s', CAST(s_suppkey AS STRING)), concat('n', CAST(s_nationkey AS STRING)),
       concat('c', CAST(s_nationkey % 5 AS STRING)), s_name, CAST(NULL AS STRING),
       CAST(s_suppkey AS INT), FALSE, 'u3', TIMESTAMP '2020-01-01 00:00:00', 'u3',
       TIMESTAMP '2020-01-04 00:00:00' FROM {supplier}"""

VIEWS["v_nodeattr"] = """
SELECT * FROM (VALUES ('na_bal', 'balance', 'decimal', 0), ('na_key', 'key', 'integer', 0),
  ('na_rich', 'rich', 'boolean', 0), ('na_label', 'label', 'text', 40),
  ('na_since', 'since', 'date', 0)) AS t(Id, Name, Type, Length)"""

VIEWS["v_nodevalue"] = """
SELECT concat('s', CAST(s_suppkey AS STRING)) AS Node, 'na_bal' AS Attribute,
       CAST(CAST(s_acctbal AS DECIMAL(12, 2)) AS STRING) AS Value FROM {supplier}
UNION ALL SELECT concat('s', CAST(s_suppkey AS STRING)), 'na_key', CAST(s_suppkey AS STRING) FROM {supplier}
UNION ALL SELECT concat('s', CAST(s_suppkey AS STRING)), 'na_rich',
       CASE WHEN s_acctbal > 5000 THEN 'yes' ELSE 'off' END FROM {supplier} WHERE s_suppkey % 2 = 0
UNION ALL SELECT concat('n', CAST(n_nationkey AS STRING)), 'na_label', n_name FROM {nation} WHERE n_nationkey % 2 = 0
UNION ALL SELECT concat('s', CAST(s_suppkey AS STRING)), 'na_since',
       concat('2020-0', CAST(1 + s_suppkey % 9 AS STRING), '-1', CAST(s_suppkey % 10 AS STRING))
       FROM {supplier} WHERE s_suppkey % 3 = 0"""

VIEWS["v_srccat"] = """
SELECT DISTINCT concat('sc_', source) AS Id, source AS Name,
       concat('documents from ', source) AS Description FROM {documents}"""

VIEWS["v_source"] = """
SELECT concat('d', CAST(doc_id AS STRING)) AS Id, concat('sc_', source) AS Category,
       concat('doc ', CAST(doc_id AS STRING)) AS Name, lang AS Description,
       CAST(doc_id % 256 AS INT) AS Color, text AS Content, 'TXT' AS ObjectType,
       'u1' AS CreatedBy, TIMESTAMP '2021-01-01 00:00:00' AS CreatedDate,
       'u1' AS ModifiedBy, TIMESTAMP '2021-01-02 00:00:00' AS ModifiedDate
FROM {documents}"""

VIEWS["v_srcattr"] = """
SELECT * FROM (VALUES ('sa_lang', 'lang', 'text', 8), ('sa_chars', 'n_chars', 'integer', 0),
  ('sa_quality', 'quality', 'integer', 0), ('sa_toxic', 'toxic', 'boolean', 0))
  AS t(Id, Name, Type, Length)"""

VIEWS["v_srcvalue"] = """
SELECT concat('d', CAST(doc_id AS STRING)) AS Source, 'sa_lang' AS Attribute, lang AS Value FROM {documents}
UNION ALL SELECT concat('d', CAST(doc_id AS STRING)), 'sa_chars', CAST(n_chars AS STRING) FROM {documents}
UNION ALL SELECT concat('d', CAST(doc_id AS STRING)), 'sa_quality', CAST(quality AS STRING) FROM {labels}
UNION ALL SELECT concat('d', CAST(doc_id AS STRING)), 'sa_toxic',
       CASE WHEN toxic = 1 THEN 'true' ELSE 'false' END FROM {labels}"""

# One span per lineitem row, one-based with the end included; some taggings are
# memo-only annotations.
VIEWS["v_span"] = """
SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-',
              CAST(l_partkey AS STRING), '-', CAST(l_suppkey AS STRING), '-',
              CAST(CAST(l_quantity AS BIGINT) AS STRING), '-',
              CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS STRING)) AS Id,
       concat('d', CAST(doc_id AS STRING)) AS Source,
       concat('n', CAST(l_suppkey % 25 AS STRING)) AS Node,
       1 + (l_orderkey * 37 + l_linenumber * 101) % n_chars AS First_,
       least(n_chars, 1 + (l_orderkey * 37 + l_linenumber * 101) % n_chars
                        + CAST(l_quantity AS BIGINT) * 4) AS Last_,
       concat('u', CAST(l_suppkey % 40 AS STRING)) AS CreatedBy, l_shipdate AS CreatedDate,
       concat('u', CAST(l_partkey % 60 AS STRING)) AS ModifiedBy, l_shipdate AS ModifiedDate
FROM (SELECT l.*, l_partkey % n AS did
      FROM {lineitem} l CROSS JOIN (SELECT count(*) AS n FROM {documents}) c) x
JOIN {documents} ON doc_id = did WHERE n_chars > 0"""

VIEWS["v_tagging"] = """
SELECT Id, Source, CASE WHEN First_ % 10 = 0 THEN NULL ELSE Node END AS Node,
       concat(CAST(First_ AS STRING), ':', CAST(Last_ AS STRING)) AS Fragment,
       CASE WHEN First_ % 10 = 0 OR First_ % 3 = 0 THEN concat('memo ', Id) END AS Memo,
       CreatedBy, CreatedDate, ModifiedBy, ModifiedDate FROM {v_span}"""

VIEWS["v_fragment"] = """
SELECT Id, Source,
  CASE WHEN First_ % 50 = 0 THEN concat('x', CAST(First_ AS STRING))
       WHEN First_ % 7 = 0 THEN concat(CAST(First_ AS STRING), ':', CAST(Last_ AS STRING), ',',
            CAST(First_ % 13 AS STRING), ':', CAST(First_ % 13 + 5 AS STRING))
       WHEN First_ % 11 = 0 THEN concat(CAST(First_ AS STRING), ':', CAST(Last_ AS STRING), ',',
            CAST(First_ % 13 AS STRING))
       ELSE concat(CAST(First_ AS STRING), ':', CAST(Last_ AS STRING)) END AS Fragment
FROM {v_span}"""

VIEWS["v_transcript"] = ""  # differs by engine, see below

_SPARK_TRANSCRIPT = """
SELECT concat('t', CAST(conv_id AS STRING)) AS Id,
       listagg(concat(role, ': ', text), chr(10)) WITHIN GROUP (ORDER BY turn) AS Content
FROM {conversations} GROUP BY conv_id"""
_ORACLE_TRANSCRIPT = """
SELECT concat('t', CAST(conv_id AS STRING)) AS Id,
       string_agg(concat(role, ': ', text), chr(10) ORDER BY turn) AS Content
FROM {conversations} GROUP BY conv_id"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Data:
    """Tables and views of one data directory, built on demand."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._make(name)
        return self._made[name]

    def _make(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        text = _SPARK_TRANSCRIPT if name == "v_transcript" else VIEWS[name]
        return self.sql(text)

    def sql(self, text: str) -> DataFrame:
        used = {n: self[n] for n in re.findall(r"\{([a-z_]\w*)\}", text)}
        return self.spark.sql(text, **used)

    def project(self, *wanted: str) -> dict[str, DataFrame]:
        """The canonical project over the views; tables not asked for are empty."""
        from codespan.sources.project import conform

        names = {
            "User": "v_user", "Project": "v_project", "NodeCategory": "v_nodecat",
            "Node": "v_node", "NodeAttribute": "v_nodeattr", "NodeValue": "v_nodevalue",
            "SourceCategory": "v_srccat", "Source": "v_source", "SourceAttribute": "v_srcattr",
            "SourceValue": "v_srcvalue", "Tagging": "v_tagging",
        }
        return conform({t: self[view] for t, view in names.items() if not wanted or t in wanted})


def _oracle_text(sql: str) -> str:
    """Prefix the common table expressions a query needs, in order."""
    needed: list[str] = []

    def visit(text):
        for name in re.findall(r"\{([a-z_]\w*)\}", text):
            if name in VIEWS and name not in needed:
                body = _ORACLE_TRANSCRIPT if name == "v_transcript" else VIEWS[name]
                visit(body)
                needed.append(name)

    visit(sql)
    plain = lambda text: re.sub(r"\{([a-z_]\w*)\}", r"\1", text)
    views = [
        f"{n} AS ({plain(_ORACLE_TRANSCRIPT if n == 'v_transcript' else VIEWS[n])})" for n in needed
    ]
    body = plain(sql).strip()
    if not views:
        return body
    if body.upper().startswith("WITH RECURSIVE"):
        return "WITH RECURSIVE " + ", ".join(views) + ", " + body[len("WITH RECURSIVE"):].strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ", ".join(views) + ", " + body[5:].strip()
    return "WITH " + ", ".join(views) + " " + body


def query(name: str, sql: str | None = None):
    """Register a query over :class:`Data` together with its oracle."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Data(spark, sf_dir))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = _oracle_text(sql)
        return fn

    return register
