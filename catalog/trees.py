"""Trees of nodes."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import VIEWS, query
from codespan.operators import tree

# A tree that grows with the data: every order hangs under an earlier one.
VIEWS["v_deep"] = """
SELECT concat('o', CAST(o_orderkey AS STRING)) AS Id,
       CASE WHEN o_orderkey > 4 THEN concat('o', CAST((o_orderkey - o_orderkey % 3) / 3 AS BIGINT)) END AS Parent,
       concat('order ', CAST(o_orderkey AS STRING)) AS Name, o_orderkey % 4 <> 0 AS Aggregate
FROM {orders}""".replace("CAST((o_orderkey - o_orderkey % 3) / 3 AS BIGINT)", "CAST(CAST((o_orderkey - o_orderkey % 3) / 3 AS BIGINT) AS STRING)")

_WALK = """WITH RECURSIVE walk AS (
  SELECT Id, Name, Parent, 0 AS Depth, Id AS TopParent, concat('Nodes', chr(92), chr(92), Name) AS HierarchicalName
  FROM {view} WHERE Parent IS NULL
  UNION ALL
  SELECT n.Id, n.Name, n.Parent, Depth + 1, TopParent, concat(HierarchicalName, chr(92), n.Name)
  FROM {view} n JOIN walk w ON w.Id = n.Parent)
SELECT Id, Depth, TopParent, HierarchicalName, CAST(Depth AS BIGINT) * 65536 + row_number() OVER (
  PARTITION BY Parent ORDER BY substring(md5(Id), 1, 3), Id) - 1 AS RoleTag FROM walk"""

_PAIRS = """WITH RECURSIVE pairs AS (
  SELECT Id, Id AS Ancestor, Parent AS up FROM {view}
  UNION ALL
  SELECT p.Id, a.Id, a.Parent FROM pairs p JOIN {view} a ON a.Id = p.up WHERE a.Aggregate)
SELECT Id, Ancestor FROM pairs"""


@query("tree_paths", _WALK.replace("{view}", "{v_node}"))
def tree_paths(d):
    return tree.tree_walk(d["v_node"].select("Id", "Parent", "Name"), folder="Nodes")


@query("tree_paths_deep", _WALK.replace("{view}", "{v_deep}"))
def tree_paths_deep(d):
    return tree.tree_walk(d["v_deep"].select("Id", "Parent", "Name"), folder="Nodes")


@query("aggregate_closure", _PAIRS.replace("{view}", "{v_node}"))
def aggregate_closure(d):
    return tree.aggregate_pairs(d["v_node"].select("Id", "Parent", "Aggregate"))


@query("aggregate_closure_deep", _PAIRS.replace("{view}", "{v_deep}"))
def aggregate_closure_deep(d):
    return tree.aggregate_pairs(d["v_deep"].select("Id", "Parent", "Aggregate"))


@query(
    "tree_orphans",
    """SELECT Id, Parent FROM {v_node} WHERE Parent NOT IN (SELECT Id FROM {v_node} WHERE Color % 4 <> 1)""",
)
def tree_orphans(d):
    n = d["v_node"].select("Id", "Parent", "Color")
    kept = n.filter(F.col("Color") % 4 != 1)
    gone = n.filter(F.col("Color") % 4 == 1)
    # Everything stays in the table under test, only the parents' own rows are missing.
    table = kept.unionByName(gone.withColumn("Id", F.concat(F.lit("z"), "Id")))
    out = tree.orphans(table).select(F.regexp_replace("Id", "^z", "").alias("Id"), "Parent")
    return out


@query(
    "tree_unreachable",
    """WITH RECURSIVE nodes AS (SELECT Id, Parent FROM {v_deep} WHERE Id <> 'o7'),
       walk AS (SELECT Id FROM nodes WHERE Parent IS NULL
         UNION ALL SELECT n.Id FROM nodes n JOIN walk w ON w.Id = n.Parent)
       SELECT Id, 'orphan' AS Reason FROM nodes WHERE Id NOT IN (SELECT Id FROM walk)""",
)
def tree_unreachable(d):
    return tree.unreachable(d["v_deep"].filter(F.col("Id") != "o7").select("Id", "Parent", "Name"))
