"""Walking a tree given by parent references, however deep and wide."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codespan.operators.numbering import number_rows
from codespan.session import cut


def orphans(nodes: DataFrame) -> DataFrame:
    """Nodes whose parent does not exist."""
    ids = nodes.select(F.col("Id").alias("_p"))
    return nodes.filter(F.col("Parent").isNotNull()).join(ids, F.col("Parent") == F.col("_p"), "left_anti")


def _climb(nodes: DataFrame, named: bool) -> tuple[DataFrame, DataFrame]:
    """Every node with its distance to the top, by doubling the stride each round.

    A row knows an ancestor ``up`` some steps away and, if ``named``, the path down
    from it; joining the ancestor's own row on doubles the stride, so a tree of
    depth d takes log2(d) joins.  Finished rows leave the joining side.  A row that
    still climbs after more steps than there are nodes sits on or below a cycle.
    """
    lost = orphans(nodes).select(F.col("Id").alias("_lost"))
    state = nodes.join(lost, F.col("Id") == F.col("_lost"), "left").select(
        "Id",
        F.when(F.col("_lost").isNull(), F.col("Parent")).alias("up"),
        F.when(F.col("Parent").isNotNull() & F.col("_lost").isNull(), 1).otherwise(0).alias("steps"),
        (F.col("Name") if named else F.lit(None).cast("string")).alias("path"),
        F.col("Id").alias("top"),
        F.col("_lost").isNotNull().alias("lost"),
    )
    state = cut(state)
    for _ in range(state.count().bit_length() + 1):
        climbing = state.filter(F.col("up").isNotNull())
        if climbing.isEmpty():
            return state, climbing
        above = state.select(
            F.col("Id").alias("_id"), F.col("up").alias("_up"), F.col("steps").alias("_steps"),
            F.col("path").alias("_path"), F.col("top").alias("_top"), F.col("lost").alias("_lost"),
        )
        moved = climbing.join(above, F.col("up") == F.col("_id")).select(
            "Id", F.col("_up").alias("up"), (F.col("steps") + F.col("_steps")).alias("steps"),
            F.concat(F.col("_path"), F.lit("\\"), F.col("path")).alias("path"),
            F.col("_top").alias("top"), F.col("_lost").alias("lost"),
        )
        state = cut(state.filter(F.col("up").isNull()).unionByName(moved))
    return state.filter(F.col("up").isNull()), state.filter(F.col("up").isNotNull())


def tree_walk(nodes: DataFrame, folder: str | None = None) -> DataFrame:
    """Id, Depth, TopParent, HierarchicalName and RoleTag of every reachable node.

    ``nodes``: Id, Parent, Name.  The tag is ``(depth << 16) + index`` among the
    siblings; the name is prefixed by the folder and two backslashes.
    """
    _, cyclic = _climb(nodes, named=False)
    # On a cycle paths would never stop growing; they are made for the other nodes only.
    sound = nodes.join(cyclic.select("Id"), "Id", "left_anti")
    reached, _ = _climb(sound, named=True)
    prefix = F.lit(f"{folder}\\\\") if folder else F.lit("")
    walked = reached.filter(~F.col("lost")).select(
        "Id", F.col("steps").alias("Depth"), F.col("top").alias("TopParent"),
        F.concat(prefix, F.col("path")).alias("HierarchicalName"),
    )
    siblings = number_rows(nodes.select("Id", "Parent"), ["Id"], "_index", group=["Parent"], start=0)
    return walked.join(siblings.select(F.col("Id").alias("_i"), "_index"), F.col("Id") == F.col("_i")).select(
        "Id", "Depth", "TopParent", "HierarchicalName",
        (F.shiftleft(F.col("Depth").cast("long"), 16) + F.col("_index")).alias("RoleTag"),
    )


def unreachable(nodes: DataFrame) -> DataFrame:
    """Nodes below an orphan, or on or below a cycle, with the reason."""
    reached, cyclic = _climb(nodes, named=False)
    below_orphan = reached.filter("lost").select("Id", F.lit("orphan").alias("Reason"))
    return below_orphan.unionByName(cyclic.select("Id", F.lit("cycle").alias("Reason")))


def aggregate_pairs(nodes: DataFrame) -> DataFrame:
    """(Id, Ancestor): each node with itself and the ancestors it aggregates to.

    A step up counts while the parent is marked ``Aggregate``.  The closure is
    doubled each round: every pair reaching exactly as far as the stride is
    extended by all the pairs of its end, until that finds nothing new, which
    ends on cycles too.  Every pair comes once.
    """
    parents = nodes.filter(F.coalesce(F.col("Aggregate"), F.lit(False))).select(F.col("Id").alias("_p"))
    edges = cut(
        nodes.join(parents, F.col("Parent") == F.col("_p"), "left_semi").select(
            "Id", F.col("Parent").alias("Ancestor")
        )
    )
    farthest = edges
    closed = edges
    while not farthest.isEmpty():
        ends = lambda df: df.select(F.col("Id").alias("_id"), F.col("Ancestor").alias("_anc"))
        extend = lambda by: farthest.join(ends(by), F.col("Ancestor") == F.col("_id")).select(
            "Id", F.col("_anc").alias("Ancestor")
        ).distinct()
        known = closed.select(F.col("Id").alias("_i"), F.col("Ancestor").alias("_a"))
        more = cut(extend(closed).join(
            known, (F.col("Id") == F.col("_i")) & (F.col("Ancestor") == F.col("_a")), "left_anti"
        ))
        if more.isEmpty():
            break
        farthest = cut(extend(farthest))
        closed = closed.unionByName(more)
    itself = nodes.select("Id", F.col("Id").alias("Ancestor"))
    return itself.unionByName(closed.filter(F.col("Id") != F.col("Ancestor")))
