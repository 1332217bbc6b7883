"""Questions asked of a project: sources, taggings and coded passages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codespan.functions import fragments as FR
from codespan.operators import spans as S

Project = dict[str, DataFrame]


def with_category(p: Project, entity: str = "Source") -> DataFrame:
    """Every source (or node) with the name of its category, if any."""
    categories = p[f"{entity}Category"].select(
        F.col("Id").alias("_category_id"), F.col("Name").alias("CategoryName")
    )
    return p[entity].join(categories, F.col("Category") == F.col("_category_id"), "left").drop("_category_id")


def filter_sources(
    p: Project,
    source: str | None = None,
    category: str | None = None,
    like: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """The sources picked by name, category name or name pattern."""
    out = p["Source"]
    if source is not None:
        out = out.filter(F.col("Name") == source)
    if like is not None:
        out = out.filter(F.col("Name").like(like))
    if category is not None:
        wanted = p["SourceCategory"].filter(F.col("Name") == category).select(F.col("Id").alias("_c"))
        out = out.join(wanted, F.col("Category") == F.col("_c"), "left_semi")
    if limit:
        out = out.orderBy("Name", "Id").limit(limit)
    return out


def require_source_category(p: Project, category: str) -> None:
    """Fail when no source category has that name (one-row probe)."""
    if p["SourceCategory"].filter(F.col("Name") == category).isEmpty():
        raise ValueError(f"source category {category!r} does not exist")


def query_sources(p: Project, source: str | None = None, category: str | None = None) -> DataFrame:
    """Name, Description, Content, Category and Color of the picked sources."""
    picked = dict(p, Source=filter_sources(p, source, category))
    return with_category(picked).select(
        "Name", "Description", "Content", F.col("CategoryName").alias("Category"), "Color"
    )


def tagging_rows(p: Project, sources: DataFrame | None = None) -> DataFrame:
    """Taggings with parsed spans and node names; annotations keep a null node.

    No text travels with them: it joins back at the end, on the result.
    """
    span = FR.parse_fragment(F.col("Fragment"))
    rows = p["Tagging"].filter(FR.is_fragment(F.col("Fragment"))).select(
        "Id", "Source", F.col("Node").alias("NodeId"), "Memo",
        span["start0"].alias("start0"), span["end0"].alias("end0"),
    )
    if sources is not None:
        rows = rows.join(sources.select(F.col("Id").alias("_s")), F.col("Source") == F.col("_s"), "left_semi")
    nodes = p["Node"].select(
        F.col("Id").alias("_n"), F.col("Name").alias("Node"), F.col("Category").alias("NodeCategory")
    )
    return rows.join(nodes, F.col("NodeId") == F.col("_n"), "left").drop("_n")


def fragment_rejects(p: Project) -> DataFrame:
    """Taggings whose fragment cannot be read."""
    return p["Tagging"].filter(~FR.is_fragment(F.col("Fragment"))).select("Id", "Source", "Fragment")


def with_text(p: Project, spans: DataFrame) -> DataFrame:
    """Add source name and passage text to spans keyed by source id."""
    texts = p["Source"].select(F.col("Id").alias("_s"), F.col("Name").alias("SourceName"), "Content")
    return spans.join(texts, F.col("Source") == F.col("_s")).select(
        *spans.columns, "SourceName",
        FR.span_text(F.col("Content"), F.col("start0"), F.col("end0")).alias("Text"),
    )


def query_taggings(
    p: Project,
    source: str | None = None,
    source_category: str | None = None,
    nodes: list[str] | None = None,
    node_category: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Passages carrying a node category and every one of the named nodes.

    With no term at all, every tagging counts, annotations included.  The memo
    of a merged passage is its first one, and only single-term queries have it.
    """
    narrowed = source is not None or source_category is not None or limit
    rows = tagging_rows(p, filter_sources(p, source, source_category, limit=limit) if narrowed else None)
    terms = []
    if node_category is not None:
        wanted = p["NodeCategory"].filter(F.col("Name") == node_category).select(F.col("Id").alias("_c"))
        terms.append(rows.join(wanted, F.col("NodeCategory") == F.col("_c"), "left_semi"))
    terms += [rows.filter(F.col("Node") == name) for name in nodes or []]
    if len(terms) > 1:
        found = S.intersect_terms(terms).withColumn("Memo", F.lit(None).cast("string"))
    else:
        named = (terms[0] if terms else rows).withColumn(
            "Nodes",
            F.when(F.coalesce(F.col("Node"), F.lit("")) != "", F.array("Node")).otherwise(
                F.array().cast("array<string>")
            ),
        )
        found = S.merge_spans(named, ["Source", "Nodes"], first=["Memo"], tie=["Id"])
    return with_text(p, found).select(
        F.col("SourceName").alias("Source"),
        F.array_join("Nodes", "\n").alias("Node"),
        "Memo",
        "Text",
        FR.format_fragment(F.col("start0"), F.col("end0")).alias("Fragment"),
    )


def extract_taggings(p: Project, node: str | None = None, source: str | None = None) -> DataFrame:
    """Coded passages with fragments read as zero-based, end included."""
    nodes = p["Node"] if node is None else p["Node"].filter(F.col("Name") == node)
    sources = p["Source"] if source is None else p["Source"].filter(F.col("Name") == source)
    span = FR.parse_fragment(F.col("Fragment"), "zero_incl")
    return (
        p["Tagging"].select("Source", F.col("Node").alias("_node"), "Fragment")
        .join(nodes.select(F.col("Id").alias("_n"), F.col("Name").alias("Node")), F.col("_node") == F.col("_n"))
        .join(
            sources.select(F.col("Id").alias("_s"), F.col("Name").alias("SourceName"), "Content"),
            F.col("Source") == F.col("_s"),
        )
        .select(
            "Node",
            F.col("SourceName").alias("Source"),
            "Fragment",
            FR.is_fragment(F.col("Fragment")).alias("Recognised"),
            FR.span_text(F.col("Content"), span["start0"], span["end0"]).alias("Text"),
        )
    )


def tagging_authors(p: Project) -> DataFrame:
    """Taggings with the name of the user who last changed them."""
    users = p["User"].select(F.col("Id").alias("_u"), F.col("Name").alias("Author"))
    return p["Tagging"].join(users, F.col("ModifiedBy") == F.col("_u")).drop("_u")
