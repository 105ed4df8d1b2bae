"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm.scratch import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(`node`, `component`) of every node of `links` (`a`, `b`); a component is its least node.

    Distributed union-find: each step hangs nodes below the least neighbour known so far, which
    halves the depth of the forest, until all hang below their root. Every step is a grouping
    with partial sums and a join with its result; no component is ever gathered.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges, path = scratch.table(edges.filter("a > b").distinct(), "edges")
    while not _all_stars(edges):
        # Every node's neighbours above it go below the least of all its neighbours,
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low"))
        wide = both.join(least, "a").filter("b > a")
        wide = wide.select(F.col("b").alias("a"), F.least("a", "low").alias("b")).distinct()
        wide, wide_path = scratch.table(wide, "edges")
        # then each node and those below it go below the least of these.
        least = wide.groupBy("a").agg(F.min("b").alias("low"))
        below = wide.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        narrow = below.filter("a > b").union(least.select("a", F.col("low").alias("b"))).distinct()
        edges, narrow_path = scratch.table(narrow, "edges")
        scratch.drop(path)
        scratch.drop(wide_path)
        path = narrow_path
    rows = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return scratch.keep(rows.union(roots), "components")


def join_components(labels: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """`labels`, as `components` gives them, after more links.

    Only the new links are contracted, between the components that their ends had so far.
    """
    for end in ("a", "b"):
        had = labels.select(F.col("node").alias(end), F.col("component").alias("had"))
        links = links.join(had, end, "left").withColumn(end, F.coalesce("had", end)).drop("had")
    joined = components(links, scratch)
    now = joined.select(F.col("node").alias("component"), F.col("component").alias("now"))
    old = labels.join(now, "component", "left").select(
        "node", F.coalesce("now", "component").alias("component")
    )
    fresh = joined.join(labels.select("node"), "node", "left_anti")
    return scratch.keep(old.union(fresh), "components")


def _all_stars(edges: DataFrame) -> bool:
    """Whether each node below another hangs below one only, which hangs below none."""
    below = edges.select(F.col("a").alias("node"), F.lit(1).alias("above"), F.lit(0).alias("under"))
    above = edges.select(F.col("b").alias("node"), F.lit(0).alias("above"), F.lit(1).alias("under"))
    nodes = below.union(above).groupBy("node")
    nodes = nodes.agg(F.sum("above").alias("above"), F.max("under").alias("under"))
    return nodes.filter("above + under > 1 and above > 0").isEmpty()
