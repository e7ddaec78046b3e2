"""Connected components of a graph given as an edge table.

Alternating large-star and small-star steps (Kiveris et al., 2014): every step replaces the edges by
edges to the smallest known neighbour, until the graph is a set of stars. Both steps are a grouped
minimum and a join back. A node with very many neighbours is pre-aggregated in the grouping. The minima
are stored before they are joined, so both sides of the join come right from a shuffle, which is
what adaptive execution needs to split such a node; no neighbourhood is ever gathered in one place.
Each round's edges and minima are tables in the shared folder, which lost executors can reread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.session import materialize, remove


def _signature(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.expr("bit_xor(xxhash64(hi, lo))")).first())


def _stored(moved: DataFrame, least: DataFrame) -> DataFrame:
    """The moved edges as a table; their minima are not needed after that."""
    stored = materialize(moved, "links")
    remove(least)
    return stored


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
        links.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = materialize(least.select("u", F.least("u", "m").alias("m")), "minima")
    moved = (
        both.join(least, "u")
        .where("v > u")
        .select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        .distinct()
    )
    return _stored(moved, least)


def _small_star(links: DataFrame) -> DataFrame:
    least = materialize(links.groupBy("hi").agg(F.min("lo").alias("m")), "minima")
    moved = links.join(least, "hi").where("lo <> m")
    moved = (
        moved.select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        .union(least.select("hi", F.col("m").alias("lo")))
        .distinct()
    )
    return _stored(moved, least)


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every node that has a smaller node in its component.

    ``component`` is the smallest node of the component under the ordering of the column's type. The
    smallest node itself and nodes without an edge have no row: they are their own component. Null
    ends, loops and repeated edges are ignored; an empty edge table gives an empty result.
    """
    links = materialize(
        edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("hi") > F.col("lo")))
        .distinct(),
        "links",
    )
    seen = _signature(links)
    while seen[0]:
        wide = _large_star(links)
        moved = _small_star(wide)
        now = _signature(moved)
        remove(links)
        remove(wide)
        links = moved
        if now == seen:
            break
        seen = now
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
