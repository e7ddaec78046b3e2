"""Similarity cache: nearest stored question within a cosine distance, and cache upsert.

The lookup is exact and works on blocks of both sides. Equal vectors of a side are one entry. A block of
stored vectors meets a block of queries in one task as a matrix product that returns at most one row
per query; no pair of vectors is ever a row, and no side is broadcast. So a vector is shuffled once
per block of the other side that it has to meet, and blocks hold as many vectors as a task's memory
allows.

With more stored vectors than fit one block, they are grouped around anchors, one per block's worth, in two
levels. A few outer anchors, the square root of that number, are known to every task; the inner anchors of
each of them are a stored table, which meets the vectors and the queries of its outer anchor only. So
neither the driver nor a task holds more than about the square root of the number of blocks.

Angles between vectors obey the triangle inequality, so on either level a query only visits the groups that
can hold a vector within the threshold angle. Inside a block, vectors are rotated to the block's main
directions; the product over the first of them and the lengths of the residuals bound the cosine, and only
pairs whose bound reaches the threshold are computed in full. That saves most work where vectors form
clusters and none where they do not; no group that could hold a match is left out.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from math import ceil, isqrt

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tradewind.operators.text_audit import audit_sql_log, question_key
from tradewind.session import materialize

# The helpers below travel with the tasks, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

THRESHOLD = 0.10
# Distances are rounded here, so a distance equal to the threshold is not taken for a smaller one.
DIGITS = 9

# Bytes of vectors in a block, counted as 8 per number.
BLOCK_BYTES = 32 << 20
# Blocks of a side of a cell, unless memory asks for more: each vector meets that many of the other side's.
_BLOCKS = 4
# Distances computed at once inside a block, which bounds their matrix in memory.
_CHUNK = 1 << 18
# Pairs computed in full at once.
_EXACT = 1 << 15
# Share of a block's squared length that the main directions hold; with fewer dimensions than this, or if
# it takes more than half of them, the product is taken over all.
_MAIN, _LEAST_DIMENSIONS = 0.9, 16
# Inner anchors of an outer one, as a multiple of the number of outer ones: what a task may gather.
_INNER = 4
# Slack for rounding in the group filter, in radians; it can only add visits.
_SLACK = 1e-5
# Slack for single precision in the first comparison; what passes is compared in double precision.
_ROUGH = 1e-4


def _unit(vectors: pd.Series) -> np.ndarray:
    rows = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _angles(vectors: pd.Series, anchors: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(_unit(vectors) @ anchors.T, -1.0, 1.0))


def _usable(vector: Column) -> Column:
    """Vectors with a direction; zero, missing or incomplete vectors are near to nothing."""
    return F.exists(vector, lambda x: x != 0) & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x)
    )


def _anchors(stored: DataFrame, wanted: int) -> np.ndarray:
    """Stored vectors picked by hash, one per block's worth of them."""
    picked = stored.orderBy(F.xxhash64("vector"), "cache_id").limit(wanted).collect()
    return _unit(pd.Series([r["vector"] for r in picked]))


def _main_directions(vectors: np.ndarray) -> np.ndarray | None:
    """Orthonormal columns with most of the squared length of the vectors; None if that takes too many."""
    size = vectors.shape[1]
    if size < _LEAST_DIMENSIONS:
        return None
    square, basis = np.linalg.eigh(vectors.T @ vectors)
    held = np.cumsum(square[::-1]) / square.sum()
    wanted = int(np.searchsorted(held, _MAIN)) + 1
    return basis[:, ::-1][:, :wanted] if wanted <= size // 2 else None


class _Bounds:
    """Upper bounds of cosines between unit vectors, up to the rounding of single precision."""

    def __init__(self, known: np.ndarray) -> None:
        self.basis = _main_directions(known)
        self.head, self.rest = self._split(known)

    def _split(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        if self.basis is None:
            return vectors.astype(np.float32), None
        head = vectors @ self.basis
        rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", head, head)))
        return head.astype(np.float32), rest.astype(np.float32)

    def of(self, asked: np.ndarray) -> np.ndarray:
        head, rest = self._split(asked)
        product = head @ self.head.T
        return product if rest is None else product + rest[:, None] * self.rest


def _possible(
    to_all: np.ndarray, nearest: np.ndarray, farthest: np.ndarray, angle: float
) -> np.ndarray:
    """Groups, by query, that may hold a match, from the angles to their anchors.

    A match x in the group of anchor c has angle(x, c) between the smallest and the largest angle of
    the group and has no nearer anchor. Both bounds carry over to the query within the threshold
    angle, for the second one twice. A group without vectors has no angles, and none is possible.
    """
    return (
        (to_all <= farthest + angle + _SLACK)
        & (to_all >= nearest - angle - _SLACK)
        & (to_all <= to_all.min(axis=1, keepdims=True) + 2 * angle + _SLACK)
    )


def _outer(stored: DataFrame, anchors: np.ndarray) -> DataFrame:
    """Stored vectors with their nearest outer anchor and the angle to it."""

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            angle = _angles(batch["vector"], anchors)
            cell = angle.argmin(axis=1)
            yield batch.assign(outer=cell, angle=angle[np.arange(len(cell)), cell])

    return stored.mapInPandas(nearest, "cache_id bigint, vector array<float>, outer int, angle double")


def _outer_visits(
    asked: DataFrame, anchors: np.ndarray, reach: dict[int, tuple[float, float]], angle: float
) -> DataFrame:
    """Queries with the outer anchors whose groups may hold a match; one row per query leaves a task."""
    ends = [reach.get(c, (np.inf, -np.inf)) for c in range(len(anchors))]
    nearest, farthest = (np.array(side) for side in zip(*ends))

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            possible = _possible(_angles(batch["vector"], anchors), nearest, farthest, angle)
            yield batch.assign(outers=[np.flatnonzero(row) for row in possible])

    return asked.mapInPandas(visit, "query_id bigint, vector array<float>, outers array<int>")


def _nothing(*columns: str) -> pd.DataFrame:
    return pd.DataFrame({c: pd.Series([], dtype=object) for c in columns})


def _with_inner(rows: DataFrame, identity: str, parts: dict[int, int], inner: DataFrame) -> tuple:
    """Rows and inner anchors by outer anchor; rows of one with many are dealt to several parts."""
    spark = rows.sparkSession

    def cut(side: DataFrame) -> DataFrame:
        # One row per outer anchor.
        counts = spark.createDataFrame(sorted(parts.items()), "outer int, parts bigint")
        return side.join(F.broadcast(counts), "outer")

    left = cut(rows).withColumn("part", _block(identity, "parts"))
    right = cut(inner).withColumn("part", _every_block("parts"))
    return left.groupBy("outer", "part"), right.groupBy("outer", "part")


def _blocks(n: int, block_rows: int, memory_rows: int) -> int:
    """Blocks of ``block_rows``, but not more than ``_BLOCKS`` where memory holds larger ones."""
    return min(ceil(n / block_rows), max(_BLOCKS, ceil(n / memory_rows)))


def _cells(
    stored: DataFrame, asked: DataFrame, rows: int, wanted: int, block_rows: int, memory_rows: int, angle: float
) -> tuple[DataFrame, DataFrame]:
    """Stored vectors with their cell, the group of an inner anchor, and queries with the cells to visit."""
    spark = stored.sparkSession
    anchors = _anchors(stored, isqrt(wanted - 1) + 1)
    grouped = materialize(_outer(stored, anchors), "outer")
    ends = grouped.groupBy("outer").agg(
        F.count("*").alias("rows"), F.min("angle").alias("lo"), F.max("angle").alias("hi")
    )
    # One row per outer anchor, as everything below that passes through the driver.
    outer = {r["outer"]: r for r in ends.collect()}
    share = {
        c: min(_INNER * len(anchors), ceil(wanted * r["rows"] / rows)) for c, r in outer.items()
    }
    chosen = F.broadcast(
        spark.createDataFrame(
            [(c, r["rows"], share[c]) for c, r in outer.items()], "outer int, rows bigint, chosen bigint"
        )
    )
    picked = grouped.join(chosen, "outer").where(F.pmod(F.xxhash64("vector", "outer"), "rows") < F.col("chosen"))
    own = spark.createDataFrame([(c, anchors[c].tolist()) for c in outer], "outer int, vector array<float>")
    inner = picked.select("outer", "vector").union(own)
    inner = materialize(inner.withColumn("cell", F.monotonically_increasing_id()), "inner")

    def assign(vectors: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
        if not len(vectors):
            return _nothing("cache_id", "vector", "cell", "angle")
        near = near.sort_values("cell", ignore_index=True)
        to_all = _angles(vectors["vector"], _unit(near["vector"]))
        nearest = to_all.argmin(axis=1)
        found = vectors[["cache_id", "vector"]]
        return found.assign(
            cell=near["cell"].to_numpy()[nearest], angle=to_all[np.arange(len(found)), nearest]
        )

    parts = {c: _blocks(r["rows"], block_rows, memory_rows) for c, r in outer.items()}
    left, right = _with_inner(grouped.drop("angle"), "cache_id", parts, inner)
    layout = "cache_id bigint, vector array<float>, cell bigint, angle double"
    assigned = materialize(left.cogroup(right).applyInPandas(assign, layout), "assigned")
    sizes = assigned.groupBy("cell").agg(
        F.count("*").alias("rows"), F.min("angle").alias("lo"), F.max("angle").alias("hi")
    )
    reach = materialize(inner.join(sizes, "cell", "left"), "reach")

    def visit(queries: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(near):
            return _nothing("query_id", "vector", "cells")
        to_all = _angles(queries["vector"], _unit(near["vector"]))
        lo, hi = near["lo"].fillna(np.inf).to_numpy(), near["hi"].fillna(-np.inf).to_numpy()
        cells = near["cell"].to_numpy()
        return queries[["query_id", "vector"]].assign(cells=[cells[row] for row in _possible(to_all, lo, hi, angle)])

    met = materialize(
        _outer_visits(asked, anchors, {c: (r["lo"], r["hi"]) for c, r in outer.items()}, angle), "outer-visits"
    ).select("query_id", "vector", F.explode("outers").alias("outer"))
    counted = met.groupBy("outer").agg(F.count("*").alias("n")).collect()
    parts = {r["outer"]: _blocks(r["n"], block_rows, memory_rows) for r in counted}
    left, right = _with_inner(met, "query_id", parts, reach.drop("rows"))
    # Stored and returned once per query and outer anchor, and repeated per cell on the way to the blocks only.
    layout = "query_id bigint, vector array<float>, cells array<bigint>"
    visits = materialize(left.cogroup(right).applyInPandas(visit, layout), "visits")
    visits = visits.select("query_id", "vector", F.explode("cells").alias("cell"))

    def blocks(n: str) -> Column:
        most = F.greatest(F.lit(_BLOCKS), F.ceil(F.col(n) / memory_rows))
        return F.least(F.ceil(F.col(n) / block_rows), most)

    counts = visits.groupBy("cell").agg(F.count("*").alias("visits"))
    grid = counts.join(sizes, "cell").select(
        "cell", blocks("rows").alias("cache_blocks"), blocks("visits").alias("query_blocks")
    )
    # As many rows as there are cells: joined by whatever its stored size allows.
    grid = materialize(grid, "grid")
    return assigned.drop("angle").join(grid, "cell"), visits.join(grid, "cell")


def _block(identity: str, blocks: str) -> Column:
    return F.pmod(F.xxhash64(identity), F.col(blocks)).cast("int")


def _every_block(blocks: str) -> Column:
    return F.explode(F.sequence(F.lit(0), (F.col(blocks) - 1).cast("int")))


def _distinct(rows: DataFrame, identity: str) -> tuple[DataFrame, int, int]:
    """Usable vectors, each once under its smallest id, their number and longest length; a vector that
    occurs very often is no heavy group."""
    found = Observation()
    once = (
        rows.where(_usable(F.col("vector")))
        .groupBy("vector")
        .agg(F.min(identity).alias(identity))
        .select(identity, "vector")
        .observe(found, F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width"))
    )
    stored = materialize(once, "vectors")
    return stored, found.get["n"], found.get["width"] or 0


def nearest_within(
    queries: DataFrame,
    cache: DataFrame,
    threshold: float = THRESHOLD,
    anchor_limit: int | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """(query_id, cache_id, distance) of the nearest stored vector closer than the threshold.

    ``queries`` has (query_id, vector), ``cache`` has (cache_id, vector). Equal distances go to the
    smaller id. Queries without such a vector are absent. ``anchor_limit`` sets the least number of inner
    anchors, ``block_rows`` the vectors of a block; by default a block has ``BLOCK_BYTES`` and an anchor
    one block's worth. Small blocks grow up to ``BLOCK_BYTES`` before a side of a cell has more than
    ``_BLOCKS``, so the copies of a vector do not grow with the tables.
    """
    angle = float(np.arccos(1.0 - threshold))
    with ThreadPoolExecutor(2) as pool:
        sides = (pool.submit(_distinct, cache, "cache_id"), pool.submit(_distinct, queries, "query_id"))
        (stored, rows, width), (asked, many, _) = (side.result() for side in sides)
    if not rows:
        return cache.sparkSession.createDataFrame(
            [], "query_id bigint, cache_id bigint, distance double"
        )
    memory_rows = max(1, BLOCK_BYTES // (8 * width))
    block_rows = min(block_rows or memory_rows, memory_rows)
    wanted = max(anchor_limit or 1, ceil(rows / memory_rows))
    if wanted == 1:
        here = {
            "cell": F.lit(0),
            "cache_blocks": F.lit(_blocks(rows, block_rows, memory_rows)),
            "query_blocks": F.lit(max(1, _blocks(many, block_rows, memory_rows))),
        }
        visits, assigned = asked.withColumns(here), stored.withColumns(here)
    else:
        assigned, visits = _cells(stored, asked, rows, wanted, block_rows, memory_rows, angle)
    left = (
        visits.withColumn("query_block", _block("query_id", "query_blocks"))
        .withColumn("cache_block", _every_block("cache_blocks"))
        .select("cell", "cache_block", "query_block", "query_id", "vector")
    )
    right = (
        assigned.withColumn("cache_block", _block("cache_id", "cache_blocks"))
        .withColumn("query_block", _every_block("query_blocks"))
        .select("cell", "cache_block", "query_block", "cache_id", "vector")
    )
    layout = "query_id bigint, cache_id bigint, distance double"

    def best(asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        found = {"query_id": [], "cache_id": [], "distance": []}
        if len(asked) and len(known):
            known = known.sort_values("cache_id", ignore_index=True)
            names, cached = asked["query_id"].to_numpy(), known["cache_id"].to_numpy()
            left, right = _unit(asked["vector"]), _unit(known["vector"])
            bounds = _Bounds(right)
            step = max(1, _CHUNK // len(cached))
            for start in range(0, len(names), step):
                part = left[start : start + step]
                row, column = np.nonzero(bounds.of(part) > 1.0 - threshold - _ROUGH)
                cosine = np.empty(len(row))
                for at in range(0, len(row), _EXACT):
                    some = slice(at, at + _EXACT)
                    cosine[some] = np.einsum("ij,ij->i", part[row[some]], right[column[some]])
                distance = np.round(1.0 - cosine, DIGITS)
                hit = distance < threshold
                row, column, distance = row[hit], column[hit], distance[hit]
                # The nearest of each query; of equally near ones the smallest id.
                order = np.lexsort((column, distance, row))
                row, column, distance = row[order], column[order], distance[order]
                first = np.flatnonzero(np.diff(row, prepend=-1))
                found["query_id"].append(names[start + row[first]])
                found["cache_id"].append(cached[column[first]])
                found["distance"].append(distance[first])
        return pd.DataFrame({k: np.concatenate(v) if v else [] for k, v in found.items()})

    keys = ("cell", "cache_block", "query_block")
    matches = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(best, layout)
    nearest = (
        matches.groupBy("query_id")
        .agg(F.min(F.struct("distance", "cache_id")).alias("m"))
        .select("query_id", "m.cache_id", "m.distance")
    )
    # Back from each distinct vector to all queries that have it.
    named = nearest.join(asked, "query_id").select("vector", "cache_id", "distance")
    return queries.join(named, "vector").select("query_id", "cache_id", "distance")


def semantic_lookup(
    queries: DataFrame,
    cache: DataFrame,
    threshold: float = THRESHOLD,
    anchor_limit: int | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """Every query with 'hit' and the stored SQL of its nearest entry, or 'miss'."""
    near = nearest_within(
        queries.select("query_id", "vector"),
        cache.select("cache_id", "vector"),
        threshold,
        anchor_limit,
        block_rows,
    )
    # Looked up per distinct entry found; a popular entry is split by adaptive execution.
    served = near.join(cache.select("cache_id", "sql"), "cache_id", "left")
    return (
        queries.select("query_id")
        .join(served, "query_id", "left")
        .select(
            "query_id",
            F.when(F.col("cache_id").isNotNull(), "hit").otherwise("miss").alias("verdict"),
            "cache_id",
            "distance",
            (1 - F.col("distance")).alias("similarity"),
            "sql",
        )
    )


def semantic_upsert(cache: DataFrame, answers: DataFrame) -> DataFrame:
    """Cache with new (question, vector, sql) entries under the key of their question.

    Only SQL the audit accepts is stored. An entry with the key of a new one is replaced; within the
    new ones the last by ``position`` stays, picked by an aggregate that collapses repeats before the
    shuffle.
    """
    fresh = (
        audit_sql_log(answers)
        .where("is_valid")
        .withColumn("id", question_key(F.col("question")))
        .groupBy("id")
        .agg(F.max_by(F.struct("question", "vector", "sql"), "position").alias("e"))
        .select("id", "e.*")
    )
    kept = cache.select("id", "question", "vector", "sql").join(fresh, "id", "left_anti")
    return kept.unionByName(fresh)
