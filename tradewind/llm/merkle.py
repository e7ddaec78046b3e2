"""Merkle manifest of a dataset: a digest per row, a root per group, one root over all, and proofs.

Rows of a group stand in the order of their id and are the leaves of the group's tree: every ``RUN``
consecutive nodes, at last fewer, become the digest of their digests, until one node is left, the group's
subroot. The subroots, ordered by group, are the leaves of one more tree with the root of the dataset.

*Levels.* A level is one window over its nodes: fixed-offset ``lag`` and ``lead`` columns, masked by
the node's slot in its run and the run's length, are its siblings, and the first node of a run hashes
itself and its siblings to the parent. The next level has those parents only, an eighth of the rows.

*Distribution.* Places within a group come from range partitioning by (group, id) and counts per
task, so a group of any size is spread over all tasks. Windows are cut every ``BLOCK`` places, a multiple
of ``RUN``. On the way down a node takes over its parent's path by a join in which eight rows meet
one. The text of a row is read once, to be hashed; only digests are shuffled and stored.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.names import quoted
from tradewind.session import materialize

#: Children of a node.
RUN = 8
#: Nodes of a level that share a window.
BLOCK = RUN**3

# monotonically_increasing_id() keeps the task above these bits and counts rows below them.
_ROW_BITS = 33


def digest(column: Column) -> Column:
    """Lowercase hex SHA-256 of a text's UTF-8 bytes."""
    return F.sha2(column, 256)


def leaf_digest(columns: Sequence[Column]) -> Column:
    """Digest of values in order, each ``-`` if null, else its UTF-8 byte count, ``:`` and itself."""

    def spelled(value: Column) -> Column:
        text = value.cast("string")
        counted = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        return F.coalesce(counted, F.lit("-"))

    return digest(F.concat(*map(spelled, columns)))


def _numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos``, the place within ``grp`` from 0 on, and ``n``, the rows of that group.

    Rows that are equal in ``order`` are told apart by where they are stored, so that many of them
    are spread over tasks as well.
    """
    stored = materialize(rows, "merkle-rows").select(
        "*", F.xxhash64("_metadata.file_name", "_metadata.row_index").alias("tie")
    )
    keys = ["grp", *order, "tie"]
    placed = materialize(
        stored.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("at", F.monotonically_increasing_id())
        .withColumn("task", F.shiftright("at", _ROW_BITS)),
        "merkle-order",
    )
    parts = materialize(
        placed.groupBy("grp", "task").agg(F.count("*").alias("rows"), F.min("at").alias("first")),
        "merkle-tasks",
    )
    group = Window.partitionBy("grp")
    before = group.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        "grp",
        "task",
        (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(group).alias("n"),
    )
    found = placed.join(starts, ["grp", "task"])
    return found.select(*rows.columns, (F.col("at") + F.col("shift")).alias("pos"), "n")


def _above(places: Column) -> Column:
    return F.floor(places / RUN)


def _with_siblings(nodes: DataFrame) -> DataFrame:
    """Nodes of groups with several, the siblings to the left and right, and the run's parent on its
    first node."""
    window = Window.partitionBy("grp", F.floor(F.col("pos") / BLOCK)).orderBy("pos")
    slot = F.col("pos") % RUN
    run = F.least(F.lit(RUN), F.col("n") - (F.col("pos") - slot))
    left = [F.when(slot >= k, F.lag("h", k).over(window)) for k in range(RUN - 1, 0, -1)]
    right = [F.when(slot + k < run, F.lead("h", k).over(window)) for k in range(1, RUN)]
    found = nodes.where("n > 1").withColumns(
        {"left": F.concat_ws("", *left), "right": F.concat_ws("", *right)}
    )
    parent = F.when(slot == 0, digest(F.concat("h", "right")))
    return found.withColumns(
        {"parent": parent, "left": F.unhex("left"), "right": F.unhex("right")}
    )


def _climb(leaves: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """Stored levels from the leaves up, and of each level the nodes that are alone in their group."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    nodes, levels, alone = leaves, [], [leaves.where("n = 1")]
    while most > 1:
        levels.append(materialize(_with_siblings(nodes), "merkle-level"))
        nodes = levels[-1].where(F.col("pos") % RUN == 0).select(
            "grp",
            _above(F.col("pos")).alias("pos"),
            F.ceil(F.col("n") / RUN).alias("n"),
            F.col("parent").alias("h"),
        )
        alone.append(nodes.where("n = 1"))
        most = -(-most // RUN)
    return levels, alone


def _descend(
    levels: list[DataFrame], alone: list[DataFrame], ends: DataFrame, kept: Sequence[str]
) -> DataFrame:
    """Leaves with the path to the root: their own siblings, then those of every node above.

    ``ends`` has the rest of the path per group, and columns to hand down; of the leaves ``kept`` stays.
    """
    handed = [c for c in ends.columns if c not in ("grp", "path")]
    rows = None
    for depth in reversed(range(len(alone))):
        columns = kept if depth == 0 else ["grp", "pos"]
        wanted = [*(F.col(c) for c in columns), "path", *handed]
        found = alone[depth].join(ends, "grp").select(*wanted)
        if rows is not None:
            own = levels[depth].withColumn("up", _above(F.col("pos")))
            above = rows.select("grp", F.col("pos").alias("up"), F.col("path").alias("rest"), *handed)
            path = F.concat(F.array(F.struct("left", "right")), "rest")
            below = own.join(above, ["grp", "up"]).withColumn("path", path)
            found = below.select(*wanted).unionByName(found)
        rows = found
    return rows


def _tops(alone: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, (a.select("grp", "h") for a in alone))


def manifest(
    docs: DataFrame,
    columns: Sequence[str],
    group_col: str,
    id_col: str,
    found: Sequence[Column] | None = None,
) -> DataFrame:
    """``(id, leaf, found_leaf, subroot, root, path)`` per row of ``docs``.

    ``leaf`` is the digest of ``columns``, ``found_leaf`` that of the values in ``found``, as they are met
    when the row is checked later (the same if left out). ``path`` lists, from the leaf to the root, the
    digests to the left and right in the node's run, as bytes.

    Groups are ordered by name, null first, bytes of UTF-8; null and empty names are two groups.
    Rows of a group are ordered by id, null first, those of one id by leaf; equal rows are equal leaves, each
    with its own place, and which of them has which place is not defined. Other columns of ``docs``
    are not read, whatever their names. An empty table has no rows and no root.
    """
    name = F.col(quoted([group_col])[0]).cast("string")
    values = [F.col(c) for c in quoted(list(columns))]
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), name), F.lit("")).alias("grp"),
        F.col(quoted([id_col])[0]).alias("id"),
        leaf_digest(values).alias("h"),
        leaf_digest(found or values).alias("found"),
    )
    levels, alone = _climb(_numbered(leaves, ["id", "h"]))
    subroots = _tops(alone).select(
        F.lit("").alias("grp"), F.col("grp").alias("name"), F.col("h")
    )
    top_levels, top_alone = _climb(_numbered(subroots, ["name"]))
    siblings = "array<struct<left:binary,right:binary>>"
    root = _tops(top_alone).select(
        "grp", F.array().cast(siblings).alias("path"), F.col("h").alias("root")
    )
    over = _descend(top_levels, top_alone, root, ["name", "h"]).select(
        F.col("name").alias("grp"), "path", F.col("h").alias("subroot"), "root"
    )
    rows = _descend(levels, alone, materialize(over, "merkle-roots"), ["id", "h", "found"])
    return rows.select(
        F.col("id").alias(id_col),
        F.col("h").alias("leaf"),
        F.col("found").alias("found_leaf"),
        "subroot",
        "root",
        "path",
    )


def _spelled(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    spelled = F.transform(path, lambda s: F.concat(_spelled(s["left"]), _spelled(s["right"])))
    return digest(F.array_join(spelled, ""))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(
        path,
        leaf,
        lambda node, s: digest(F.concat(_spelled(s["left"]), node, _spelled(s["right"]))),
    )
