"""Near duplicates by SimHash: a self-join of binary tries under a Hamming budget.

Fingerprints are 64 bits over word shingles. All pairs within ``max_bits`` differing bits are found by
walking a binary trie against itself: a pair of nodes stands for all pairs of fingerprints below
them, carries the bits in which the two paths differ, and is dropped as soon as those exceed the
budget of its depth.

*Budget per depth.* Cut the 64 bits into 8 blocks and read them as a ring. If two fingerprints differ
in at most k bits, some rotation of the ring has at most j*k/8 differing bits in its first j blocks,
for every j at once (start the ring behind the point where the surplus over the average is largest).
So there is one trie per rotation, and in each the budget grows with the depth from floor(k/8) to k
instead of being k from the root on. No pair is lost, and for k < 8 the first block has to be equal.

*Distribution.* The first levels are walked as DataFrames of node pairs with the number of
fingerprints below them; a pair that is small enough becomes a task, a larger one is replaced by its
children. A task receives the fingerprints below its two nodes and walks the rest of the trie on
arrays. Equal fingerprints are one entry, so a group of copies costs one entry, and a dense group of
near copies is cut into as many tasks as its size needs.

Within a task, links are folded into a spanning forest; the forests of all tasks together have
exactly the components of the full link graph, with fewer edges than fingerprints per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm.components import connected_components
from tradewind.llm.names import quoted
from tradewind.llm.worker import travels_with_tasks
from tradewind.session import materialize

travels_with_tasks(__name__)

BITS = 64
BLOCK = 8
SEED = 42
#: Levels the distributed walk descends at a time.
STEP = 4
#: Fingerprints below the two nodes of a task, at most.
TASK_SIZE = 100_000
#: Node pairs and fingerprint pairs handled at a time within a task.
CHUNK = 1 << 18
#: Node pairs with at most this many fingerprint pairs are compared directly.
LEAF = 64


# --- fingerprints ---------------------------------------------------------------------------------


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """XXH64 of the space-joined word shingles, in order, repeats included.

    Only A-Z are lower-cased and only ASCII white space separates words, as ``bytes`` methods do.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-size] + 1))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts.tolist(), ends[size - 1 :].tolist(), strict=True)
    return np.fromiter((digest(joined[s:e], SEED) for s, e in spans), np.uint64, len(starts))


def fingerprint(text: str | None, size: int) -> int:
    """Bit i is set if it is set in over half of the hashes; no words give zero."""
    hashes = shingle_hashes(text or "", size)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at : at + CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def simhash(text: Column, size: int) -> Column:
    """Fingerprint as a signed 64-bit number."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, size) for t in texts], dtype="int64")

    return of(text)


def hex_digits(column: Column) -> Column:
    """16 lowercase digits of a signed 64-bit number."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))


# --- the trie within a task -----------------------------------------------------------------------


def budget(depth: int, max_bits: int) -> int:
    """Bits in which two paths of this depth may differ."""
    return -(-depth // BLOCK) * max_bits // (BITS // BLOCK)


class Forest:
    """Components of links that arrive in blocks; every node points to a smaller or equal one."""

    def __init__(self, size: int) -> None:
        self.parent = np.arange(size)

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        parent = self.parent
        while len(i):
            i, j = parent[i], parent[j]
            apart = i != j
            i, j = i[apart], j[apart]
            np.minimum.at(parent, np.maximum(i, j), np.minimum(i, j))
            while True:
                above = parent[parent]
                if np.array_equal(above, parent):
                    break
                parent[:] = above


def _compare(keys, a0, a1, b0, b1, max_bits) -> tuple[np.ndarray, np.ndarray]:
    """All pairs below the given node pairs that are within the budget."""
    wide = b1 - b0
    counts = (a1 - a0) * wide
    of = np.repeat(np.arange(len(counts)), counts)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    i, j = a0[of] + nth // wide[of], b0[of] + nth % wide[of]
    near = (i < j) & (np.bitwise_count(keys[i] ^ keys[j]) <= max_bits)
    return i[near], j[near]


def trie_links(
    keys: np.ndarray, cut: int | None, depth: int, differ: int, max_bits: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (i, j), i < j, of keys within ``max_bits`` under the budgets of all depths.

    ``keys`` are sorted and distinct. With ``cut``, the two nodes are the keys before and from that
    position, whose paths of length ``depth`` differ in ``differ`` bits; without, one node meets itself.
    """
    one = lambda x: np.array([x], np.int64)
    a1, b0 = (len(keys), 0) if cut is None else (cut, cut)
    todo = [(depth, one(0), one(a1), one(b0), one(len(keys)), one(differ))]
    while todo:
        depth, a0, a1, b0, b1, err = todo.pop()
        if len(a0) > CHUNK:
            half = len(a0) // 2
            for part in (slice(None, half), slice(half, None)):
                todo.append((depth, *(x[part] for x in (a0, a1, b0, b1, err))))
            continue
        small = ((a1 - a0) * (b1 - b0) <= LEAF) | (depth == BITS)
        if small.any():
            yield _compare(keys, a0[small], a1[small], b0[small], b1[small], max_bits)
            a0, a1, b0, b1, err = (x[~small] for x in (a0, a1, b0, b1, err))
        if not len(a0):
            continue
        bit = np.uint64(1 << (BITS - 1 - depth))
        path = np.uint64(((1 << depth) - 1) << (BITS - depth))
        am = np.searchsorted(keys, (keys[a0] & path) | bit)
        bm = np.searchsorted(keys, (keys[b0] & path) | bit)
        most, two = budget(depth + 1, max_bits), a0 != b0
        children = [
            (a0, am, b0, bm, err, err <= most),
            (am, a1, bm, b1, err, err <= most),
            (a0, am, bm, b1, err + 1, err < most),
            (am, a1, b0, bm, err + 1, (err < most) & two),
        ]
        kept = []
        for *node, ok in children:
            ok = ok & (node[0] < node[1]) & (node[2] < node[3])
            kept.append([x[ok] for x in node])
        joined = [np.concatenate(x) for x in zip(*kept, strict=True)]
        if len(joined[0]):
            todo.append((depth + 1, *joined))


def _task_forest(rows: pd.DataFrame, max_bits: int) -> pd.DataFrame:
    depth, rotation = int(rows["depth"].iloc[0]), int(rows["rotation"].iloc[0])
    raw = rows["ring"].to_numpy(np.int64).view(np.uint64)
    keys = np.unique(raw)
    first = keys[0] >> np.uint64(BITS - depth)
    last = keys[-1] >> np.uint64(BITS - depth)
    cut, differ = None, 0
    if first != last:
        cut = int(np.searchsorted(keys, last << np.uint64(BITS - depth)))
        differ = int(np.bitwise_count(first ^ last))
    forest = Forest(len(keys))
    for i, j in trie_links(keys, cut, depth, differ, max_bits):
        forest.add(i, j)
    found = np.flatnonzero(forest.parent != np.arange(len(keys)))
    turn = rotation * BLOCK
    if turn:
        keys = (keys >> np.uint64(turn)) | (keys << np.uint64(BITS - turn))
    ends = keys.view(np.int64)
    return pd.DataFrame({"a": ends[found], "b": ends[forest.parent[found]]})


# --- the walk over Spark --------------------------------------------------------------------------


def _path(depth: int) -> Column:
    return F.shiftrightunsigned("ring", BITS - depth)


def _tasks(rings: DataFrame, max_bits: int, task_size: int) -> list[DataFrame]:
    """Pairs of trie nodes small enough for a task: ``(depth, rotation, p, q)`` for each depth."""
    depth, pairs, tasks = BLOCK, None, []
    while True:
        nodes = rings.groupBy("rotation", _path(depth).alias("path")).agg(F.count("*").alias("n"))
        nodes = materialize(nodes, "nodes")
        p = nodes.select("rotation", F.col("path").alias("p"), F.col("n").alias("np"))
        q = nodes.select("rotation", F.col("path").alias("q"), F.col("n").alias("nq"))
        if pairs is None and budget(depth, max_bits) == 0:
            pairs = p.withColumns({"q": F.col("p"), "nq": F.lit(0).cast("long")})
        elif pairs is None:
            pairs = p.join(q, "rotation")  # At most 256 nodes a side.
        else:
            above = pairs.select("rotation", F.col("p").alias("pp"), F.col("q").alias("qq"))
            pairs = above.join(
                p.withColumn("pp", F.shiftrightunsigned("p", STEP)), ["rotation", "pp"]
            ).join(q.withColumn("qq", F.shiftrightunsigned("q", STEP)), ["rotation", "qq"])
        differ = F.bit_count(F.col("p").bitwiseXOR(F.col("q")))
        pairs = pairs.where((F.col("p") <= F.col("q")) & (differ <= budget(depth, max_bits)))
        pairs = materialize(
            pairs.select(
                "rotation", "p", "q", F.when(F.col("p") == F.col("q"), F.col("np"))
                .otherwise(F.col("np") + F.col("nq")).alias("n"),
            ),
            "node-pairs",
        )
        tasks.append(
            pairs.where(F.col("n").between(2, task_size)).withColumn("depth", F.lit(depth))
        )
        # Below this depth a node has at most 2^(64 - depth) keys, so the walk always ends.
        pairs = pairs.where(F.col("n") > task_size)
        if pairs.isEmpty():
            return tasks
        depth += STEP


def links(
    prints: DataFrame, column: str, max_bits: int, task_size: int = TASK_SIZE
) -> DataFrame:
    """Edges ``(a, b)`` over distinct fingerprints with the components of all pairs within ``max_bits``.

    ``prints`` holds distinct non-null signed 64-bit numbers in ``column``.
    """
    ring = F.col(column)
    turn = (F.col("rotation") * BLOCK).cast("int")
    rings = prints.select(
        ring.alias("print"), F.explode(F.sequence(F.lit(0), F.lit(BITS // BLOCK - 1))).alias("rotation")
    ).select(
        "rotation",
        F.call_function("shiftleft", F.col("print"), turn)
        .bitwiseOR(F.call_function("shiftrightunsigned", F.col("print"), F.lit(BITS) - turn))
        .alias("ring"),
    )
    found = None
    for tasks in _tasks(rings, max_bits, task_size):
        ends = F.when(F.col("p") == F.col("q"), F.array("p")).otherwise(F.array("p", "q"))
        sides = tasks.select("depth", "rotation", "p", "q", F.explode(ends).alias("path"))
        # The depth is one number per table, so the path of a fingerprint is too.
        depth = BLOCK if found is None else depth + STEP
        members = rings.withColumn("path", _path(depth)).join(sides, ["rotation", "path"])
        forests = (
            members.select("depth", "rotation", "p", "q", "ring")
            .groupBy("depth", "rotation", "p", "q")
            .applyInPandas(lambda rows: _task_forest(rows, max_bits), "a long, b long")
        )
        found = forests if found is None else found.union(forests)
    return found


def near_duplicates(
    docs: DataFrame,
    shingle: int = 4,
    max_bits: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
    task_size: int = TASK_SIZE,
) -> DataFrame:
    """``(id, fingerprint, component_id)`` per row of ``docs``; the fingerprint is a signed number.

    ``component_id`` is the smallest id reachable over links of at most ``max_bits`` differing bits.
    Null and empty texts have fingerprint zero and link like others. A null id keeps its row and never
    is a component's smallest id unless all are null. Repeated rows give repeated rows; other columns
    are ignored, an empty table gives an empty one.
    """
    prints = materialize(
        docs.select(F.col(id_col).alias(id_col), simhash(F.col(text_col), shingle).alias("fingerprint")),
        "fingerprints",
    )
    distinct = materialize(
        prints.groupBy("fingerprint").agg(F.min(id_col).alias("least")), "distinct-fingerprints"
    )
    edges = links(distinct, "fingerprint", max_bits, task_size)
    roots = connected_components(edges, "a", "b")
    rooted = distinct.join(
        roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left"
    ).withColumn("root", F.coalesce("component", "fingerprint"))
    # Stored, so that the join can be split where one component has very many fingerprints.
    smallest = materialize(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "smallest")
    named = rooted.join(smallest, "root").select("fingerprint", "component_id")
    return prints.join(named, "fingerprint").select(id_col, "fingerprint", "component_id")


def one_per_group(
    docs: DataFrame, named: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The document with the smallest id of every component of ``named`` (see ``near_duplicates``).

    Of several rows with that id the one with the smallest text stays, then that with the smallest other
    columns. Rows without an id cannot be named by a component and stay as they are.
    """
    simple = (T.AtomicType, T.NullType)
    rest = [f.name for f in docs.schema if isinstance(f.dataType, simple) and f.name != text_col]
    kept = named.where(F.col(id_col) == F.col("component_id")).select(id_col).distinct()
    order = F.struct(F.col(text_col), *quoted(rest))
    whole = F.struct(*quoted(docs.columns))
    chosen = (
        docs.join(kept, id_col, "left_semi")
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.min_by(whole, order).alias("_row"))
        .select("_row.*")
    )
    return chosen.unionByName(docs.where(F.col(id_col).isNull()))
