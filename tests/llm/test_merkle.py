from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tradewind.llm import merkle as M
from tradewind.llm.queries import op13_merkle_manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i : i + 8])) for i in range(0, len(last), 8)])
    return levels


def path_of(levels, at):
    path = []
    for nodes in levels[:-1]:
        start = at // 8 * 8
        path.append(("".join(nodes[start:at]), "".join(nodes[at + 1 : start + 8])))
        at //= 8
    return path


def by_hand(docs):
    """Rows of the query, from (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for d in docs:
        groups.setdefault(d[2], []).append(d)
    names = sorted(groups, key=lambda name: (name is not None, (name or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda d: (d[0] is not None, d[0] or 0, leaf_of(d)))
        trees[name] = tree([leaf_of(d) for d in groups[name]])
    top = tree([trees[name][-1][0] for name in names])
    rows = []
    for k, name in enumerate(names):
        for at, d in enumerate(groups[name]):
            path = path_of(trees[name], at) + path_of(top, k)
            doc_id, source, lang, n_chars, text = d
            if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
                text = text.translate(LOWER)
            node = leaf_of((doc_id, source, lang, n_chars, text))
            for left, right in path:
                node = sha(left + node + right)
            root = top[-1][0]
            proof = sha("".join(left + right for left, right in path))
            rows.append((doc_id, trees[name][0][at], trees[name][-1][0], root, proof, node, node == root))
    return rows


def query(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    return op13_merkle_manifest(spark, str(tmp_path))


def values(docs):
    return [tuple(r[c] for c in COLUMNS) for r in docs.collect()]


def test_query_equals_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = op13_merkle_manifest(spark, folder).collect()
    assert Counter(map(tuple, got)) == Counter(by_hand(values(docs)))
    assert {r.verified for r in got} == {True, False}


def test_odd_rows(spark, tmp_path):
    """Nulls in every column, empty and long texts, repeated ids and rows, names that look alike."""
    rows = [
        (1, "A b", "en", "s", 3), (1, "A b", "en", "s", 3), (1, "Other", "en", "s", 5), (2, "", "en", "", 0),
        (3, None, "en", None, None), (None, "x", "en", "s", 1), (None, "x", "en", "s", 1), (4, "É Ü ÄB", None, "s", 6),
        (5, "LONG " * 300_000, "", "s", 1_500_000), (6, "lone", "zz", "s", 4), (7, "-", "=en", "s", 1), (8, "é", "été", "ß", 1),
        (-9, "Neg", "en", "s", 3), (2**62, "Big", "en", "s", 3), (None, None, None, None, None),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("grp", "pos", "n", "h", "leaf", "path", "tie", "at"):
        docs = docs.withColumn(name, F.lit("x"))
    got = query(spark, docs, tmp_path).collect()
    assert Counter(map(tuple, got)) == Counter(by_hand(values(docs)))


def test_empty_and_single(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    assert query(spark, empty, tmp_path / "none").count() == 0
    one = spark.createDataFrame([(6, "One", "en", "s", 3)], SCHEMA)
    got = query(spark, one, tmp_path / "one").collect()
    assert list(map(tuple, got)) == by_hand(values(one))
    # A lone leaf is subroot and root, and its proof has no sibling.
    assert got[0].leaf == got[0].subroot == got[0].root and got[0].proof_sha256 == sha("")


@pytest.mark.parametrize("n", [9, 64, 1030])
def test_sizes_of_one_group(spark, tmp_path, n):
    """Full runs, a last run of one, windows that are cut, and equal ids; a third of the rows are equal."""
    docs = spark.createDataFrame(
        [(0 if i % 3 == 0 else i, "Same" if i % 3 == 0 else f"T{i}", "en", "s", i % 3 and i) for i in range(n)], SCHEMA
    ).repartition(5)
    got = query(spark, docs, tmp_path).collect()
    assert Counter(map(tuple, got)) == Counter(by_hand(values(docs)))


def test_many_groups(spark, tmp_path):
    """More groups than a run, and one with most rows."""
    docs = spark.createDataFrame(
        [(i, f"Text {i}", f"l{i}" if i < 80 else "hot", "s", i) for i in range(700)], SCHEMA
    )
    got = query(spark, docs, tmp_path).collect()
    assert Counter(map(tuple, got)) == Counter(by_hand(values(docs)))


def test_a_changed_value_is_seen(spark):
    """Whatever column changes, the folded root is another; the same leaf in another place is no proof."""
    docs = spark.createDataFrame([(i, f"t{i}", "en", "s", i) for i in range(20)], SCHEMA)
    for name in COLUMNS[1:]:
        other = [F.concat(F.col(c), F.lit("1")) if c == name else F.col(c) for c in COLUMNS]
        rows = M.manifest(docs, COLUMNS, "lang", "doc_id", other)
        assert rows.where(M.folded(F.col("found_leaf"), F.col("path")) == F.col("root")).isEmpty()
    rows = M.manifest(docs, COLUMNS, "lang", "doc_id")
    assert rows.where(M.folded(F.col("found_leaf"), F.col("path")) == F.col("root")).count() == 20
    moved = rows.select("leaf", "root", F.lead("path").over(M.Window.orderBy("doc_id")).alias("path"))
    assert moved.where(M.folded(F.col("leaf"), F.col("path")) == F.col("root")).isEmpty()


def test_numbering_spreads_equal_rows(spark, monkeypatch):
    """A group of wholly equal rows is not one task: places come from several of them."""
    stored, store = {}, M.materialize
    monkeypatch.setattr(M, "materialize", lambda df, label: stored.setdefault(label, store(df, label)))
    rows = spark.range(0, 40_000, 1, 8).select(F.lit("").alias("grp"), F.lit(1).alias("id"), F.lit("h").alias("h"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = M._numbered(rows, ["id", "h"])
        assert found.agg(F.min("pos"), F.max("pos"), F.countDistinct("pos"), F.max("n")).first()[:] == (0, 39_999, 40_000, 40_000)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert stored["merkle-tasks"].agg(F.max("rows")).first()[0] < 10_000
