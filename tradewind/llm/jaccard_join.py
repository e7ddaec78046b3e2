"""N-gram Jaccard join: components of documents whose sets of word shingles overlap enough.

A document is a row of a sparse matrix with a column per shingle; the overlaps of all pairs are the
product of that matrix with its transpose. Only rows and columns that can hold a link take part in the
product, it is taken in blocks, and of each block's pairs those below the bound that follows from
their sizes are discarded. A link needs ``|x & y| >= 4/9 (|x| + |y|)``, for a similarity of 0.8.

*Equal sets* are one row, a class.

*Rows that can link.* Less than ``spare(n)`` of a class's ``n`` shingles may be missing in a partner. So a class
with that many shingles that no other class has cannot link. To see this, only the ``sketch(n)`` smallest
hashes of a class are counted: packed blocks of columns, in which a batch of documents sends every shingle once,
however many of its documents have it.

*Candidate groups.* For the rest, all shingles are counted. Rarest first, one of the first ``spare(n)`` shingles
of both ends of a link is common to them, and shingles of one class alone can be left out of
these. Classes that share such a shingle are joined to a star around the smallest, and the stars' components
are the groups within which all links lie; no pair is ever a row.

*The product.* Small groups are put together in cells by hash. Of a larger group, a pivot (the class with the
largest share of common shingles) is compared with every member first, and members linked to it need
no comparison with one another. The others are cut by size, in bands that only adjacent bands can link
to, and by hash, and every two blocks that can hold a link are a cell. A cell returns a spanning forest of
its links, which have the components of all links.

Shingles are told apart by 64-bit hashes and classes by a 64-bit hash of their set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.components import connected_components
from tradewind.llm.simhash_dedup import Forest
from tradewind.llm.worker import travels_with_tasks
from tradewind.session import materialize, small_batches

travels_with_tasks(__name__)

SEED = 61011
#: Documents and bytes of a text that are hashed at a time.
DOCS, TEXT = 512, 1 << 20
#: Shingles that a task gathers before it sends them, and shingles of a block of columns.
SENT, BLOCK = 1 << 20, 1 << 20
#: Rows and shingles of a cell.
CELL_ROWS, CELL_SHINGLES = 512, 1 << 20
#: Columns with more rows than this are multiplied as dense matrices of at most so many numbers.
DENSE, CHUNK = 16, 1 << 22
#: Keys of at most so many bytes are broadcast.
BROADCAST_BYTES = 32 << 20
#: Sizes of a band grow by this at most; linked sizes differ by a factor of 1.25.
BAND = 1.3

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)
_BYTES = np.random.Generator(np.random.PCG64(SEED)).integers(0, 1 << 64, 256, dtype=np.uint64)
_SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
_NOBODY = -1


# --- shingles -------------------------------------------------------------------------------------


def _letters_hashed(letters: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash per word: its bytes stand for random numbers and are weighed by their place."""
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(letters)) - np.repeat(first, lengths)
    power = np.full(int(lengths.max()), _MULTIPLIER)
    power[0] = 1
    found = np.add.reduceat(_BYTES[letters] * np.multiply.accumulate(power)[place], first)
    found = (found ^ found >> np.uint64(32)) * _MULTIPLIER
    return found ^ found >> _SHIFT


def _words(text: str) -> np.ndarray:
    """Hashes of the words, in order; only A-Z are lower-cased, only ASCII white space separates."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8)
    inside = np.concatenate(([False], ~_SPACE[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    out = np.empty(len(starts), np.uint64)
    # Whole words of about TEXT bytes at a time, which bounds memory.
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + TEXT, "right")))
        part = data[starts[at] : ends[to - 1]]
        out[at:to] = _letters_hashed(part[~_SPACE[part]], ends[at:to] - starts[at:to])
        at = to
    return out


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles; fewer words than ``size`` are one, no words none."""
    words = _words(text or "")
    if not len(words):
        return words
    size = min(size, len(words))
    found = np.full(len(words) - size + 1, size, np.uint64)
    for at in range(size):
        found = (found + words[at : at + len(found)]) * _MULTIPLIER
        found ^= found >> _SHIFT
    found *= _MULTIPLIER
    found ^= found >> np.uint64(32)
    found.sort()
    return found[np.append(True, found[1:] != found[:-1])]


def _key(found: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63)


def _sets(batches: Iterator[pd.DataFrame], size: int) -> Iterator[tuple[pd.DataFrame, list]]:
    for batch in batches:
        for at in range(0, len(batch), DOCS):
            part = batch.iloc[at : at + DOCS]
            # None and NaN stand for null.
            yield part, [shingles(t if isinstance(t, str) else None, size) for t in part["text"]]


def spare(n):
    """A class of ``n`` shingles links with none that lacks this many of them."""
    return n // 5 + 1


def sketch(n):
    """Smallest hashes to be counted: ``spare(n)`` and half as many again."""
    return min(n, spare(n) + max(8, n // 10))


# --- which classes can link -----------------------------------------------------------------------


def _messages(keys: list[int], sets: list[np.ndarray], blocks: int) -> pd.DataFrame:
    """Shingles of a batch of classes by block of columns, each shingle once.

    A shingle of several classes of the batch names nobody; it is credited to all of them here.
    """
    token = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    block = (token % np.uint64(blocks)).astype(np.int64)
    order = np.lexsort((token, block))
    token, owner, block = token[order], owner[order], block[order]
    first = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
    length = np.diff(np.append(first, len(token)))
    common = np.repeat(length > 1, length)
    names = np.array(keys, np.int64)
    out = {"block": [], "tokens": [], "owners": [], "keys": [], "credits": []}
    starts = np.flatnonzero(np.append(True, block[1:] != block[:-1])).tolist()
    for start, end in zip(starts, [*starts[1:], len(block)], strict=True):
        who, place = np.unique(owner[start:end], return_inverse=True)
        sent = slice(*np.searchsorted(first, (start, end)))
        owners = np.where(length[sent] > 1, _NOBODY, place[first[sent] - start])
        out["block"].append(int(block[start]))
        out["tokens"].append(token[first[sent]].tobytes())
        out["owners"].append(owners.astype(np.int32).tobytes())
        out["keys"].append(names[who].tobytes())
        credit = np.bincount(place[common[start:end]], minlength=len(who))
        out["credits"].append(credit.astype(np.int32).tobytes())
    return pd.DataFrame(out)


def _joined(column: pd.Series, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of bytes, and how many each row has."""
    width = np.dtype(kind).itemsize
    return np.frombuffer(b"".join(column), kind), np.array([len(x) // width for x in column], np.int64)


def _common_counts(rows: pd.DataFrame, parts: int) -> pd.DataFrame:
    """Per class, its shingles in this block that other classes have too; packed by part of the classes."""
    tokens, _ = _joined(rows["tokens"], np.uint64)
    owners, sent = _joined(rows["owners"], np.int32)
    keys, named = _joined(rows["keys"], np.int64)
    counts, _ = _joined(rows["credits"], np.int32)
    counts = counts.astype(np.int64)
    names, who = np.unique(keys, return_inverse=True)
    entry = np.where(owners == _NOBODY, _NOBODY, owners + np.repeat(np.cumsum(named) - named, sent))
    who_sent = np.where(entry == _NOBODY, _NOBODY, who[entry])
    order = np.lexsort((who_sent, tokens))
    tokens, who_sent, entry = tokens[order], who_sent[order], entry[order]
    first = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
    last = np.append(first[1:], len(tokens)) - 1
    common = (who_sent[first] == _NOBODY) | (who_sent[first] != who_sent[last])
    common = np.repeat(common, last - first + 1) & (entry != _NOBODY)
    counts += np.bincount(entry[common], minlength=len(counts))
    # A class in several batches has the same count from each.
    most = np.zeros(len(names), np.int64)
    np.maximum.at(most, who, counts)
    names, most = names[most > 0], most[most > 0]
    part = names % parts
    order = np.argsort(part, kind="stable")
    names, most, part = names[order], most[order], part[order]
    ends = np.flatnonzero(np.append(part[1:] != part[:-1], True))[: len(part)] + 1
    cut = lambda x: [p.tobytes() for p in np.split(x, ends[:-1])] if len(x) else []
    return pd.DataFrame({"part": part[ends - 1], "keys": cut(names), "counts": cut(most)})


def _sums(rows: pd.DataFrame) -> pd.DataFrame:
    """Per class, its common shingles over all blocks."""
    keys, _ = _joined(rows["keys"], np.int64)
    counts, _ = _joined(rows["counts"], np.int64)
    names, who = np.unique(keys, return_inverse=True)
    common = np.zeros(len(names), np.int64)
    np.add.at(common, who, counts)
    return pd.DataFrame({"key": names, "common": common})


def _linkable(docs: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """``(key, n, least)`` of classes with fewer than ``spare(n)`` shingles of their own in their sketch."""
    total = classes.agg(F.sum(_sketch_size(F.col("n")))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK))

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gathered, held = {}, 0
        for _, sets in _sets(batches, size):
            for found in sets:
                if len(found) and (key := _key(found)) not in gathered:
                    gathered[key] = found[: sketch(len(found))].copy()
                    held += len(gathered[key])
                if held >= SENT:
                    yield _messages(list(gathered), list(gathered.values()), blocks)
                    gathered, held = {}, 0
        if gathered:
            yield _messages(list(gathered), list(gathered.values()), blocks)

    messages = docs.select("text").mapInPandas(
        send, "block long, tokens binary, owners binary, keys binary, credits binary"
    )
    counted = messages.groupBy("block").applyInPandas(
        lambda rows: _common_counts(rows, blocks), "part long, keys binary, counts binary"
    )
    counts = counted.groupBy("part").applyInPandas(_sums, "key long, common long")
    own = _sketch_size(F.col("n")) - F.col("common")
    return classes.join(counts, "key").where(own < _spare(F.col("n"))).select("key", "n", "least")


def _spare(n: Column) -> Column:
    return F.floor(n / 5) + 1


def _sketch_size(n: Column) -> Column:
    return F.least(n, _spare(n) + F.greatest(F.lit(8), F.floor(n / 10)))


# --- candidate groups -----------------------------------------------------------------------------


def _incidence(docs: DataFrame, linkable: DataFrame, size: int) -> DataFrame:
    """``(key, n, tokens)`` of the classes, read from the text once more."""

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch, sets in _sets(batches, size):
            has = [len(s) > 0 for s in sets]
            sets = [s for s in sets if len(s)]
            tokens = pd.Series([s.view(np.int64) for s in sets], dtype=object)
            keys = np.array([_key(s) for s in sets], np.int64)
            yield pd.DataFrame({"id": batch["id"][has].to_numpy(), "key": keys, "tokens": tokens})

    kind = docs.schema["id"].dataType.simpleString()
    found = docs.mapInPandas(whole, f"id {kind}, key long, tokens array<long>")
    wanted = linkable.withColumnRenamed("key", "wanted")
    if 16 * linkable.count() <= BROADCAST_BYTES:
        wanted = F.broadcast(wanted)
    # One row of a class: that with the smallest id. Repeated ids may leave several, which are equal.
    found = found.join(wanted, (F.col("key") == F.col("wanted")) & F.col("id").eqNullSafe(F.col("least")))
    return found.groupBy("key").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens"))


def _rows(sets: DataFrame) -> DataFrame:
    """``(key, n, tokens, prefix)``: shingles that other classes have, and the rarest of them of which a
    partner has one; rows without the latter link with none."""
    spread = sets.select("key", F.explode("tokens").alias("token"))
    counts = materialize(
        spread.groupBy("token").agg(F.count("*").alias("rows")).where("rows > 1"), "columns"
    )
    common = spread.join(counts, "token").groupBy("key")
    common = common.agg(F.array_sort(F.collect_list(F.struct("rows", "token"))).alias("common"))
    tokens = F.transform("common", lambda c: c["token"])
    own = F.col("n") - F.size("common")
    return (
        common.join(sets.select("key", "n"), "key")
        .withColumn("wanted", (_spare(F.col("n")) - own).cast("int"))
        .where("wanted > 0")
        .select("key", "n", tokens.alias("tokens"), F.slice(tokens, F.lit(1), F.col("wanted")).alias("prefix"))
    )


def _groups(rows: DataFrame) -> DataFrame:
    """``(grp, key)`` of rows that share a prefix shingle with another, directly or over others."""
    spread = rows.select("key", F.explode("prefix").alias("token"))
    hubs = spread.groupBy("token").agg(F.min("key").alias("hub"), F.max("key").alias("other"))
    hubs = materialize(hubs.where("hub < other").select("token", "hub"), "hubs")
    stars = spread.join(hubs, "token").where("key > hub").select("key", "hub").distinct()
    found = connected_components(stars, "key", "hub")
    found = found.select(F.col("component").alias("grp"), F.col("node").alias("key"))
    return found.union(found.select("grp", F.col("grp").alias("key")).distinct())


# --- the product ----------------------------------------------------------------------------------


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Common shingles of every two rows, above the diagonal: the product of the incidence matrix with its
    transpose, taken by blocks of columns."""
    size = len(sets)
    out = np.zeros((size, size), np.int32)
    token = np.concatenate(sets)
    owner = np.repeat(np.arange(size), [len(s) for s in sets])
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    first = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
    length = np.diff(np.append(first, len(token)))
    for rows in range(2, DENSE + 1):
        # Owners of a column ascend.
        who = owner[first[length == rows][:, None] + np.arange(rows)]
        for i in range(rows):
            for j in range(i + 1, rows):
                pair, n = np.unique(who[:, i] * size + who[:, j], return_counts=True)
                out.ravel()[pair] += n.astype(np.int32)
    heavy = length > DENSE
    owner = owner[np.repeat(heavy, length)]
    column = np.repeat(np.arange(heavy.sum()), length[heavy])
    step = max(1, CHUNK // size)
    for at in range(0, int(heavy.sum()), step):
        part = slice(*np.searchsorted(column, (at, at + step)))
        block = np.zeros((size, step), np.float32)
        block[owner[part], column[part] - at] = 1
        out += np.triu(block @ block.T, 1).astype(np.int32)
    return out


def _cell_links(rows: pd.DataFrame) -> pd.DataFrame:
    keys, n = rows["key"].to_numpy(), rows["n"].to_numpy(np.int64)
    common = overlaps(rows["tokens"].tolist())
    i, j = np.nonzero(common)
    enough = 9 * common[i, j].astype(np.int64) >= 4 * (n[i] + n[j])
    forest = Forest(len(keys))
    forest.add(i[enough], j[enough])
    found = np.flatnonzero(forest.parent != np.arange(len(keys)))
    return pd.DataFrame({"a": keys[found], "b": keys[forest.parent[found]]})


def _parts(rows: Column, tokens: Column, share: int) -> Column:
    """Parts of a group so that one has about ``1 / share`` of a cell."""
    wanted = F.greatest(rows / (CELL_ROWS // share), tokens / (CELL_SHINGLES // share))
    return F.greatest(F.lit(1), F.ceil(wanted)).cast("long")


def _hashed(column: str, parts: Column) -> Column:
    return F.pmod(F.xxhash64(column, F.lit(SEED)), parts)


def _links(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` between classes, with the components of all links."""
    rows = materialize(groups.join(rows.drop("prefix"), "key"), "candidates")
    weigh = (F.count("*").alias("rows"), F.sum(F.size("tokens")).alias("tokens"))
    sums = materialize(rows.groupBy("grp").agg(*weigh), "groups")
    is_small = (F.col("rows") <= CELL_ROWS // 4) & (F.col("tokens") <= CELL_SHINGLES // 4)
    small = rows.join(sums.where(is_small).select("grp"), "grp", "left_semi")
    total = sums.where(is_small).agg(F.sum("rows"), F.sum("tokens")).first()
    cells = max(1, -(-(total[0] or 0) // CELL_ROWS), -(-(total[1] or 0) // CELL_SHINGLES))
    found = (
        small.withColumn("cell", _hashed("grp", F.lit(cells)))
        .select("cell", "key", "n", "tokens")
        .groupBy("cell")
        .applyInPandas(_cell_links, "a long, b long")
    )
    large = sums.where(~is_small).select("grp")
    if large.isEmpty():
        return found
    return found.union(_large_links(rows.join(large, "grp", "left_semi")))


def _large_links(rows: DataFrame) -> DataFrame:
    share = F.struct(F.size("tokens") / F.col("n"), F.col("n"), F.col("key"))
    chosen = rows.groupBy("grp").agg(F.max(share).alias("s")).select("grp", F.col("s.key").alias("key"))
    pivots = materialize(
        rows.join(chosen, ["grp", "key"]).select(
            "grp", F.col("key").alias("pivot"), F.col("n").alias("pivot_n"), F.col("tokens").alias("pivot_tokens")
        ),
        "pivots",
    )
    met = F.size(F.array_intersect("tokens", "pivot_tokens"))
    star = (F.col("key") == F.col("pivot")) | (9 * met >= 4 * (F.col("n") + F.col("pivot_n")))
    tried = materialize(
        rows.join(pivots, "grp").select(
            "grp", "pivot", "key", "n", "tokens", star.alias("star"), F.floor(F.log("n") / float(np.log(BAND))).alias("band")
        ),
        "compared",
    )
    kind = ["grp", "band", "star"]
    weigh = (F.count("*").alias("rows"), F.sum(F.size("tokens")).alias("tokens"))
    cuts = tried.groupBy(*kind).agg(*weigh).withColumn("parts", _parts(F.col("rows"), F.col("tokens"), 2))
    cuts = materialize(cuts.select(*kind, "parts"), "cuts")
    blocks = cuts.select(*kind, F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    a = blocks.select("grp", *(F.col(c).alias(f"a_{c}") for c in ("band", "star", "part")))
    # The block itself and those behind it, in its own band and the next.
    b = blocks.select("grp", *(F.col(c).alias(f"b_{c}") for c in ("band", "star", "part")))
    b = b.withColumn("a_band", F.explode(F.array(F.col("b_band"), F.col("b_band") - 1)))
    pairs = a.join(b, ["grp", "a_band"]).where(
        "not (a_star and b_star) and (a_band < b_band or struct(a_star, a_part) <= struct(b_star, b_part))"
    )
    pairs = materialize(
        pairs.withColumn("cell", F.xxhash64("grp", "a_band", "a_star", "a_part", "b_band", "b_star", "b_part")), "cells"
    )
    side = lambda s: pairs.select("cell", "grp", *(F.col(f"{s}_{c}").alias(c) for c in ("band", "star", "part")))
    places = side("a").union(side("b")).distinct()
    placed = tried.join(cuts, kind).withColumn("part", _hashed("key", F.col("parts")))
    found = (
        placed.join(places, [*kind, "part"])
        .select("cell", "key", "n", "tokens")
        .groupBy("cell")
        .applyInPandas(_cell_links, "a long, b long")
    )
    stars = tried.where("star and key <> pivot").select(F.col("key").alias("a"), F.col("pivot").alias("b"))
    return found.union(stars)


def near_duplicates(
    docs: DataFrame, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, n_shingles, component_id)`` per row: the size of its set, and the smallest id reachable over
    links of a similarity of 0.8 or more, itself included.

    Words are separated by ASCII white space and A-Z are lower-cased. Fewer words than ``shingle`` are one
    shingle. Null texts and texts without words have an empty set and link with nothing, so
    ``component_id`` is their own id. A null id keeps its row and is never a smallest id unless all are
    null. Repeated rows give repeated rows; other columns are ignored, whatever their names; an empty table gives
    an empty one.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()

    def sized(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch, sets in _sets(batches, shingle):
            keys = pd.array([_key(s) if len(s) else None for s in sets], dtype="Int64")
            yield pd.DataFrame({"id": batch["id"], "n": np.array([len(s) for s in sets], np.int64), "key": keys})

    # All Python runs in the tables that are stored here.
    with small_batches(docs.sparkSession):
        # Null ids would make pandas turn numbers into floats; they travel as text.
        named = docs.withColumn("id", F.col("id").cast("string"))
        sizes = named.mapInPandas(sized, "id string, n long, key long").withColumn("id", F.col("id").cast(kind))
        sizes = materialize(sizes, "set-sizes")
        classes = sizes.where("key is not null").groupBy("key")
        classes = materialize(classes.agg(F.first("n").alias("n"), F.min("id").alias("least")), "classes")
        linkable = _linkable(docs, classes, shingle).withColumn("least", F.col("least").cast("string"))
        linkable = materialize(linkable, "linkable")
        sets = materialize(_incidence(named, linkable, shingle), "incidence")
        rows = materialize(_rows(sets), "rows")
        roots = connected_components(_links(rows, _groups(rows)), "a", "b")
        rooted = classes.join(roots.withColumnRenamed("node", "key"), "key", "left").select(
            "key", "least", F.coalesce("component", "key").alias("root")
        )
        rooted = materialize(rooted, "rooted")
        smallest = materialize(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "smallest")
        found = materialize(rooted.join(smallest, "root").select("key", "component_id"), "named")
    linked = sizes.where("key is not null").join(found, "key").select("id", "n", "component_id")
    rest = sizes.where("key is null").select("id", "n", F.col("id").alias("component_id"))
    return linked.union(rest).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")
