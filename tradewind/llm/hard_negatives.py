"""Hard negatives of labelled vectors: exact scores for what one-bit codes cannot rule out.

For an anchor, the positives are the best-scoring other rows of its label, and the hard negatives of a
positive the best rows of other labels whose score lies in a range set by the positive's. Components
are scaled to whole numbers, scores are integer inner products.

*Codes.* Vectors are rotated by random signs and Walsh-Hadamard steps, which keeps inner products. The
code of a row is the signs of its rotated components, the vector ``b`` of length one; stored beside it are
the alignment ``a = <o, b>`` and the length of the residual ``r = o - a b``. An anchor ``q`` is rounded to
eight bits a component, ``q = p + e``, and ``g = <p, b>`` comes from popcounts of its bit planes with the
code. Then ``<q, o> = a g + <p - g b, r> + <e, o>``, and by Cauchy-Schwarz the last two lie within
``|p - g b| |r| + |e| |o|``. This interval always holds the score, so what it rules out is no result.

*Search.* The best estimates are scored first; the worst of them that counts is a threshold, and rows whose
interval reaches it and the wanted range are scored exactly. Rows and anchors meet in cells of fixed
size, both dealt by hash, so no label, copy or anchor makes a cell heavy, and neither side is broadcast. A
cell returns at most the wanted number of rows per anchor and positive; a window with a limit merges cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.names import quoted
from tradewind.llm.worker import travels_with_tasks
from tradewind.session import materialize

travels_with_tasks(__name__)

#: Components are multiplied by this and rounded down.
SCALE = 256
SEED = 60316
ROUNDS = 3
#: Bits of a rounded anchor component, and what is added to make it positive.
PLANES, SHIFT = 8, 128
#: Rows and anchors of a cell.
CELL = 4096
#: Intervals and exact scores computed at a time.
CHUNK, SCORES = 1 << 18, 1 << 15
#: The id that stands for none; such rows come last among equal scores.
NO_ID = (1 << 63) - 1

_ENCODED = "row long, place long, label long, whole binary, code binary, along double, rest double, norm double"


# --- codes ----------------------------------------------------------------------------------------


def padded(dimensions: int) -> int:
    """Dimensions of the codes: a power of two, whole 64-bit words."""
    return max(64, 1 << max(0, dimensions - 1).bit_length())


def rotated(vectors: np.ndarray) -> np.ndarray:
    """The same pseudo-random rotation for every vector of this length."""
    out = vectors.astype(np.float64)
    rows, size = out.shape
    signs = np.random.Generator(np.random.PCG64(SEED)).integers(0, 2, (ROUNDS, size)) * 2.0 - 1.0
    for sign in signs:
        out *= sign
        half = 1
        while half < size:
            pairs = out.reshape(rows, -1, 2, half)
            left, right = pairs[:, :, 0], pairs[:, :, 1]
            out = np.stack((left + right, left - right), axis=2).reshape(rows, size)
            half *= 2
        out /= np.sqrt(size)
    return out


def words(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=1).view(np.uint64)


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code words, alignment, residual and length per row."""
    turned = rotated(vectors)
    along = np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])
    square = (vectors.astype(np.float64) ** 2).sum(axis=1)
    return words(turned >= 0), along, np.sqrt(np.maximum(square - along**2, 0)), np.sqrt(square)


class Anchors:
    """Bit planes of rounded anchors, and intervals of their scores with coded rows."""

    def __init__(self, vectors: np.ndarray) -> None:
        turned = rotated(vectors)
        self.size = turned.shape[1]
        self.step = np.maximum(np.abs(turned).max(axis=1), 1e-300) / (SHIFT - 1)
        whole = np.rint(turned / self.step[:, None]).astype(np.int64)
        raised = (whole + SHIFT).astype(np.uint8)
        self.planes = [words(raised >> j & 1) for j in range(PLANES)]
        self.total = whole.sum(axis=1)
        kept = whole * self.step[:, None]
        self.square = (kept**2).sum(axis=1)
        self.lost = np.sqrt(((turned - kept) ** 2).sum(axis=1))
        self.norm = np.sqrt((turned**2).sum(axis=1))

    def intervals(self, part: slice, code, along, rest, norm) -> tuple[np.ndarray, np.ndarray]:
        """Estimates and half widths, anchors by rows."""
        counts = np.zeros((len(self.total[part]), len(code)), np.int64)
        for j, plane in enumerate(self.planes):
            for word in range(code.shape[1]):
                counts += np.bitwise_count(plane[part, word][:, None] & code[:, word]).astype(np.int64) << j
        ones = np.bitwise_count(code).sum(axis=1, dtype=np.int64)
        signed = 2 * (counts - SHIFT * ones) - self.total[part, None]
        g = signed * (self.step[part, None] / np.sqrt(self.size))
        half = np.sqrt(np.maximum(self.square[part, None] - g**2, 0)) * rest
        # The last part covers the rounding of this arithmetic.
        half += self.lost[part, None] * norm + 1e-9 * self.norm[part, None] * norm + 1e-6
        return along * g, half


# --- a cell ---------------------------------------------------------------------------------------


def _scores(asked: np.ndarray, known: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Integer scores of the given pairs."""
    out = np.empty(len(i), np.int64)
    for at in range(0, len(i), SCORES):
        part = slice(at, at + SCORES)
        out[part] = np.einsum("ij,ij->i", asked[i[part]], known[j[part]])
    return out


def _threshold(asked, known, estimate, fits, most, low, high) -> np.ndarray:
    """Per anchor, a score that the ``most``-th best row in its range reaches at least."""
    ranked = np.where(fits & (estimate <= high[:, None] + 0.5), estimate, -np.inf)
    if ranked.shape[1] > most:
        nth = np.argpartition(-ranked, most - 1, axis=1)[:, :most]
    else:
        nth = np.tile(np.arange(ranked.shape[1]), (len(ranked), 1))
    i = np.repeat(np.arange(len(ranked)), nth.shape[1])
    score = _scores(asked, known, i, nth.ravel()).reshape(nth.shape)
    good = np.isfinite(np.take_along_axis(ranked, nth, axis=1))
    good &= (score >= low[:, None]) & (score <= high[:, None])
    enough = good.sum(axis=1) >= most
    return np.where(enough, np.where(good, score, NO_ID).min(axis=1, initial=NO_ID), low)


def _first(i, score, place, row, most) -> np.ndarray:
    """Positions of the first ``most`` of every ``i`` by score, then id."""
    order = np.lexsort((row, place, -score, i))
    ranks = np.arange(len(order))
    starts = np.flatnonzero(np.diff(i[order], prepend=-1))
    ranks -= np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[ranks < most]


def _best(asked: pd.DataFrame, known: pd.DataFrame, same: bool, most: int) -> Iterator[tuple]:
    """(anchors, wanted, rows, scores) of the first ``most`` rows in each wanted range."""
    stack = lambda side: np.frombuffer(b"".join(side["whole"]), np.int64).reshape(len(side), -1)
    left, right = stack(asked), stack(known)
    code = np.frombuffer(b"".join(known["code"]), np.uint64).reshape(len(known), -1)
    along, rest, norm = (known[c].to_numpy() for c in ("along", "rest", "norm"))
    labels, rows, places = (known[c].to_numpy() for c in ("label", "row", "place"))
    label, row = asked["label"].to_numpy(), asked["row"].to_numpy()
    low, high = (np.array(asked[c].tolist(), np.int64).reshape(len(asked), -1) for c in ("low", "high"))
    anchors = Anchors(left)
    step = max(1, CHUNK // len(known))
    for at in range(0, len(asked), step):
        part = slice(at, at + step)
        estimate, half = anchors.intervals(part, code, along, rest, norm)
        fits = (label[part, None] == labels) == same
        fits &= row[part, None] != rows
        survives, reach = np.zeros_like(fits), []
        for w in range(low.shape[1]):
            lo, hi = low[part, w], high[part, w]
            inside = fits & (estimate + half >= lo[:, None]) & (estimate - half <= hi[:, None])
            least = _threshold(left[part], right, estimate, inside, most, lo, hi)
            survives |= inside & (estimate + half >= least[:, None])
            reach.append(least)
        i, j = np.nonzero(survives)
        score = _scores(left[part], right, i, j)
        for w, least in enumerate(reach):
            good = np.flatnonzero((score >= least[i]) & (score <= high[part, w][i]))
            first = good[_first(i[good], score[good], places[j[good]], rows[j[good]], most)]
            yield at + i[first], np.full(len(first), w), j[first], score[first]


# --- over Spark -----------------------------------------------------------------------------------


def whole_numbers(vector: Column) -> Column:
    """Components times ``SCALE``, rounded down; null unless all are finite numbers."""
    usable = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return F.when(
        vector.isNotNull() & usable,
        F.transform(vector, lambda x: F.floor(SCALE * x.cast("double"))),
    )


def _encoded(rows: DataFrame, size: int) -> DataFrame:
    def codes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            whole = np.zeros((len(batch), size), np.int64)
            for vector, found in zip(whole, batch["whole"], strict=True):
                vector[: len(found)] = found
            code, along, rest, norm = encode(whole)
            yield batch[["row", "place", "label"]].assign(
                whole=[v.tobytes() for v in whole], code=[c.tobytes() for c in code], along=along, rest=rest, norm=norm
            )

    return rows.select("row", "place", "label", "whole").mapInPandas(codes, _ENCODED)


def _dealt(anchors: DataFrame, rows: DataFrame, cell: int) -> tuple:
    """Both sides with the cells in which every anchor meets every row once."""
    across, down = (max(1, -(-side.count() // cell)) for side in (anchors, rows))
    block = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumn("across", block(across)).withColumn("down", every(down))
    right = rows.withColumn("down", block(down)).withColumn("across", every(across))
    return left.groupBy("across", "down"), right.groupBy("across", "down")


def _search(anchors: DataFrame, rows: DataFrame, same: bool, most: int, cell: int) -> DataFrame:
    """``(anchor, wanted, nth, place, score)``: the first rows in every range ``low`` to ``high``."""

    def best(asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        out = {"anchor": [], "wanted": [], "row": [], "place": [], "score": []}
        if len(asked) and len(known):
            for i, w, j, score in _best(asked, known, same, most):
                out["anchor"].append(asked["row"].to_numpy()[i])
                out["wanted"].append(w)
                out["row"].append(known["row"].to_numpy()[j])
                out["place"].append(known["place"].to_numpy()[j])
                out["score"].append(score)
        empty = np.empty(0, np.int64)
        return pd.DataFrame({k: np.concatenate([empty, *v]) for k, v in out.items()})

    left, right = _dealt(anchors, rows, cell)
    found = left.cogroup(right).applyInPandas(
        best, "anchor long, wanted long, row long, place long, score long"
    )
    order = Window.partitionBy("anchor", "wanted").orderBy(F.desc("score"), "place", "row")
    return found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= most)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = 5,
    negatives: int = 10,
    percent: tuple[int, int] = (30, 90),
    cell: int = CELL,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    The rows for which ``is_anchor`` holds are searched for against all rows. The positives of an anchor
    are its first ``positives`` other rows with the same label by score, then by id; for each of
    them the first ``negatives`` rows of other labels whose score is within ``percent`` of the positive's.
    Anchors without a positive, and positives without a row in that range, have no result; a positive
    with a negative score has an empty range.

    Rows with a null label, a null vector or a component that is null or not finite take no part. A null id
    is no anchor unless ``is_anchor`` says so, comes last among equal scores and is returned as null (the
    largest 64-bit number stands for it). Repeated rows are rows of their own: a copy of the anchor is
    another row, and a repeated anchor repeats its results. Shorter vectors count as filled up with
    zeros; an empty one scores zero. Scores have to fit 64 bits, or an error names the largest component.
    Other columns are ignored, an empty table gives an empty one.
    """
    id_, vector, label = (F.col(c) for c in quoted([id_col, vector_col, label_col]))
    rows = materialize(
        vectors.select(
            F.coalesce(id_.cast("long"), F.lit(NO_ID)).alias("place"),
            label.cast("long").alias("label"),
            whole_numbers(vector).alias("whole"),
            F.coalesce(is_anchor, F.lit(False)).alias("asks"),
        )
        .where("label is not null and whole is not null")
        .withColumn("row", F.monotonically_increasing_id()),
        "vectors",
    )
    width = rows.agg(
        F.max(F.size("whole")), F.max(F.array_max(F.transform("whole", lambda x: F.abs(x))))
    ).first()
    size, largest = padded(width[0] or 0), width[1] or 0
    if size * largest**2 >= 1 << 62:
        raise ValueError(f"a component of {largest / SCALE:g} makes scores that do not fit 64 bits")
    coded = materialize(_encoded(rows, size), "codes")
    asks = rows.where("asks").select("row")
    anchors = materialize(coded.join(asks, "row", "left_semi"), "anchors")
    anything = F.lit(1 << 62)
    near = _search(
        anchors.withColumns({"low": F.array(-anything), "high": F.array(anything)}), coded, True, positives, cell
    )
    near = materialize(near.select("anchor", "nth", "place", "score"), "positives")
    # At most `positives` entries per anchor; place k of a range belongs to the k-th positive.
    ranges = near.groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct("nth", "score"))).alias("found")
    )
    bound = lambda p, up: F.transform(
        F.concat("found", F.array_repeat(F.struct(F.lit(0).alias("nth"), F.lit(-1).cast("long").alias("score")), positives)),
        lambda s: _quotient(p * s["score"], up),
    )
    wanted = ranges.select(
        F.col("anchor").alias("row"),
        F.slice(bound(percent[0], True), 1, positives).alias("low"),
        F.slice(bound(percent[1], False), 1, positives).alias("high"),
    )
    far = _search(anchors.join(wanted, "row"), coded, False, negatives, cell)
    far = far.select(
        "anchor",
        (F.col("wanted") + 1).alias("positive"),
        F.col("nth").alias("rank"),
        F.col("place").alias("negative"),
        F.col("score").alias("negative_score"),
    )
    named = near.select(
        "anchor", F.col("nth").alias("positive"), F.col("place").alias("near"), F.col("score").alias("positive_score")
    )
    ids = anchors.select(F.col("row").alias("anchor"), F.col("place").alias("own"))
    known = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return (
        far.join(named, ["anchor", "positive"])
        .join(ids, "anchor")
        .select(
            known("own").alias("anchor_id"),
            known("near").alias("positive_id"),
            "rank",
            known("negative").alias("negative_id"),
            "positive_score",
            "negative_score",
        )
    )


def _quotient(number: Column, up: bool) -> Column:
    """A hundredth of a whole number, rounded up or down exactly."""
    rest = F.pmod(number, F.lit(100).cast("long"))
    down = (number - rest).cast("long")
    whole = F.call_function("div", down, F.lit(100).cast("long"))
    return F.when(rest > 0, whole + 1).otherwise(whole) if up else whole
