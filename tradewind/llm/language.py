"""Language identification with hyperdimensional letter profiles.

Every letter has a random vector of +1 and -1, derived from its code point and a seed, so that any
script works without a fixed alphabet. An n-gram is the product of its letters' vectors, each permuted
(rolled) by its place; a text is the sum of its n-grams (Joshi, Halseth and Kanerva, 2016). A language
is the sum of its texts, and a text belongs to the language with the largest cosine.

Training adds whole numbers per language, per task and then over tasks, so the prototypes do not depend
on the partitioning. The model is one vector per language; texts never leave their task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.names import quoted, unused
from tradewind.llm.worker import remembered, travels_with_tasks

travels_with_tasks(__name__)

UNDETERMINED = "und"
#: Bits of a code point; a packed n-gram of three fits 63 bits.
CODE_BITS = 21
#: Letters, texts and n-grams handled at a time, which bounds memory whatever the texts are.
CHUNK_LETTERS, CHUNK_TEXTS, CHUNK_GRAMS = 1 << 18, 256, 2048


@dataclass(frozen=True)
class Space:
    """``size`` letters per n-gram, at most 3."""

    dimensions: int = 1024
    size: int = 3
    seed: int = 20160


@dataclass
class Model:
    """Prototype per language, in the order of the names."""

    space: Space
    names: list[str] = field(default_factory=list)
    prototypes: np.ndarray = field(default_factory=lambda: np.empty((0, 0)))


def _make_folding() -> np.ndarray:
    fold = np.zeros(0x110000, np.int64)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            fold[code] = ord(low) if len(low) == 1 else code
    return fold


def _folding() -> np.ndarray:
    """Lower-case code point of every letter, zero for all else (the gap between words)."""
    return remembered(("letters",), _make_folding)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def letters(text: str) -> np.ndarray:
    """Folded letters with one zero between words and at both ends; empty without a letter."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    folded = _folding()[codes]
    folded = np.concatenate(([0], folded, [0]))
    kept = folded[np.concatenate(([True], (folded[1:] != 0) | (folded[:-1] != 0)))]
    return kept if len(kept) > 1 else kept[:0]


def grams(text: str | None, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams, packed into a number, and how often each occurs."""
    codes = letters(text or "")
    found = []
    for at in range(0, max(0, len(codes) - size + 1), CHUNK_LETTERS):
        part = codes[at : at + CHUNK_LETTERS + size - 1]
        packed = np.zeros(len(part) - size + 1, np.int64)
        for place in range(size):
            packed = packed << CODE_BITS | part[place : place + len(packed)]
        found.append(np.unique(packed, return_counts=True))
    if len(found) == 1:
        return found[0]
    return _merge(found)


def _merge(found: list) -> tuple[np.ndarray, np.ndarray]:
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    values, at = np.unique(np.concatenate([v for v, _ in found]), return_inverse=True)
    counts = np.bincount(at, np.concatenate([c for _, c in found]), len(values))
    return values, counts.astype(np.int64)


def letter_vectors(codes: np.ndarray, space: Space) -> np.ndarray:
    """Rows of +1 and -1 from a mixing function (splitmix64) of seed, code point and place."""
    words = -(-space.dimensions // 64)
    with np.errstate(over="ignore"):
        x = codes.astype(np.uint64)[:, None] * np.uint64(words) + np.arange(words, dtype=np.uint64)
        x = (x + np.uint64(space.seed)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    bits = np.unpackbits(x.view(np.uint8), axis=1)[:, : space.dimensions]
    return (2 * bits.astype(np.int8) - 1).astype(np.int8)


def gram_vectors(packed: np.ndarray, space: Space) -> np.ndarray:
    mask = (1 << CODE_BITS) - 1
    out = np.ones((len(packed), space.dimensions), np.int8)
    for place in range(space.size):
        codes = packed >> CODE_BITS * (space.size - 1 - place) & mask
        values, at = np.unique(codes, return_inverse=True)
        out *= np.roll(letter_vectors(values, space), space.size - 1 - place, axis=1)[at]
    return out


def bundle(texts: list, space: Space) -> np.ndarray:
    """One row per entry of ``texts``, each a ``grams`` result."""
    values = _merge(texts)[0]
    out = np.zeros((len(texts), space.dimensions), np.float64)
    for at in range(0, len(values), CHUNK_GRAMS):
        block = values[at : at + CHUNK_GRAMS]
        counts = np.zeros((len(texts), len(block)), np.float32)
        for row, (packed, n) in enumerate(texts):
            low, high = np.searchsorted(packed, [block[0], block[-1] + 1])
            counts[row, np.searchsorted(block, packed[low:high])] = n[low:high]
        out += counts @ gram_vectors(block, space).astype(np.float32)
    return out


def _groups(texts: list) -> Iterator[list]:
    """Runs of n-gram tables of bounded size."""
    run, size = [], 0
    for table in texts:
        run.append(table)
        size += len(table[0])
        if len(run) >= CHUNK_TEXTS or size >= CHUNK_LETTERS:
            yield run
            run, size = [], 0
    if run:
        yield run


def train(docs: DataFrame, label: str = "lang", text: str = "text", space: Space = Space()) -> Model:
    """Prototypes from all rows with a label and a text.

    The driver receives one vector per label, nothing that grows with the rows. Labels without a
    letter in any text are not learned; no usable rows give a model that knows no language.
    """

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, texts in batch.groupby("label", sort=False)["text"]:
                vector = total.setdefault(name, np.zeros(space.dimensions, np.int64))
                for run in _groups(grams(t, space.size) for t in texts):
                    packed, n = _merge(run)
                    for at in range(0, len(packed), CHUNK_GRAMS):
                        part = slice(at, at + CHUNK_GRAMS)
                        # Whole numbers below 2^53, so the sums are exact.
                        signs = gram_vectors(packed[part], space).astype(np.float64)
                        vector += (n[part].astype(np.float64) @ signs).astype(np.int64)
        if total:
            vectors = [v.tolist() for v in total.values()]
            yield pd.DataFrame({"label": list(total), "vector": vectors})

    rows = docs.select(F.col(label).cast("string").alias("label"), F.col(text).alias("text"))
    parts = rows.dropna().mapInPandas(sums, "label string, vector array<long>")
    places = parts.select("label", F.posexplode("vector").alias("place", "value"))
    summed = places.groupBy("label", "place").agg(F.sum("value").alias("value"))
    vectors = summed.groupBy("label").agg(
        F.sort_array(F.collect_list(F.struct("place", "value"))).alias("vector")
    )
    found = {r["label"]: [v["value"] for v in r["vector"]] for r in vectors.collect()}
    found = {name: v for name, v in sorted(found.items()) if any(v)}
    if not found:
        return Model(space)
    matrix = np.array(list(found.values()), np.float64)
    return Model(space, list(found), matrix / np.linalg.norm(matrix, axis=1, keepdims=True))


def predict(text: Column, model: Model) -> Column:
    """Struct of the best language and its cosine, not below 0.

    A text without a letter, a null text, and any text under a model without languages get
    ``und`` and 0. Of equal cosines the first name wins.
    """

    @F.pandas_udf("lang_pred string, score double")
    def of(texts: pd.Series) -> pd.DataFrame:
        names, scores = [], []
        for run in _groups(grams(t, model.space.size) for t in texts):
            vectors = bundle(run, model.space)
            norms = np.linalg.norm(vectors, axis=1)
            known = np.array([len(packed) > 0 for packed, _ in run]) & bool(model.names)
            cosines = np.zeros((len(run), max(1, len(model.names))))
            if model.names:
                cosines = vectors @ model.prototypes.T / np.where(norms, norms, 1)[:, None]
            cosines = np.round(cosines, 12)
            best = cosines.argmax(axis=1)
            for ok, i, score in zip(known, best, cosines.max(axis=1), strict=True):
                names.append(model.names[i] if ok else UNDETERMINED)
                scores.append(min(1.0, max(0.0, float(score))) if ok else 0.0)
        return pd.DataFrame({"lang_pred": names, "score": scores})

    return of(text)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with the columns ``lang_pred`` and ``score``, replacing columns of these names."""
    found = unused(docs, "found")
    kept = docs.drop("lang_pred", "score")
    return docs.withColumn(found, predict(F.col(text), model)).select(
        *quoted(kept.columns), f"{found}.lang_pred", f"{found}.score"
    )


def _size_class(text: Column) -> Column:
    return F.floor(F.log2(F.length(text))).cast("int")


def floors(
    found: DataFrame, model: Model, label: str = "lang", text: str = "text",
    share: float = 0.6, letters_: int = 100,
) -> dict[tuple[str, int], float]:
    """Least cosine per language and size class (powers of two of the length) of a text in that language.

    It is a share of what 95 % of the labelled texts reach, as other languages of the same script are well
    below that. Taken from all rows of ``identify`` with a label; a size class without texts has the least
    cosine of the next smaller one.
    """
    rows = found.select(
        F.col(label).cast("string").alias("label"), F.col(text).alias("text"), "lang_pred", "score"
    )
    own = rows.where((F.col("label") == F.col("lang_pred")) & (F.length("text") >= letters_))
    own = own.withColumn("size", _size_class(F.col("text")))
    low = own.groupBy("label", "size").agg(F.percentile_approx("score", 0.05).alias("low")).collect()
    seen = {(r["label"], r["size"]): share * r["low"] for r in low}
    out = {}
    for name in model.names:
        last = 0.0
        for size in range(32):
            last = out[name, size] = seen.get((name, size), last)
    return out


def accepted(
    found: DataFrame,
    text: str = "text",
    least: float = 0.1,
    letters_: int = 100,
    floors: dict[tuple[str, int], float] | None = None,
    labelled: Column | None = None,
) -> DataFrame:
    """Rows of ``identify`` in a learned language.

    Rejected are texts without a letter, and texts of at least ``letters_`` characters that resemble no
    learned language: a cosine below ``least``, or, unless ``labelled`` says that the row's language is
    known, below the one that ``floors`` gives for the predicted language. Shorter texts hold too few
    n-grams to reject them.
    """
    bound = F.lit(least)
    if floors:
        table = F.create_map(*(F.lit(x) for (name, size), v in floors.items() for x in (f"{name}:{size}", v)))
        key = F.concat_ws(":", "lang_pred", _size_class(F.col(text)).cast("string"))
        bound = F.greatest(bound, F.coalesce(F.try_element_at(table, key), F.lit(0.0)))
        if labelled is not None:
            bound = F.when(labelled, F.lit(least)).otherwise(bound)
    judged = (F.length(text) < letters_) | (F.col("score") >= bound)
    return found.where((F.col("lang_pred") != UNDETERMINED) & judged)


def held_out(key: Column) -> Column:
    """A quarter of the keys, by checksum; a null key is not held out."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))
