"""Benchmark decontamination: documents that hold a benchmark passage within an edit budget.

*Filter.* A passage of m characters that occurs with at most k edits shares at least m + 1 - q(k + 1) of
its character q-grams with the place where it occurs (q-gram lemma), and those q-grams lie on at most
k + 1 neighbouring diagonals (place in the text minus place in the passage). The diagonals are cut
into bands of twice that width, each overlapping the next by half, so one band holds them all. Bands
with fewer distinct shared q-grams are dropped.

*Verification.* What is left is aligned: edit distance of the whole passage against any stretch of the
text, along the diagonals of the band only. A distance within the budget is a leak.

Text is compared in a folded form: letters and digits in lower case, everything else one blank. Places
are reported in the original text, in code points.

The benchmark is the stated query set. It is split by hash into blocks of bounded size, each shipped
to the tasks as arrays; documents are scanned once per block and never shuffled, so a hot source or a
passage that very many documents share changes nothing. Passages longer than ``segment`` characters
are cut into overlapping segments, one each ``stride`` characters, each of which counts as a passage. That
bounds an alignment, and any excerpt of segment + stride - 1 characters, less the budget, is found.
A passage up to a segment long is found as a whole only.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tradewind.llm.worker import latest, remembered, travels_with_tasks

travels_with_tasks(__name__)

#: Characters of text searched at a time within a task; shared q-grams from which on a stretch is halved
#: (repetitive texts share very many), down to the shortest; cells of one batch of alignments.
WINDOW = 1 << 18
SHARED = 1 << 20
CELLS = 1 << 22
_FAR = 1 << 20


@dataclass(frozen=True)
class Rules:
    """``edit_rate``: edits allowed per character of the folded passage.

    A folded passage shorter than ``q`` has no q-gram and finds nothing. ``block_chars`` bounds the
    passages searched for in one scan.
    """

    q: int = 8
    edit_rate: float = 0.1
    segment: int = 512
    stride: int = 128
    block_chars: int = 1 << 21

    def edits(self, length: int) -> int:
        """Budget of a passage; for short ones what leaves the lemma at least one q-gram."""
        return max(0, min(int(length * self.edit_rate), length // self.q - 1))


def _make_folding() -> np.ndarray:
    fold = np.full(0x110000, 32, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalnum():
            low = char.lower()
            fold[code] = ord(low) if len(low) == 1 else code
    return fold


def _folding() -> np.ndarray:
    """Lower-case code point of letters and digits, a blank for all else."""
    return remembered(("letters and digits",), _make_folding)


def folded(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Folded code points and the place of each in the original."""
    raw = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4")
    codes = _folding()[raw]
    word = codes != 32
    kept = word.copy()
    kept[1:] |= word[:-1]  # The first blank behind a word.
    at = np.flatnonzero(kept)
    if len(at) and not word[at[-1]]:
        at = at[:-1]
    return codes[at], at


def hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of every q-gram, built by doubling."""
    if len(codes) < q:
        return np.empty(0, np.uint64)
    mix = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        power, width, done, out = codes.astype(np.uint64) * mix, 1, 0, None
        rest = q
        while rest:
            if rest & 1:
                n = len(codes) - q + 1
                part = power[done : done + n]
                out = part.copy() if out is None else (out ^ (out >> np.uint64(29))) * mix + part
                done += width
            rest >>= 1
            if rest:
                power = (power[:-width] ^ (power[:-width] >> np.uint64(31))) * mix + power[width:]
                width *= 2
    return out


class Index:
    """The q-grams of one block of passages."""

    def __init__(self, items: list, texts: list, rules: Rules) -> None:
        self.rules = rules
        self.items, self.codes, grams, owners, places = [], [], [], [], []
        for item, text in zip(items, texts, strict=True):
            codes = folded(text)[0]
            starts = range(0, max(1, len(codes) - rules.segment + 1), rules.stride)
            starts = {*starts, max(0, len(codes) - rules.segment)}
            for at in sorted(starts):
                part = codes[at : at + rules.segment]
                own = hashes(part, rules.q)
                if len(own):
                    owners.append(np.full(len(own), len(self.items)))
                    places.append(np.arange(len(own)))
                    grams.append(own)
                    self.items.append(item)
                    self.codes.append(part)
        self.length = np.array([len(c) for c in self.codes], np.int64)
        self.budget = np.array([rules.edits(n) for n in self.length], np.int64)
        self.needed = self.length + 1 - rules.q * (self.budget + 1)
        if not grams:
            return
        gram, owner, place = map(np.concatenate, (grams, owners, places))
        order = np.argsort(gram, kind="stable")
        self.owner, self.place = owner[order], place[order]
        self.gram, self.first, self.count = np.unique(gram[order], return_index=True, return_counts=True)
        self.bits = max(16, int(len(self.gram) * 16).bit_length())
        self.present = np.zeros(1 << self.bits, bool)
        self.present[self.gram >> np.uint64(64 - self.bits)] = True

    def candidates(self, codes: np.ndarray, most: int | None = None) -> np.ndarray | None:
        """Rows (segment, first diagonal of the band) that pass the filter; None beyond ``most`` hits."""
        none = np.empty((0, 2), np.int64)
        own = hashes(codes, self.rules.q)
        if not self.items or not len(own):
            return none
        at = np.flatnonzero(self.present[own >> np.uint64(64 - self.bits)])
        slot = np.minimum(np.searchsorted(self.gram, own[at]), len(self.gram) - 1)
        hit = self.gram[slot] == own[at]
        at, slot = at[hit], slot[hit]
        if not len(at):
            return none
        n = self.count[slot]
        if most is not None and n.sum() > most:
            return None
        entry = np.repeat(self.first[slot], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        owner, place = self.owner[entry], self.place[entry]
        # Diagonals from zero on: the earliest start lies one passage before the text.
        diagonal = np.repeat(at, n) - place + self.rules.segment
        step = self.budget[owner] + 1
        band = diagonal // step
        # Band b holds the diagonals from (b - 1) * step on, so a diagonal lies in this and the next.
        key = np.concatenate([owner << 32 | band, owner << 32 | (band + 1)])
        key, count = _distinct_places(key, np.concatenate([place, place]))
        owner = key >> 32
        passed = count >= self.needed[owner]
        owner, band = owner[passed], (key & 0xFFFFFFFF)[passed]
        return np.stack([owner, (band - 1) * (self.budget[owner] + 1) - self.rules.segment], 1)

    def align(self, codes: np.ndarray, found: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(segment, edits, start, end) for candidates within their budget; places in ``codes``."""
        order = np.argsort(self.length[found[:, 0]], kind="stable")
        found = found[order]
        while len(found):
            longest = self.length[found[:, 0]]
            width = int(2 * (self.budget[found[:, 0]].max() + 1))
            n = max(1, min(len(found), CELLS // int(longest[-1] * width)))
            yield from self._align(codes, found[:n], width)
            found = found[n:]

    def _align(self, codes, found, width) -> Iterator[tuple[int, int, int, int]]:
        owner, first = found[:, 0], found[:, 1]
        own = 2 * (self.budget[owner] + 1)
        lengths = self.length[owner]
        rows = int(lengths.max())
        pattern = np.zeros((len(found), rows), np.int64)
        for row, segment in enumerate(owner):
            pattern[row, : lengths[row]] = self.codes[segment]
        # Text along the band: cell (i, c) compares passage place i with text place first + c + i.
        places = first[:, None] + np.arange(rows + width)
        inside = (places >= 0) & (places < len(codes))
        text = np.where(inside, codes[np.clip(places, 0, len(codes) - 1)].astype(np.int64), -1)
        column = np.arange(width)
        outside = column >= own[:, None]
        # Edits and starting diagonal in one number, so a minimum keeps both.
        best = np.where(outside, _FAR, 0) * _FAR + column
        result = np.full(len(found), _FAR * _FAR)
        end = np.zeros(len(found), np.int64)
        for i in range(rows):
            window = text[:, i : i + width]
            edit = np.where(window == pattern[:, i : i + 1], 0, _FAR)
            step = best + edit
            step[:, :-1] = np.minimum(step[:, :-1], best[:, 1:] + _FAR)  # A character is missing.
            step[outside] = _FAR * _FAR
            step = np.minimum.accumulate(step - column * _FAR, axis=1) + column * _FAR  # One too many.
            best = step
            done = lengths == i + 1
            if done.any():
                at = best[done].argmin(axis=1)
                result[done] = best[done, at]
                end[done] = first[done] + at + i + 1
        edits, start = result // _FAR, first + result % _FAR
        for row in np.flatnonzero(edits <= self.budget[owner]):
            stop = min(int(end[row]), len(codes))
            yield int(owner[row]), int(edits[row]), max(0, int(start[row])), stop

    def leaks(self, text: str | None) -> dict:
        """Per item the best occurrence: (edits, start, end, segments found)."""
        codes, origin = folded(text)
        best: dict = {}
        overlap = 2 * (self.rules.segment + self.rules.edits(self.rules.segment) + 1)
        todo = [
            (at, min(WINDOW, len(codes) - at)) for at in range(0, max(1, len(codes) - overlap), WINDOW)
        ]
        while todo:
            at, width = todo.pop()
            part = codes[at : at + width + overlap]
            found = self.candidates(part, SHARED if width > overlap else None)
            if found is None:
                half = width // 2
                todo += [(at, half), (at + half, width - half)]
                continue
            if not len(found):
                continue
            for segment, edits, start, end in self.align(part, found):
                if start >= end:
                    continue
                hit = (edits, int(origin[at + start]), int(origin[at + end - 1]) + 1)
                item = self.items[segment]
                best[item] = min(best.get(item, hit), hit)
        return best


def _distinct_places(keys: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the number of distinct places of each.

    A q-gram of the passage counts once per band, however often the text repeats it.
    """
    order = np.lexsort((place, keys))
    keys, place = keys[order], place[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (place[1:] != place[:-1])
    return np.unique(keys[new], return_counts=True)


def _blocks(benchmark: DataFrame, item: str, text: str, rules: Rules) -> Iterator[tuple[list, list]]:
    rows = benchmark.select(F.col(item).alias("item"), F.col(text).alias("text")).dropna()
    rows = rows.distinct()
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // rules.block_chars)
    for block in range(n):
        part = rows.where(F.pmod(F.xxhash64("item"), F.lit(n)) == block).collect()
        if part:
            yield [r["item"] for r in part], [r["text"] for r in part]


class _Block:
    """A block of passages on its way to the tasks; a worker builds its index once."""

    def __init__(self, passages: Broadcast, rules: Rules) -> None:
        self.passages, self.rules, self.name = passages, rules, uuid.uuid4().hex

    def index(self) -> Index:
        make = lambda: Index(*self.passages.value, self.rules)
        return latest("benchmark block", self.name, make)


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    rules: Rules = Rules(),
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per document and benchmark item it holds.

    Columns: the document's id, ``item_id``, ``edits``, ``start_char`` and ``end_char`` (exclusive, code
    points of the original text) of the occurrence with the fewest edits, the first of them if tied.
    Null texts and items without id or text find nothing; rows of ``docs`` that repeat give repeated
    rows; two benchmark rows with one id are passages of one item.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    item_type = benchmark.schema[item_col].dataType
    item_kind = item_type.simpleString()
    schema = f"`{id_col}` {kind}, item_id {item_kind}, edits int, start_char long, end_char long"
    sc = docs.sparkSession.sparkContext
    rows = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("_text"))
    found = docs.sparkSession.createDataFrame([], schema)
    for passages in _blocks(benchmark, item_col, item_text, rules):
        shipped = _Block(sc.broadcast(passages), rules)

        def scan(
            batches: Iterator[pa.RecordBatch], block: _Block = shipped
        ) -> Iterator[pa.RecordBatch]:
            index = block.index()
            for batch in batches:
                hits = [
                    (row, item, *hit)
                    for row, text in enumerate(batch.column(1))
                    for item, hit in sorted(index.leaks(text.as_py()).items())
                ]
                row, item, *places = zip(*hits, strict=True) if hits else [()] * 5
                kinds = (pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(row, pa.int64())),
                        pa.array(item, to_arrow_type(item_type)),
                        *map(pa.array, places, kinds),
                    ],
                    [id_col, "item_id", "edits", "start_char", "end_char"],
                )

        found = found.union(rows.mapInArrow(scan, schema))
    return found


def without_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    rules: Rules = Rules(),
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns.

    The decision is taken row by row in the scan, so it needs no id and no shuffle.
    """
    sc = docs.sparkSession.sparkContext
    for block in _blocks(benchmark, item_col, item_text, rules):
        docs = docs.where(_clean(_Block(sc.broadcast(block), rules))(F.col(text_col)))
    return docs


def _clean(block: _Block) -> Callable[[Column], Column]:
    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = block.index()
        for batch in batches:
            yield pd.Series([not index.leaks(text) for text in batch], dtype=bool)

    return clean
