"""Best-fit packing of token sequences, planned on the histogram of lengths.

Documents are turned into token ids and cut into pieces of at most ``capacity`` tokens. The plan is made
on how many pieces have each length, never on the pieces: lengths descend, and all pieces of a length
fill the sequences whose free room is tightest, in whole ranges of equal sequences at a time. The plan
is a list of slot ranges per length, whose size depends on the capacity only. Every piece then takes
the slot of its rank within its length.

Ranks come without gathering a length in one task: pieces are numbered within (length, writing task) and
shifted by the counts of earlier tasks, so a length that holds a third of all pieces is spread like any
other. Only lengths and row numbers are numbered; the rows with their token ids, made and stored once
before, meet their places in one join by row number.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.names import quoted
from tradewind.llm.worker import remembered, travels_with_tasks
from tradewind.session import materialize

travels_with_tasks(__name__)

END_ID = 2
CAPACITY = 1024
#: Bytes of ids per batch that a task hands on.
BATCH_BYTES = 16 << 20
#: White space from which on a text goes to the library: the fast engine's stack ends at about a million.
LONG_SPACE = 100_000
# Tried where a run begins only, so that a search takes one pass over the text.
_LONG_SPACE = re.compile(rf"(?<!\s)\s{{{LONG_SPACE}}}")


# --- token ids ------------------------------------------------------------------------------------


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of a byte-level BPE file, as the ``tokenizers`` library gives them.

    The merges run in the faster ``tiktoken`` engine on the same vocabulary; a text that holds one of
    the file's added tokens goes to ``tokenizers``, which treats those strings apart, and so does one with a
    very long run of white space.
    """

    def __init__(self, path: str) -> None:
        import public_tokenizers
        import tiktoken

        self.path, self._reference = path, None
        with open(path, encoding="utf-8") as file:
            layout = json.load(file)
        self.added = [token["content"] for token in layout.get("added_tokens") or []]
        byte_of = _byte_alphabet()
        ranks = {
            bytes(byte_of[c] for c in token): number
            for token, number in layout["model"]["vocab"].items()
            if token not in self.added
        }
        self.fast = tiktoken.Encoding(
            "file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    @property
    def reference(self):
        """The tokenizer of the library, loaded for the first text that needs it."""
        if self._reference is None:
            from tokenizers import Tokenizer

            self._reference = Tokenizer.from_file(self.path)
        return self._reference

    def __call__(self, text: str) -> list[int]:
        spaced = len(text) >= LONG_SPACE and _LONG_SPACE.search(text)
        if spaced or any(token in text for token in self.added):
            return self.reference.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def _byte_alphabet() -> dict[str, int]:
    """Byte of each character that byte-level vocabularies write bytes with.

    Printable Latin-1 bytes stand for themselves, the others for the code points from 256 on in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


def encoder(path: str) -> Encoder:
    """Loaded once per Python worker."""
    return remembered(("ids", path), lambda: Encoder(path))


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids; only the first may be shorter than the capacity."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def tokenize(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    capacity: int = CAPACITY,
) -> DataFrame:
    """``(key, piece, start, length, ids)`` per piece; ``ids`` are little-endian 32-bit numbers.

    Every document ends with ``END_ID``, so null and empty texts are one piece of one id.
    """
    path = path or default_path()
    kind = docs.schema[key].dataType.simpleString()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            rows, size = [], 0
            for row, text in enumerate(batch.column(1)):
                ids = np.array([*encode(text.as_py() or ""), END_ID], "<u4")
                for piece, (at, n) in enumerate(cuts(len(ids), capacity)):
                    rows.append((row, piece, at, n, ids[at : at + n].tobytes()))
                size += ids.nbytes
                if size >= BATCH_BYTES:
                    yield to_batch(batch.column(0), rows)
                    rows, size = [], 0
            if rows:
                yield to_batch(batch.column(0), rows)

    def to_batch(keys: pa.Array, rows: list) -> pa.RecordBatch:
        row, *columns = zip(*rows, strict=True)
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
        arrays = [keys.take(pa.array(row)), *map(pa.array, columns, kinds)]
        return pa.RecordBatch.from_arrays(arrays, [key, "piece", "start", "length", "ids"])

    schema = f"`{key}` {kind}, piece int, start long, length long, ids binary"
    return docs.select(F.col(key).alias(key), F.col(text).alias("_text")).mapInArrow(pieces, schema)


# --- the plan -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Slots:
    """Places for the pieces of a length with ranks from ``low`` to before ``high``.

    Rank r goes to sequence ``sequence + (r - low) // each``, behind ``offset`` ids and the
    ``(r - low) % each`` pieces of its length before it.
    """

    length: int
    low: int
    high: int
    each: int
    sequence: int
    offset: int


def plan(counts: dict[int, int], capacity: int) -> list[Slots]:
    """Best fit with descending lengths, over counts."""
    open_: dict[int, list[tuple[int, int]]] = {}  # Free room: ranges (first sequence, how many).
    slots, sequences = [], 0
    for length in sorted(counts, reverse=True):
        done, count = 0, counts[length]

        def place(room: int, first: int, many: int) -> int:
            """Fill as much of a range as there are pieces; the number of sequences used."""
            nonlocal done
            each = room // length
            full = min(many, (count - done) // each)
            left = count - done - full * each if full < many else 0
            taken = full * each + left
            slots.append(Slots(length, done, done + taken, each, first, capacity - room))
            if full:
                open_.setdefault(room - each * length, []).append((first, full))
            if left:
                open_.setdefault(room - left * length, []).append((first + full, 1))
            done += taken
            return full + (left > 0)

        for room in sorted(r for r in open_ if r >= length):
            ranges = open_.pop(room)
            while ranges and done < count:
                first, many = ranges.pop()
                used = place(room, first, many)
                if used < many:
                    ranges.append((first + used, many - used))
            if ranges:
                open_.setdefault(room, []).extend(ranges)
            if done == count:
                break
        if done < count:
            fresh = -(-(count - done) // (capacity // length))
            place(capacity, sequences, fresh)
            sequences += fresh
    return slots


def pack(pieces: DataFrame, capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, replacing columns of these names.

    ``length`` is from 1 to ``capacity`` in every row. Sequences are numbered from 0 and filled without
    gaps from offset 0. Pieces of equal length are interchangeable; which of them gets which slot
    follows the order in which they were written.
    """
    spark = pieces.sparkSession
    kept = pieces.drop("sequence_id", "offset")
    # The caller's columns ride in a struct, so their names clash with none of those below.
    rows = materialize(
        pieces.select(
            F.struct(*quoted(kept.columns)).alias("_row"),
            F.col(length).cast("long").alias("_length"),
            F.spark_partition_id().alias("_task"),
            F.monotonically_increasing_id().alias("_at"),
        ),
        "pieces",
    )
    stored = rows.drop("_row")
    per_task = stored.groupBy("_length", "_task").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("_length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    shift = per_task.withColumn("_shift", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    histogram = per_task.groupBy("_length").agg(F.sum("_n").alias("n")).collect()
    slots = plan({r["_length"]: r["n"] for r in histogram}, capacity)
    table = spark.createDataFrame(
        [(s.length, s.low, s.high, s.each, s.sequence, s.offset) for s in slots],
        "_length long, _low long, _high long, _each long, _sequence long, _offset long",
    )
    order = Window.partitionBy("_length", "_task").orderBy("_at")
    ranked = stored.withColumn("_rank", F.row_number().over(order) - 1)
    shifted = ranked.join(shift.drop("_n"), ["_length", "_task"]).withColumn(
        "_rank", F.col("_rank") + F.col("_shift")
    )
    # Bounded by the capacity, whatever the number of pieces.
    placed = shifted.join(F.broadcast(table), "_length").where("_rank >= _low AND _rank < _high")
    nth = F.col("_rank") - F.col("_low")
    places = placed.select(
        "_at",
        (F.col("_sequence") + F.floor(nth / F.col("_each"))).cast("long").alias("_in"),
        (F.col("_offset") + nth % F.col("_each") * F.col("_length")).cast("long").alias("_from"),
    )
    return rows.select("_at", "_row").join(places, "_at").select(
        "_row.*", F.col("_in").alias("sequence_id"), F.col("_from").alias("offset")
    )


def assemble(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids, n_ids)``: the token ids of every sequence, from pieces that kept theirs."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(ordered, F.lit(b""), lambda out, x: F.concat(out, x["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("n_ids"))
