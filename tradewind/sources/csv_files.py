"""CSV ingest with declared schemas and a defined row order.

Files whose values may hold line breaks are split like any text. Whether a line begins a record depends on
the quotes before it. So each split tells where its lines and its end stand if it begins outside of a quoted value,
and if it begins inside of one; put together over the splits of a file, this tells every line its record. Only
lines of records that span several are brought together.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping
from functools import reduce
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.columns import parse_money, parse_timestamp, parse_whole
from tradewind.schemas import NA_WORDS, POSITION, RAW, RULES
from tradewind.session import materialize, small_splits

# The helpers below travel with the tasks, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_OVERFLOW = "_overflow"


# The messages for missing, empty and unreadable files.
def _data_files(spark: SparkSession, path: str) -> list[str]:
    """Files with content under a file or folder, hidden ones left out."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(where):
        raise FileNotFoundError(f"missing dataset file: {path}")
    found, listing = [], files.listFiles(where, True)
    while listing.hasNext():
        status = listing.next()
        if status.getLen() and status.getPath().getName()[0] not in "._":
            found.append(status.getPath().toString())
    if not found:
        raise ValueError(f"dataset file is empty: {path}")
    return sorted(found)


def _first_lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """``(file, header)``: the first line of every file, read in tasks and decompressed by the file's extension.

    No task reads more than one split. All lines are read, but only the first ones of files leave the scan: a worker
    in Python that stops after a line would still be sent the others.
    """
    apart = small_splits(spark)
    apart.conf.set("spark.sql.files.openCostInBytes", str(1 << 50))
    first = (F.col("start") == 0) & (F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0)
    lines = apart.read.option("lineSep", "\n").text(files)
    lines = lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
    )
    return lines.where(first).select("file", F.rtrim("value", F.lit("\r")).alias("header"))


def _by_header(spark: SparkSession, path: str) -> list[list[str]]:
    """Files by their header.

    The driver receives the number of headers, and the headers themselves only if there are several.
    """
    files = _data_files(spark, path)
    if len(files) == 1:
        return [files]
    lines = materialize(_first_lines(spark, files), "headers")
    if lines.select("header").distinct().count() == 1:
        return [files]
    groups: dict[str, list[str]] = {}
    for file, header in sorted((unquote(r.file), r.header) for r in lines.collect()):
        groups.setdefault(header, []).append(file)
    return sorted(groups.values())


# A line that begins outside of quoted values and ends inside of one: fields that are closed, then one that is
# not. A quote inside of an unquoted value is text.
_LEFT_OPEN = r'^(?:(?:"(?:[^"]|"")*"(?:[^",][^,]*)?|[^",][^,]*|),)*"(?:[^"]|"")*$'


def _inside(outer: np.ndarray, inner: np.ndarray, begins: int) -> tuple[np.ndarray, int]:
    """Whether each line begins inside of a quoted value, and the last one ends inside of one.

    ``outer`` and ``inner`` tell how a line ends that begins outside and inside; most keep or switch what
    was before, others end the same way in any case.
    """
    switch = (outer > inner).astype(np.int64)
    switched = np.cumsum(switch)
    fixed = np.maximum.accumulate(np.where(outer == inner, np.arange(len(outer)), -1))
    fixed = np.append(-1, fixed[:-1])
    base = np.where(fixed >= 0, outer[fixed], begins)
    since = switched - switch - np.where(fixed >= 0, switched[fixed], 0)
    before = base ^ since & 1
    return before, int(inner[-1] if before[-1] else outer[-1])


def _lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """Lines with file, start of their split and row in it. ``left_open``: ends inside of a quoted value, if it
    begins outside. The others come twice, if the split begins outside and inside: ``begins``, the line
    begins outside; ``nth``, lines so far that do; ``ends``, the line ends inside."""

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Lines come in the order of their split, splits one after another.
        split, row, state, nth = None, 0, [0, 1], [0, 0]
        for batch in batches:
            names, starts, lines = batch.column("file"), batch.column("start").to_numpy(), batch.column("line")
            outer, inner = np.zeros(len(starts), np.int64), np.ones(len(starts), np.int64)
            quoted = np.flatnonzero(pc.count_substring(lines, '"').to_numpy())
            if len(quoted):
                some = lines.take(pa.array(quoted))
                outer[quoted] = pc.match_substring_regex(some, _LEFT_OPEN).to_numpy(zero_copy_only=False)
                some = pc.binary_join_element_wise('"', some, "")
                inner[quoted] = pc.match_substring_regex(some, _LEFT_OPEN).to_numpy(zero_copy_only=False)
            same = starts[1:] == starts[:-1]
            if len(same):
                same &= pc.equal(names.slice(1), names.slice(0, len(names) - 1)).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(~same) + 1).tolist(), len(starts)] if len(starts) else []
            for at, to in zip(cuts, cuts[1:]):
                here = (names[at].as_py(), int(starts[at]))
                if here != split:
                    split, row, state, nth = here, 0, [0, 1], [0, 0]
                counted = {"row": np.arange(row, row + to - at), "left_open": outer[at:to] == 1}
                for s in (0, 1):
                    before, state[s] = _inside(outer[at:to], inner[at:to], state[s])
                    counted[f"begins{s}"] = before == 0
                    counted[f"nth{s}"] = nth[s] + np.cumsum(before == 0)
                    counted[f"ends{s}"] = np.where(before == 1, inner[at:to], outer[at:to])
                    nth[s] = int(counted[f"nth{s}"][-1])
                row += to - at
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(at, to - at) for c in ("file", "start", "line")),
                     *(pa.array(c) for c in counted.values())],
                    names=["file", "start", "line", *counted],
                )

    text = spark.read.option("lineSep", "\n").text(files).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").alias("line"),
    )
    twice = ", ".join(f"begins{s} boolean, nth{s} long, ends{s} long" for s in (0, 1))
    layout = f"file string, start long, line string, row long, left_open boolean, {twice}"
    return text.mapInArrow(follow, layout)


def _splits(lines: DataFrame) -> DataFrame:
    """``(file, start, open, earlier, returned)``, one row per split: whether it begins inside of a quoted
    value, the records that began in earlier ones, and whether the file's lines end with a carriage return."""
    # Lines of a file end as its first one does; then a carriage return before a line feed is no text.
    returned = (F.col("start") == 0) & (F.col("row") == 0) & F.col("line").endswith("\r")
    ends = (F.max_by(f"ends{s}", "row").alias(f"ends{s}") for s in (0, 1))
    counts = (F.max(f"nth{s}").alias(f"nth{s}") for s in (0, 1))
    splits = materialize(
        lines.groupBy("file", "start").agg(*ends, *counts, F.max(returned).alias("returned")), "splits"
    )
    # As with lines: a split switches, keeps, or ends the same way in any case.
    order = Window.partitionBy("file").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    switches = F.when(F.col("ends0") > F.col("ends1"), 1).otherwise(0)
    splits = splits.withColumn("switched", F.sum(switches).over(order))
    fixed = F.when(F.col("ends0") == F.col("ends1"), F.struct("ends0", "switched"))
    splits = splits.withColumns(
        {"fixed": F.last(fixed, True).over(before), "before": F.coalesce(F.lag("switched").over(order), F.lit(0))}
    )
    base, since = F.coalesce("fixed.ends0", F.lit(0)), F.col("before") - F.coalesce("fixed.switched", F.lit(0))
    splits = splits.withColumn("open", (base + since) % 2 == 1)
    begun = F.when(F.col("open"), F.col("nth1")).otherwise(F.col("nth0"))
    return splits.select(
        "file",
        "start",
        "open",
        F.coalesce(F.sum(begun).over(before), F.lit(0)).alias("earlier"),
        F.max("returned").over(Window.partitionBy("file")).alias("returned"),
    )


def _records(spark: SparkSession, files: list[str]) -> DataFrame:
    """``(file, start, row, text)`` of every record after the header, which may span lines and splits.

    A quoted value that is never closed takes the rest of its file as one record.
    """
    lines = _lines(spark, files)
    known = lambda c: F.when(F.col("open"), F.col(f"{c}1")).otherwise(F.col(f"{c}0"))
    placed = lines.join(_splits(lines), ["file", "start"]).select(
        "file",
        "start",
        "row",
        F.when(F.col("returned"), F.regexp_replace("line", "\r$", "")).otherwise(F.col("line")).alias("line"),
        (known("begins") & ~F.col("left_open")).alias("whole"),
        (F.col("earlier") + known("nth")).alias("nth"),
    )
    spanning = (
        placed.where("not whole")
        .groupBy("file", "nth")
        .agg(F.array_sort(F.collect_list(F.struct("start", "row", "line"))).alias("lines"))
        .select(
            "file",
            F.col("lines")[0]["start"].alias("start"),
            F.col("lines")[0]["row"].alias("row"),
            F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("line"),
            "nth",
        )
    )
    records = placed.where("whole").select(*spanning.columns).union(spanning)
    return records.where("nth > 1 and line <> ''").select("file", "start", "row", F.col("line").alias("text"))


def read_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """All columns as text, named by the header, words for missing values as null.

    Every file's own header names its columns, so files may order them differently; files that name
    other columns stop the job. So do rows with more fields than their header, when they are read;
    rows with fewer are filled with nulls. The source position orders rows as they stand in the
    files: by file, by start of the split, then by running number inside the split.
    """
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": multiline}
    wide = F.raise_error(F.lit(f"failed to read csv {path}: a row has too many fields"))
    position = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )
    fits = F.when(F.col(_OVERFLOW).isNull(), F.lit(True)).otherwise(wide.cast("boolean"))

    def read(files: list[str]) -> DataFrame:
        try:
            header = spark.read.options(**options).csv(files[0]).columns
        except Exception as error:
            raise RuntimeError(f"failed to read csv {path}: {error}") from error
        layout = T.StructType([T.StructField(c, T.StringType()) for c in [*header, _OVERFLOW]])
        if multiline:
            parsed = F.from_csv("text", layout.toDDL(), {k: str(v).lower() for k, v in options.items()})
            at = F.struct("file", "start", "row").alias(POSITION)
            rows = _records(spark, files).select(parsed.alias("fields"), at).select("fields.*", POSITION)
        else:
            rows = spark.read.options(**options).schema(layout).csv(files).withColumn(POSITION, position)
        return rows.where(fits).select(
            *(F.when(~F.col(c).isin(*NA_WORDS), F.col(c)).alias(c) for c in header), POSITION
        )

    parts = [read(files) for files in _by_header(spark, path)]
    for part in parts[1:]:
        if set(part.columns) != set(parts[0].columns):
            raise RuntimeError(
                f"failed to read csv {path}: files name different columns, "
                f"{sorted(set(part.columns) ^ set(parts[0].columns))}"
            )
    return reduce(DataFrame.unionByName, parts)


def _typed(field: T.StructField) -> Column:
    text = F.col(field.name)
    if isinstance(field.dataType, T.TimestampNTZType):
        return parse_timestamp(text)
    if isinstance(field.dataType, T.IntegerType):
        return parse_whole(text)
    if isinstance(field.dataType, T.DecimalType):
        return parse_money(text)
    return text.try_cast(field.dataType)


def typed_table(rows: DataFrame, name: str) -> DataFrame:
    """Text rows of a known table cast to its declared types.

    Text that is no value of its type becomes null (``unreadable`` counts it); an amount too large for
    the money type stops the job, since it is a number that would be lost.
    """
    return rows.select(*(_typed(f).alias(f.name) for f in RAW[name]), POSITION)


def unreadable(rows: DataFrame, name: str) -> DataFrame:
    """(table_name, column_name, values): texts per column that their declared type cannot hold."""
    lost = [
        F.count(F.when(F.col(f.name).isNotNull() & _typed(f).isNull(), 1)).alias(f.name)
        for f in RAW[name]
    ]
    totals = rows.agg(*lost)
    pairs = F.array(
        *(
            F.struct(F.lit(f.name).alias("column_name"), F.col(f.name).alias("values"))
            for f in RAW[name]
        )
    )
    return totals.select(F.lit(name).alias("table_name"), F.explode(pairs).alias("c")).select(
        "table_name", "c.*"
    )


def extract_text(
    spark: SparkSession, folder: str, files: Mapping[str, str]
) -> dict[str, DataFrame]:
    """Tables as text, from one file or folder per table."""
    return {
        name: read_csv(spark, f"{folder}/{file}", name in RULES and RULES[name].multiline)
        for name, file in files.items()
    }


def extract_all(
    spark: SparkSession, folder: str, files: Mapping[str, str]
) -> dict[str, DataFrame]:
    """Bundle of raw tables from one file or folder per table."""
    text = extract_text(spark, folder, files)
    return {name: typed_table(rows, name) for name, rows in text.items()}
