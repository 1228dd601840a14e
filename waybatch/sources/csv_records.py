"""Records of CSV files whose quoted fields hold line breaks, split by split.

Whether a line break ends a record depends on all quotes before it, so a split
can't be cut without knowing how the splits before it end. Reading such a file
whole (``multiLine``) makes it one task. Here each split is first read under
both starting states, outside and inside quotes, which gives two end states a
split; these are combined per file, and then each split is cut into records from
the state that it really starts in. A record that goes on in later splits is put
together from its pieces; everything else stays where it was read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waybatch.session import checkpoint_root, ship_package

#: A field, and a line whose fields are all complete.
_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+)?+'
COMPLETE = f"^{_FIELD}(?:,{_FIELD})*+$"
#: Quoted parts; what is left has one comma between any two fields.
QUOTED = r'"[^"]*+(?:""[^"]*+)*+"'
_BOM = "﻿"
_FLUSH_ROWS, _FLUSH_CHARS = 5_000, 1 << 20


def is_open(line: Column) -> Column:
    """Whether a line that starts a record ends inside quotes."""
    return F.contains(line, F.lit('"')) & ~F.regexp_replace(line, f"^{_BOM}", "").rlike(COMPLETE)


def leaves_open(line: str, inside: bool) -> bool:
    """Whether the line ends inside quotes. ``inside``: it starts there, else at
    the start of a record. A quote opens a field only as its first character;
    two quotes in a quoted field are one that belongs to it."""
    at, n = 0, len(line)
    if not inside:
        if not line.startswith('"'):
            at = line.find(',"') + 1
            if not at:
                return False
        at += 1
    while True:  # at: inside quotes
        end = line.find('"', at)
        if end < 0:
            return True
        if end + 1 < n and line[end + 1] == '"':
            at = end + 2
            continue
        at = line.find(',"', end + 1) + 2
        if at == 1:
            return False


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bool, str]]:
    """``(file, block, first line of its split, line)``, in scan order."""
    now = None
    for b in batches:
        for file, block, line in zip(b.column("file").to_pylist(), b.column("block").to_pylist(), b.column("value").to_pylist(), strict=True):
            first = (file, block) != now
            now = (file, block)
            yield file, block, first, line.removeprefix(_BOM) if first and block == 0 else line


_ENDS = "file string, block long, outside boolean, inside boolean, closed boolean"


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a split: whether it ends inside quotes if it starts outside and
    if it starts inside, and whether a line ends outside if it starts inside."""
    found: list[list] = []
    for file, block, first, line in _lines(batches):
        if first:
            found.append([file, block, False, True, False])
        split = found[-1]
        if '"' in line:
            split[2], split[3] = leaves_open(line, split[2]), leaves_open(line, split[3])
        split[4] |= not split[3]
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found, strict=True)], ["file", "block", "outside", "inside", "closed"])


def split_states(lines: DataFrame) -> DataFrame:
    """``(file, block, starts_inside, opener, ends_inside)`` of each split of
    ``lines (file, block, value)``: whether it starts inside quotes, the split
    in which the record began that it starts with, and how it ends. Windows
    over slim rows, one a split."""
    ends = lines.mapInArrow(_ends, _ENDS)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    fixed = F.col("outside") == F.col("inside")  # the end doesn't depend on the start
    swaps = F.col("outside") & ~F.col("inside")  # the end is the other state
    n = ends.withColumn("swapped", F.sum(swaps.cast("int")).over(upto) % 2)
    n = n.withColumn("from_fixed", F.when(fixed, (F.col("outside").cast("int") + F.col("swapped")) % 2))
    after = (F.coalesce(F.last("from_fixed", True).over(upto), F.lit(0)) + F.col("swapped")) % 2 == 1
    n = n.withColumn("ends_inside", after)
    n = n.withColumn("starts_inside", F.coalesce(F.lag("ends_inside").over(Window.partitionBy("file").orderBy("block")), F.lit(False)))
    begins = F.col("ends_inside") & (~F.col("starts_inside") | F.col("closed"))
    n = n.withColumn("begins", F.when(begins, F.col("block")))
    return n.select("file", "block", "starts_inside", F.last("begins", True).over(before).alias("opener"), "ends_inside")


_PIECE = "file string, block long, idx long, kind int, value string"
_WHOLE, _GOES_ON, _BEGINS = 0, 1, 2


def _cut(inside):
    """Pieces of each split: whole records and the one that it ends in, numbered
    in order (the header record -1), and what belongs to a record begun in an
    earlier split."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = inside.value
        out: list[tuple] = []
        size = 0

        def give() -> pa.RecordBatch:
            nonlocal size
            cols = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()), strict=True)]
            out.clear()
            size = 0
            return pa.RecordBatch.from_arrays(cols, ["file", "block", "idx", "kind", "value"])

        def add(kind: int) -> None:
            nonlocal idx, header, size
            value = "\n".join(held)
            held.clear()
            if kind == _GOES_ON:
                out.append((*now, None, kind, value))
            elif value.strip():
                out.append((*now, -1 if header else idx, kind, value))
                idx, header = idx + (not header), False
            size += len(value)

        def end_split() -> None:
            if held:
                add(_GOES_ON if goes_on else _BEGINS)

        now, held, open_, goes_on, header, idx = None, [], False, False, False, 0
        for file, block, first, line in _lines(batches):
            if first:
                end_split()
                now, idx, header = (file, block), 0, block == 0
                open_ = goes_on = now in starts
            held.append(line)
            if '"' in line:
                open_ = leaves_open(line, open_)
            if not open_:
                add(_GOES_ON if goes_on else _WHOLE)
                goes_on = False
            if len(out) >= _FLUSH_ROWS or size >= _FLUSH_CHARS:
                yield give()
        end_split()
        if out:
            yield give()
    return run


def read_records(spark: SparkSession, files: list[str]) -> tuple[DataFrame, DataFrame]:
    """``(file, block, idx, value)``: the records of CSV files, one text each,
    and the states of their splits.

    ``block`` is the start of the split in which a record begins and ``idx`` its
    place there, from 0 without gaps; the file's first record, its header, has
    -1. Line breaks inside quotes become ``\\n``, blank lines between records
    are left out. A file that ends inside quotes ends with a record that is
    not complete (``ends_inside`` of its last split). A record is one row,
    whatever number of splits it covers. The splits that start inside quotes
    are sent to all tasks: file and offset, as Spark's own listing has them.
    """
    ship_package(spark)
    checkpoint_root(spark)
    lines = spark.read.text(files).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    states = split_states(lines).checkpoint()
    inside = {(r["file"], r["block"]) for r in states.filter("starts_inside").select("file", "block").collect()}
    pieces = lines.mapInArrow(_cut(spark.sparkContext.broadcast(inside)), _PIECE).checkpoint()
    openers = states.select("file", "block", "opener")
    parts = pieces.filter(F.col("kind") != _WHOLE).join(openers, ["file", "block"])
    parts = parts.withColumn("opener", F.when(F.col("kind") == _BEGINS, F.col("block")).otherwise(F.col("opener")))
    long_ = parts.groupBy("file", "opener").agg(
        F.array_sort(F.collect_list(F.struct("block", "value"))).alias("p"), F.max("idx").alias("idx"))
    joined = long_.select("file", F.col("opener").alias("block"), "idx", F.array_join("p.value", "\n").alias("value"))
    return pieces.filter(F.col("kind") == _WHOLE).select("file", "block", "idx", "value").union(joined), states
