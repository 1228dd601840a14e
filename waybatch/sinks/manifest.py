"""Appends that can be repeated: a commit manifest beside a folder table.

    table/batch=<id>/route_month=<yyyy-MM>/part-*   rows of one append
    table/_filters/batch=<id>/...                   Bloom blocks of its natural keys
    table/_commits/<version>.json                   one file an append, by rename

An append writes its folders first and then renames one small file into
``_commits``; readers see the batches that are named there, and nothing else. A
job that dies before the rename leaves the table as it was, and the same batch
id writes the same folder again. A batch id that is named already is not
appended a second time. The last surrogate key is in the manifest, so that the
next append needn't scan the table. One writer at a time.
"""

from __future__ import annotations

import json
import math
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybatch.session import path_exists

MONTH = "route_month"
_COMMIT = "version long, batch_id string, rows long, last_key long, n_blocks long"
#: Bits of a filter for each row; words of a block.
_BITS, _WORDS = 16, 4


class AppendConflict(RuntimeError):
    """Another append took the version that this one meant to commit."""


def _fs(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def create(spark: SparkSession, path: str) -> None:
    """An empty table, if there is nothing at ``path``."""
    if path_exists(spark, f"{path}/_commits"):
        return
    fs, hpath = _fs(spark, path)
    if fs.exists(hpath) and len(fs.listStatus(hpath)):
        raise ValueError(f"{path} holds files but no manifest; read it and append its rows to a new table")
    fs, hpath = _fs(spark, f"{path}/_commits")
    fs.mkdirs(hpath)


def commits(spark: SparkSession, path: str) -> list[Row]:
    """The appends of a table in order, one row each."""
    if not path_exists(spark, f"{path}/_commits"):
        return []
    return spark.read.schema(_COMMIT).json(f"{path}/_commits").orderBy("version").collect()


def check_batch_id(batch_id: str) -> None:
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]{0,127}", batch_id):
        raise ValueError("a batch id has 1 to 128 letters, digits, '.', '_' or '-', the first a letter or digit")


def commit(spark: SparkSession, path: str, done: Sequence[Row], batch_id: str, rows: int, last_key: int, n_blocks: int) -> None:
    """Makes a written batch visible by one rename."""
    version = (done[-1]["version"] if done else 0) + 1
    entry = {"version": version, "batch_id": batch_id, "rows": rows, "last_key": last_key, "n_blocks": n_blocks}
    fs, target = _fs(spark, f"{path}/_commits/{version:020d}.json")
    _, draft = _fs(spark, f"{path}/_commits/.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(entry).encode()))
    out.close()
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise AppendConflict(f"version {version} of {path} was committed by another append")


def _folders(path: str, done: Sequence[Row], kind: str = "") -> list[str]:
    return [f"{path}{kind}/batch={c['batch_id']}" for c in done if c["rows"]]


def read(spark: SparkSession, path: str, schema: T.StructType, done: Sequence[Row] | None = None) -> DataFrame:
    """Rows of all committed batches, with ``route_month`` to prune by."""
    done = commits(spark, path) if done is None else done
    full = T.StructType([*schema, T.StructField("batch", T.StringType()), T.StructField(MONTH, T.StringType())])
    folders = _folders(path, done)
    if not folders:
        return spark.createDataFrame([], full).drop("batch")
    return spark.read.schema(full).option("basePath", path).parquet(*folders).drop("batch")


def _address(keys: Sequence[str], n_blocks: Column) -> list[Column]:
    """Block of a key, and for each word of the block a mask of two bits."""
    h = F.xxhash64(F.lit("bits"), *keys)
    one = F.lit(1).cast("long")
    bit = [F.call_function("shiftleft", one, F.pmod(F.shiftrightunsigned(h, 6 * i), F.lit(64)).cast("int")) for i in range(2 * _WORDS)]
    return [F.pmod(F.xxhash64(*keys), n_blocks).alias("block"), *(bit[2 * w].bitwiseOR(bit[2 * w + 1]).alias(f"m{w}") for w in range(_WORDS))]


def write_filters(spark: SparkSession, path: str, batch_id: str, written: DataFrame, keys: Sequence[str], rows: int) -> int:
    """Bloom blocks of the natural keys of a written batch, by month; the number
    of blocks a month. Blocks are put together map-side."""
    months = max(1, written.select(MONTH).distinct().count())
    n_blocks = 1 << max(0, math.ceil(math.log2(max(1, rows) * _BITS / (64 * _WORDS) / months)))
    address = written.select(MONTH, *_address(keys, F.lit(n_blocks)))
    blocks = address.groupBy(MONTH, "block").agg(*(F.bit_or(f"m{w}").alias(f"w{w}") for w in range(_WORDS)))
    blocks.withColumn("n_blocks", F.lit(n_blocks).cast("long")).write.mode("overwrite").parquet(f"{path}/_filters/batch={batch_id}")
    return n_blocks


def possible_repeats(spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], done: Sequence[Row]) -> DataFrame:
    """``(month, keys)`` of those ``rows`` whose natural key some filter of their
    month doesn't rule out. Filters are read for the months of ``rows`` only."""
    folders = _folders(path, done, "/_filters")
    months = [r[0] for r in rows.select(MONTH).distinct().collect()]  # as many as the calendar has
    fields = ", ".join(f"w{w} long" for w in range(_WORDS))
    blocks = spark.read.schema(f"{MONTH} string, block long, {fields}, n_blocks long").parquet(*folders).filter(F.col(MONTH).isin(months))
    sizes = sorted({c["n_blocks"] for c in done if c["rows"]})  # powers of two
    probe = rows.select(MONTH, *keys).withColumn("n_blocks", F.explode(F.array(*(F.lit(n).cast("long") for n in sizes))))
    probe = probe.select("*", *_address(keys, F.col("n_blocks")))
    fits = F.lit(True)
    for w in range(_WORDS):
        fits = fits & (F.col(f"w{w}").bitwiseAND(F.col(f"m{w}")) == F.col(f"m{w}"))
    return probe.join(blocks, [MONTH, "n_blocks", "block"]).filter(fits).select(MONTH, *keys).distinct()
