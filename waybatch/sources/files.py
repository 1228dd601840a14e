"""File sources.

CSV files are checked per file with one text pass (header, line count,
UTF-8, blank), valid ones are read with every required column as text and
unioned by name, then typed. Files with line breaks in quotes are read by
record. Any Hadoop file system path works (local,
``hdfs://``, ``s3a://``); listing, retries and reads are Spark's.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybatch.functions.timefn import normalize_nulls, parse_timestamp
from waybatch.operators.lookup import polygon_vertices
from waybatch.operators.sequence import with_file_order
from waybatch.schema import DELIVERY_COLUMNS, DELIVERY_SCHEMA, TRIP_COLUMNS
from waybatch.session import checkpoint_root, path_exists
from waybatch.sources import csv_records


class IngestError(RuntimeError):
    """Raised when no usable input is found."""


def _as_list(paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def scan_trips(spark: SparkSession, paths, columns=TRIP_COLUMNS, file_order: bool = True) -> DataFrame:
    """Parquet trips, only the three needed columns (pruned at the scan).
    With ``file_order`` rows carry their file position for the sequence."""
    df = spark.read.parquet(*_as_list(paths))
    return with_file_order(df.select(*columns)) if file_order else df.select(*columns)


def read_zone_vertices(spark: SparkSession, paths) -> DataFrame:
    """Zone polygons as vertex rows ``(zone_id, ring, seq, x, y)``."""
    return spark.read.parquet(*_as_list(paths)).select(
        F.col("zone_id").cast("int"), F.col("ring").cast("int"), F.col("seq").cast("int"),
        F.col("x").cast("double"), F.col("y").cast("double"),
    )


def read_zone_polygons(spark: SparkSession, paths, id_col: str = "zone_id", wkt_col: str = "wkt") -> DataFrame:
    """Zone polygons stored as WKT text in Parquet, as vertex rows (``lookup.polygon_vertices``)."""
    return polygon_vertices(spark.read.parquet(*_as_list(paths)), id_col, wkt_col)


def _text_lines(spark: SparkSession, paths) -> DataFrame:
    return (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv")
        .text(_as_list(paths))
        .select(
            "value",
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_name").alias("file_name"),
            F.col("_metadata.file_block_start").alias("_wb_block"),
            F.monotonically_increasing_id().alias("_wb_row"),
        )
    )


def _pos_col(c: str) -> str:
    return f"pos_{c}"


def _names(line: Column) -> Column:
    """Column names of a header: cut at commas outside quotes, quotes removed."""
    cut = F.split(F.regexp_replace(line, "^\ufeff", ""), ',(?=(?:[^"]*+"[^"]*+")*+[^"]*+$)')
    return F.transform(cut, lambda n: F.regexp_replace(F.regexp_replace(n, '^"|"$', ""), '""', '"'))


def _per_file(rows: DataFrame, required, is_head, order) -> DataFrame:
    """Counts and header layout by file of ``rows`` (lines or records, as
    ``value``); the first row of those that ``is_head`` is the header."""
    names = _names(F.col("value"))

    def head(e):
        return F.min_by(F.when(is_head, e), F.when(is_head, order))

    return rows.groupBy("file_path", "file_name").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(F.trim(F.col("value")) != F.lit("")).alias("n_nonblank"),
        F.bool_and(F.is_valid_utf8("value")).alias("utf8"),
        F.max(F.size(F.split(F.regexp_replace(F.col("value"), csv_records.QUOTED, ""), ","))).alias("n_most"),
        F.count_if(csv_records.is_open(F.col("value"))).alias("n_open"),
        head(F.size(names)).alias("n_columns"),
        *[head(F.array_position(names, F.lit(c)).cast("int")).alias(_pos_col(c)) for c in required],
    )


def line_counts(spark: SparkSession, paths, required=DELIVERY_COLUMNS) -> DataFrame:
    """One row a file, from its lines. Every aggregate has a fixed-width buffer
    (counts, flags, and for the header only the position of each required
    column and the column count), so Spark hash-aggregates the lines in one
    pass without sorting them."""
    return _per_file(_text_lines(spark, paths), required, F.col("_wb_block") == F.lit(0), F.col("_wb_row"))


def _inspect(spark: SparkSession, paths, required) -> tuple[DataFrame, DataFrame | None]:
    """The report, and the records of files with line breaks in quotes if there are any."""
    checkpoint_root(spark)
    lines = line_counts(spark, paths, required).checkpoint()
    broken = [r["file_path"] for r in lines.filter("utf8 and n_open > 0").select("file_path").collect()]
    per_file = lines.withColumn("quoted_breaks", F.lit(False)).withColumn("unfinished", F.lit(False))
    records = None
    if broken:
        records, states = csv_records.read_records(spark, sorted(broken))
        name = F.element_at(F.split("file", "/"), -1).alias("file_name")
        rows = records.select(F.col("file").alias("file_path"), name, "idx", "value")
        unfinished = states.groupBy("file").agg(F.max_by("ends_inside", "block").alias("unfinished"))
        by_record = _per_file(rows, required, F.col("idx") == F.lit(-1), F.col("idx")).withColumn("quoted_breaks", F.lit(True))
        by_record = by_record.join(unfinished.withColumnRenamed("file", "file_path"), "file_path")
        kept = per_file.join(by_record.select("file_path"), "file_path", "left_anti")
        per_file = kept.unionByName(by_record).checkpoint()
    has_all = reduce(lambda a, b: a & b, [F.col(_pos_col(c)) > 0 for c in required])
    status = (
        F.when(~F.col("utf8"), F.lit("non_utf8"))
        .when(F.col("n_nonblank") == 0, F.lit("empty"))
        .when(F.col("unfinished"), F.lit("malformed"))
        .when(F.col("n_nonblank") <= 1, F.lit("header_only"))
        .when(~has_all, F.lit("missing_columns"))
        .when(F.col("n_most") > F.col("n_columns"), F.lit("malformed"))
        .otherwise(F.lit("ok"))
    )
    return per_file.select(
        "file_path", "file_name", "n_lines",
        F.greatest(F.col("n_nonblank") - F.lit(1), F.lit(0)).alias("n_data_lines"),
        "n_columns", *[_pos_col(c) for c in required], status.alias("status"), "quoted_breaks",
    ), records


def csv_file_report(spark: SparkSession, paths, required=DELIVERY_COLUMNS) -> DataFrame:
    """One row per ``*.csv`` file under ``paths`` (recursive).

    ``status``: ``ok``, ``non_utf8``, ``empty`` (blank), ``header_only``,
    ``missing_columns``, ``malformed`` (a row has more fields than the
    header; commas in quotes separate none; rows with fewer end in nulls; or
    the file ends inside quotes). Counts are of lines, and of records where
    quoted fields hold line breaks (``quoted_breaks``). Zero-byte files yield
    no lines and so no row; they are skipped all the same. The header is the
    first line of the file (smallest scan row of its first split), or its
    first record.

    Files are read once as lines; only those with a line that ends inside
    quotes are read again, by split (``csv_records``). What this returns is
    one row a file, computed already.
    """
    return _inspect(spark, paths, required)[0]


def read_delivery_csv(spark: SparkSession, paths, required=DELIVERY_COLUMNS, report: DataFrame | None = None) -> DataFrame:
    """Valid delivery CSV files as text columns plus file-order tags.

    Files are grouped by header layout (column count and the position of
    each required column); each group is read with a matching all-text
    schema, so files ordering their columns differently line up by name.
    Files whose quoted fields hold line breaks are read as records, by split.
    The report (one row per file) is the only thing collected.
    """
    records = None
    if report is None:
        report, records = _inspect(spark, paths, required)
    layout = ["quoted_breaks", "n_columns"] + [_pos_col(c) for c in required]
    ok = report.filter(F.col("status") == F.lit("ok")).select("file_path", *layout).collect()
    if not ok:
        raise IngestError(f"No valid CSV content found in {_as_list(paths)}")
    groups: dict[tuple, list[str]] = {}
    for r in ok:
        groups.setdefault(tuple(r[c] for c in layout), []).append(r["file_path"])
    frames = []
    for key, group_files in sorted(groups.items()):
        quoted_breaks, n_columns, positions = key[0], key[1], dict(zip(required, key[2:]))
        by_pos = {p: c for c, p in positions.items()}
        schema = T.StructType(
            [T.StructField(by_pos.get(i, f"_wb_other_{i}"), T.StringType(), True) for i in range(1, n_columns + 1)]
        )
        if quoted_breaks:
            if records is None:
                records = csv_records.read_records(spark, sorted(r["file_path"] for r in ok if r["quoted_breaks"]))[0]
            group = F.broadcast(spark.createDataFrame([(f,) for f in group_files], "file string"))
            own = records.filter(F.col("idx") >= 0).join(group, "file", "left_semi")
            df = own.select(F.from_csv("value", schema.simpleString()[len("struct<"):-1].replace(":", " "), {"escape": '"', "maxCharsPerColumn": "-1"}).alias("r"),
                            F.col("file").alias("_wb_file"), F.col("block").alias("_wb_block"), F.col("idx").alias("_wb_row"))
            frames.append(df.select(*(F.col(f"r.{c}").alias(c) for c in required), "_wb_file", "_wb_block", "_wb_row"))
            continue
        df = spark.read.schema(schema).option("header", "true").option("mode", "PERMISSIVE").option("escape", '"').csv(sorted(group_files))
        df = with_file_order(df)
        frames.append(df.select(*required, "_wb_file", "_wb_block", "_wb_row"))
    return reduce(lambda a, b: a.unionByName(b), frames)


def typed_deliveries(text_df: DataFrame) -> DataFrame:
    """Text delivery columns to the typed schema (other columns kept)."""
    casts = {
        "delivery_id": normalize_nulls("delivery_id").try_cast("long"),
        "timestamp": parse_timestamp(normalize_nulls("timestamp")),
    }
    for c in DELIVERY_COLUMNS:
        if c not in casts:
            casts[c] = normalize_nulls(c).try_cast("double")
    extra = [c for c in text_df.columns if c not in DELIVERY_COLUMNS]
    return text_df.select(*[casts[f.name].cast(f.dataType).alias(f.name) for f in DELIVERY_SCHEMA], *extra)


def choose_source(spark: SparkSession, sample_path: str | None, full_path: str, source: str = "full") -> str:
    """``full``: the full folder. Only on request ``auto`` (the sample if it
    exists, else the full folder) or ``sample``. What is missing is an error."""
    if source not in ("auto", "sample", "full"):
        raise ValueError("source must be 'auto', 'sample' or 'full'")
    if source in ("auto", "sample") and sample_path and path_exists(spark, sample_path):
        return sample_path
    if source == "sample":
        raise IngestError(f"No sample CSV at {sample_path}")
    if not path_exists(spark, full_path):
        raise IngestError(f"No CSV files found in {full_path}")
    return full_path


def load_deliveries(
    spark: SparkSession,
    full_path: str,
    sample_path: str | None = None,
    source: str = "full",
    required=DELIVERY_COLUMNS,
) -> DataFrame:
    """Load of delivery CSVs as text with file-order tags."""
    chosen = choose_source(spark, sample_path, full_path, source)
    return read_delivery_csv(spark, chosen, required)


