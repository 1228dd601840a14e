"""Data-quality checks of delivery inputs as a report DataFrame.

One aggregation pass per source computes every row-level rule, one more
pass finds repeated ids. ``observed_rules`` counts the row-level rules while
rows are on their way elsewhere, without a pass. ``raise_on_failure`` turns the report into the
first error in the order the studied validator checks its rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from waybatch.functions.timefn import normalize_nulls, parse_timestamp
from waybatch.schema import COORD_COLUMNS, DELIVERY_COLUMNS


class QualityError(ValueError):
    """Raised when a delivery input fails a quality rule."""


SOURCE = "source"
_INT_TEXT = r"^[+-]?[0-9]+$"


def _rules(col=F.col):
    """(rule, column, bad-row predicate) in the studied check order; ``col``
    gives the normalized text of a column."""
    out = []
    for c in COORD_COLUMNS:
        v = col(c)
        num = v.try_cast("double")
        out.append(("numeric", c, v.isNotNull() & num.isNull()))
        out.append(("not_null", c, v.isNull()))
        lo, hi = (-90.0, 90.0) if c.endswith("lat") else (-180.0, 180.0)
        rule = "lat_range" if c.endswith("lat") else "lon_range"
        out.append((rule, c, num.isNotNull() & ~num.between(F.lit(lo), F.lit(hi))))
    ident = col("delivery_id")
    out.append(("integer", "delivery_id", ident.isNull() | ~ident.rlike(_INT_TEXT)))
    out.append(("not_null", "delivery_id", ident.isNull()))
    ts = col("timestamp")
    out.append(("timestamp", "timestamp", ts.isNotNull() & parse_timestamp(ts).isNull()))
    return out


def _rule_names():
    names = []
    for c in COORD_COLUMNS:
        names += [f"numeric:{c}", f"not_null:{c}", f"{'lat' if c.endswith('lat') else 'lon'}_range:{c}"]
    return names + ["integer:delivery_id", "not_null:delivery_id", "timestamp:timestamp"]


RULE_ORDER = ["empty", "required_columns", "duplicate_id"] + _rule_names()

# The error texts of the studied validator, one per rule.
_MESSAGES = {
    "empty": "CSV data is empty or lacks a header",
    "required_columns": "CSV schema mismatch: expected {expected}",
    "duplicate_id": "Duplicate delivery_id values found",
    "numeric": "Column {column} must be numeric",
    "not_null": "Column {column} contains null values",
    "lat_range": "{column} out of valid latitude range (-90 to 90)",
    "lon_range": "{column} out of valid longitude range (-180 to 180)",
    "integer": "Column {column} must be integer",
    "timestamp": "Column {column} must be datetime, found invalid values",
}


def normalized_text(df: DataFrame) -> DataFrame:
    """Required columns as text, with pandas' missing-value tokens as null."""
    return df.select(
        *[c for c in df.columns if c not in DELIVERY_COLUMNS],
        *[normalize_nulls(F.col(c).cast("string")).alias(c) for c in DELIVERY_COLUMNS],
    )


def quality_report(df: DataFrame, source_col: str | None = None) -> DataFrame:
    """Report rows ``(source, rule, column, n_bad, passed)``.

    ``df`` holds the required columns as text (extra columns allowed);
    ``source_col`` names the file of each row (rules apply per file, as in
    the studied validator). Missing required columns give one
    ``required_columns`` row and no row rules (no job is run for them).
    """
    missing = [c for c in DELIVERY_COLUMNS if c not in df.columns]
    src = F.col(source_col).cast("string") if source_col else F.lit("input")
    if missing:
        spark = df.sparkSession
        return spark.createDataFrame(
            [("input", "required_columns", ",".join(missing), len(missing), False)],
            "source string, rule string, column string, n_bad long, passed boolean",
        )
    t = normalized_text(df).withColumn(SOURCE, src)
    rules = _rules()
    aggs = [F.count(F.lit(1)).alias("_n")] + [
        F.count_if(pred).alias(f"_r{i}") for i, (_r, _c, pred) in enumerate(rules)
    ]
    if source_col:
        per_source = t.groupBy(SOURCE).agg(*aggs)
    else:  # a global aggregate gives a row even for empty input
        per_source = t.agg(*aggs).withColumn(SOURCE, F.lit("input"))
    dup = (
        t.groupBy(SOURCE, "delivery_id")
        .agg(F.count(F.lit(1)).alias("_k"))
        .filter(F.col("_k") > 1)
        .groupBy(SOURCE)
        .agg(F.count(F.lit(1)).alias("_dup"))
    )
    # one row per source; a union and a small aggregate, no join
    cols = [c for c in per_source.columns if c != SOURCE]
    joined = per_source.unionByName(dup, allowMissingColumns=True).groupBy(SOURCE).agg(
        *[F.max(c).alias(c) for c in cols + ["_dup"]]
    )
    entries = [
        F.struct(F.lit("empty").alias("rule"), F.lit(None).cast("string").alias("column"),
                 (F.col("_n") == 0).cast("long").alias("n_bad")),
        F.struct(F.lit("required_columns").alias("rule"), F.lit(None).cast("string").alias("column"),
                 F.lit(0).cast("long").alias("n_bad")),
        F.struct(F.lit("duplicate_id").alias("rule"), F.lit("delivery_id").alias("column"),
                 F.coalesce(F.col("_dup"), F.lit(0)).cast("long").alias("n_bad")),
    ] + [
        F.struct(F.lit(r).alias("rule"), F.lit(c).alias("column"), F.col(f"_r{i}").cast("long").alias("n_bad"))
        for i, (r, c, _p) in enumerate(rules)
    ]
    report = joined.select(SOURCE, F.inline(F.array(*entries)))
    return report.withColumn("passed", F.col("n_bad") == 0)


def observed_rules(df: DataFrame, observation: Observation) -> DataFrame:
    """``df`` as it is. The action that runs over it fills ``observation`` with
    the count of ``rows`` and, as ``rule:column``, of the rows that break each
    row-level rule, over all sources."""
    text = F.struct(*[normalize_nulls(F.col(c).cast("string")).alias(c) for c in DELIVERY_COLUMNS])
    rules = _rules(lambda c: F.col("_wb_checked").getField(c))
    counts = [F.count_if(pred).alias(f"{r}:{c}") for r, c, pred in rules]
    return df.withColumn("_wb_checked", text).observe(observation, F.count(F.lit(1)).alias("rows"), *counts).drop("_wb_checked")


def has_repeated_ids(df: DataFrame, source_col: str) -> bool:
    """Whether any source has an id more than once; reads these two columns."""
    ids = normalized_text(df).select(source_col, "delivery_id")
    return not duplicate_ids(ids, source_col).isEmpty()


def raise_on_failure(report: DataFrame) -> None:
    """Raises :class:`QualityError` for the first failing rule, in the
    studied order (per source in name order). Only that row reaches the
    driver."""
    named = F.when(F.col("rule").isin("empty", "required_columns", "duplicate_id"), F.col("rule")).otherwise(
        F.concat_ws(":", "rule", "column"))
    rank = F.coalesce(F.array_position(F.array(*[F.lit(k) for k in RULE_ORDER]), named), F.lit(0))
    failed = report.filter(~F.col("passed")).select("*", F.when(rank == 0, len(RULE_ORDER) + 1).otherwise(rank).alias("rank"))
    first = failed.orderBy(F.coalesce("source", F.lit("")), "rank").limit(1).collect()
    if first:
        msg = _MESSAGES[first[0]["rule"]].format(column=first[0]["column"], expected=DELIVERY_COLUMNS)
        raise QualityError(f"{msg} ({first[0]['source']}: {first[0]['n_bad']} rows)")


def duplicate_ids(df: DataFrame, source_col: str | None = None, key: str = "delivery_id") -> DataFrame:
    """Ids seen more than once within one source (null equals null)."""
    src = F.col(source_col) if source_col else F.lit("input")
    return (
        df.withColumn(SOURCE, src)
        .groupBy(SOURCE, key)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def invalid_timestamps(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Rows and rows whose timestamp is missing or does not parse (counted,
    not dropped)."""
    parsed = parse_timestamp(normalize_nulls(F.col(column).cast("string")))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(parsed.isNull()).alias("n_invalid"),
    )


def yield_check(df: DataFrame, expected: int, ratio: float = 0.9) -> DataFrame:
    """Row count against ``ratio * expected``; ``warn`` when below."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(int(expected)).cast("long").alias("expected"),
        (F.col("n_rows") < F.lit(float(expected) * ratio)).alias("warn"),
    )
