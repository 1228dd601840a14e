"""Whole jobs: trips to delivery CSVs, and ingest -> check -> route -> store."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from waybatch.operators.batching import FILE_ORDER, check_batch_size
from waybatch.operators.prepare import check_row_params, prepare_deliveries
from waybatch.operators.quality import (
    has_repeated_ids, invalid_timestamps, observed_rules, quality_report, raise_on_failure, yield_check,
)
from waybatch.operators.routing import optimize_routes
from waybatch.operators.sequence import FILE_COL
from waybatch.schema import (
    DEFAULT_PIPELINE_BATCH_SIZE,
    DEFAULT_SAMPLE_ROWS,
    DELIVERY_COLUMNS,
    YIELD_RATIO,
)
from waybatch.session import delete_path, scratch_path
from waybatch.sinks.routes import append_routes, read_routes, write_delivery_csv, write_sample_csv
from waybatch.sources.files import load_deliveries, typed_deliveries


@dataclass
class PrepareResult:
    rows: int
    invalid_timestamps: int
    yield_warning: bool
    sample_written: bool


def prepare_job(
    trips: DataFrame,
    zones: DataFrame,
    output_path: str,
    sample_path: str | None = None,
    order_by="file_order",
    max_rows: int | None = None,
    sample_rows: int = DEFAULT_SAMPLE_ROWS,
    **kwargs,
) -> PrepareResult:
    """Trips -> deliveries -> full CSV folder (+ sample of the first rows).

    The prepared rows are written once; counts and the sample read the
    written folder, so the trip plan runs one time.
    """
    spark = trips.sparkSession
    check_row_params(max_rows, sample_rows if max_rows is not None else 0)
    prepared = prepare_deliveries(trips, zones, order_by=order_by, max_rows=max_rows, **kwargs)
    write_delivery_csv(prepared, output_path)
    written = typed_deliveries(spark.read.option("header", "true").schema(
        ", ".join(f"`{c}` string" for c in DELIVERY_COLUMNS)).csv(output_path))
    stats = invalid_timestamps(written).first()
    n_trips = trips.count()
    expected = n_trips if max_rows is None else min(n_trips, max_rows)
    warn = yield_check(written, expected, YIELD_RATIO).first()["warn"]
    sampled = write_sample_csv(written, sample_path, "delivery_id", sample_rows) if sample_path else False
    return PrepareResult(stats["n_rows"], stats["n_invalid"], bool(warn), sampled)


def stage_input(text: DataFrame, spark: SparkSession) -> tuple[DataFrame, str]:
    """Writes the checked text input once as Parquet in the shared folder:
    later passes (checks, sequence, routing) read columns, not CSV text,
    and a lost executor does not send the job back to the CSV."""
    path = scratch_path(spark, "staged-input")
    text.write.parquet(path)
    return spark.read.parquet(path), path


@dataclass
class RouteResult:
    stored: DataFrame
    rows_in: int
    rows_routed: int
    rows_appended: int


def route_job_metrics(
    spark: SparkSession,
    target_path: str,
    **kwargs,
) -> RouteResult:
    """:func:`route_job` with counters taken by ``Observation`` while the
    data flows (no extra job): rows read and rows routed."""
    obs_in, obs_out = Observation("waybatch_in"), Observation("waybatch_out")
    appended = []
    stored = route_job(spark, target_path, _observe=(obs_in, obs_out), _appended=appended, **kwargs)
    return RouteResult(stored, obs_in.get["rows"], obs_out.get["rows"], appended[0])


def route_job(
    spark: SparkSession,
    target_path: str,
    full_path: str | None = None,
    sample_path: str | None = None,
    source: str = "full",
    batch_size: int = DEFAULT_PIPELINE_BATCH_SIZE,
    mode: str = "nearest",
    strict: bool = True,
    stage: bool = True,
    dedupe: bool = False,
    batch_id: str | None = None,
    _observe=None,
    _appended=None,
) -> DataFrame:
    """Ingest -> quality check -> route -> append; returns the stored table.

    The only driver-side data are per-file reports and per-range counts. With
    a ``batch_id`` a job that ran already appends nothing (``append_routes``).

    A staged input is checked by the pass that writes it; only repeated ids
    need another read, of two columns. The report by file is made just where
    a check fails, to name the first error. The staged copy is deleted when
    the job ends, by an error too.
    """
    check_batch_size(batch_size)
    if full_path is None:
        raise ValueError("full_path is required")
    text = load_deliveries(spark, full_path, sample_path, source)
    if not stage:
        if strict:
            raise_on_failure(quality_report(text, source_col=FILE_COL))
        return _routed(spark, text, target_path, batch_size, mode, dedupe, batch_id, _observe, _appended)
    seen = Observation("waybatch_checks")
    text, staged = stage_input(observed_rules(text, seen) if strict else text, spark)
    try:
        if strict and (any(n for rule, n in seen.get.items() if rule != "rows") or has_repeated_ids(text, FILE_COL)):
            raise_on_failure(quality_report(text, source_col=FILE_COL))
        return _routed(spark, text, target_path, batch_size, mode, dedupe, batch_id, _observe, _appended)
    finally:
        delete_path(spark, staged)  # the routes are stored, or the job failed


def _routed(spark, text, target_path, batch_size, mode, dedupe, batch_id, observe, appended) -> DataFrame:
    """Routes checked input and appends it; the stored table."""
    typed = typed_deliveries(text)
    if observe:
        typed = typed.observe(observe[0], F.count(F.lit(1)).alias("rows"))
    routes = optimize_routes(typed, order_by=FILE_ORDER, batch_size=batch_size, mode=mode)
    if observe:
        routes = routes.observe(observe[1], F.count(F.lit(1)).alias("rows"))
    n = append_routes(spark, routes, target_path, dedupe=dedupe, batch_id=batch_id)
    if appended is not None:
        appended.append(n)
    return read_routes(spark, target_path)
