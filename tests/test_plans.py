"""Physical plan properties the library relies on at scale."""

import pytest

from helpers import SF_TINY, THREE_ROWS, write_text
import __spark_entry__ as entry
from waybatch.sources import files


def _plan(df) -> str:
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def _exchanges(text: str) -> int:
    return text.count("Exchange hashpartitioning") + text.count("Exchange rangepartitioning")


@pytest.mark.parametrize("key", ["route_input_order", "route_nearest", "optimize_routes", "nearest_dropoff", "nearest_dropoff_grid"])
def test_routing_uses_one_exchange(spark, key):
    # dense ids: the sequence is a projection; batch_id is the only shuffle
    assert _exchanges(_plan(entry.queries()[key](spark, SF_TINY))) == 1


def test_dense_batches_do_not_shuffle(spark):
    assert _exchanges(_plan(entry.queries()["batch_assign"](spark, SF_TINY))) == 0


def test_file_report_hash_aggregates(spark, tmp_dir):
    write_text(f"{tmp_dir}/raw/a.csv", THREE_ROWS)
    text = _plan(files.line_counts(spark, f"{tmp_dir}/raw"))
    assert "SortAggregate" not in text and "HashAggregate" in text


def test_trip_scan_prunes_and_pushes(spark):
    text = _plan(entry.queries()["trips_scan"](spark, SF_TINY))
    assert "ReadSchema: struct<trip_id:bigint,tpep_pickup_datetime:timestamp_ntz,pulocationid:int,dolocationid:int>" in text  # no fare
    assert "PushedFilters: [IsNotNull(o_custkey)]" in _plan(entry.queries()["shift_year"](spark, SF_TINY))


@pytest.mark.parametrize("key", ["zone_centroid", "quality_report", "prepare_deliveries", "unknown_zones", "delivery_edges"])
def test_no_nested_loop_or_cartesian(spark, key):
    text = _plan(entry.queries()[key](spark, SF_TINY))
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text
