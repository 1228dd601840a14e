import datetime as dt
import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from helpers import SF_TINY, THREE_ROWS, write_text
from waybatch.operators.prepare import check_row_params, prepare_deliveries
from waybatch.operators.quality import QualityError, observed_rules, quality_report
from waybatch.plans import fixtures, jobs
from waybatch.session import checkpoint_root


def test_csv_job_two_files(spark, tmp_dir):
    write_text(f"{tmp_dir}/raw/a.csv", THREE_ROWS.split("\n")[0] + "\n" + THREE_ROWS.split("\n")[1] + "\n")
    write_text(f"{tmp_dir}/raw/b.csv", THREE_ROWS.split("\n")[0] + "\n" + THREE_ROWS.split("\n")[2] + "\n")
    out = jobs.route_job(spark, f"{tmp_dir}/routes", full_path=f"{tmp_dir}/raw", batch_size=10, mode="input_order")
    assert [(r.route_key, r.delivery_id) for r in out.orderBy("route_key").collect()] == [(1, 1), (2, 2)]


def test_csv_job_rejects_bad_values(spark, tmp_dir):
    write_text(f"{tmp_dir}/raw/a.csv", THREE_ROWS.replace("40.7517", "invalid"))
    with pytest.raises(QualityError, match="must be numeric"):
        jobs.route_job(spark, f"{tmp_dir}/routes", full_path=f"{tmp_dir}/raw", batch_size=10)


def test_prepare_reference_example(spark, tmp_dir):
    trips = spark.createDataFrame(
        [(0, "2024-01-01 12:00:00", 1, 2), (1, "2024-01-01 13:00:00", 999, 2)],
        "k long, tpep_pickup_datetime string, PULocationID int, DOLocationID int",
    )
    zones = spark.createDataFrame([(1, 40.75, -73.98), (2, 40.76, -73.99)], "locationid int, lat double, lon double")
    out = prepare_deliveries(trips, zones, order_by="k", max_rows=2, sample_rows=1).orderBy("delivery_id").collect()
    assert [(r.delivery_id, r.pickup_lat, r.pickup_lon) for r in out] == [(1, 40.75, -73.98), (2, 40.75, -73.98)]
    assert out[0].timestamp == dt.datetime(2025, 1, 1, 12)
    res = jobs.prepare_job(trips, zones, f"{tmp_dir}/full", f"{tmp_dir}/sample", order_by="k", max_rows=2, sample_rows=1)
    assert res.rows == 2 and res.sample_written and res.invalid_timestamps == 0 and not res.yield_warning


def test_prepare_box_and_ids_have_gaps(spark):
    trips = spark.createDataFrame(
        [(0, "2024-02-29 08:00:00", 1, 1), (1, "bad", 3, 1), (2, None, 1, 1)],
        "k long, tpep_pickup_datetime string, PULocationID int, DOLocationID int",
    )
    zones = spark.createDataFrame([(1, 40.5, -74.3), (3, 40.49, -74.0)], "locationid int, lat double, lon double")
    out = prepare_deliveries(trips, zones, order_by="k").orderBy("delivery_id").collect()
    assert [r.delivery_id for r in out] == [1, 3]
    assert out[0].timestamp == dt.datetime(2025, 2, 28, 8) and out[1].timestamp is None


def test_row_params():
    with pytest.raises(ValueError, match="cannot exceed"):
        check_row_params(10, 20)


def test_route_job_metrics(spark, tmp_dir):
    write_text(f"{tmp_dir}/raw/a.csv", THREE_ROWS)
    res = jobs.route_job_metrics(spark, f"{tmp_dir}/routes", full_path=f"{tmp_dir}/raw", batch_size=2, mode="nearest")
    assert (res.rows_in, res.rows_routed, res.rows_appended) == (3, 3, 3)
    assert res.stored.count() == 3


def test_prepare_drop_invalid_option(spark):
    trips = spark.createDataFrame(
        [(0, "2024-05-01 08:00:00", 1, 1), (1, "bad", 1, 1)],
        "k long, tpep_pickup_datetime string, PULocationID int, DOLocationID int",
    )
    zones = spark.createDataFrame([(1, 40.7, -74.0)], "locationid int, lat double, lon double")
    assert prepare_deliveries(trips, zones, order_by="k").count() == 2
    assert [r.delivery_id for r in prepare_deliveries(trips, zones, order_by="k", drop_invalid=True).collect()] == [1]


def test_prepare_in_file_order(spark, tmp_dir):
    from waybatch.sources.files import scan_trips

    # two Parquet files; ids follow file name then row order, head cuts by it
    a = [("2024-01-01 10:00:00", 1, 1, 5.0), ("2024-01-01 11:00:00", 1, 1, 6.0)]
    b = [("2024-01-02 10:00:00", 1, 1, 7.0), ("2024-01-02 11:00:00", 1, 1, 8.0), ("2024-01-02 12:00:00", 1, 1, 9.0)]
    schema = "tpep_pickup_datetime string, PULocationID int, DOLocationID int, fare double"
    spark.createDataFrame(b, schema).coalesce(1).write.parquet(f"{tmp_dir}/t/part=1")
    spark.createDataFrame(a, schema).coalesce(1).write.parquet(f"{tmp_dir}/t/part=0")
    trips = scan_trips(spark, [f"{tmp_dir}/t/part=0", f"{tmp_dir}/t/part=1"])
    zones = spark.createDataFrame([(1, 40.7, -74.0)], "locationid int, lat double, lon double")
    out = prepare_deliveries(trips, zones, max_rows=4, sample_rows=1).orderBy("delivery_id").collect()
    assert [(r.delivery_id, r.timestamp.day, r.timestamp.hour) for r in out] == [(1, 1, 10), (2, 1, 11), (3, 2, 10), (4, 2, 11)]


def test_all_trips_unless_a_cap_is_asked_for(spark):
    trips = spark.range(1500).select(
        F.col("id").alias("k"), F.lit("2024-05-01 08:00:00").alias("tpep_pickup_datetime"), F.lit(1).alias("PULocationID"), F.lit(1).alias("DOLocationID"))
    zones = spark.createDataFrame([(1, 40.7, -74.0)], "locationid int, lat double, lon double")
    assert prepare_deliveries(trips, zones, order_by="k").count() == 1500
    assert prepare_deliveries(trips, zones, order_by="k", max_rows=100).count() == 100


def test_full_set_is_read_though_a_sample_lies_beside_it(spark, tmp_dir):
    write_text(f"{tmp_dir}/raw/a.csv", THREE_ROWS)
    write_text(f"{tmp_dir}/sample.csv", "\n".join(THREE_ROWS.split("\n")[:2]) + "\n")
    args = dict(full_path=f"{tmp_dir}/raw", sample_path=f"{tmp_dir}/sample.csv", batch_size=10)
    assert jobs.route_job(spark, f"{tmp_dir}/r1", **args).count() == 3
    assert jobs.route_job(spark, f"{tmp_dir}/r2", source="auto", **args).count() == 1


def _staged_copies(spark):
    root = checkpoint_root(spark)
    root = root[len("file:"):] if root.startswith("file:") else root
    return {os.path.join(at, d) for at, dirs, _ in os.walk(root) for d in dirs if d.startswith("staged-input-")}


def test_checks_run_in_the_pass_that_stages(spark, tmp_dir, monkeypatch):
    before = _staged_copies(spark)
    write_text(f"{tmp_dir}/raw/a.csv", THREE_ROWS)
    monkeypatch.setattr(jobs, "quality_report", lambda *a, **k: pytest.fail("no report where nothing is wrong"))
    assert jobs.route_job(spark, f"{tmp_dir}/routes", full_path=f"{tmp_dir}/raw", batch_size=10).count() == 3
    assert _staged_copies(spark) == before


@pytest.mark.parametrize("stage", [True, False])
def test_first_error_is_that_of_the_report(spark, tmp_dir, stage):
    before = _staged_copies(spark)
    lines = THREE_ROWS.strip().split("\n")
    write_text(f"{tmp_dir}/raw/b.csv", "\n".join([*lines, lines[1]]) + "\n")  # an id twice
    write_text(f"{tmp_dir}/raw/c.csv", THREE_ROWS.replace("40.7517", "140.7517"))
    args = dict(full_path=f"{tmp_dir}/raw", batch_size=10, stage=stage)
    with pytest.raises(QualityError, match=r"Duplicate delivery_id.*b\.csv"):
        jobs.route_job(spark, f"{tmp_dir}/routes", **args)
    write_text(f"{tmp_dir}/raw/b.csv", THREE_ROWS)  # one id in two files is none
    with pytest.raises(QualityError, match=r"latitude range.*c\.csv: 1 rows"):
        jobs.route_job(spark, f"{tmp_dir}/routes", **args)
    args["batch_size"] = 3  # a batch holds an id once; so each file is a batch
    assert jobs.route_job(spark, f"{tmp_dir}/lax", strict=False, **args).count() == 6
    assert _staged_copies(spark) == before


def test_observed_counts_are_those_of_the_report(spark, tmp_dir):
    raw = fixtures.raw_text(spark, SF_TINY)
    seen = Observation("counts")
    watched = observed_rules(raw, seen)
    watched.write.format("noop").mode("overwrite").save()
    want = {f"{r.rule}:{r.column}": r.n_bad for r in quality_report(raw).collect()
            if r.rule not in ("empty", "required_columns", "duplicate_id")}
    assert watched.columns == raw.columns and sum(want.values()) > 0
    assert seen.get == want | {"rows": raw.count()}
