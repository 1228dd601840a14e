import pytest

from helpers import HEADER, THREE_ROWS, write_text
from waybatch.sources import files


def test_file_report_statuses(spark, tmp_dir):
    write_text(f"{tmp_dir}/raw/good.csv", THREE_ROWS)
    write_text(f"{tmp_dir}/raw/sub/deep.csv", THREE_ROWS)
    write_text(f"{tmp_dir}/raw/wrong.csv", "wrong_col1,wrong_col2\n1,2\n")
    write_text(f"{tmp_dir}/raw/header.csv", HEADER)
    write_text(f"{tmp_dir}/raw/blank.csv", "   \n\n")
    write_text(f"{tmp_dir}/raw/zero.csv", "")
    write_text(f"{tmp_dir}/raw/notes.txt", THREE_ROWS)
    write_text(f"{tmp_dir}/raw/latin.csv", HEADER + "4,40.7,-74.0,40.7,-74.0,café\n", encoding="latin-1")
    write_text(f"{tmp_dir}/raw/quoted.csv", '"' + '","'.join(HEADER.strip().split(",")) + '"\n' + THREE_ROWS.split("\n", 1)[1])
    rep = {r.file_name: (r.status, r.n_data_lines) for r in files.csv_file_report(spark, f"{tmp_dir}/raw").collect()}
    assert rep == {
        "good.csv": ("ok", 3),
        "deep.csv": ("ok", 3),
        "wrong.csv": ("missing_columns", 1),
        "header.csv": ("header_only", 0),
        "blank.csv": ("empty", 0),
        "latin.csv": ("non_utf8", 1),
        "quoted.csv": ("ok", 3),
    }


def test_no_valid_file_is_an_error(spark, tmp_dir):
    write_text(f"{tmp_dir}/raw/invalid.csv", "wrong_col1,wrong_col2\n1,2")
    with pytest.raises(files.IngestError, match="No valid CSV content"):
        files.read_delivery_csv(spark, f"{tmp_dir}/raw")


def test_columns_in_another_order_line_up(spark, tmp_dir):
    write_text(f"{tmp_dir}/raw/a.csv", THREE_ROWS)
    cols = HEADER.strip().split(",")[::-1]
    write_text(f"{tmp_dir}/raw/b.csv", ",".join(cols) + "\n2025-02-20 11:00:00,-74.1,40.8,-74.2,40.9,4\n")
    typed = files.typed_deliveries(files.read_delivery_csv(spark, f"{tmp_dir}/raw"))
    row = typed.filter("delivery_id = 4").first()
    assert (row.pickup_lat, row.pickup_lon, row.dropoff_lat, row.dropoff_lon) == (40.9, -74.2, 40.8, -74.1)
    assert typed.count() == 4


def test_source_choice(spark, tmp_dir):
    write_text(f"{tmp_dir}/raw/deliveries.csv", THREE_ROWS)
    # no sample: falls back to the full folder
    df = files.load_deliveries(spark, f"{tmp_dir}/raw", sample_path=f"{tmp_dir}/raw/sample_deliveries.csv", source="auto")
    assert df.count() == 3
    write_text(f"{tmp_dir}/raw/sample_deliveries.csv", HEADER + "9,40.7,-74.0,40.7,-74.0,2025-02-20 10:00:00\n")
    df = files.load_deliveries(spark, f"{tmp_dir}/raw", sample_path=f"{tmp_dir}/raw/sample_deliveries.csv", source="auto")
    assert [r.delivery_id for r in df.collect()] == ["9"]
    df = files.load_deliveries(spark, f"{tmp_dir}/raw", sample_path=f"{tmp_dir}/raw/sample_deliveries.csv", source="full")
    assert df.count() == 4
    with pytest.raises(files.IngestError, match="No CSV files found"):
        files.load_deliveries(spark, f"{tmp_dir}/nothing", sample_path=f"{tmp_dir}/nothing/s.csv")


def test_scan_trips_prunes_columns(spark, tmp_dir):
    spark.createDataFrame(
        [("2024-01-01 12:00:00", 1, 2, 9.5)], "tpep_pickup_datetime string, PULocationID int, DOLocationID int, fare double"
    ).write.parquet(f"{tmp_dir}/trips")
    df = files.scan_trips(spark, f"{tmp_dir}/trips")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "fare" not in plan.split("ReadSchema")[1].split("\n")[0]
    assert df.columns[:3] == ["tpep_pickup_datetime", "PULocationID", "DOLocationID"]


def test_bom_header(spark, tmp_dir):
    write_text(f"{tmp_dir}/raw/bom.csv", "﻿" + THREE_ROWS)
    rep = files.csv_file_report(spark, f"{tmp_dir}/raw").first()
    assert rep.status == "ok"
    typed = files.typed_deliveries(files.read_delivery_csv(spark, f"{tmp_dir}/raw"))
    assert sorted(r.delivery_id for r in typed.collect()) == [1, 2, 3]


def test_malformed_rows_are_reported_and_their_file_skipped(spark, tmp_dir):
    write_text(f"{tmp_dir}/more.csv", HEADER + "1,40.7,-74.0,40.7,-74.0,2025-01-01 00:00:00,x\n")
    write_text(f"{tmp_dir}/fewer.csv", HEADER + "2,40.7,-74.0\n")
    write_text(f"{tmp_dir}/quoted.csv", HEADER + '3,40.7,-74.0,40.7,-74.0,"2025-01-01, noon"\n')
    got = {r.file_name: r.status for r in files.csv_file_report(spark, tmp_dir).collect()}
    assert got == {"more.csv": "malformed", "fewer.csv": "ok", "quoted.csv": "ok"}
    assert sorted(r.delivery_id for r in files.read_delivery_csv(spark, tmp_dir).collect()) == ["2", "3"]
