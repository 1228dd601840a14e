import pytest

from helpers import HEADER, THREE_ROWS, write_text
from waybatch.operators.quality import QualityError, quality_report, raise_on_failure
from waybatch.schema import DELIVERY_COLUMNS


def _text(spark, rows, cols=DELIVERY_COLUMNS):
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in cols))


def _bad(report):
    return {(r.rule, r.column): r.n_bad for r in report.collect() if not r.passed}


def test_clean_input_passes(spark):
    df = _text(spark, [("1", "40.7", "-74.0", "40.71", "-74.01", "2025-02-20 10:00:00")])
    rep = quality_report(df)
    assert _bad(rep) == {}
    raise_on_failure(rep)


def test_rules_and_edges(spark):
    rows = [
        ("1", "invalid", "-74.0", "40.7", "-74.0", "2025-02-20 10:00:00"),   # not numeric
        ("2", None, "-74.0", "40.7", "-74.0", "2025-02-20 10:00:00"),        # null
        ("3", "91", "-74.0", "40.7", "-74.0", "2025-02-20 10:00:00"),        # lat out of range
        ("4", "90", "180", "-90", "-180", "2025-02-29 10:00:00"),            # edges ok, bad date
        ("5", "40.7", "181", "40.7", "-74.0", None),                          # lon out, null ts ok
        ("1.0", "40.7", "-74.0", "40.7", "-74.0", "2025-02-20 10:00:00"),    # id not integer
        ("NA", "40.7", "-74.0", "40.7", "-74.0", "2025-02-20 10:00:00"),     # id null token
        ("5", "40.7", "-74.0", "40.7", "-74.0", "2025-02-20 10:00:00"),      # repeated id
    ]
    bad = _bad(quality_report(_text(spark, rows)))
    assert bad == {
        ("numeric", "pickup_lat"): 1,
        ("not_null", "pickup_lat"): 1,
        ("lat_range", "pickup_lat"): 1,
        ("lon_range", "pickup_lon"): 1,
        ("integer", "delivery_id"): 2,
        ("not_null", "delivery_id"): 1,
        ("timestamp", "timestamp"): 1,
        ("duplicate_id", "delivery_id"): 1,
    }


def test_first_failure_order(spark):
    rows = [("1", "invalid", "-74.0", "40.7", "-74.0", "x"), ("1", "40", "-74.0", "40.7", "-74.0", "x")]
    with pytest.raises(QualityError, match="Duplicate delivery_id"):
        raise_on_failure(quality_report(_text(spark, rows)))
    rows = [("1", "invalid", "-74.0", "40.7", "-74.0", "2025-02-20 10:00:00")]
    with pytest.raises(QualityError, match="must be numeric"):
        raise_on_failure(quality_report(_text(spark, rows)))


def test_schema_mismatch(spark):
    df = _text(spark, [("1", "40.7", "-74.0", "2025-02-20")], ["id", "lat", "lon", "time"])
    with pytest.raises(QualityError, match="schema mismatch"):
        raise_on_failure(quality_report(df))


def test_empty_input(spark):
    with pytest.raises(QualityError, match="empty or lacks a header"):
        raise_on_failure(quality_report(_text(spark, [])))
    assert _bad(quality_report(_text(spark, []))) == {("empty", None): 1}


def test_duplicates_are_per_file(spark, tmp_dir):
    from waybatch.sources.files import read_delivery_csv

    write_text(f"{tmp_dir}/a.csv", THREE_ROWS)
    write_text(f"{tmp_dir}/b.csv", THREE_ROWS)
    df = read_delivery_csv(spark, tmp_dir)
    assert _bad(quality_report(df, source_col="_wb_file")) == {}
    write_text(f"{tmp_dir}/c.csv", HEADER + "7,40.7,-74.0,40.7,-74.0,\n7,40.7,-74.0,40.7,-74.0,\n")
    bad = _bad(quality_report(read_delivery_csv(spark, tmp_dir), source_col="_wb_file"))
    assert bad == {("duplicate_id", "delivery_id"): 1}
