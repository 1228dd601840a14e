"""CSV records with line breaks in quotes, over splits of any size."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from helpers import HEADER, THREE_ROWS, write_text
from waybatch.operators.sequence import with_file_order_sequence
from waybatch.sources import csv_records, files

COLUMNS = [*HEADER.strip().split(","), "note"]


@pytest.fixture
def split_bytes(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")

    def set_to(n):
        spark.conf.set(keys[0], str(n))
        spark.conf.set(keys[1], "1")
    yield set_to
    for k in keys:
        spark.conf.unset(k)


def written(rows, terminator="\r\n"):
    out = io.StringIO()
    w = csv.writer(out, lineterminator=terminator)
    w.writerow(COLUMNS)
    w.writerows(rows)
    return out.getvalue()


def rows_of(seed, n):
    rng = random.Random(seed)
    bits = ["a", '"', "\n", ",", "\n\n", ' "', "é", '"",', "x" * 30]
    return [[str(i), "40.7", "-74.0", "40.8", "-73.9", "2025-01-01 00:00:00", "".join(rng.choice(bits) for _ in range(rng.randint(0, 9))).strip(" ") or "-"] for i in range(n)]


def test_leaves_open_equals_the_pattern(spark):
    rng = random.Random(1)
    lines = ["".join(rng.choice('a",') for _ in range(rng.randint(0, 9))) for _ in range(400)]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = [r[0] for r in df.select(csv_records.is_open(F.col("line"))).collect()]
    assert got == [csv_records.leaves_open(x, False) for x in lines]
    assert [csv_records.leaves_open(x, True) for x in ('a', 'a"', 'a"",', 'a","b', 'a",b"', 'a","b"')] == [True, False, True, True, False, False]


@pytest.mark.parametrize("size", [40, 1000])
def test_records_equal_a_csv_reader(spark, tmp_dir, split_bytes, size):
    files_ = {f"{k}.csv": rows_of(k, 25) for k in range(3)}
    for name, rows in files_.items():
        write_text(f"{tmp_dir}/raw/{name}", written(rows, "\n"))
    write_text(f"{tmp_dir}/raw/plain.csv", THREE_ROWS.replace("timestamp\n", "timestamp,note\n").replace(":00\n", ":00,n\n"))
    split_bytes(size)
    report = {r.file_name: (r.status, r.n_data_lines, r.quoted_breaks) for r in files.csv_file_report(spark, f"{tmp_dir}/raw", COLUMNS).collect()}
    assert report == {**{k: ("ok", 25, True) for k in files_}, "plain.csv": ("ok", 3, False)}
    df = with_file_order_sequence(files.read_delivery_csv(spark, f"{tmp_dir}/raw", COLUMNS))
    got = [[r[c] for c in COLUMNS] for r in df.orderBy("seq").collect()]
    assert [r[:1] + r[6:] for r in got[:75]] == [r[:1] + r[6:] for k in range(3) for r in files_[f"{k}.csv"]]
    assert [r.seq for r in df.select("seq").orderBy("seq").collect()] == list(range(1, 79))


def test_one_field_over_many_splits(spark, tmp_dir, split_bytes):
    long_ = "\n".join(f"line {i}, " + '"quoted" ' * (i % 3) for i in range(300)).rstrip()
    rows = [["1", *["0"] * 5, "before"], ["2", *["0"] * 5, long_], ["3", *["0"] * 5, "after\nit"]]
    write_text(f"{tmp_dir}/raw/long.csv", written(rows))
    split_bytes(300)
    df = files.read_delivery_csv(spark, f"{tmp_dir}/raw", COLUMNS)
    assert sorted((r.delivery_id, r.note) for r in df.collect()) == [("1", "before"), ("2", long_), ("3", "after\nit")]
    _, states = csv_records.read_records(spark, [f"{tmp_dir}/raw/long.csv"])
    assert states.filter("starts_inside").count() > 10


def test_a_file_that_ends_in_quotes_is_malformed(spark, tmp_dir):
    write_text(f"{tmp_dir}/raw/open.csv", THREE_ROWS + '4,"40.7\n5,1,2,3,4,5\n')
    write_text(f"{tmp_dir}/raw/more.csv", HEADER + '1,2,3,4,5,"a\nb",7\n')
    write_text(f"{tmp_dir}/raw/bom.csv", '﻿"delivery_id"' + HEADER[len("delivery_id"):] + '7,2,3,4,5,"a\nb"\n')
    write_text(f"{tmp_dir}/raw/head.csv", HEADER.strip() + ',"no\nte"\n')
    report = {r.file_name: r.status for r in files.csv_file_report(spark, f"{tmp_dir}/raw").collect()}
    assert report == {"open.csv": "malformed", "more.csv": "malformed", "bom.csv": "ok", "head.csv": "header_only"}
    assert [(r.delivery_id, r.timestamp) for r in files.read_delivery_csv(spark, f"{tmp_dir}/raw").collect()] == [("7", "a\nb")]


def test_quotes_inside_unquoted_fields_are_plain(spark, tmp_dir):
    write_text(f"{tmp_dir}/raw/a.csv", HEADER + '1,2,3,4,5,6" tall\n2,2,3,4,5,"say ""hi"""\n')
    report = files.csv_file_report(spark, f"{tmp_dir}/raw").first()
    assert (report.status, report.n_data_lines, report.quoted_breaks) == ("ok", 2, False)
    assert sorted(r.timestamp for r in files.read_delivery_csv(spark, f"{tmp_dir}/raw").collect()) == ['6" tall', 'say "hi"']
