import random

import pytest

from pyspark.sql import functions as F

from helpers import HEADER, write_text
from waybatch.operators import sequence
from waybatch.operators.batching import FILE_ORDER, assign_batches, batch_count


def test_sequence_dense_and_ordered(spark):
    rnd = random.Random(7)
    keys = rnd.sample(range(10_000_000), 10_000)
    df = spark.createDataFrame([(k, -k) for k in keys], "k long, v long")
    for nb in (1, 3, 16):
        out, n = sequence.with_sequence(df, "k", num_buckets=nb)
        got = sorted((r.k, r.seq) for r in out.collect())
        assert n == 10_000
        assert [s for _, s in got] == list(range(1, 10_001))


def test_sequence_composite_key_and_start(spark):
    rows = [(b, r) for b in range(5) for r in range(7)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "b long, r long")
    out, n = sequence.with_sequence(df, ["b", "r"], start=101, num_buckets=4)
    got = sorted((r.b, r.r, r.seq) for r in out.collect())
    assert [s for *_, s in got] == list(range(101, 101 + 35))


def test_sequence_empty(spark):
    df = spark.createDataFrame([], "k long")
    out, n = sequence.with_sequence(df, "k")
    assert n == 0 and out.count() == 0


def test_head_and_page_both_paths(spark):
    df = spark.range(1, 5001).select((F.col("id") * 3).alias("k"))
    for small in (10**9, 0):
        h = sorted(r.k for r in sequence.head_rows(df, "k", 1234, small_limit=small).collect())
        assert h == [3 * i for i in range(1, 1235)]
        p = sorted(r.k for r in sequence.page_rows(df, "k", 300, 100, small_limit=small).collect())
        assert p == [3 * i for i in range(301, 401)]


def test_head_and_page_need_a_unique_key_on_both_paths(spark):
    df = spark.range(1, 51).select((F.col("id") % 49).alias("k"), "id")
    for small in (10**9, 0):
        with pytest.raises(ValueError, match="not unique"):
            sequence.head_rows(df, "k", 10, small_limit=small)
        with pytest.raises(ValueError, match="not unique"):
            sequence.page_rows(df, "k", 5, 10, small_limit=small)
        assert sorted(r.id for r in sequence.head_rows(df, ["k", "id"], 3, small_limit=small).collect()) == [1, 49, 50]


def test_batches(spark):
    df = spark.range(1, 251).select(F.col("id").alias("delivery_id"))
    b = assign_batches(df, "delivery_id", 100)
    got = {r.delivery_id: (r.batch_id, r.rn) for r in b.collect()}
    assert got[1] == (0, 0) and got[100] == (0, 99) and got[101] == (1, 0) and got[250] == (2, 49)
    assert batch_count(250, 100) == 3 and batch_count(0, 100) == 0


def test_file_order_sequence(spark, tmp_dir):
    # three files; the position in (file name, line) order is the sequence
    for name, ids in (("b.csv", [5, 1, 9]), ("a.csv", [7, 8]), ("c.csv", [2])):
        write_text(f"{tmp_dir}/in/{name}", HEADER + "".join(
            f"{i},40.7,-74.0,40.7,-74.0,2025-01-01 00:00:00\n" for i in ids))
    df = sequence.with_file_order(
        spark.read.option("header", "true").schema(
            "delivery_id long, pickup_lat double, pickup_lon double, dropoff_lat double, dropoff_lon double, timestamp string"
        ).csv(f"{tmp_dir}/in")
    )
    out = assign_batches(df, FILE_ORDER, 2)
    got = [r.delivery_id for r in out.orderBy("seq").collect()]
    assert got == [7, 8, 5, 1, 9, 2]
    assert sorted(r.seq for r in out.collect()) == list(range(1, 7))


def test_dense_key_needs_no_shuffle(spark):
    df = spark.range(0, 1000).select((F.col("id") + 50).alias("k"))
    out, n = sequence.with_sequence(df, "k", start=1)
    assert n == 1000
    assert sorted((r.k, r.seq) for r in out.collect()) == [(k, k - 49) for k in range(50, 1050)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    # one hole: no longer dense, numbered by the range path
    gappy = df.filter(F.col("k") != 60)
    out, n = sequence.with_sequence(gappy, "k")
    got = dict((r.k, r.seq) for r in out.collect())
    assert n == 999 and got[59] == 10 and got[61] == 11 and got[1049] == 999


def test_composite_key_with_hot_leading_value(spark):
    # a third of the rows share the leading value; order is (src, line)
    rows = [("hot", i) for i in range(3000)] + [(f"s{i % 37:02d}", i) for i in range(6000)]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "src string, line long")
    out, n = sequence.with_sequence(df, ["src", "line"], start=1, num_buckets=8)
    got = [(r.src, r.line) for r in out.orderBy("seq").collect()]
    assert n == 9000 and got == sorted(rows)
    assert sorted(r.seq for r in out.collect()) == list(range(1, 9001))
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(sizes) < 3000  # the hot source is split across ranges


def test_string_key(spark):
    df = spark.createDataFrame([(f"k{i:05d}",) for i in random.Random(5).sample(range(100000), 500)], "k string")
    out, n = sequence.with_sequence(df, "k")
    got = [r.k for r in out.orderBy("seq").collect()]
    assert got == sorted(got) and n == 500


def test_head_paths_agree_on_fixture(spark):
    from helpers import SF_TINY
    from waybatch.plans import fixtures as fx

    trips = fx.trips(spark, SF_TINY)
    a = sorted(tuple(r) for r in sequence.head_rows(trips, "trip_id", 700).collect())
    b = sorted(tuple(r) for r in sequence.head_rows(trips, "trip_id", 700, small_limit=0).collect())
    assert a == b and len(a) == 700


def test_repeated_keys_raise_and_null_and_nan_have_places(spark):
    with pytest.raises(ValueError, match="not unique"):
        sequence.with_sequence(spark.createDataFrame([(1,), (1,), (3,)], "k long"), "k")
    df = spark.createDataFrame([(float("nan"),), (None,), (2.5,), (-1.0,), (float("inf"),)], "k double")
    out, n = sequence.with_sequence(df, "k", num_buckets=3)
    got = [r.k for r in out.orderBy("seq").collect()]
    assert n == 5 and got[0] is None and got[1:4] == [-1.0, 2.5, float("inf")] and got[4] != got[4]


def test_sparse_keys_are_dealt_evenly(spark):
    df = spark.range(80_000).select((F.col("id") * 7).alias("k"))
    out, _ = sequence.with_sequence(df, "k", num_buckets=8)
    sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(sizes) <= 1.5 * sum(sizes) / len(sizes) and len(sizes) == 8


def test_repeats_show_without_a_distinct_shuffle(spark):
    dense = spark.range(100).select(F.col("id").alias("k"))
    with pytest.raises(ValueError, match="not unique"):  # as many rows as values, one of them twice
        sequence.with_sequence(dense.filter("k <> 50").unionByName(spark.range(51, 52).toDF("k")), "k")
    for rows, kind in (([1.5, float("nan"), float("nan")], "double"), ([None, None, 2.0], "double"), ([0.0, -0.0], "double"),
                       (["a", "b", "a"], "string"), ([[1], [2], [1]], "array<int>"), ([1, 1], "long")):
        with pytest.raises(ValueError, match="not unique"):
            sequence.with_sequence(spark.createDataFrame([(r,) for r in rows], f"k {kind}"), "k")
    ok = spark.createDataFrame([(None, 1), (float("nan"), 1), (float("nan"), 2), (None, 2), (0.0, 1)], "k double, m int")
    got, n = sequence.with_sequence(ok, ["k", "m"])
    assert n == 5 and [(r.k if r.k == r.k else "nan", r.m) for r in got.orderBy("seq").collect()] == [(None, 1), (None, 2), (0.0, 1), ("nan", 1), ("nan", 2)]


def test_head_looks_at_the_first_keys_only(spark):
    df = spark.createDataFrame([(1,), (2,), (9,), (9,)], "k int")
    assert [r.k for r in sequence.head_rows(df, "k", 2).collect()] == [1, 2]
    with pytest.raises(ValueError):
        sequence.head_rows(df, "k", 3)
    assert [r.k for r in sequence.page_rows(df, "k", 1, 1).collect()] == [2]


def test_pages_of_an_ordered_copy(spark, tmp_dir):
    df = spark.range(1000).select(((F.col("id") * 37) % 1000).alias("k"), F.lit("x").alias("start"))
    assert sequence.write_ordered(df, "k", f"{tmp_dir}/o", rows_per_file=70, num_buckets=3) == 1000
    for offset, size in ((0, 10), (615, 200), (999, 5), (1000, 5), (3, 0), (0, 1000)):
        got = sequence.read_page(spark, f"{tmp_dir}/o", offset, size)
        assert sorted((r.seq, r.k) for r in got.collect()) == [(i + 1, i) for i in range(offset, min(offset + size, 1000))]
    page = sequence.read_page(spark, f"{tmp_dir}/o", 900, 10)
    assert len(page.inputFiles()) <= 2 < len(spark.read.parquet(f"{tmp_dir}/o/rows").inputFiles())
    assert sequence.write_ordered(df.filter("false"), "k", f"{tmp_dir}/e") == 0
    assert sequence.read_page(spark, f"{tmp_dir}/e", 0, 5).count() == 0
