import datetime as dt
import os

import pytest

from waybatch.operators import routing
from waybatch.operators.batching import assign_batches
from waybatch.schema import DELIVERY_SCHEMA
from waybatch.sinks import manifest
from waybatch.sinks import routes as sinks

ROWS = [
    (1, 40.7421, -73.851, 40.7302, -73.8644, None),
    (2, 40.7517, -73.8333, 40.7689, -73.8201, None),
    (3, 40.729, -73.8702, 40.7455, -73.8477, None),
]


def _routes(spark):
    d = spark.createDataFrame(ROWS, DELIVERY_SCHEMA)
    return routing.route_input_order(assign_batches(d, "delivery_id", 2))


def test_append_key_continues(spark, tmp_dir):
    path = f"{tmp_dir}/routes"
    assert sinks.append_routes(spark, _routes(spark), path) == 3
    assert sinks.append_routes(spark, _routes(spark), path) == 3
    got = sorted((r.route_key, r.delivery_id) for r in sinks.read_routes(spark, path).collect())
    assert got == [(1, 1), (2, 2), (3, 3), (4, 1), (5, 2), (6, 3)]
    row = sinks.read_routes(spark, path).filter("route_key = 1").first()
    assert row.geometry == "POINT (-73.851 40.7421)" and row.timestamp is None


def test_append_dedupe_and_parity(spark, tmp_dir):
    path = f"{tmp_dir}/routes"
    sinks.append_routes(spark, _routes(spark), path, parity=True)
    assert sinks.append_routes(spark, _routes(spark), path, dedupe=True) == 0
    rows = sinks.read_routes(spark, path).collect()
    assert len(rows) == 3 and all(r.delivery_id is None for r in rows)


def test_repair_geometry(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, None), (1.0, 2.0, "LINESTRING (0 0, 1 1)"), (None, 2.0, None), (1.0, 2.0, "POINT (5 6)")],
        "pickup_lon double, pickup_lat double, geometry string",
    )
    got = [(r.geometry, r.geometry_fixed) for r in sinks.repair_geometry(df).collect()]
    assert got == [("POINT (1 2)", True), ("POINT (1 2)", True), (None, True), ("POINT (5 6)", False)]
    with pytest.raises(ValueError):
        sinks.repair_geometry(df.drop("pickup_lat"))


def test_sample_skipped_when_empty(spark, tmp_dir):
    empty = spark.createDataFrame([], DELIVERY_SCHEMA)
    assert sinks.write_sample_csv(empty, f"{tmp_dir}/s", "delivery_id", 10) is False
    full = spark.createDataFrame(ROWS, DELIVERY_SCHEMA)
    assert sinks.write_sample_csv(full, f"{tmp_dir}/s", "delivery_id", 2) is True
    back = spark.read.option("header", "true").csv(f"{tmp_dir}/s")
    assert sorted(int(r.delivery_id) for r in back.collect()) == [1, 2]


def test_append_to_catalog_table(spark):
    name = "wb_routes_catalog"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert sinks.append_routes(spark, _routes(spark), name) == 3
    assert sinks.append_routes(spark, _routes(spark), name, dedupe=True) == 0
    assert sinks.append_routes(spark, _routes(spark), name) == 3
    keys = sorted(r.route_key for r in sinks.read_routes(spark, name).collect())
    assert keys == [1, 2, 3, 4, 5, 6]
    spark.sql(f"DROP TABLE {name}")


def test_append_key_with_short_batches(spark, tmp_dir):
    rows = [(i, 40.7 + k / 100, -74.0, 40.7, -74.0, None) for k, i in enumerate([1, 1, 2, 3, 4, 5, 6])]
    d = spark.createDataFrame([(k,) + r for k, r in enumerate(rows)],
                              "k long, delivery_id long, pickup_lat double, pickup_lon double, "
                              "dropoff_lat double, dropoff_lon double, timestamp timestamp_ntz")
    routes = routing.route_input_order(assign_batches(d, "k", 2))  # batch 0 keeps one row
    path = f"{tmp_dir}/routes"
    assert sinks.append_routes(spark, routes, path) == 6
    got = sorted((r.route_key, r.delivery_id) for r in sinks.read_routes(spark, path).collect())
    assert got == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 6)]


def _dated(spark, ids, days):
    rows = [(i, 40.7 + i / 1000, -73.9, 40.8, -73.8, dt.datetime(2025, 1 + d % 12, 1 + d % 28)) for i, d in zip(ids, days, strict=True)]
    d = spark.createDataFrame(rows, DELIVERY_SCHEMA)
    return routing.route_input_order(assign_batches(d, "delivery_id", 5))


def test_a_batch_id_is_appended_once(spark, tmp_dir):
    path = f"{tmp_dir}/routes"
    assert sinks.append_routes(spark, _routes(spark), path, batch_id="a") == 3
    assert sinks.append_routes(spark, _routes(spark), path, batch_id="a") == 0
    assert sinks.append_routes(spark, _routes(spark), path, batch_id="b") == 3
    assert sorted(r.route_key for r in sinks.read_routes(spark, path).collect()) == [1, 2, 3, 4, 5, 6]
    assert [(c.version, c.batch_id, c.rows, c.last_key) for c in manifest.commits(spark, path)] == [(1, "a", 3, 3), (2, "b", 3, 6)]
    for bad in ("", "../x", "a/b", ".a", "x" * 129):
        with pytest.raises(ValueError):
            sinks.append_routes(spark, _routes(spark), path, batch_id=bad)
    with pytest.raises(ValueError):
        sinks.append_routes(spark, _routes(spark), "wb_catalog_name", batch_id="a")


def test_death_before_the_commit_leaves_the_old_version(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/routes"
    sinks.append_routes(spark, _routes(spark), path, batch_id="a")

    def dies(*_):
        raise RuntimeError("killed")
    with monkeypatch.context() as m:
        m.setattr(manifest, "commit", dies)
        with pytest.raises(RuntimeError, match="killed"):
            sinks.append_routes(spark, _dated(spark, range(10), range(10)), path, batch_id="b")
    assert os.path.isdir(f"{path}/batch=b")
    assert sinks.read_routes(spark, path).count() == 3
    assert sinks.append_routes(spark, _dated(spark, range(4), range(4)), path, batch_id="b") == 4
    assert sorted(r.route_key for r in sinks.read_routes(spark, path).collect()) == list(range(1, 8))


def test_two_writers_conflict(spark, tmp_dir):
    path = f"{tmp_dir}/routes"
    manifest.create(spark, path)
    manifest.commit(spark, path, [], "a", 0, 0, 0)
    with pytest.raises(manifest.AppendConflict):
        manifest.commit(spark, path, [], "b", 0, 0, 0)
    assert [c.batch_id for c in manifest.commits(spark, path)] == ["a"]


def test_a_folder_without_a_manifest_is_refused(spark, tmp_dir):
    spark.range(3).write.parquet(f"{tmp_dir}/plain")
    with pytest.raises(ValueError, match="no manifest"):
        sinks.append_routes(spark, _routes(spark), f"{tmp_dir}/plain")


def test_dedupe_reads_only_the_months_it_must(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/routes"
    sinks.append_routes(spark, _dated(spark, range(120), range(120)), path)
    seen = []
    real = manifest.read

    def watched(spark, path, schema, done=None):
        df = real(spark, path, schema, done)
        seen.append(df)
        return df
    monkeypatch.setattr(manifest, "read", watched)
    # 200 .. 203 are new, 12 is stored (January)
    assert sinks.append_routes(spark, _dated(spark, [12, 200, 201, 202, 203], [12, 24, 48, 60, 72]), path, dedupe=True) == 4
    plan = seen[0].filter("route_month in ('2025-01')")._jdf.queryExecution().executedPlan().toString()  # the read for the exact join
    assert "PartitionFilters: [" in plan and "route_month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    # keys that no filter has open nothing: the table is not read
    seen.clear()
    assert sinks.append_routes(spark, _dated(spark, [900], [400]), path, dedupe=True) == 1
    assert len(seen) == 1  # the new batch, for its own filter
    assert sinks.read_routes(spark, path).count() == 125


def test_dedupe_keeps_nulls_equal(spark, tmp_dir):
    path = f"{tmp_dir}/routes"
    sinks.append_routes(spark, _routes(spark), path)  # null timestamps
    assert sinks.append_routes(spark, _routes(spark), path, dedupe=True) == 0
    assert [c.rows for c in manifest.commits(spark, path)] == [3, 0]


def test_stored_geometry_is_parsed_and_converted_once(spark):
    rows = [(i, 40.7, -74.0, 40.8, -73.9, None, f"POINT ({585000 + i} 4511000)", "EPSG:32618") for i in range(20)]
    routes = spark.createDataFrame(rows, "delivery_id long, pickup_lat double, pickup_lon double, dropoff_lat double, dropoff_lon double, "
                                         "timestamp timestamp_ntz, geometry string, crs string").repartition(2)
    stored = sinks.to_stored(routes, "crs")
    assert stored.columns == [*routes.columns, "geometry_fixed"]
    got = {r.delivery_id: r.geometry for r in stored.collect()}
    assert len(set(got.values())) == 20 and all(g.startswith("POINT (-73.99") for g in got.values())
    plan = stored._jdf.queryExecution().optimizedPlan().toString().lower()
    # x and y of the text; the two series of the inverse UTM projection end in one asin and one atan2, the conic's in one more atan2
    assert plan.count("regexp_extract(") == 2
    assert plan.count("asin(") == 1 and plan.count("atan2(") == 2
