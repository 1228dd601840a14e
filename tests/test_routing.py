import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import THREE_ROWS, write_text
from waybatch.operators import nearest_index, routing
from waybatch.operators.batching import assign_batches, batch_crs, check_batch_size
from waybatch.schema import DELIVERY_SCHEMA


def _deliveries(spark, n, seed=907, ties=False):
    """Places over Queens and Nassau; with ``ties`` many at one point, as zone centroids give."""
    rnd = np.random.default_rng(seed)
    pick = rnd.normal((40.72, -73.72), 0.04, (n, 2))
    drop = pick + rnd.normal(0, 0.03, (n, 2))
    if ties:
        pick, drop = np.round(pick, 2), np.round(drop, 2)
    start = pd.Timestamp("2025-06-01 05:10")
    rows = [
        (i + 1, *map(float, pick[i]), *map(float, drop[i]), (start + pd.Timedelta(seconds=95 * i)).to_pydatetime())
        for i in range(n)
    ]
    return spark.createDataFrame(rows, DELIVERY_SCHEMA)


def test_routes_of_a_file_are_its_rows_with_their_pickup_points(spark, tmp_dir):
    from waybatch.sources.files import read_delivery_csv, typed_deliveries

    write_text(f"{tmp_dir}/in/a.csv", THREE_ROWS)
    d = typed_deliveries(read_delivery_csv(spark, f"{tmp_dir}/in"))
    points = {r.delivery_id: f"POINT ({r.pickup_lon} {r.pickup_lat})" for r in d.collect()}
    for mode in routing.ROUTE_MODES:
        out = routing.optimize_routes(d, order_by="file_order", batch_size=2, mode=mode)
        assert {r.delivery_id: r.geometry for r in out.collect()} == points
        assert sorted((r.batch_id, r.visit_seq) for r in out.collect()) == [(0, 1), (0, 2), (1, 1)]


def test_each_batch_is_visited_once(spark):
    for mode in routing.ROUTE_MODES:
        out = routing.optimize_routes(_deliveries(spark, 37), "delivery_id", 8, mode).collect()
        ids = {}
        for r in sorted(out, key=lambda r: (r.batch_id, r.visit_seq)):
            assert r.visit_seq == len(ids.setdefault(r.batch_id, [])) + 1
            ids[r.batch_id].append(r.delivery_id)
        assert [sorted(ids[b]) for b in sorted(ids)] == [list(range(s, min(s + 8, 38))) for s in range(1, 38, 8)]


def test_input_order_is_input_order_with_first_of_each_id(spark):
    rows = [(i, 40.7 + i / 1000, -74.0, 40.71, -74.01, None) for i in (5, 3, 5, 9, 3, 1)]
    df = spark.createDataFrame([(k,) + r for k, r in enumerate(rows)], "k long, delivery_id long, pickup_lat double, pickup_lon double, dropoff_lat double, dropoff_lon double, timestamp timestamp_ntz")
    out = routing.optimize_routes(df, "k", 4, "input_order").orderBy("batch_id", "visit_seq").collect()
    assert [(r.batch_id, r.delivery_id) for r in out] == [(0, 5), (0, 3), (0, 9), (1, 3), (1, 1)]


def _brute_walk(pdf):
    pe, pn, de, dn = (pdf[c].to_numpy() for c in ("pe", "pn", "de", "dn"))
    order, left = [0], list(range(1, len(pdf)))
    while left:
        c = order[-1]
        best = min(left, key=lambda j: (math.sqrt((pe[j] - de[c]) ** 2 + (pn[j] - dn[c]) ** 2), j))
        order.append(best)
        left.remove(best)
    return order


def test_nearest_walk_is_greedy(spark):
    d = _deliveries(spark, 60, seed=3, ties=True)
    b = assign_batches(d, "delivery_id", 30)
    proj = routing.with_projection(b).toPandas()
    got = routing.route_nearest(b).toPandas()
    for bid, grp in proj.groupby("batch_id"):
        grp = grp.sort_values("rn").reset_index(drop=True)
        expect = _brute_walk(grp)
        seq = got[got.batch_id == bid].sort_values("visit_seq").rn.tolist()
        assert seq == expect


def test_walk_batch_empty_and_single():
    cols = [f.name for f in routing.WALK_SCHEMA if f.name != "visit_seq"]
    empty = routing.walk_batch(pd.DataFrame(columns=cols))
    assert "visit_seq" in empty.columns and empty.empty
    one = pd.DataFrame([[0, 0, 7, 40.7, -74.0, 40.7, -74.0, None, 1.0, 2.0, 3.0, 4.0]], columns=cols)
    assert routing.walk_batch(one).visit_seq.tolist() == [1]


def _all_pairs_nearest(bid, row, pe, pn, de, dn):
    """Definition: every pickup against every foreign dropoff of its batch."""
    out = {}
    for i in range(len(bid)):
        if not (np.isfinite(pe[i]) and np.isfinite(pn[i])):
            continue
        dx, dy = de - pe[i], dn - pn[i]
        d = np.sqrt(dx * dx + dy * dy)
        best = min(((float(d[j]), int(row[j])) for j in range(len(bid))
                    if bid[j] == bid[i] and j != i and np.isfinite(de[j]) and np.isfinite(dn[j])), default=None)
        if best:
            out[int(bid[i]), int(row[i])] = (best[1], best[0])
    return out


@pytest.mark.parametrize("ties", [False, True])
def test_nearest_dropoff_equals_all_pairs(spark, ties):
    b = assign_batches(_deliveries(spark, 900, seed=11, ties=ties), "delivery_id", 300)
    p = routing.with_projection(b).toPandas()
    expect = _all_pairs_nearest(*(p[c].to_numpy() for c in ("batch_id", "rn", "pe", "pn", "de", "dn")))
    got = routing.nearest_dropoff(b.withColumn("nearest_rn", F.lit("x")).withColumn("dist", F.lit(0))).collect()
    assert {(r.batch_id, r.rn): (r.nearest_rn, r.dist) for r in got} == expect and len(got) == len(expect)


def test_nearest_index_on_ties_clusters_and_rows_without_a_place(monkeypatch):
    rng = np.random.default_rng(8)
    for trial in range(80):
        monkeypatch.setattr(nearest_index, "PICKUPS_AT_ONCE", int(rng.integers(1, 60)))
        monkeypatch.setattr(nearest_index, "CANDIDATES_AT_ONCE", int(rng.integers(1, 200)))
        m = int(rng.integers(1, 120))
        bid = np.sort(rng.integers(0, 5, m)) * 3
        row = np.concatenate([rng.permutation(int((bid == k).sum())) for k in np.unique(bid)]).astype(np.int64)
        c = rng.uniform(0, 1000, (4, m))
        if trial % 4 == 1:
            c = np.round(rng.uniform(0, 4, (4, m)))  # exact ties
        elif trial % 4 == 2:  # a third of the dropoffs at one place, pickups far away
            c[2:, rng.random(m) < 0.34] = 500.0
            c[:2] += 4e6
        elif trial % 4 == 3:
            c[rng.integers(0, 4, m // 5), rng.integers(0, m, m // 5)] = rng.choice([np.nan, np.inf], m // 5)
        at, dst, dist = nearest_index.nearest_foreign(bid, row, *c)
        got = {(int(bid[i]), int(row[i])): (int(j), float(d)) for i, j, d in zip(at, dst, dist)}
        assert got == _all_pairs_nearest(bid, row, *c), trial


def test_nearest_index_with_a_large_hot_place():
    """20,000 deliveries, a third dropped off at one place: no pair per copy."""
    rng = np.random.default_rng(5)
    m = 20_000
    c = rng.uniform(0, 1e4, (4, m))
    c[2:, ::3] = 5000.0
    zeros, row = np.zeros(m, dtype=np.int64), np.arange(m)
    at, dst, dist = nearest_index.nearest_foreign(zeros, row, *c)
    assert len(at) == m
    for i in range(0, m, 1999):
        d = np.sqrt((c[2] - c[0, i]) ** 2 + (c[3] - c[1, i]) ** 2)
        d[i] = np.inf
        assert dst[i] == int(np.argmin(d)) and dist[i] == d.min()


def test_batches_that_span_chunks_stay_whole():
    pdf = pd.DataFrame({"batch_id": np.repeat([0, 1, 2, 3, 4], [3, 50, 1, 20, 2]), "v": range(76)})
    for size in (1, 7, 76):
        parts = list(routing.whole_batches(pdf.iloc[i:i + size] for i in range(0, 76, size)))
        assert pd.concat(parts, ignore_index=True).equals(pdf)
        assert sum(p.batch_id.nunique() for p in parts) == 5
    assert list(routing.whole_batches(iter([pdf.iloc[:0]]))) == []


def test_walks_in_step_equal_walks_one_by_one(monkeypatch):
    rng = np.random.default_rng(77)
    for trial in range(40):
        monkeypatch.setattr(routing, "STEP_CELLS", int(rng.integers(1, 500)))
        monkeypatch.setattr(routing, "TREE_WALK_MIN", 40)
        sizes = rng.integers(1, 60, 12)
        ends = np.cumsum(sizes)
        c = np.round(rng.uniform(0, 9, (4, ends[-1]))) if trial % 2 else rng.uniform(0, 1e3, (4, ends[-1]))
        if trial % 3 == 0:
            c[rng.integers(0, 4, 30), rng.integers(0, ends[-1], 30)] = np.nan
        starts = ends - sizes
        got = routing.greedy_orders(starts, ends, *c)
        for a, z, order in zip(starts, ends, got):
            place = np.isfinite(c[:, a:z]).all(axis=0)
            at = np.flatnonzero(place)
            expect = np.concatenate([at[routing.greedy_order(*c[:, a:z][:, at])], np.flatnonzero(~place)])
            assert order.tolist() == expect.tolist(), trial


def test_batch_of_one_has_no_foreign_dropoff(spark):
    d = _deliveries(spark, 3)
    b = assign_batches(d, "delivery_id", 2)
    assert routing.nearest_dropoff(b).filter("batch_id = 1").count() == 0
    assert routing.nearest_dropoff_grid(b).filter("batch_id = 1").count() == 0


def test_edges_and_path(spark):
    b = assign_batches(_deliveries(spark, 5), "delivery_id", 5)
    e = routing.delivery_edges(b)
    assert e.count() == 5 + 5 * 4
    assert e.filter("weight = 0").count() >= 5
    p = routing.stop_path(b).orderBy("visit_seq").collect()
    assert [r.stop_key for r in p[:4]] == ["p_0", "d_0", "p_1", "d_1"]
    assert batch_crs(b).first().crs == "EPSG:32618"


def test_route_length_parts(spark):
    b = assign_batches(_deliveries(spark, 10), "delivery_id", 10)
    r = routing.route_length(routing.route_input_order(b), "input_order").first()
    assert r.n_stops == 10 and r.total_mm == r.loaded_mm + r.empty_mm and r.empty_mm > 0


def test_empty_input_gives_empty_routes(spark):
    d = spark.createDataFrame([], DELIVERY_SCHEMA)
    for mode in routing.ROUTE_MODES:
        out = routing.optimize_routes(d, "delivery_id", 10, mode)
        assert out.count() == 0
        assert "geometry" in out.columns


def test_bad_batch_size():
    for bad in (0, -1, 1.5, True):
        with pytest.raises(ValueError):
            check_batch_size(bad)


def test_dedup_scope_all_with_many_copies(spark):
    from waybatch.operators.batching import dedup_first

    rows = [(7 if i % 3 == 0 else i, i) for i in range(3000)]  # a third are copies of id 7
    df = spark.createDataFrame(rows, "delivery_id long, seq long").withColumn("batch_id", F.floor(F.col("seq") / 100))
    kept = sorted((r.delivery_id, r.seq) for r in dedup_first(df, order="seq", scope="all").collect())
    expect = sorted({d: s for s, d in sorted(((s, d) for d, s in rows), reverse=True)}.items())
    assert kept == expect
    per_batch = dedup_first(df, order="seq", scope="batch").count()
    assert per_batch == len({(s // 100, d) for d, s in rows})


def test_tree_walk_equals_scan_walk(monkeypatch):
    monkeypatch.setattr(routing, "TREE_WALK_MIN", 2)
    rng = np.random.default_rng(21)
    for trial in range(120):
        monkeypatch.setattr(routing, "_LEAF_PLACES", int(rng.integers(1, 30)))
        m = int(rng.integers(2, 300))
        if trial % 3 == 0:
            a = rng.uniform(0, 1000, (4, m))
        elif trial % 3 == 1:
            a = np.round(rng.uniform(0, 5, (4, m)))  # many exact ties
        else:  # clustered pickups, dropoffs far outside them
            c = rng.uniform(0, 1e5, (4, 2))
            k = rng.integers(0, 4, m)
            a = np.round(np.vstack([c[k, 0] + rng.normal(0, 30, m), c[k, 1] + rng.normal(0, 30, m),
                                    rng.uniform(-1e5, 2e5, m), rng.uniform(-1e5, 2e5, m)]), 3)
        assert np.array_equal(routing.greedy_order(*a), routing.greedy_order_tree(*a)), trial


def test_rows_without_a_place_come_last_at_any_batch_size(spark):
    rng = np.random.default_rng(3)
    for n in (100, 3000):
        c = rng.random((4, n))
        c[0, n // 2] = np.nan
        c[3, 0] = np.nan
        order = routing.greedy_order_tree(*c)
        assert sorted(order.tolist()) == list(range(n))
        assert order.tolist()[-2:] == [0, n // 2]
