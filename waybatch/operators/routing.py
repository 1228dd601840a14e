"""Routing inside fixed-size batches.

* stops and edges of the delivery graph as tables,
* nearest foreign dropoff per pickup (exact, by an index on arrays),
* the route as the studied code computes it (input order, first of each
  id) and as it is documented (greedy nearest neighbour),
* leg distances and route length.

Every batch holds at most ``batch_size`` rows, so per-batch work is bounded
however large or skewed the input is; batches spread over tasks by hash of
``batch_id``.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybatch.functions.geo import planar_distance, utm_forward, wkt_point
from waybatch.operators.batching import assign_batches, by_batch, dedup_first, with_batch_zone
from waybatch.operators.nearest_index import nearest_foreign

ROUTE_MODES = ("input_order", "nearest")
_DELIVERY_PASS = ["delivery_id", "pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon", "timestamp"]


def with_projection(batched: DataFrame, spread: int = 1) -> DataFrame:
    """Adds the batch zone and pickup/dropoff UTM metres (``pe, pn, de, dn``)."""
    z = with_batch_zone(batched, spread)
    pe, pn = utm_forward("pickup_lon", "pickup_lat", "utm_zone", "utm_south")
    de, dn = utm_forward("dropoff_lon", "dropoff_lat", "utm_zone", "utm_south")
    return z.withColumn("pe", pe).withColumn("pn", pn).withColumn("de", de).withColumn("dn", dn)


def stops(batched: DataFrame) -> DataFrame:
    """Each delivery as two stop rows, ``p_<rn>`` (pickup) and ``d_<rn>``."""
    rn = F.col("rn").cast("string")
    pickup = F.struct(
        F.lit("pickup").alias("point_type"),
        F.concat(F.lit("p_"), rn).alias("stop_key"),
        F.col("pickup_lat").alias("lat"),
        F.col("pickup_lon").alias("lon"),
    )
    dropoff = F.struct(
        F.lit("dropoff").alias("point_type"),
        F.concat(F.lit("d_"), rn).alias("stop_key"),
        F.col("dropoff_lat").alias("lat"),
        F.col("dropoff_lon").alias("lon"),
    )
    return batched.select("batch_id", "rn", "delivery_id", "timestamp", F.inline(F.array(pickup, dropoff)))


def pickup_stops(stop_rows: DataFrame) -> DataFrame:
    return stop_rows.filter(F.col("point_type") == F.lit("pickup"))


def keyed_stops(stop_rows: DataFrame, prefix: str = "p_") -> DataFrame:
    """Stops whose key starts with ``prefix``, with the row number sliced back out."""
    return stop_rows.filter(F.col("stop_key").startswith(prefix)).withColumn(
        "key_rn", F.substring(F.col("stop_key"), len(prefix) + 1, 1 << 20).cast("int")
    )


def stop_path(batched: DataFrame) -> DataFrame:
    """Stop path as the studied walk produces it: p_0, d_0, p_1, d_1, ..."""
    s = stops(batched)
    visit = F.col("rn") * F.lit(2) + F.when(F.col("point_type") == F.lit("pickup"), F.lit(1)).otherwise(F.lit(2))
    return s.withColumn("visit_seq", visit.cast("int"))


def _pair_input(batched: DataFrame) -> DataFrame:
    """Projected stops, narrow, checkpointed once in the shared folder.

    The pickup and dropoff sides of the pair join both read it, so the
    upstream plan (sequence, batch windows, projection) runs once instead
    of once per join side; only the narrow stop table is shuffled again.
    """
    from waybatch.session import checkpoint_root

    checkpoint_root(batched.sparkSession)
    return with_projection(batched).select("batch_id", "rn", "pe", "pn", "de", "dn").checkpoint()


def _pickups_dropoffs(projected: DataFrame):
    p = projected.select("batch_id", F.col("rn").alias("src_rn"), "pe", "pn")
    d = projected.select("batch_id", F.col("rn").alias("dst_rn"), "de", "dn")
    return p, d


def delivery_edges(batched: DataFrame) -> DataFrame:
    """Edge table: own edge ``p_i -> d_i`` (weight 0) and every foreign edge
    ``p_i -> d_j`` (j != i) weighted by UTM metres in the batch's zone."""
    z = _pair_input(batched)
    p, d = _pickups_dropoffs(z)
    foreign = p.join(d, "batch_id").filter(F.col("src_rn") != F.col("dst_rn"))
    foreign = foreign.select(
        "batch_id",
        F.concat(F.lit("p_"), F.col("src_rn").cast("string")).alias("src"),
        F.concat(F.lit("d_"), F.col("dst_rn").cast("string")).alias("dst"),
        planar_distance("pe", "pn", "de", "dn").alias("weight"),
    )
    own = z.select(
        "batch_id",
        F.concat(F.lit("p_"), F.col("rn").cast("string")).alias("src"),
        F.concat(F.lit("d_"), F.col("rn").cast("string")).alias("dst"),
        F.lit(0.0).alias("weight"),
    )
    return own.unionByName(foreign)


def whole_batches(chunks):
    """Chunks of one partition sorted by ``batch_id``, cut again so that each
    holds whole batches. The last, possibly unfinished batch is carried on
    (at most ``batch_size`` rows), so many batches share one Arrow chunk."""
    carry: list[pd.DataFrame] = []
    for pdf in chunks:
        if pdf.empty:
            continue
        bids = pdf["batch_id"].to_numpy()
        if carry and bids[-1] == carry[0]["batch_id"].iloc[0]:
            carry.append(pdf)
            continue
        cut = int(np.searchsorted(bids, bids[-1], side="left"))
        done = carry + ([pdf.iloc[:cut]] if cut else [])
        carry = [pdf.iloc[cut:]]
        if done:
            yield pd.concat(done, ignore_index=True)
    if carry:
        yield pd.concat(carry, ignore_index=True)


NEAREST_SCHEMA = T.StructType([
    T.StructField("batch_id", T.LongType()),
    T.StructField("rn", T.IntegerType()),
    T.StructField("nearest_rn", T.IntegerType()),
    T.StructField("dist", T.DoubleType()),
])


def nearest_partition(chunks):
    """``mapInPandas`` body of :func:`nearest_dropoff`."""
    for pdf in whole_batches(chunks):
        bids, rn = pdf["batch_id"].to_numpy(), pdf["rn"].to_numpy(dtype=np.int64)
        at, dst, dist = nearest_foreign(bids, rn, *(pdf[c].to_numpy(dtype=np.float64) for c in ("pe", "pn", "de", "dn")))
        yield pd.DataFrame({"batch_id": bids[at], "rn": rn[at].astype(np.int32), "nearest_rn": dst.astype(np.int32), "dist": dist})


def nearest_dropoff(batched: DataFrame) -> DataFrame:
    """Nearest foreign dropoff per pickup: ``batch_id, rn, nearest_rn, dist``
    (metres in the batch's zone; lowest row on ties).

    Rows are hash-partitioned by ``batch_id`` (the exchange that the batch-zone
    window needs), sorted inside each partition, and searched by
    ``nearest_index`` many batches per Arrow chunk: no pair rows, no second
    shuffle. Batches of one delivery give no row. A pickup without a place
    gives no row, a dropoff without one is no candidate. Other columns are
    ignored; an empty table gives an empty one.
    """
    from waybatch.session import ship_package

    ship_package(batched.sparkSession)
    z = with_projection(batched).select(
        F.col("batch_id").cast("long"), F.col("rn").cast("int"), *[F.col(c).cast("double") for c in ("pe", "pn", "de", "dn")])
    return z.sortWithinPartitions("batch_id").mapInPandas(nearest_partition, schema=NEAREST_SCHEMA)


def nearest_dropoff_grid(batched: DataFrame) -> DataFrame:
    """Kept name of the search that avoids all pairs; :func:`nearest_dropoff` does so itself now."""
    return nearest_dropoff(batched)


def route_input_order(batched: DataFrame, dedup_scope: str = "batch") -> DataFrame:
    """The route the studied code computes: each batch in input order,
    first row of each ``delivery_id`` kept, pickup point as WKT.

    One exchange on ``batch_id`` serves the dedup and the numbering.
    """
    b = by_batch(batched)
    kept = dedup_first(b, scope=dedup_scope)
    w = Window.partitionBy("batch_id").orderBy("rn")
    out = kept.withColumn("visit_seq", F.row_number().over(w))
    return _route_columns(out)


def _route_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "batch_id",
        "visit_seq",
        "rn",
        *_DELIVERY_PASS,
        wkt_point("pickup_lon", "pickup_lat").alias("geometry"),
    )


def greedy_order(pe, pn, de, dn) -> np.ndarray:
    """Visiting order of rows 0..m-1 (arrays in row order): start at row 0;
    from the dropoff of the current row go to the nearest unvisited pickup,
    lowest row on ties. Visited rows are masked; the candidate arrays are
    compacted whenever half of them are used, so the work stays near
    ``m^2 / 2`` distance evaluations. O(m) memory, no distance matrix."""
    m = len(pe)
    order = np.empty(m, dtype=np.int64)
    if m == 0:
        return order
    order[0] = 0
    idx = np.arange(1, m, dtype=np.int64)  # candidates, ascending row
    cpe, cpn = pe[idx], pn[idx]
    live = np.ones(len(idx), dtype=bool)
    n_live = len(idx)
    cur = 0
    for step in range(1, m):
        dx = cpe - de[cur]
        dy = cpn - dn[cur]
        dist = np.sqrt(dx * dx + dy * dy)
        dist[~live] = np.inf
        k = int(np.argmin(dist))  # first minimum = lowest row
        cur = int(idx[k])
        order[step] = cur
        live[k] = False
        n_live -= 1
        if n_live and n_live * 2 <= len(idx):
            idx, cpe, cpn = idx[live], cpe[live], cpn[live]
            live = np.ones(len(idx), dtype=bool)
    return order


def walk_batch(pdf: pd.DataFrame) -> pd.DataFrame:
    """Greedy nearest neighbour route of one batch (pandas, in a task).

    Distances come from millimetre UTM coordinates, so they equal the Spark
    and SQL ones bit for bit. The first visit of each ``delivery_id`` is
    kept and numbered 1..k.
    """
    if pdf.empty:
        return pdf.assign(visit_seq=pd.Series(dtype="int32"))
    by_row = np.argsort(pdf["rn"].to_numpy(), kind="stable")
    cols = [pdf[c].to_numpy(dtype=np.float64)[by_row] for c in ("pe", "pn", "de", "dn")]
    visit = by_row[greedy_order(*cols)]
    ids = pdf["delivery_id"].to_numpy()[visit]
    _, first = np.unique(ids, return_index=True)
    keep = visit[np.sort(first)]
    out = pdf.iloc[keep]
    return out.assign(visit_seq=np.arange(1, len(keep) + 1, dtype=np.int32))


# Batches at least this large walk with the tree below.
TREE_WALK_MIN = 2000
LONG_BATCH_SPREAD = 8  # partitions of long batches, in shuffle partitions
_LEAF_PLACES = 96


class _PickupTree:
    """Unvisited pickups of a large batch for exact nearest queries: a k-d tree
    over their distinct places, split at medians, so clusters and gaps cost
    alike. A place holds its rows in ascending order and gives the lowest
    unvisited one; parts without an unvisited place are passed over."""

    def __init__(self, rows: np.ndarray, pe: np.ndarray, pn: np.ndarray):
        by_place = rows[np.lexsort((rows, pn[rows], pe[rows]))]
        x, y = pe[by_place], pn[by_place]
        at = np.flatnonzero(np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
        x, y = x[at], y[at]
        order = np.arange(len(at))
        self.span, self.child, self.parent, self.alive, self.box = [], [], [], [], []
        todo = [(0, len(at), -1)]
        while todo:
            a, b, parent = todo.pop()
            node, part = len(self.span), order[a:b]
            px, py = x[part], y[part]
            west, east, south, north = float(px.min()), float(px.max()), float(py.min()), float(py.max())
            self.span.append((a, b))
            self.child.append([])
            self.parent.append(parent)
            self.alive.append(b - a)
            self.box.append((west, east, south, north))
            if parent >= 0:
                self.child[parent].append(node)
            if b - a > _LEAF_PLACES:
                half = (b - a) // 2
                order[a:b] = part[np.argpartition(px if east - west >= north - south else py, half)]
                todo += [(a, a + half, node), (a + half, b, node)]
        self.leaf = np.zeros(len(at), dtype=np.int64)
        for node, (a, b) in enumerate(self.span):
            if not self.child[node]:
                self.leaf[a:b] = node
        self.rows = by_place
        self.next, self.end = at[order], np.r_[at[1:], len(by_place)][order]
        self.x, self.y, self.low = x[order], y[order], by_place[self.next]

    def _apart(self, node: int, qx: float, qy: float) -> float:
        """Squared distance from a point to the box of a node."""
        west, east, south, north = self.box[node]
        dx = west - qx if qx < west else qx - east if qx > east else 0.0
        dy = south - qy if qy < south else qy - north if qy > north else 0.0
        return dx * dx + dy * dy

    def take_nearest(self, qx: float, qy: float) -> int:
        """Lowest row among the unvisited pickups nearest to (qx, qy); it is visited then."""
        best, best_row, best_at, limit = math.inf, -1, -1, math.inf
        todo = [(0.0, 0)]
        while todo:
            apart, node = todo.pop()
            if apart > limit:
                continue
            nodes = self.child[node]
            if nodes:
                near = [(self._apart(k, qx, qy), k) for k in nodes if self.alive[k]]
                if len(near) == 2 and near[0][0] < near[1][0]:
                    near.reverse()  # the nearer one is looked at first
                todo += [n for n in near if n[0] <= limit]
                continue
            a, b = self.span[node]
            dx, dy = self.x[a:b] - qx, self.y[a:b] - qy
            d = np.sqrt(dx * dx + dy * dy)
            k = int(d.argmin())
            least = float(d[k])
            if least > best or least == math.inf:
                continue
            tied = np.flatnonzero(d == least)
            if len(tied) > 1:
                k = int(tied[np.argmin(self.low[a:b][tied])])
            row = int(self.low[a + k])
            if least < best or row < best_row:
                best, best_row, best_at = least, row, a + k
                limit = best * best * (1.0 + 1e-9) + 1e-9  # wider than the rounding, so no tie is passed over
        self._visit(best_at)
        return best_row

    def _visit(self, place: int) -> None:
        self.next[place] += 1
        if self.next[place] < self.end[place]:
            self.low[place] = self.rows[self.next[place]]
            return
        self.x[place] = math.inf
        node = int(self.leaf[place])
        while node >= 0:
            self.alive[node] -= 1
            node = self.parent[node]


def greedy_order_tree(pe, pn, de, dn) -> np.ndarray:
    """Same order as :func:`greedy_order` for large batches, from a tree of
    places instead of every pickup. The tree is rebuilt over the unvisited
    pickups whenever half of its places are used."""
    placed = np.isfinite(pe) & np.isfinite(pn) & np.isfinite(de) & np.isfinite(dn)
    if not placed.all():  # at any batch size: rows without a place come last, in row order
        at = np.flatnonzero(placed)
        return np.concatenate([at[greedy_order_tree(pe[at], pn[at], de[at], dn[at])], np.flatnonzero(~placed)])
    m = len(pe)
    if m < TREE_WALK_MIN:
        return greedy_order(pe, pn, de, dn)
    order = np.zeros(m, dtype=np.int64)
    unvisited = np.ones(m, dtype=bool)
    unvisited[0] = False
    tree = _PickupTree(np.flatnonzero(unvisited), pe, pn)
    places, cur = tree.alive[0], 0
    for step in range(1, m):
        if tree.alive[0] * 2 < places:
            tree = _PickupTree(np.flatnonzero(unvisited), pe, pn)
            places = tree.alive[0]
        cur = tree.take_nearest(float(de[cur]), float(dn[cur]))
        order[step], unvisited[cur] = cur, False
    return order


# Cells of the padded arrays that are walked in step.
STEP_CELLS = 1_000_000


def greedy_orders(starts, ends, pe, pn, de, dn) -> list[np.ndarray]:
    """:func:`greedy_order_tree` of many batches (``starts[i]..ends[i]``).

    Batches below ``TREE_WALK_MIN`` rows advance together: they are padded to
    one array, and each step is one pass over it, whatever their number."""
    out: list[np.ndarray] = [np.empty(0, dtype=np.int64)] * len(starts)
    placed = np.isfinite(pe) & np.isfinite(pn) & np.isfinite(de) & np.isfinite(dn)
    sizes = np.asarray(ends) - np.asarray(starts)
    for i in np.flatnonzero(sizes >= TREE_WALK_MIN):
        at = slice(starts[i], ends[i])
        out[i] = greedy_order_tree(pe[at], pn[at], de[at], dn[at])
    small = np.flatnonzero(sizes < TREE_WALK_MIN)
    small = small[np.argsort(-sizes[small], kind="stable")]
    while len(small):
        take = max(1, STEP_CELLS // max(int(sizes[small[0]]), 1))
        group, small = small[:take], small[take:]
        rows = [starts[i] + np.flatnonzero(placed[starts[i]:ends[i]]) for i in group]
        for i, at, order in zip(group, rows, _orders_in_step(rows, pe, pn, de, dn)):
            apart = np.flatnonzero(~placed[starts[i]:ends[i]])
            out[i] = np.concatenate([at[order] - starts[i], apart])
    return out


def _orders_in_step(rows, pe, pn, de, dn) -> list[np.ndarray]:
    """Greedy orders of batches of placed rows, all batches one step at a time."""
    length = np.array([len(r) for r in rows])
    width = int(length.max()) if len(length) else 0
    if not width:
        return [np.empty(0, dtype=np.int64) for _ in rows]
    x = np.full((len(rows), width), np.inf)
    y, to_x, to_y = np.zeros_like(x), np.zeros_like(x), np.zeros_like(x)
    for k, r in enumerate(rows):
        x[k, :len(r)], y[k, :len(r)], to_x[k, :len(r)], to_y[k, :len(r)] = pe[r], pn[r], de[r], dn[r]
    every = np.arange(len(rows))
    order = np.zeros((len(rows), width), dtype=np.int64)
    cur = np.zeros(len(rows), dtype=np.int64)
    x[:, 0] = np.inf
    for step in range(1, width):  # a finished batch goes on over infinities; its entries are cut off
        dx = x - to_x[every, cur][:, None]
        dy = y - to_y[every, cur][:, None]
        cur = np.argmin(np.sqrt(dx * dx + dy * dy), axis=1)  # first minimum = lowest row
        order[:, step] = cur
        x[every, cur] = np.inf
    return [order[k, :n] for k, n in enumerate(length)]


def _walk_sorted(pdf: pd.DataFrame) -> pd.DataFrame:
    """Walks every batch of a frame sorted by ``(batch_id, rn)``."""
    bids = pdf["batch_id"].to_numpy()
    starts = np.flatnonzero(np.r_[True, bids[1:] != bids[:-1]])
    ends = np.r_[starts[1:], len(bids)]
    pe, pn, de, dn = (pdf[c].to_numpy(dtype=np.float64) for c in ("pe", "pn", "de", "dn"))
    ids = pdf["delivery_id"].to_numpy()
    keep_parts, seq_parts = [], []
    for a, order in zip(starts, greedy_orders(starts, ends, pe, pn, de, dn)):
        visit = a + order
        _, first = np.unique(ids[visit], return_index=True)
        kept = visit[np.sort(first)]
        keep_parts.append(kept)
        seq_parts.append(np.arange(1, len(kept) + 1, dtype=np.int32))
    keep = np.concatenate(keep_parts)
    return pdf.iloc[keep].assign(visit_seq=np.concatenate(seq_parts))


def walk_partition(chunks):
    """``mapInPandas`` body: walks the batches of one partition sorted by ``(batch_id, rn)``."""
    for pdf in whole_batches(chunks):
        yield _walk_sorted(pdf)


_WALK_FIELDS = [
    T.StructField("batch_id", T.LongType()),
    T.StructField("rn", T.IntegerType()),
    T.StructField("delivery_id", T.LongType()),
    T.StructField("pickup_lat", T.DoubleType()),
    T.StructField("pickup_lon", T.DoubleType()),
    T.StructField("dropoff_lat", T.DoubleType()),
    T.StructField("dropoff_lon", T.DoubleType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("pe", T.DoubleType()),
    T.StructField("pn", T.DoubleType()),
    T.StructField("de", T.DoubleType()),
    T.StructField("dn", T.DoubleType()),
    T.StructField("visit_seq", T.IntegerType()),
]
WALK_SCHEMA = T.StructType(_WALK_FIELDS)


def route_nearest(batched: DataFrame, spread: int = 1) -> DataFrame:
    """The route as documented: greedy nearest neighbour per batch.

    Rows are hash-partitioned by ``batch_id`` (the exchange the batch-zone
    window already needs), sorted by ``(batch_id, rn)`` inside each
    partition, and walked by ``mapInPandas`` many batches per Arrow chunk.
    Batches run in parallel; each holds at most ``batch_size`` rows. Where
    batches are few and long, ``spread`` takes more partitions, so that no
    task walks several while others have none.
    """
    from waybatch.session import ship_package

    ship_package(batched.sparkSession)
    z = with_projection(batched, spread)
    cols = [f.name for f in _WALK_FIELDS if f.name != "visit_seq"]
    z = z.select(*[F.col(c).cast(WALK_SCHEMA[c].dataType) for c in cols])
    walked = z.sortWithinPartitions("batch_id", "rn").mapInPandas(walk_partition, schema=WALK_SCHEMA)
    return _route_columns(walked)


def route(batched: DataFrame, mode: str = "nearest", dedup_scope: str = "batch", spread: int = 1) -> DataFrame:
    if mode == "input_order":
        return route_input_order(batched, dedup_scope=dedup_scope)
    if mode == "nearest":
        if dedup_scope != "batch":
            raise ValueError("mode='nearest' dedups per batch only")
        return route_nearest(batched, spread)
    raise ValueError(f"mode must be one of {ROUTE_MODES}, got {mode!r}")


def leg_distance(routed: DataFrame) -> DataFrame:
    """Planar distance (degrees) from each pickup to the next one on the route."""
    w = Window.partitionBy("batch_id").orderBy("visit_seq")
    nxt_lon = F.lead("pickup_lon").over(w)
    nxt_lat = F.lead("pickup_lat").over(w)
    legs = routed.select(
        "batch_id",
        "visit_seq",
        planar_distance("pickup_lon", "pickup_lat", nxt_lon, nxt_lat).alias("leg_deg"),
    )
    return legs.filter(F.col("leg_deg").isNotNull())


def route_length(routed: DataFrame, mode: str) -> DataFrame:
    """Per batch: loaded legs (pickup -> own dropoff) and empty legs (dropoff
    -> next pickup) in whole millimetres, UTM metres of the batch's zone."""
    z = with_projection(routed)
    w = Window.partitionBy("batch_id").orderBy("visit_seq")
    to_mm = lambda c: F.round(c * F.lit(1000.0)).cast("long")
    loaded = to_mm(planar_distance("pe", "pn", "de", "dn"))
    empty = to_mm(planar_distance("de", "dn", F.lead("pe").over(w), F.lead("pn").over(w)))
    legs = z.select("batch_id", loaded.alias("loaded_mm"), empty.alias("empty_mm"))
    return legs.groupBy("batch_id").agg(
        F.lit(mode).alias("mode"),
        F.count(F.lit(1)).alias("n_stops"),
        F.sum("loaded_mm").alias("loaded_mm"),
        F.coalesce(F.sum("empty_mm"), F.lit(0).cast("long")).alias("empty_mm"),
    ).withColumn("total_mm", F.col("loaded_mm") + F.col("empty_mm"))


def optimize_routes(
    deliveries: DataFrame,
    order_by="delivery_id",
    batch_size: int = 100,
    mode: str = "nearest",
    dedup_scope: str = "batch",
) -> DataFrame:
    """Whole optimisation: sequence, fixed-size batches, route, WKT geometry.

    ``order_by`` is a unique key or ``"file_order"`` (rows read with
    ``with_file_order``). Output: ``batch_id, visit_seq, rn`` and the
    delivery columns with ``geometry``; order is carried in columns.
    """
    batched = assign_batches(deliveries, order_by, batch_size)
    spread = LONG_BATCH_SPREAD if batch_size >= TREE_WALK_MIN else 1
    return route(batched, mode=mode, dedup_scope=dedup_scope, spread=spread)
