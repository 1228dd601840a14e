"""Nearest foreign dropoff of every pickup, many batches at once, on arrays.

Works inside tasks on NumPy arrays of whole batches. Dropoffs at one place
are one entry with its two lowest rows, so a place that many deliveries
share (a default coordinate) is looked at once. The places of a batch are
cut into strips of equal count along the easting and sorted by northing
inside each strip, so dense and sparse parts of a batch are cut alike.

A first look at the neighbours in three strips bounds each pickup's
distance; then all places in the strips and northing ranges within that
bound are compared. The result equals the scan of all pairs, ties
included (lowest dropoff row).
"""

from __future__ import annotations

import numpy as np

# Pickups whose strips are expanded at once, and candidates compared at once.
PICKUPS_AT_ONCE = 16_384
CANDIDATES_AT_ONCE = 2_000_000
_SLACK = 1e-6  # metres: bounds are widened past the rounding of their sums
_NO_ROW = np.iinfo(np.int64).max


def _bisect(values, lo, hi, query, right=False):
    """First position in ``lo..hi`` (per query) whose value is not below the
    query, or with ``right`` is above it; ``values`` ascend within each range."""
    lo, hi = lo.copy(), hi.copy()
    open_ = lo < hi
    while open_.any():
        mid = (lo + hi) >> 1
        v = values[np.minimum(mid, len(values) - 1)]
        below = (v <= query) if right else (v < query)
        lo = np.where(open_ & below, mid + 1, lo)
        hi = np.where(open_ & ~below, mid, hi)
        open_ = lo < hi
    return lo


def _ranges(start, count):
    """``start[i] .. start[i] + count[i] - 1`` for all i, one after the other."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - count), count)


class _Strips:
    def __init__(self, batch, n_batches, de, dn, row):
        by_place = np.lexsort((row, dn, de, batch))
        b, x, y, r = batch[by_place], de[by_place], dn[by_place], row[by_place]
        new = np.r_[True, (b[1:] != b[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])]
        at = np.flatnonzero(new)
        several = np.diff(np.r_[at, len(b)]) > 1
        second = np.full(len(at), -1, dtype=np.int64)
        second[several] = r[at[several] + 1]
        b, x, y, first = b[at], x[at], y[at], r[at]
        places = np.bincount(b, minlength=n_batches)
        size = np.maximum(np.ceil(np.sqrt(places)).astype(np.int64), 1)
        strips = -(-places // size)
        self.base = np.r_[0, np.cumsum(strips)]  # first strip of each batch
        offset = np.r_[0, np.cumsum(places)]
        strip = self.base[b] + (np.arange(len(b)) - offset[b]) // size[b]
        self.start = np.searchsorted(strip, np.arange(self.base[-1] + 1))
        self.west, self.east = x[self.start[:-1]], x[self.start[1:] - 1]
        order = np.lexsort((y, strip))
        self.x, self.y, self.first, self.second = x[order], y[order], first[order], second[order]

    def foreign(self, place, row):
        """Lowest dropoff row at a place that isn't the pickup's own; -1 if none."""
        return np.where(self.first[place] == row, self.second[place], self.first[place])

    def bound(self, batch, px, py, row):
        """An upper bound of each pickup's nearest distance (inf: none seen)."""
        lo, hi = self.base[batch], self.base[batch + 1]
        own = np.clip(_bisect(self.west, lo, hi, px, right=True) - 1, lo, hi - 1)
        best = np.full(len(px), np.inf)
        for step in (-1, 0, 1):
            s = np.clip(own + step, lo, hi - 1)
            a, z = self.start[s], self.start[s + 1]
            at = _bisect(self.y, a, z, py)
            for near in (-2, -1, 0, 1):
                p = np.clip(at + near, a, z - 1)
                dx, dy = self.x[p] - px, self.y[p] - py
                d = np.sqrt(dx * dx + dy * dy)
                best = np.where((self.foreign(p, row) >= 0) & (d < best), d, best)
        return best

    def nearest(self, batch, px, py, row):
        """(dropoff row or -1, distance) of pickups, a bounded number of candidates at a time."""
        out_row, out_dist = np.full(len(px), -1, dtype=np.int64), np.full(len(px), np.inf)
        for i in range(0, len(px), PICKUPS_AT_ONCE):
            part = slice(i, i + PICKUPS_AT_ONCE)
            out_row[part], out_dist[part] = self._nearest(batch[part], px[part], py[part], row[part])
        return out_row, out_dist

    def _nearest(self, batch, px, py, row):
        reach = self.bound(batch, px, py, row) + _SLACK
        lo, hi = self.base[batch], self.base[batch + 1]
        west = _bisect(self.east, lo, hi, px - reach)
        east = _bisect(self.west, lo, hi, px + reach, right=True)
        n_strips = np.maximum(east - west, 0)
        strip, who = _ranges(west, n_strips), np.repeat(np.arange(len(px)), n_strips)
        gap = np.maximum(np.maximum(self.west[strip] - px[who], px[who] - self.east[strip]), 0.0)
        half = np.sqrt(np.maximum(reach[who] ** 2 - gap**2, 0.0)) + _SLACK
        a, z = self.start[strip], self.start[strip + 1]
        south = _bisect(self.y, a, z, py[who] - half)
        count = _bisect(self.y, a, z, py[who] + half, right=True) - south
        per_pickup = np.bincount(who, weights=count, minlength=len(px)).astype(np.int64)
        best_row, best_dist = np.full(len(px), -1, dtype=np.int64), np.full(len(px), np.inf)
        block = np.cumsum(per_pickup) // CANDIDATES_AT_ONCE
        for k in np.unique(block):
            p0, p1 = np.searchsorted(block, k), np.searchsorted(block, k, side="right")
            s0, s1 = np.searchsorted(who, p0), np.searchsorted(who, p1)
            place, mine = _ranges(south[s0:s1], count[s0:s1]), np.repeat(who[s0:s1], count[s0:s1])
            dst = self.foreign(place, row[mine])
            place, mine, dst = place[dst >= 0], mine[dst >= 0], dst[dst >= 0]
            if not len(mine):
                continue
            dx, dy = self.x[place] - px[mine], self.y[place] - py[mine]
            d = np.sqrt(dx * dx + dy * dy)
            head = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])
            least = np.minimum.reduceat(d, head)
            tied = np.where(d == np.repeat(least, np.diff(np.r_[head, len(d)])), dst, _NO_ROW)
            best_row[mine[head]], best_dist[mine[head]] = np.minimum.reduceat(tied, head), least
        return best_row, best_dist


def nearest_foreign(batch_id, row, pe, pn, de, dn):
    """(positions, dropoff rows, distances): for each position whose pickup has
    a foreign dropoff in its batch, the nearest one (lowest row on ties).
    ``batch_id`` ascends; ``row`` is unique in a batch. A pickup or a
    dropoff without a place (null, NaN, infinite) takes no part; equal
    places are compared like any others."""
    none = np.empty(0, dtype=np.int64)
    if not len(batch_id):
        return none, none, np.empty(0)
    batch = np.cumsum(np.r_[0, batch_id[1:] != batch_id[:-1]])
    drop = np.flatnonzero(np.isfinite(de) & np.isfinite(dn))
    has_drop = np.bincount(batch[drop], minlength=batch[-1] + 1) > 0
    pick = np.flatnonzero(np.isfinite(pe) & np.isfinite(pn) & has_drop[batch])
    if not len(pick):
        return none, none, np.empty(0)
    strips = _Strips(batch[drop], batch[-1] + 1, de[drop], dn[drop], row[drop])
    dst, dist = strips.nearest(batch[pick], pe[pick], pn[pick], row[pick])
    found = dst >= 0
    return pick[found], dst[found], dist[found]
