"""Exact Jaccard join of word shingle sets, as classes of linked documents.

Index: a set's elements in one fixed order, rare first (by hashed counts over
all documents), of which only the first ``n - ceil(t n) + 1`` are listed; two
linked sets share one of these. Lists are walked in order of set size, and
whole stretches are skipped by size, by position, and by set relations:

1. Equal sets are one set.
2. A list is walked with open pairs taken as links: a set is compared only
   with sets that those do not already tie to it, so that a group of near
   copies costs a pair a member, not a pair a pair. These pairs are verified
   on the whole sets.
3. Sets that open pairs connect are a cluster; no link leaves it. A cluster all
   of whose pairs are verified is done: what was skipped is implied by links.
   In a cluster with a pair that failed, each set's answers are derived from
   those of one set, the pivot: sets are what they lack of the pivot and have
   besides it, and two sets' intersection is the pivot's size, less what either
   lacks, plus what both lack and what both have besides. So all pairs of a
   cluster cost their differences from the pivot only, and none is ever a row:
   what leaves a task are links, at most one a set.

"Open" is what size, position and parity leave open: parities of two sets,
taken at the width of the smaller one, bound the number of differing elements
exactly from below.

No step emits the pairs within a group, and none has a cap: long lists and large
clusters are cut into bands of set size, of which only neighbours can be linked,
and these are dealt out as pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybatch.llm.common import (
    SPACE, binaries, mix, prepared, ragged, release, small, steps, table, text_buffers, word_hashes, word_spans,
)
from waybatch.llm.components import connected_components

#: Counters of the hashed element counts, in chunks of so many.
COUNTERS, CHUNK = 1 << 21, 1 << 15
#: Sets of a list, and elements of a cluster's sets, that one task compares with each other.
BLOCK, BLOCK_ELEMENTS = 1024, 1 << 21
#: Bits of the largest parity.
MAX_BITS = 1 << 13

_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, joined; and set sizes.
    Words are runs of bytes other than white space, A-Z lower-cased; a text
    with fewer words than a shingle has its whole sequence as one."""
    data, offsets = text_buffers(texts)
    starts, ends, before = word_spans(data, offsets, SPACE)
    h = word_hashes(data, starts, ends)
    counts = np.diff(before)
    n = np.where(counts >= words, counts - words + 1, (counts > 0).astype(np.int64))
    doc, place = ragged(n)
    first = before[:-1][doc] + place
    with np.errstate(over="ignore"):
        g = np.zeros(len(doc), np.uint64)
        multiplier = np.uint64(0xD1B54A32D192ED03)
        for j in range(words):
            have = j < counts[doc]
            g = g * multiplier
            g[have] += h[np.minimum(first + j, max(len(h) - 1, 0))[have]] + np.uint64(j + 1)
        g = mix(g)
    order = np.lexsort((g, doc))
    g, doc = g[order], doc[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
    return g[new], np.bincount(doc[new], minlength=len(counts)).astype(np.int64)


def _keys(g: np.ndarray, n: np.ndarray) -> list[bytes | None]:
    """128-bit keys of sets: two sums of differently mixed elements."""
    edges = np.concatenate([[0], np.cumsum(n)])
    with np.errstate(over="ignore"):
        sums = []
        for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
            s = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(g ^ np.uint64(salt)))])
            sums.append(s[edges[1:]] - s[edges[:-1]])
    both = np.stack(sums, 1)
    return [both[i].tobytes() if n[i] else None for i in range(len(n))]


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches, "text"):
            g, n = shingle_sets(b.column("text"), words)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n), pa.array(_keys(g, n), pa.binary())], ["doc_id", "n", "key"])
    return run


def _counted(words: int):
    """Elements of this task's sets, counted by hash; a row for each chunk of counters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.uint32)
        some = False
        for b in steps(batches, "text", 4_000_000):
            g, _ = shingle_sets(b.column("text"), words)
            total += np.bincount((g >> np.uint64(40)).astype(np.int64) % COUNTERS, minlength=COUNTERS).astype(np.uint32)
            some = True
        if some:
            parts = total.reshape(-1, CHUNK)
            kind = np.uint8 if total.max() < 256 else np.uint32
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(parts), dtype=np.int32)), pa.array([p.astype(kind).tobytes() for p in parts], pa.binary())],
                ["chunk", "counts"])
    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums the counters of each chunk as they stream in; holds the chunks only."""
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for chunk, counts in zip(b.column("chunk").to_pylist(), b.column("counts").to_pylist(), strict=True):
            kind = np.uint8 if len(counts) == CHUNK else np.uint32
            sums = total.setdefault(chunk, np.zeros(CHUNK, np.uint64))
            sums += np.frombuffer(counts, kind)
    for chunk, sums in total.items():
        level = np.minimum(np.log2(sums + 1.0) * 8, 255).astype(np.uint8)
        yield pa.RecordBatch.from_arrays(
            [pa.array([chunk], pa.int32()), pa.array([level.tobytes()], pa.binary())], ["chunk", "counts"])


def element_levels(reps: DataFrame, words: int) -> np.ndarray:
    """How common elements are, by hash: a table of fixed size (``COUNTERS``
    bytes), from counts over all sets. Any order of elements gives whole
    results; this one keeps common elements out of the index."""
    rows = (reps.mapInArrow(_counted(words), "chunk int, counts binary")
            .repartition(COUNTERS // CHUNK, "chunk").mapInArrow(_added, "chunk int, counts binary").collect())
    levels = np.zeros((COUNTERS // CHUNK, CHUNK), np.uint8)
    for r in rows:
        levels[r["chunk"]] = np.frombuffer(bytes(r["counts"]), np.uint8)
    return levels.reshape(-1)


def _parity(g: np.ndarray, bits: int) -> bytes:
    """Bit b: whether an odd number of elements fall on b. Two sets' parities
    differ in at most as many bits as the sets have differing elements."""
    odd = np.bincount((g & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _bits(n: int) -> int:
    return min(MAX_BITS, max(64, 1 << int(n - 1).bit_length()))


def _index(words: int, percent: int, levels):
    """Index entries ``(token, node, at)``, ``at`` being set size and place in
    one number; place 0 has the set's parity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = levels.value
        for b in steps(batches, "text"):
            g, n = shingle_sets(b.column("text"), words)
            if len(g) == 0:
                continue
            ids = b.column("doc_id").to_numpy(zero_copy_only=False)
            doc, _ = ragged(n)
            order = np.lexsort((g, level[(g >> np.uint64(40)).astype(np.int64) % COUNTERS], doc))
            _, place = ragged(n)
            keep = place < (n - (percent * n + 99) // 100 + 1)[doc]
            token, d, place = g[order][keep], doc[keep], place[keep]
            edges = np.concatenate([[0], np.cumsum(n)])
            parities = np.empty(len(token), object)
            heads = np.flatnonzero(place == 0)
            for i in heads:
                parities[i] = _parity(g[edges[d[i]]:edges[d[i] + 1]], _bits(int(n[d[i]])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(token.view(np.int64)), pa.array(ids[d], pa.int64()), pa.array(n[d] << 32 | place), pa.array(parities, pa.binary())],
                ["token", "node", "at", "parity"])
    return run


def _whole_groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """Columns of a key-sorted stream, cut so that no key's rows are split.
    Chunks hold whole keys; a key's rows are slim and of one partition."""
    held: list[dict[str, np.ndarray]] = []

    def joined():
        return {c: np.concatenate([h[c] for h in held]) for c in names}

    for b in batches:
        if b.num_rows == 0:
            continue
        now = {c: b.column(c).to_numpy(zero_copy_only=False) for c in names}
        key = now[names[0]]
        others = np.flatnonzero(key != key[-1])
        if len(others):
            last = int(others[-1]) + 1
            held.append({c: v[:last] for c, v in now.items()})
            yield joined()
            held = [{c: v[last:] for c, v in now.items()}]
        else:
            if held and held[0][names[0]][0] != key[0]:
                yield joined()
                held = []
            held.append(now)
    if held:
        yield joined()
        held.clear()
    release()


def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
    return starts, np.concatenate([starts[1:], [len(key)]])


def _needed(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Least intersection with which sets of these sizes are linked."""
    return -((-percent * (a.astype(np.int64) + b)) // (100 + percent))


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of key-sorted lists: the entries of lists with two sets or more, that is
    those whose token the row before or behind has. One row is held back."""
    names = ["token", "at", "node"]
    held = {c: np.zeros(0, np.int64) for c in names}
    before = None  # the token of the row before
    for b in batches:
        if b.num_rows == 0:
            continue
        now = {c: np.concatenate([held[c], b.column(c).to_numpy(zero_copy_only=False)]) for c in names}
        token = now["token"]
        same = token[1:] == token[:-1]
        keep = same.copy()  # of all rows but the last
        keep[1:] |= same[:-1]
        if len(keep) and before is not None:
            keep[0] |= before == token[0]
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(now[c][:-1][keep]) for c in names], names)
        if len(token) > 1:
            before = token[-2]
        held = {c: v[-1:] for c, v in now.items()}
    if before is not None and len(held["token"]) and held["token"][0] == before:
        yield pa.RecordBatch.from_arrays([pa.array(held[c]) for c in names], names)
    release()


def _fold(rows: list[bytes], size: int) -> np.ndarray:
    """Parities cut to ``size`` bytes each by xor of their parts."""
    out = np.empty((len(rows), size), np.uint8)
    for i, r in enumerate(rows):
        out[i] = np.bitwise_xor.reduce(np.frombuffer(r, np.uint8).reshape(-1, size), 0)
    return out


def _arrays(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches, "text"):
            g, n = shingle_sets(b.column("text"), words)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), binaries(g, n)], ["node", "elements"])
    return run


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            linked = np.zeros(b.num_rows, bool)
            for i, (x, y) in enumerate(zip(b.column("xa"), b.column("xb"), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked[i] = 100 * both >= percent * (len(x) + len(y) - both) and both > 0
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(linked)], ["a", "b", "linked"])
    return run


class _Parities:
    """Parities of one list's sets in order of size, at any set's width. Sets
    that a set is compared with are as large or larger, and so as wide or wider."""

    def __init__(self, parities: list[bytes]):
        self.rows, self.widths, self.folded = parities, np.array([len(x) for x in parities]), {}

    def distances(self, i: int, j: np.ndarray) -> np.ndarray:
        """In how many bits the set ``i`` differs from each of ``j``, at its width."""
        width = int(self.widths[i])
        if width not in self.folded:
            first = int(np.argmax(self.widths >= width))
            self.folded[width] = first, _fold(self.rows[first:], width)
        first, at = self.folded[width]
        return _POP[at[j - first] ^ at[i - first]].sum(1, dtype=np.int64)


def _open(c: dict[str, np.ndarray], at: slice, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Of one list, by size: each set's place, and those after it with which
    size, position and parity leave a link open, but for what is implied once
    the open pairs given so far are taken as links."""
    n, place, side = c["at"][at] >> 32, c["at"][at] & 0xFFFFFFFF, c["side"][at]
    known = np.unique(c["node"][at], return_inverse=True)[1]
    parities = _Parities(c["parity"][at].tolist())
    two_sided = (side != side[0]).any()
    stop = np.searchsorted(n, 100 * n // percent, "right")
    for i in range(len(n) - 1):
        j = np.arange(i + 1, max(stop[i], i + 1))
        j = j[known[j] != known[i]]
        if two_sided:
            j = j[side[j] != side[i]]
        need = _needed(n[j], n[i], percent)
        keep = np.minimum(n[j] - place[j], n[i] - place[i]) >= need
        j, need = j[keep], need[keep]
        if len(j):
            j = j[parities.distances(i, j) <= n[j] + n[i] - 2 * need]
        if len(j):
            classes, first = np.unique(known[j], return_index=True)
            j = j[first]
            known[np.isin(known, classes)] = known[i]
            yield i, j


def _across(percent: int):
    """Candidate pairs of key-sorted lists."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in _whole_groups(batches, ["cell", "at", "node", "side", "parity"]):
            found = []
            for s, e in zip(*_runs(c["cell"]), strict=True):
                node = c["node"][s:e]
                found += [(np.full(len(j), node[i]), node[j]) for i, j in _open(c, slice(s, e), percent)]
            if found:
                a, b = (np.concatenate(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["a", "b"])
    return run


def _dealt(rows: DataFrame, key: str, weight, block: int, percent: int) -> DataFrame:
    """Rows ``(key, node, n, ...)`` with a ``cell`` whose sets one task compares,
    and a ``side``: sets of one side only are compared elsewhere.

    A key of up to ``block`` in weight is one cell. A heavier one is cut into
    bands of set size, in each of which sizes grow by a little more than ``100 /
    percent``, so that sets can only be linked within a band or with the next
    one. Bands are cut
    into blocks by hash, and each pair of blocks of one band or of two
    neighbours is a cell.
    """
    slim = rows.select(key, "n", weight.alias("weight"))
    heavy = slim.groupBy(key).agg(F.sum("weight").alias("total")).filter(F.col("total") > block).select(key)
    heavy = small(table(rows.sparkSession, heavy, "jaccard-heavy"))
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(101.0 / percent))).cast("int")
    whole = rows.join(heavy, key, "left_anti").withColumn("cell", F.xxhash64(key)).withColumn("side", F.lit(0))
    large = rows.join(heavy, key, "left_semi").withColumn("band", band)
    sizes = slim.join(heavy, key, "left_semi").withColumn("band", band).groupBy(key, "band").agg(
        F.ceil(F.sum("weight") / block).cast("int").alias("blocks"))
    sizes = small(table(rows.sparkSession, sizes, "jaccard-bands"))
    own = large.join(sizes, [key, "band"]).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    same = own.withColumn("other", other).select(
        *rows.columns, F.xxhash64(key, "band", F.least("own", "other"), F.greatest("own", "other")).alias("cell"),
        F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"))
    next_ = own.drop("blocks").join(sizes.withColumn("band", F.col("band") - 1), [key, "band"]).withColumn("other", other).select(
        *rows.columns, F.xxhash64(F.lit("next"), key, "band", "own", "other").alias("cell"), F.lit(0).alias("side"))
    last = own.drop("blocks").join(sizes.withColumn("band", F.col("band") + 1), [key, "band"]).withColumn("other", other).select(
        *rows.columns, F.xxhash64(F.lit("next"), key, F.col("band") - 1, "other", "own").alias("cell"), F.lit(1).alias("side"))
    return whole.select(*rows.columns, "cell", "side").union(same).union(next_).union(last)


def _candidates(spark: SparkSession, lists: DataFrame, parities: DataFrame, percent: int) -> DataFrame:
    """``(a, b)``: pairs to verify, of lists ``(token, n, at, node)``."""
    cells = (_dealt(lists, "token", F.lit(1), BLOCK, percent).join(parities, "node").select("cell", "at", "node", "side", "parity")
             .repartition("cell").sortWithinPartitions("cell", "at", "node"))
    return table(spark, cells.mapInArrow(_across(percent), "a long, b long").distinct(), "jaccard-pairs")


def _sets_of(spark: SparkSession, reps: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """``(node, elements)`` of the documents ``ids (doc_id)``."""
    return table(spark, reps.join(small(ids), "doc_id", "left_semi").mapInArrow(_arrays(words), "node long, elements binary"), "jaccard-elements")


def _verify(spark: SparkSession, reps: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """``(a, b, linked)``: the candidate pairs with what their whole sets say."""
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    sets = _sets_of(spark, reps, table(spark, ids, "jaccard-asked"), words)
    a = sets.select(F.col("node").alias("a"), F.col("elements").alias("xa"))
    b = sets.select(F.col("node").alias("b"), F.col("elements").alias("xb"))
    asked = pairs.join(a, "a").join(b, "b").select("a", "b", "xa", "xb").mapInArrow(_verified(percent), "a long, b long, linked boolean")
    # an id with several texts is linked if one of them is
    return table(spark, asked.groupBy("a", "b").agg(F.max("linked").alias("linked")), "jaccard-links")


def derived_links(sets: list[np.ndarray], side: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    """Links of sorted ``sets``, but for those that the ones given so far imply;
    of two sides, only links between them. A set is kept as what it lacks of the
    pivot, a set of middle size, and what it has besides it; the sets that share
    such elements are looked up by element."""
    n = np.array([len(x) for x in sets], np.int64)
    pivot = sets[int(np.argsort(n, kind="stable")[len(n) // 2])]
    lacks = [np.setdiff1d(pivot, x, assume_unique=True) for x in sets]
    besides = [np.setdiff1d(x, pivot, assume_unique=True) for x in sets]
    # no element is both lacked and had besides, so one index serves both
    own = [np.concatenate(x) for x in zip(lacks, besides, strict=True)]
    lengths = np.array([len(x) for x in own], np.int64)
    owner = np.repeat(np.arange(len(sets)), lengths)
    _, element = np.unique(np.concatenate(own), return_inverse=True)
    by_element = owner[np.argsort(element, kind="stable")]
    ends = np.concatenate([[0], np.cumsum(np.bincount(element))]) if len(element) else np.zeros(1, np.int64)
    edges = np.concatenate([[0], np.cumsum(lengths)])
    lacking = np.array([len(x) for x in lacks], np.int64)
    two_sided = (side != side[0]).any()
    known = np.arange(len(sets))
    for i in range(len(sets) - 1):
        mine = element[edges[i]:edges[i + 1]]
        group, place = ragged(ends[mine + 1] - ends[mine])
        shared = np.bincount(by_element[ends[mine][group] + place], minlength=len(sets))
        j = np.arange(i + 1, len(sets))
        both = len(pivot) - lacking[i] - lacking[j] + shared[j]
        j = j[(100 * both >= percent * (n[i] + n[j] - both)) & (both > 0) & (known[j] != known[i])]
        if two_sided:
            j = j[side[j] != side[i]]
        if len(j):
            classes, first = np.unique(known[j], return_index=True)
            known[np.isin(known, classes)] = known[i]
            for k in j[first]:
                yield i, int(k)


def _derived(percent: int):
    """Links of the cells of a cell-sorted stream; a cell is of bounded weight."""
    def links(rows: list[tuple]) -> Iterator[tuple[int, int]]:
        sets = [np.frombuffer(x, np.uint64) for _, _, _, x in rows]
        if len(rows) > 1:
            for i, j in derived_links(sets, np.array([r[1] for r in rows]), percent):
                a, b = rows[i][2], rows[j][2]
                if a != b:
                    yield max(a, b), min(a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["cell", "side", "node", "elements"]
        stream = (row for b in batches for row in zip(*(b.column(c).to_pylist() for c in names), strict=True))
        for _, rows in groupby(stream, key=lambda r: r[0]):
            found = list(links(list(rows)))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["a", "b"])
        release()
    return run


def _rest(spark: SparkSession, reps: DataFrame, asked: DataFrame, words: int, percent: int) -> DataFrame:
    """Links in clusters with a pair ``(a, b, linked)`` that is no link."""
    clusters = table(spark, connected_components(spark, asked), "jaccard-clusters")
    failed = asked.filter("not linked").select(F.col("a").alias("node"))
    open_ = small(table(spark, failed.join(clusters, "node").select("component").distinct(), "jaccard-open"))
    nodes = table(spark, clusters.join(open_, "component", "left_semi").select(F.col("node").alias("doc_id"), F.col("component").alias("cluster")), "jaccard-nodes")
    sets = _sets_of(spark, reps, nodes.select("doc_id"), words)
    rows = nodes.withColumnRenamed("doc_id", "node").join(sets, "node").withColumn("n", (F.octet_length("elements") / 8).cast("long"))
    cells = _dealt(rows.filter("n > 0"), "cluster", F.col("n"), BLOCK_ELEMENTS, percent)
    cells = cells.select("cell", "side", "node", "elements").repartition("cell").sortWithinPartitions("cell", "node")
    return table(spark, cells.mapInArrow(_derived(percent), "a long, b long").distinct(), "jaccard-rest")


def link_classes(spark: SparkSession, docs: DataFrame, words: int = 5, percent: int = 80,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for each row of ``docs``.

    Documents are linked if ``100 * intersection >= percent * union`` of their
    shingle sets; ``component_id`` is the least id reachable by links, the own
    included. Null and empty texts have an empty set and are linked with
    nothing; repeated rows give repeated rows, and rows that share an id count
    as one document with several texts. Null ids give a null component and
    link nothing. Whole texts of any length count. Other columns are ignored.
    """
    prepared(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    slim = table(spark, docs.mapInArrow(_sets(words), "doc_id long, n long, key binary"), "jaccard-sets")
    with_set = slim.filter("key is not null and doc_id is not null")
    classes = with_set.groupBy("key").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("copies"))
    classes = table(spark, classes.filter("copies > 1").select("key", "node"), "jaccard-classes")
    copies = table(spark, with_set.join(small(classes), "key").select("doc_id", "node"), "jaccard-copies")
    spare = copies.filter("doc_id <> node").select("doc_id").distinct()
    spare = spare.join(copies.filter("doc_id = node").select("doc_id").distinct(), "doc_id", "left_anti")
    reps = docs.filter("doc_id is not null").join(small(spare), "doc_id", "left_anti")

    levels = spark.sparkContext.broadcast(element_levels(reps, words))
    entries = table(spark, reps.mapInArrow(_index(words, percent, levels), "token long, node long, at long, parity binary"), "jaccard-index")
    parities = entries.filter("parity is not null").select("node", "parity")
    lists = entries.select("token", "at", "node").repartition("token").sortWithinPartitions("token", "at", "node")
    lists = table(spark, lists.mapInArrow(_listed, "token long, at long, node long"), "jaccard-lists")
    lists = lists.select("token", F.shiftright("at", 32).alias("n"), "at", "node")
    asked = _verify(spark, reps, _candidates(spark, lists, parities, percent), words, percent)
    links = asked.filter("linked").select("a", "b").union(_rest(spark, reps, asked, words, percent))
    found = connected_components(spark, copies.select(F.col("doc_id").alias("a"), F.col("node").alias("b")).union(links))
    return slim.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def keep_one(spark: SparkSession, docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose document has the least id of its class of
    linked documents; one row where that id is repeated. Rows with a null id
    stay."""
    classes = table(spark, link_classes(spark, docs, words, percent).select("doc_id", "component_id"), "jaccard-classes")
    gone = classes.filter("doc_id <> component_id").select("doc_id").distinct()
    repeated = table(spark, classes.filter("doc_id = component_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
                     .filter("rows > 1").select("doc_id"), "jaccard-repeated")
    left = docs.join(small(gone), "doc_id", "left_anti").select(*docs.columns)
    if repeated.isEmpty():
        return left
    once = left.join(small(repeated), "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id"])
    return left.join(small(repeated), "doc_id", "left_anti").select(*docs.columns).unionByName(once)
