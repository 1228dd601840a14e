"""Prefix trie of conversations: for each shared beginning, who shares it and
what caching it would save.

Turns become ids by a dictionary, and a conversation a sequence of ids. Equal
sequences are one, with their number and the digest of their members. Sequences
are dealt to shards by ranges of their order, so that a shard holds neighbours;
each shard inserts its sequences into a ternary search tree, the median first,
and accumulates members, leaves and savings by one walk from the youngest node
back to the root.

A node is in two shards only if it is a prefix of the last sequence of one and
of the first of the next. Such boundary nodes are given out as parts with the
hash of their prefix, and merged by one aggregation, as all that is counted is
a sum or a minimum over shards: sequences are different, so a boundary node
always has a child and is no leaf; and what counts once a node (the node as a
child, and the one member that pays) is counted in the first shard that has it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybatch.llm.common import prepared, release, small, table
from waybatch.session import checkpoint_root

#: Turns of a shard (about 300 bytes of a task's memory each).
SHARD_TURNS = 200_000
#: Members whose ids one row holds on the way to their digest.
CHUNK_IDS = 4096
#: The digest of no members.
NO_MEMBERS = hashlib.sha256(b"").hexdigest()

_NODE = ("key binary, parent_key binary, depth long, conv_id long, parent_conv_id long, n_convs long, "
         "n_children long, n_leaves long, saved_tokens long, ends_sha256 string")


def turn_sequences(spark: SparkSession, conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(conv_id, ids, sizes)`` of each conversation, and the dictionary
    ``(id, digest, role, text)`` that the ids come from.

    Turns are ordered by ``turn`` (null first), those of one number by a digest
    of role and text; ``sizes`` are the UTF-8 bytes of their texts. A null role
    or text is empty, rows without ``conv_id`` belong to no conversation,
    repeated rows are repeated turns, other columns are ignored. A conversation
    is one row: 16 bytes a turn in a task.
    """
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                 F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).filter("conv_id is not null")
    named = turns.withColumn("digest", F.unhex(F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text").cast("binary"))))
    slim = table(spark, named.select("conv_id", "turn", "digest", F.octet_length("text").cast("long").alias("size")), "trie-turns")
    dictionary = table(spark, slim.select("digest").distinct().withColumn("id", F.monotonically_increasing_id()), "trie-dictionary")
    coded = slim.join(small(dictionary), "digest")
    ordered = coded.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "digest", "id", "size"))).alias("t"))
    words = named.join(dictionary, "digest").groupBy("id").agg(F.first("digest").alias("digest"), F.first("role").alias("role"), F.first("text").alias("text"))
    return ordered.select("conv_id", F.col("t.id").alias("ids"), F.col("t.size").alias("sizes")), words


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key and id: the ids of a key, joined, in rows of at most ``CHUNK_IDS``."""
    for b in batches:
        keys, ids = b.column("key").to_pylist(), b.column("conv_id").to_pylist()
        out, start = [], 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i] != keys[start] or i - start == CHUNK_IDS:
                out.append((keys[start], ids[start], ",".join(map(str, ids[start:i]))))
                start = i
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*out, strict=True), (pa.binary(), pa.int64(), pa.string()), strict=True)], ["key", "first", "joined"])


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's joined ids as they stream by; nothing is held."""
    key, h = None, None
    give = lambda: pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([h.hexdigest()])], ["key", "ends"])
    for b in batches:
        for k, joined in zip(b.column("key").to_pylist(), b.column("joined").to_pylist(), strict=True):
            if k != key:
                if h is not None:
                    yield give()
                key, h = k, hashlib.sha256()
            else:
                h.update(b",")
            h.update(joined.encode())
    if h is not None:
        yield give()


def distinct_sequences(spark: SparkSession, sequences: DataFrame) -> DataFrame:
    """``(ids, sizes, conv_id, n, ends)``: different sequences with their least
    conversation, the number of conversations, and the digest of these.

    Copies are counted before the shuffle. The ids of a much-copied sequence
    are sorted and joined by ranges in many tasks; one task streams what they
    joined through the digest, which can't be computed in parts.
    """
    keyed = table(spark, sequences.withColumn("key", F.unhex(F.md5(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary")))), "trie-sequences")
    classes = table(spark, keyed.groupBy("key").agg(F.min(F.struct("conv_id", "ids", "sizes")).alias("s"), F.count(F.lit(1)).alias("n")), "trie-classes")
    copied = small(classes.filter("n > 1").select("key"))
    members = table(spark, keyed.select("key", "conv_id").join(copied, "key", "left_semi"), "trie-copies")
    chunks = members.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(_chunks, "key binary, first long, joined string")
    ends = chunks.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_digested, "key binary, ends string")
    return classes.join(ends, "key", "left").select(
        "s.ids", "s.sizes", "s.conv_id", "n", F.coalesce("ends", F.sha2(F.col("s.conv_id").cast("string").cast("binary"), 256)).alias("ends"))


class TernaryTree:
    """A ternary search tree over sequences of ids. Node 0 is the textless
    root; a node comes after its parent. ``low`` and ``high`` lead to other
    children of the same parent, ``equal`` to a child."""

    def __init__(self):
        self.label, self.low, self.high, self.equal = [-1], [-1], [-1], [-1]
        self.parent, self.depth, self.size = [-1], [0], [0]

    def _new(self, label: int, parent: int, size: int) -> int:
        v = len(self.label)
        for column, value in ((self.label, label), (self.low, -1), (self.high, -1), (self.equal, -1),
                              (self.parent, parent), (self.depth, self.depth[parent] + 1), (self.size, size)):
            column.append(value)
        return v

    def insert(self, ids: list[int], sizes: list[int]) -> int:
        """The node at the end of the sequence."""
        label, u = self.label, 0
        for t, size in zip(ids, sizes, strict=True):
            v = self.equal[u]
            if v < 0:
                v = self.equal[u] = self._new(t, u, size)
            while label[v] != t:
                side = self.low if t < label[v] else self.high
                if side[v] < 0:
                    side[v] = self._new(t, u, size)
                v = side[v]
            u = v
        return u

    def path(self, u: int) -> list[int]:
        """The nodes from the root to ``u``."""
        found = [u]
        while found[-1]:
            found.append(self.parent[found[-1]])
        return found[::-1]


def median_first(n: int) -> Iterator[int]:
    """0 .. n - 1, the middle of each stretch before the rest of it."""
    open_ = [(0, n)]
    while open_:
        a, b = open_.pop()
        if a < b:
            m = (a + b) // 2
            yield m
            open_ += [(m + 1, b), (a, m)]


def _shard_nodes(rows: list[tuple], left: int, right: int) -> Iterator[tuple]:
    """The nodes of a shard's sorted sequences ``(ids, sizes, conv_id, n, ends)``.
    Nodes of up to ``left`` turns of the first one are also in the shard before,
    those of up to ``right`` turns of the last one in the shard behind (-1: none)."""
    tree = TernaryTree()
    ends_at: dict[int, tuple] = {}
    for i in median_first(len(rows)):
        ids, sizes, conv_id, n, ends = rows[i]
        ends_at[tree.insert(ids, sizes)] = (conv_id, n, ends, i)
    at = {i: u for u, (*_, i) in ends_at.items()}
    before, behind = set(tree.path(at[0])[:left + 1]), set(tree.path(at[len(rows) - 1])[:right + 1])
    boundary = before | behind
    total = len(tree.label)
    members, least, kids, leaves, saved = ([0] * total for _ in range(5))
    least = [1 << 63] * total
    inner = [False] * total  # has a child
    for u in range(total - 1, -1, -1):
        if u in ends_at:
            conv_id, n, *_ = ends_at[u]
            members[u] += n
            least[u] = min(least[u], conv_id)
        leaves[u] += not inner[u] and u not in boundary
        saved[u] += (members[u] - (u not in before)) * tree.size[u]
        p = tree.parent[u]
        if p >= 0:
            inner[p] = True
            members[p] += members[u]
            least[p] = min(least[p], least[u])
            kids[p] += u not in before
            leaves[p] += leaves[u]
            saved[p] += saved[u]
    keys: dict[int, bytes] = {}
    for path in (tree.path(at[0]), tree.path(at[len(rows) - 1])):
        h = hashlib.md5()
        for u in path:
            if u not in boundary:
                break
            h.update(int(tree.label[u]).to_bytes(8, "little", signed=True))
            keys[u] = h.copy().digest()
    for u in range(total):
        p = tree.parent[u]
        yield (keys.get(u), keys.get(p), tree.depth[u], least[u], None if p < 0 or p in boundary else least[p], members[u],
               kids[u], leaves[u], saved[u], ends_at[u][2] if u in ends_at else None)


def _shards(edges: dict[int, tuple[int, int]], names: list[str], types: list):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        shard = None
        for b in batches:
            if b.num_rows:
                shard = b.column("shard")[0].as_py()
                rows += zip(*(b.column(c).to_pylist() for c in ("ids", "sizes", "conv_id", "n", "ends")), strict=True)
        if rows:
            nodes = _shard_nodes(rows, *edges[shard])
            while part := [x for x, _ in zip(nodes, range(20_000))]:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part, strict=True), types, strict=True)], names)
        rows.clear()
        release()
    return run


def _boundaries(spark: SparkSession, ranged: DataFrame) -> dict[int, tuple[int, int]]:
    """For each shard with rows: the turns that its first sequence shares with
    the last one before, and its last one with the first one behind (-1: there
    is none). Two numbers a shard reach the driver."""
    edge = table(spark, ranged.groupBy("shard").agg(F.min("ids").alias("first"), F.max("ids").alias("last")), "trie-edges")
    present = sorted(r["shard"] for r in edge.select("shard").collect())
    if len(present) < 2:
        return dict.fromkeys(present, (-1, -1))
    follows = spark.createDataFrame(list(zip(present[:-1], present[1:], strict=True)), "shard int, next int")
    both = follows.join(edge.select("shard", "last"), "shard").join(edge.select(F.col("shard").alias("next"), "first"), "next")
    differs = F.zip_with("last", "first", lambda x, y: ~x.eqNullSafe(y))
    shared = {r["shard"]: r["shared"] for r in both.select("shard", (F.array_position(differs, True) - 1).alias("shared")).collect()}
    return {s: (shared[present[i - 1]] if i else -1, shared.get(s, -1)) for i, s in enumerate(present)}


def prefix_trie(spark: SparkSession, sequences: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row for each different beginning of the ``sequences (conv_id, ids,
    sizes)``, the empty one included: ``conv_id`` (its least member), ``depth``,
    ``parent_conv_id``, ``n_convs`` (members), ``n_children``, ``n_leaves``
    (childless nodes in its subtree), ``saved_tokens`` (over its subtree, what
    all members but one need not be read again for, in ``sizes``) and
    ``ends_sha256`` (SHA-256 of the ids of the members that end here,
    ascending, joined by commas).

    A ``conv_id`` has one sequence; an empty sequence is a member of the root,
    no sequences give no rows. A node's texts are the first ``depth`` ids of
    its ``conv_id``, by the dictionary. A shard holds about ``shard_turns``
    ids, or one sequence that is longer.
    """
    prepared(spark)
    distinct = table(spark, distinct_sequences(spark, sequences), "trie-distinct")
    turns = distinct.agg(F.sum(F.size("ids") + 1)).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), turns // shard_turns + 1)
    checkpoint_root(spark)
    ranged = (distinct.repartitionByRange(int(shards), "ids").sortWithinPartitions("ids")
              .withColumn("shard", F.spark_partition_id()).checkpoint())
    node = spark.createDataFrame([], _NODE).schema
    names, types = node.names, [pa.binary()] * 2 + [pa.int64()] * 7 + [pa.string()]
    nodes = table(spark, ranged.mapInArrow(_shards(_boundaries(spark, ranged), names, types), _NODE), "trie-nodes")
    counted = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    merged = table(spark, nodes.filter("key is not null").groupBy("key").agg(
        F.min("parent_key").alias("parent_key"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.lit(None).cast("long").alias("parent_conv_id"), *(F.sum(c).alias(c) for c in counted), F.max("ends_sha256").alias("ends_sha256")).select(*names), "trie-boundary")
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("merged_parent"))
    return nodes.filter("key is null").union(merged).join(small(parents), "parent_key", "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "merged_parent").alias("parent_conv_id"), *counted,
        F.coalesce("ends_sha256", F.lit(NO_MEMBERS)).alias("ends_sha256"))


def with_shared_heads(sequences: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """Sequences rebuilt: the first ``h`` turns of conversation ``c - c % group``
    (all if it has fewer, none if there is no such), then ``c``'s own after its
    first ``h``; ``h`` is the crc32 of the decimal ``c``, modulo ``most``."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    base = F.col("conv_id") - F.col("conv_id") % group
    heads = sequences.filter(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("base"), *(F.slice(c, 1, most - 1).alias(f"head_{c}") for c in ("ids", "sizes")))
    rest = lambda c: F.slice(c, F.col("h") + 1, F.greatest(F.size(c) - F.col("h"), F.lit(0)))
    head = lambda c: F.slice(F.coalesce(f"head_{c}", F.array().cast("array<long>")), F.lit(1), F.col("h"))
    joined = sequences.withColumn("h", h).withColumn("base", base).join(heads, "base", "left")
    return joined.select("conv_id", *(F.concat(head(c), rest(c)).alias(c) for c in ("ids", "sizes")))
