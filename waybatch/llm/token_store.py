"""Token files: ids ranked by frequency, in a byte-aligned variable-length
code whose control bytes stand apart from the data.

A block holds whole documents in ascending order of id:

    magic "TKB1" | documents u32 | tokens u32 | lengths u32 each | control | data

Two control bits a value say how many bytes (1 to 4) its rank has in ``data``;
each document's control starts at a byte of its own.
Blocks are rows of Parquet files that Spark commits in the shared folder;
next to them lies the table of ranks.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybatch.llm.bpe import byte_characters
from waybatch.llm.chunks import Encoder, Pieces
from waybatch.llm.common import binaries, prepared, ragged, steps, table, text_buffers
from waybatch.session import scratch_path

MAGIC = b"TKB1"
#: A block is closed when it has so many tokens.
BLOCK_TOKENS = 1 << 19
#: Ids whose counts one row holds on their way to the sums.
COUNTED = 1 << 11
#: Coded bytes of a range of documents, about.
RANGE_BYTES = 64 << 20
#: Text bytes of one step: each different word in it is looked up once.
STEP_TEXT = 4_000_000
#: Pieces and words that a worker keeps: about 350 MB.
MOST_PIECES, MOST_WORDS = 500_000, 1_200_000

_WIDTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.int64) + 1


def pack(values: np.ndarray) -> bytes:
    """Control bytes, then data bytes, of unsigned 32-bit values."""
    v = np.ascontiguousarray(values, "<u4")
    width = 1 + (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    two = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    two[:len(v)] = width - 1
    two = two.reshape(-1, 4)
    control = two[:, 0] | two[:, 1] << 2 | two[:, 2] << 4 | two[:, 3] << 6
    data = v.view(np.uint8).reshape(-1, 4)[np.arange(4) < width[:, None]]
    return control.tobytes() + data.tobytes()


def unpack(code: bytes, lengths: np.ndarray) -> np.ndarray:
    """Values of documents of these lengths; a table gives each control
    byte's four widths. A document's control starts at a byte of its own."""
    own = -(-lengths // 4)
    c = int(own.sum())
    group, place = ragged(lengths)
    width = _WIDTHS[np.frombuffer(code, np.uint8, c)].reshape(-1)[(np.cumsum(own) - own)[group] * 4 + place]
    data = np.concatenate([np.frombuffer(code, np.uint8, offset=c), np.zeros(3, np.uint8)])
    at = np.cumsum(width) - width
    out = data[at].astype(np.uint32)
    for k in range(1, int(width.max(initial=1))):
        more = np.flatnonzero(width > k)
        out[more] |= data[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def block_bytes(lengths: list[int], codes: list[bytes]) -> bytes:
    """A block of documents that are packed already, each by itself."""
    head = np.array([len(lengths), sum(lengths)], "<u4").tobytes()
    control = [c[:-(-n // 4)] for c, n in zip(codes, lengths, strict=True)]
    data = [c[-(-n // 4):] for c, n in zip(codes, lengths, strict=True)]
    return MAGIC + head + np.array(lengths, "<u4").tobytes() + b"".join(control) + b"".join(data)


def read_block(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Document lengths and ranks; a block that is none is an error."""
    if block[:4] != MAGIC:
        raise ValueError("not a token block")
    docs, tokens = np.frombuffer(block, "<u4", 2, 4).tolist()
    lengths = np.frombuffer(block, "<u4", docs, 12).astype(np.int64)
    if lengths.sum() != tokens:
        raise ValueError("a token block's lengths don't add up")
    return lengths, unpack(block[12 + 4 * docs:], lengths)


def _split(text: str) -> list[str]:
    """Words between blanks, which are encoded independently of each other, as
    this kind of tokenizer drops white space."""
    for blank in "\n\t\r":
        text = text.replace(blank, " ")
    return list(filter(None, text.split(" ")))


#: Bytes as they are, but blanks as spaces.
_BLANKS = np.arange(256, dtype=np.uint8)
_BLANKS[[9, 10, 13]] = 32


def _words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Different words of a column of texts, as ``_split`` cuts them; the place
    of each text's words among these, joined; and how many each text has."""
    data, offsets = text_buffers(texts)
    spaced = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(_BLANKS[data].tobytes()))
    lists = pc.split_pattern(spaced, " ")
    coded = lists.flatten().dictionary_encode()
    words, place = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    kept = place != (words.index("") if "" in words else -1)
    before = np.concatenate([[0], np.cumsum(kept)])
    edges = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    return words, place[kept], np.diff(before[edges - edges[0]])


_PIECES: dict[int, tuple[Pieces, int]] = {}


def _pieces(shared) -> tuple[Pieces, int]:
    """A tokenizer's pieces and vocabulary size; one per Python worker and file."""
    key = hash(shared.value)
    if key not in _PIECES:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(shared.value)
        _PIECES.clear()
        encode = Encoder(tokenizer, byte_characters(), '"Lowercase"' in shared.value, MOST_WORDS)
        _PIECES[key] = Pieces(_split, encode, MOST_PIECES), tokenizer.get_vocab_size()
    return _PIECES[key]


_STAGED = "doc_id long, tie long, n_tokens long, ids binary, chunk int, counts binary"


def _ids(shared, end_id: int):
    """A row for each document with its ids, and rows for the task with the
    counts of its ids, by chunks of ``COUNTED`` ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "tie", "n_tokens", "ids", "chunk", "counts"]
        total = np.zeros(0, np.int64)
        for b in steps(batches, "text", STEP_TEXT):
            pieces, size = _pieces(shared)
            words, place, counts = _words(b.column("text"))
            ids, counts = pieces.joined(pieces.codes_of(words)[place], counts)
            ids = np.insert(ids, np.cumsum(counts), end_id)
            some = np.bincount(ids, minlength=len(total))
            some[:len(total)] += total
            total = some
            kind = np.dtype("<u2") if max(size, end_id + 1) <= 1 << 16 else np.dtype("<u4")
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("tie"), pa.array(counts + 1), binaries(ids.astype(kind), counts + 1),
                 pa.nulls(b.num_rows, pa.int32()), pa.nulls(b.num_rows, pa.binary())], names)
        chunks = [k for k in range(-(-len(total) // COUNTED)) if total[k * COUNTED:(k + 1) * COUNTED].any()]
        if chunks:
            n = len(chunks)
            yield pa.RecordBatch.from_arrays(
                [*(pa.nulls(n, pa.int64()) for _ in range(3)), pa.nulls(n, pa.binary()), pa.array(chunks, pa.int32()),
                 pa.array([total[k * COUNTED:(k + 1) * COUNTED].astype("<i8").tobytes() for k in chunks], pa.binary())], names)
    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of tasks, added up by chunk as they stream in."""
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for chunk, counts in zip(b.column("chunk").to_pylist(), b.column("counts").to_pylist(), strict=True):
            some = np.frombuffer(counts, "<i8")
            total.setdefault(chunk, np.zeros(COUNTED, np.int64))[:len(some)] += some
    for chunk, sums in total.items():
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used + chunk * COUNTED), pa.array(sums[used])], ["id", "n"])


def _range_of(firsts: list[tuple], ids: pa.Array, ties: np.ndarray) -> np.ndarray:
    """The range of each ``(id, tie)``; ``firsts`` are the least of each range,
    ascending, null ids first."""
    nulls = sum(i is None for i, _ in firsts)
    starts = np.array([i for i, _ in firsts if i is not None], np.int64)
    first_ties = np.array([t for _, t in firsts], np.int64)
    missing = ids.is_null().to_numpy(zero_copy_only=False)
    own = ids.fill_null(0).to_numpy()
    low = np.where(missing, 0, nulls + np.searchsorted(starts, own, "left"))
    high = np.where(missing, nulls, nulls + np.searchsorted(starts, own, "right"))
    for a, z in set(zip(low[low < high].tolist(), high[low < high].tolist(), strict=True)):
        here = np.flatnonzero((low == a) & (high == z))
        low[here] = a + np.searchsorted(first_ties[a:z], ties[here], "right")
    return np.maximum(low - 1, 0)


def _coded(ranks, firsts: list[tuple]):
    """Each document's ids as ranks in the variable-length code, and its range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = ranks.value
        for b in batches:
            n, ids = b.column("n_tokens").to_numpy(), b.column("ids").to_pylist()
            kinds = [np.dtype("<u2") if len(x) == 2 * k else np.dtype("<u4") for x, k in zip(ids, n.tolist(), strict=True)]
            code = [pack(rank[np.frombuffer(x, kind)]) for x, kind in zip(ids, kinds, strict=True)]
            part = _range_of(firsts, b.column("doc_id"), b.column("tie").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), b.column("doc_id"), b.column("tie"), b.column("n_tokens"), pa.array(code, pa.binary())],
                ["part", "doc_id", "tie", "n_tokens", "code"])
    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of one range of documents, in order."""
    ids: list = []
    lengths: list[int] = []
    codes: list[bytes] = []
    number, before, size, part = 0, 0, 0, 0

    def block():
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([before], pa.int64()), pa.array([size], pa.int64()),
             pa.array([ids], pa.list_(pa.int64())), pa.array([block_bytes(lengths, codes)], pa.binary())],
            ["part", "block", "first_token", "n_tokens", "doc_ids", "bytes"])

    for b in batches:
        if b.num_rows:
            part = b.column("part")[0].as_py()
        for doc_id, n, code in zip(*(b.column(c).to_pylist() for c in ("doc_id", "n_tokens", "code")), strict=True):
            ids.append(doc_id)
            lengths.append(n)
            codes.append(code)
            size += n
            if size >= BLOCK_TOKENS:
                yield block()
                ids, lengths, codes, number, before, size = [], [], [], number + 1, before + size, 0
    if ids:
        yield block()


def _documents(id_of_rank):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, ids, code in zip(*(b.column(c).to_pylist() for c in ("first_token", "doc_ids", "bytes")), strict=True):
                lengths, ranks = read_block(code)
                values = id_of_rank.value[ranks].astype("<u4")
                edges = np.concatenate([[0], np.cumsum(lengths)])
                for low in range(0, len(ids), 1000):
                    high = min(low + 1000, len(ids))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[low:high], pa.int64()), pa.array(first + edges[low:high]), pa.array(lengths[low:high]),
                         binaries(values[edges[low]:edges[high]], lengths[low:high])], ["doc_id", "start", "n_tokens", "ids"])
    return run


def write_tokens(spark: SparkSession, docs: DataFrame, tokenizer_path: str, path: str, end_id: int = 1,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the tokens of all rows, each with ``end_id`` after it, under
    ``path``: ``blocks`` in ascending order of id, and ``ranks``.

    Null and empty texts have the end id only. Null ids come first; of rows
    with one id the order is that of their texts' hashes. An empty table gives
    empty folders. Other columns are ignored. Ids are counted over all rows;
    the counts are as many as the vocabulary.
    """
    prepared(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    slim = slim.withColumn("tie", F.xxhash64("text"))
    staged = table(spark, slim.mapInArrow(_ids(shared, end_id), _STAGED), "token-ids", "zstd")
    counts = (staged.filter("counts is not null").select("chunk", "counts").repartition("chunk")
              .mapInArrow(_summed, "id long, n long").collect())
    counts.sort(key=lambda r: (-r["n"], r["id"]))
    ids = np.array([r["id"] for r in counts], np.int64)
    rank = np.zeros(int(ids.max(initial=0)) + 1, np.uint32)
    rank[ids] = np.arange(len(ids))
    spark.createDataFrame([(k, int(i)) for k, i in enumerate(ids)], "rank long, id long").coalesce(1).write.parquet(f"{path}/ranks")
    # Ids alone are cut into ranges; of each range one row, its first, reaches
    # the driver. Then documents are coded and shuffled once, each to its range.
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie").asc()]
    keys = staged.filter("counts is null").select("doc_id", "tie")
    coded_bytes = 2 * sum(r["n"] for r in counts)
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), coded_bytes // RANGE_BYTES + 1)
    firsts = [(r["k"]["doc_id"], r["k"]["tie"]) for r in
              keys.repartitionByRange(ranges, *order).groupBy(F.spark_partition_id().alias("part"))
              .agg(F.min(F.struct("doc_id", "tie")).alias("k")).orderBy("part").collect()]
    coded = staged.filter("counts is null").drop("chunk", "counts").mapInArrow(
        _coded(spark.sparkContext.broadcast(rank), firsts), "part int, doc_id long, tie long, n_tokens long, code binary")
    ranged = coded.repartitionById(max(1, len(firsts)), F.col("part")).sortWithinPartitions("part", *order)
    ranged.select("part", "doc_id", "n_tokens", "code").mapInArrow(
        _blocks, "part int, block int, first_token long, n_tokens long, doc_ids array<long>, bytes binary",
    ).write.option("compression", "zstd").parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` from the files under ``path``;
    ``start`` counts the ids of all documents before, over all files."""
    prepared(spark)
    ranks = spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()
    id_of_rank = spark.sparkContext.broadcast(np.array([r["id"] for r in ranks], np.uint32))
    blocks = spark.read.parquet(f"{path}/blocks")
    sums = sorted((r["part"], r["n"]) for r in blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    before = np.cumsum([0, *(n for _, n in sums)]).tolist()
    base = spark.createDataFrame([(p, before[i]) for i, (p, _) in enumerate(sums)], "part int, base long")
    return (blocks.join(F.broadcast(base), "part")
            .select((F.col("base") + F.col("first_token")).alias("first_token"), "doc_ids", "bytes")
            .mapInArrow(_documents(id_of_rank), "doc_id long, start long, n_tokens long, ids binary"))


def stored(spark: SparkSession, docs: DataFrame, tokenizer_path: str, end_id: int = 1) -> DataFrame:
    """Tokens of ``docs`` written to a fresh folder and read back."""
    path = scratch_path(spark, "tokens")
    write_tokens(spark, docs, tokenizer_path, path, end_id)
    return read_tokens(spark, path)
