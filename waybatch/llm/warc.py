"""WARC archives: written by Spark's text writer, read back split by split.

A record's bytes end in a line feed, so a text file whose lines are records is
an archive. Reading takes lines with Spark's text source; a task counts the
bytes of its splits, and the splits' sums give every line's offset.

Any line may look like a record's first: payloads can hold the magic. So each
such line is only a candidate, with the offset of its successor by its length
field. Within a split the chains of candidates are followed to where they
leave it; between splits, pointer jumping from the start of each file finds
where its true chain enters each split. Only records on that chain are kept.
A record that spans splits is put together from their pieces.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybatch.llm.common import prepared, small, table
from waybatch.session import scratch_path

#: Records with equal payloads from this size on are revisits of one.
REVISIT_BYTES = 1000
#: Splits whose entries are broadcast at once (about 100 bytes each); files of more go in groups.
SPLITS_AT_ONCE = 200_000

_MAGIC = re.compile(rb"WARC/1\.[01]\r?$")
_MAGICS = (b"WARC/1.0\r", b"WARC/1.1\r")
_LENGTH = re.compile(rb"^Content-Length:[ \t]*([0-9]{1,18})[ \t]*\r?$", re.I | re.M)
#: Of longer lines only the size and a length field are looked at to find the chain.
_LONG_LINE = 8192
_STEP = 1 << 20


def header(fields: list[tuple[str, Column]]) -> Column:
    """A record's header; fields that are null are left out."""
    lines = [F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")) for name, value in fields]
    return F.concat(F.lit("WARC/1.0\r\n"), *(F.coalesce(x, F.lit("")) for x in lines), F.lit("\r\n"))


def _uuid(key: Column) -> Column:
    h = F.md5(key)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))), F.lit(">"))


def _one_line(text: Column) -> Column:
    return F.regexp_replace(text, "[\\x00-\\x20\\x7f]", "%20")


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """``(value)``: the bytes of a record for each page, without the last line
    feed. Of pages with equal payloads of ``REVISIT_BYTES`` or more, that with
    the largest id is a response and the others revisit it; all others are
    responses, and so is a page without an id. Null payloads count as empty. Payloads are only shuffled where
    their digest repeats too often for a broadcast."""
    p = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                     F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    p = p.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    groups = (p.filter(F.col("size") >= REVISIT_BYTES).groupBy("digest", "size")
              .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("pages")).filter("pages > 1").drop("pages"))
    groups = table(pages.sparkSession, groups, "warc-groups")
    p = p.join(small(groups), ["digest", "size"], "left")
    revisit = F.coalesce(F.col("first") != F.col("page_id"), F.lit(False))
    body = F.when(~revisit, F.col("payload")).otherwise(F.lit(b""))
    key = lambda c: _uuid(F.concat_ws("-", F.lit("page"), F.coalesce(c.cast("string"), F.lit("null"))))
    head = header([
        ("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        ("WARC-Record-ID", key(F.col("page_id"))),
        ("WARC-Target-URI", _one_line(F.col("url"))),
        ("WARC-Date", F.lit("2025-01-01T00:00:00Z")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.upper(F.col("digest")))),
        ("WARC-Refers-To", F.when(revisit, key(F.col("first")))),
        ("X-Page-ID", F.col("page_id")),
        ("X-Payload-Length", F.col("size")),
        ("X-Refers-To-Page", F.when(revisit, F.col("first"))),
        ("Content-Type", F.lit("application/octet-stream")),
        ("Content-Length", F.octet_length(body)),
    ])
    return p.select(F.concat(head.cast("binary"), body, F.lit(b"\r\n\r")).cast("string").alias("value"))


def write_archives(pages: DataFrame, path: str, **columns: str) -> None:
    """Archives under ``path``, a file a task."""
    records(pages, **columns).write.option("lineSep", "\n").option("compression", "none").text(path)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(path)
    return files.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("line"))


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], np.ndarray, list]]:
    """For each stretch of lines of one split: the split, the lines' sizes with
    their line feeds, and the lines."""
    for b in batches:
        if b.num_rows == 0:
            continue
        files, starts = b.column("file").to_pylist(), b.column("split").to_numpy()
        sizes = b.column("size").to_numpy().astype(np.int64) + 1
        cuts = [0, *(i for i in range(1, len(files)) if starts[i] != starts[i - 1] or files[i] != files[i - 1]), len(files)]
        lines = b.column("line")
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            yield (files[s], int(starts[s])), sizes[s:e], lines.slice(s, e - s).to_pylist()


_FOUND = "file string, split long, at long, head long, length long, whole boolean, bytes long"
_FOUND_NAMES = ["file", "split", "at", "head", "length", "whole", "bytes"]


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates, by offset in their split, with the bytes and the length
    field of their header as far as the split has it; for each split its bytes,
    and the same of its lines up to the first blank one, which may end a header
    of a split before. Of long lines only the size counts: they come as null. A
    split's last line may be a first line cut off: a candidate with ``whole`` null."""
    split, rows, last = None, [], None
    at, open_at, head, length, lead, lead_length, leading = 0, None, 0, None, 0, None, True

    def done():
        rows.append((*split, -1, lead, lead_length, not leading, at))
        if open_at is not None:
            rows.append((*split, open_at, head, length, False, 0))
        if last and any(m.startswith(last) for m in _MAGICS) and not _MAGIC.match(last):
            rows.append((*split, at - len(last) - 1, len(last) + 1, None, None, 0))

    def record():
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], _FOUND_NAMES)

    for now, sizes, lines in _splits(batches):
        if now != split:
            if split is not None:
                done()
            split, at, open_at, lead, lead_length, leading = now, 0, None, 0, None, True
        for size, line in zip(sizes.tolist(), lines, strict=True):
            if line is not None and _MAGIC.match(line):
                open_at, head, length = at, size, None
                if leading:
                    lead += size
            elif open_at is not None or leading:
                blank = line in (b"\r", b"")
                got = _LENGTH.match(line) if line is not None else None
                if open_at is not None:
                    head += size
                    if length is None and got:
                        length = int(got[1])
                    if blank:
                        rows.append((*split, open_at, head, length, True, 0))
                        open_at = None
                if leading:
                    lead += size
                    if lead_length is None and got:
                        lead_length = int(got[1])
                    leading = not blank
            at += size
            last = line
        if len(rows) >= 2000:
            yield record()
            rows = []
    if split is not None:
        done()
        yield record()


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Follows each candidate's successors to the first offset beyond its
    split. Rows come split by split, offsets ascending."""
    held: list[tuple] = []
    split = None

    def followed():
        leave: dict[int, int] = {}
        for _, _, at, after, _ in reversed(held):
            leave[at] = leave.get(after, after)
        return pa.RecordBatch.from_arrays(
            [pa.array([h[0] for h in held], pa.string()), pa.array([h[2] for h in held], pa.int64()), pa.array([leave[h[2]] for h in held], pa.int64())],
            ["file", "at", "leaves"])

    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in ("file", "split", "at", "after", "end")), strict=True):
            if row[:2] != split:
                if held:
                    yield followed()
                held, split = [], row[:2]
            held.append(row)
    if held:
        yield followed()


def _check_ends(splits: DataFrame, reached: DataFrame, unended: DataFrame) -> None:
    """Raises if a chain ends before its file does, unless the file is cut off
    within the header at which the chain ends."""
    last = reached.groupBy("file").agg(F.max("at").alias("at"))
    broken = last.join(splits.select("file", "total").distinct(), "file").filter("at < total").join(unended, ["file", "at"], "left_anti")
    if r := broken.orderBy("file").first():
        raise ValueError(f"{r['file']}: the chain of records breaks off at byte {r['at']} of {r['total']}")


def entries(spark: SparkSession, path: str) -> DataFrame:
    """``(file, split, base, entry, bytes)``: for each split the offset of its
    first line, its bytes, and the offset at which the true chain of records
    enters it (null: it passes over it, or breaks off before)."""
    size = F.octet_length("line")
    # A longer line is no magic and not blank, but may be a padded length field.
    field = F.lower(F.substring("line", 1, 15).cast("string")) == "content-length:"
    number = F.regexp_extract(F.col("line").cast("string"), "^.{15}[ \t]*([0-9]{1,18})[ \t]*\r?$", 1)
    seen_line = F.when(size <= _LONG_LINE, F.col("line")).when(field, F.concat(F.lit("Content-Length: "), number).cast("binary"))
    lines = _lines(spark, path).select("file", "split", size.alias("size"), seen_line.alias("line"))
    found = table(spark, lines.mapInArrow(_candidates, _FOUND), "warc-candidates")
    before = "sum(bytes) over (partition by file order by split rows between unbounded preceding and 1 preceding)"
    splits = found.filter("at < 0").withColumn("base", F.expr(f"coalesce({before}, 0)"))
    # A header that its split does not end is ended by the next split with a blank line; its length field may be in any up to there.
    behind = "over (partition by file order by split desc rows between unbounded preceding and 1 preceding)"
    splits = splits.select(
        "file", "split", "bytes", "base", F.expr("sum(bytes) over (partition by file)").alias("total"),
        F.expr(f"last(if(whole, struct(split, base + head as at), null), true) {behind}").alias("ends"),
        F.expr(f"last(if(length is not null, struct(split, length), null), true) {behind}").alias("next"))
    splits = table(spark, splits, "warc-splits")
    seen = found.filter("at >= 0").select("file", "split", F.col("at").alias("inside"), "head", "length", "whole").join(splits, ["file", "split"])
    seen = seen.select(
        "file", "split", "whole", "total", (F.col("base") + F.col("bytes")).alias("end"), (F.col("base") + F.col("inside")).alias("at"),
        F.when(F.col("whole"), F.col("base") + F.col("inside") + F.col("head")).otherwise(F.col("ends.at")).alias("body"),
        F.coalesce("length", F.when(~F.col("whole") & (F.col("next.split") <= F.col("ends.split")), F.col("next.length"))).alias("length"))
    unended = table(spark, seen.filter("body is null and (whole is not null or end = total)").select("file", "at"), "warc-unended")
    seen = seen.filter("whole is not null and body is not null and length is not null").select(
        "file", "split", "end", "at", (F.col("body") + F.col("length") + 4).alias("after"))
    seen = seen.repartition("file", "split").sortWithinPartitions("file", "split", "at")
    jump = table(spark, seen.mapInArrow(_exits, "file string, at long, leaves long"), "warc-exits")

    # Where the chain from offset 0 enters: reached offsets and jumps double each round.
    reached = splits.select("file").distinct().withColumn("at", F.lit(0).cast("long"))
    many = 0
    while True:
        reached = table(spark, reached.union(reached.join(jump, ["file", "at"]).select("file", F.col("leaves").alias("at"))).distinct(), "warc-reached")
        now = reached.count()
        if now == many:
            break
        many = now
        jump = table(spark, jump.alias("a").join(jump.alias("b"), (F.col("a.file") == F.col("b.file")) & (F.col("a.leaves") == F.col("b.at")), "left")
                     .select("a.file", "a.at", F.coalesce("b.leaves", "a.leaves").alias("leaves")), "warc-jumps")
    _check_ends(splits, reached, unended)
    inside = (F.col("s.file") == F.col("r.file")) & (F.col("r.at") >= F.col("s.base")) & (F.col("r.at") < F.col("s.base") + F.col("s.bytes"))
    first = splits.alias("s").join(reached.alias("r"), inside).groupBy("s.file", "s.split").agg(F.min("r.at").alias("entry"))
    return table(spark, splits.select("file", "split", "base", "bytes").join(first, ["file", "split"], "left"), "warc-entries")


_FIELD = re.compile(rb"^([A-Za-z0-9-]+):[ \t]*(.*?)[ \t]*\r?$", re.M)
_OUT = "file string, at long, piece long, bytes binary, fields map<string,string>, size long, sha1 string"
_OUT_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.map_(pa.string(), pa.string()), pa.int64(), pa.string()]
_OUT_NAMES = ["file", "at", "piece", "bytes", "fields", "size", "sha1"]


def _parsed(data: bytes) -> tuple[dict[str, str], int, str, int] | None:
    """Fields, payload size, its SHA-1 and the record's length with the blank
    lines after it; None if ``data`` has no whole record at its start."""
    end = re.compile(rb"\n\r?\n").search(data)
    if end is None:
        return None
    fields = {k.decode(): v.decode("utf-8", "replace") for k, v in _FIELD.findall(data[:end.start()])}
    length = _LENGTH.search(data[:end.start()])
    size = int(length[1]) if length else -1
    if size < 0 or len(data) < end.end() + size + 4:
        return None
    payload = memoryview(data)[end.end():end.end() + size]
    return fields, size, hashlib.sha1(payload).hexdigest(), end.end() + size + 4


def _walk(shared):
    """Records of the true chain that lie whole in a split, and pieces of
    those that don't: what a split has before its entry, and its rest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        split, rows, held, begin, base, entry = None, [], [], 0, 0, None
        need, limit = 0, _STEP  # bytes held since the last try, and those that call for one

        def consume(final: bool):
            """Takes whole records off the held lines; ``begin`` is where they start."""
            nonlocal held, begin, need, limit
            data = b"".join(held)
            place = 0
            if entry is None or begin < entry:
                cut = len(data) if entry is None else min(len(data), entry - begin)
                if final or (entry is not None and cut < len(data)) or cut >= _STEP:
                    if cut:
                        rows.append((split[0], None, begin, data[:cut], None, None, None))
                    place = cut
                else:
                    return
            if entry is not None and begin + place >= entry:
                view = data[place:]
                while view and (got := _parsed(view)) is not None:
                    rows.append((split[0], begin + place, None, None, *got[:3]))
                    place += got[3]
                    view = view[got[3]:]
                if final and view:
                    rows.append((split[0], begin + place, begin + place, view, None, None, None))
                    place = len(data)
            held, begin, need = ([data[place:]] if place < len(data) else []), begin + place, 0
            limit = max(_STEP, len(data) - place)  # a long record is not tried at every step

        def record():
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(_OUT_TYPES)], _OUT_NAMES)

        for now, sizes, lines in _splits(batches):
            if now != split:
                if split is not None:
                    consume(True)
                split = now
                base, entry = known.get(now, (0, None))
                held, begin, need, limit = [], base, 0, _STEP
            for size, line in zip(sizes.tolist(), lines, strict=True):
                held.append(line + b"\n")
                need += size
                if need >= limit:
                    consume(False)
            if len(rows) >= 500:
                yield record()
                rows = []
        if split is not None:
            consume(True)
        if rows:
            yield record()
    return run


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records from their pieces, which come in order, record by record."""
    key, parts = None, []

    def parsed():
        got = _parsed(b"".join(parts))
        rows = [(key[0], key[1], None, None, *got[:3])] if got else []
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(_OUT_TYPES)], _OUT_NAMES)

    for b in batches:
        for file, at, data in zip(*(b.column(c).to_pylist() for c in ("file", "at", "bytes")), strict=True):
            if (file, at) != key:
                if parts:
                    yield parsed()
                key, parts = (file, at), []
            parts.append(data)
    if parts:
        yield parsed()


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``(file, at, fields, size, sha1)``: each record of the archives under
    ``path`` with its offset, header fields, payload size and payload SHA-1.

    Only records on the chain from a file's start count, so bytes in payloads
    that look like records give none. In a truncated file the chain ends with
    the last whole record; a chain that breaks off otherwise (a wrong length)
    is a ``ValueError``. Headers and their lines are of any length. Files of any size are read split by
    split; empty files give nothing.
    """
    prepared(spark)
    where = entries(spark, path)
    lines = _lines(spark, path).select("file", "split", F.octet_length("line").alias("size"), "line")
    n = where.count()
    groups = max(1, -(-n // SPLITS_AT_ONCE))
    parts = None
    for k in range(groups):
        some = where if groups == 1 else where.filter(F.pmod(F.xxhash64("file"), F.lit(groups)) == k)
        known = {(r["file"], r["split"]): (r["base"], r["entry"]) for r in some.toLocalIterator()}
        mine = lines if groups == 1 else lines.filter(F.pmod(F.xxhash64("file"), F.lit(groups)) == k)
        part = mine.mapInArrow(_walk(spark.sparkContext.broadcast(known)), _OUT)
        parts = part if parts is None else parts.union(part)
    read = table(spark, parts, "warc-read")
    # A piece without an offset belongs to the last record that began before it.
    pieces = read.filter("piece is not null").withColumn(
        "at", F.expr("last(at, true) over (partition by file order by piece)")).filter("at is not null")
    whole = pieces.select("file", "at", "piece", "bytes").repartition("file", "at").sortWithinPartitions("file", "at", "piece").mapInArrow(_assembled, _OUT)
    return read.filter("piece is null").union(whole).select("file", "at", "fields", "size", "sha1")


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of
    all pages, from archives written for them and read back.

    A response's size and digest are those of the payload read. A revisit has
    no payload of its own; they are its header's. Null and empty payloads are
    responses of no bytes. Rows that share an id give a record each; those of
    equal payloads from ``REVISIT_BYTES`` on that have the largest id are each
    a response. Extra columns are ignored; an empty table gives no rows.
    """
    path = scratch_path(spark, "warc")
    write_archives(pages, path)
    r = read_archives(spark, path)
    f = lambda name: F.col("fields").getItem(name)
    revisit = f("WARC-Type") == "revisit"
    kind = pages.schema["page_id"].dataType.simpleString()
    return r.select(
        f("X-Page-ID").cast(kind).alias("page_id"),
        F.when(revisit, f("X-Payload-Length").cast("long")).otherwise(F.col("size")).alias("payload_bytes"),
        F.when(revisit, F.lower(F.substring(f("WARC-Payload-Digest"), 6, 40))).otherwise(F.col("sha1")).alias("payload_digest"),
        f("WARC-Type").alias("record_type"), f("X-Refers-To-Page").cast(kind).alias("refers_to"))
