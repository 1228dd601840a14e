"""Benchmark decontamination by spaced seeds.

A seed hashes the words under the ones of a fixed mask and ignores those under
its zeros. Test seeds are joined with the seeds of all documents by hash, in
the documents' tasks; around each hit the test item is laid along the document
and the best stretch with substitutions is verified word by word.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybatch.llm.common import NOT_ALNUM, mix, prepared, ragged, small, steps, table, text_buffers, word_hashes, word_spans

#: Ones are compared, zeros ignored: all ways in which four words can be within
#: five. An item of which no five neighbours keep four words has three of each
#: five in place at most, so every item with more than that is found, whatever
#: the places of its edits.
MASKS = ("1111", "11101", "11011", "10111")
#: Equal words from which a stretch far from the others counts for an item of
#: ``LONG_FROM`` words or more; shorter ones are chance.
FAR_WORDS = 6
#: Items with fewer words take the masks of ``SHORT_MASKS``. Of such an item
#: with ``ITEM_SHARE`` of its words in place three are within five words, and
#: the masks are all ways in which three can be.
LONG_FROM = 16
SHORT_MASKS = ("111", "1101", "1011", "11001", "10101", "10011")
#: Items with fewer words match only documents that are that item.
SHORT = 4
#: A stretch counts with so many equal words, or this share of its item.
RUN_WORDS, ITEM_SHARE = 13, 0.6
#: Score of an unequal word where an equal one has 1.
MISMATCH = -2
#: Test words that are broadcast at once (8 bytes each); more go in blocks.
BLOCK_WORDS = 2_000_000

_TABLE = 1 << 20
#: Words that are compared at once.
_AT_ONCE = 1 << 20
#: Scripts without spaces between words: each code point is a word.
_UNSPACED = "([" + "".join(rf"\p{{{x}}}" for x in (
    "Han", "Hiragana", "Katakana", "Bopomofo", "Yi", "Thai", "Lao", "Khmer", "Myanmar",
    "Tai_Le", "New_Tai_Lue", "Tai_Tham", "Tai_Viet", "Javanese", "Balinese")) + "])"


def _between() -> str:
    """A class of all punctuation, white space and controls beyond ASCII."""
    points = [c for c in range(128, 0x20000) if unicodedata.category(chr(c)) in ("Cc", "Zs", "Zl", "Zp", "Pc", "Pd", "Ps", "Pe", "Pi", "Pf", "Po")]
    cuts = [i for i, c in enumerate(points) if i == 0 or points[i - 1] != c - 1] + [len(points)]
    return "[" + "".join(rf"\x{{{points[a]:x}}}-\x{{{points[b - 1]:x}}}" for a, b in zip(cuts[:-1], cuts[1:], strict=True)) + "]"


_BETWEEN = _between()


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes (lower-cased runs of letters and digits, and the code points
    of scripts without spaces) and the number of words before each text."""
    lower = pc.utf8_lower(column)
    data, offsets = text_buffers(lower)
    if len(data) and data.max() >= 128:
        lower = pc.replace_substring_regex(pc.replace_substring_regex(lower, _BETWEEN, " "), _UNSPACED, r" \1 ")
        data, offsets = text_buffers(lower)
    starts, ends, before = word_spans(data, offsets, NOT_ALNUM)
    return word_hashes(data, starts, ends), before


def _masks() -> list[np.ndarray]:
    return [np.flatnonzero([c == "1" for c in m]) for m in (*MASKS, *SHORT_MASKS)]


def _seeds(words: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """A hash for each place at which the mask fits."""
    n = max(0, len(words) - int(mask[-1]))
    h = np.full(n, len(mask) * 64 + int(mask[-1]), np.uint64)
    with np.errstate(over="ignore"):
        for o in mask:
            h = h * np.uint64(0xD1B54A32D192ED03) + words[o:o + n]
    return mix(h)


class _Items:
    """Test items and their seeds, sorted by hash."""

    def __init__(self, items: list[np.ndarray]):
        self.items = items
        self.masks = _masks()
        self.lengths = np.array([len(x) for x in items], np.int64)
        self.flat = np.concatenate([*items, np.zeros(0, np.uint64)])
        self.short = {x.tobytes(): i for i, x in reversed(list(enumerate(items))) if 0 < len(x) < SHORT}
        self.index = []
        for k, mask in enumerate(self.masks):
            use = [i for i, x in enumerate(items) if len(x) >= SHORT and (len(x) >= LONG_FROM) == (k < len(MASKS))]
            seeds = [_seeds(items[i], mask) for i in use]
            h = np.concatenate([*seeds, np.zeros(0, np.uint64)])
            item = np.repeat(np.array(use, np.int64), [len(s) for s in seeds])
            place = np.concatenate([*(np.arange(len(s)) for s in seeds), np.zeros(0, np.int64)]).astype(np.int64)
            order = np.argsort(h, kind="stable")
            seen = np.zeros(_TABLE, bool)
            seen[(h >> np.uint64(44)).astype(np.int64)] = True
            self.index.append((mask, h[order], item[order], place[order], seen))

    def hits(self, words: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Distinct ``(text, item, first)``: a seed fits if the item's first word lies at ``first``."""
        out = [np.zeros((0, 3), np.int64)]
        for mask, h, item, place, seen in self.index:
            if len(h) == 0:
                continue
            seeds = _seeds(words, mask)
            at = np.flatnonzero(seen[(seeds >> np.uint64(44)).astype(np.int64)])
            low, high = np.searchsorted(h, seeds[at], "left"), np.searchsorted(h, seeds[at], "right")
            at, low, many = at[high > low], low[high > low], (high - low)[high > low]
            text = np.searchsorted(before, at, "right") - 1
            inside = at + mask[-1] < before[text + 1]
            at, low, many, text = at[inside], low[inside], many[inside], text[inside]
            group, k = ragged(many)
            entry = low[group] + k
            out.append(np.stack([text[group], item[entry], at[group] - place[entry]], 1))
        return np.unique(np.concatenate(out), axis=0)


    def likely(self, hits: np.ndarray, words: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Those of ``hits`` whose text and item have enough equal words on all their diagonals."""
        if len(hits) == 0:
            return hits
        text, item, first = hits.T
        n = self.lengths[item]
        low, high = np.maximum(first, before[text]), np.minimum(first + n, before[text + 1])
        at = (np.cumsum(self.lengths) - self.lengths)[item] + low - first
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(np.cumsum(high - low) // _AT_ONCE)) + 1, [len(hits)]])
        same = np.zeros(len(hits), np.int64)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            group, k = ragged((high - low)[a:b])
            same[a:b] = np.bincount(group[words[low[a:b][group] + k] == self.flat[at[a:b][group] + k]], minlength=b - a)
        new = np.flatnonzero(np.concatenate([[True], (np.diff(text) != 0) | (np.diff(item) != 0)]))
        enough = np.add.reduceat(same, new) >= np.minimum(RUN_WORDS, ITEM_SHARE * n[new])
        return hits[np.repeat(enough, np.diff(np.concatenate([new, [len(hits)]])))]


def best_stretch(equal: np.ndarray) -> tuple[int, int]:
    """The stretch with the highest score: equal words less twice the others;
    the first and shortest of several."""
    sums = np.concatenate([[0], np.cumsum(np.where(equal, 1, MISMATCH))])
    low = np.minimum.accumulate(sums)
    end = int(np.argmax(sums - low))
    start = int(np.flatnonzero(sums[:end + 1] == low[end])[-1])
    return start, end


def stretches(equal: np.ndarray, least: int) -> list[tuple[int, int]]:
    """The best stretch, the best ones beside it, and so on, as far as they
    score ``least`` or more."""
    out, open_ = [], [(0, len(equal))]
    while open_:
        low, high = open_.pop()
        start, end = best_stretch(equal[low:high])
        if np.where(equal[low + start:low + end], 1, MISMATCH).sum() >= max(1, least):
            out.append((low + start, low + end))
            open_ += [(low, low + start), (low + end, high)]
    return sorted(out)


def _covered(n: int, diagonals: list[tuple[int, np.ndarray, np.ndarray]]) -> int:
    """How many of an item's ``n`` words a text has in place: on one diagonal,
    or in stretches on diagonals less than ``n`` words apart."""
    diagonals = sorted(diagonals, key=lambda d: d[0])
    most = max(len(same) for _, same, _ in diagonals)
    count, begin = np.zeros(n, np.int64), 0
    for first, _, runs in diagonals:
        count[runs] += 1
        while diagonals[begin][0] <= first - n:
            count[diagonals[begin][2]] -= 1
            begin += 1
        most = max(most, int(np.count_nonzero(count)))
    return most


def _overlaps(items: _Items, words: np.ndarray, before: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
    """``(text, item, from, to, equal words)`` for each verified item of each text."""
    found: dict[tuple[int, int], list[tuple[int, np.ndarray, int]]] = {}
    for text, item, first in items.likely(items.hits(words, before), words, before).tolist():
        x = items.items[item]
        low, high = max(first, int(before[text])), min(first + len(x), int(before[text + 1]))
        found.setdefault((text, item), []).append((first, words[low:high] == x[low - first:high - first], low))
    for (text, item), laid in sorted(found.items(), key=lambda f: f[0]):
        n = len(items.items[item])
        best, diagonals = [], []
        for first, equal, low in laid:
            start, end = best_stretch(equal)
            best.append((low + start, low + end, np.flatnonzero(equal[start:end]) + start + low - first))
            runs = [np.flatnonzero(equal[s:e]) + s for s, e in stretches(equal, SHORT)]
            diagonals.append((first, np.flatnonzero(equal), np.concatenate([*runs, np.zeros(0, np.int64)]).astype(np.int64) + low - first))
        covered = _covered(n, diagonals)
        far = [s[2] for s in best if len(s[2]) >= FAR_WORDS]
        if n >= LONG_FROM and far:
            covered = max(covered, len(np.unique(np.concatenate(far))))
        start, end, same = max(best, key=lambda s: (len(s[2]), -s[0]))
        if len(same) >= RUN_WORDS or covered >= ITEM_SHARE * n:
            yield text, item, start - int(before[text]), end - int(before[text]), covered
    if items.short:
        for text in np.flatnonzero((np.diff(before) > 0) & (np.diff(before) < SHORT)).tolist():
            whole = words[before[text]:before[text + 1]]
            if (item := items.short.get(whole.tobytes())) is not None:
                yield text, item, 0, len(whole), len(whole)


def _find(blocks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = None
        for b in steps(batches, "text"):
            if items is None:
                items = _Items([np.frombuffer(x, np.uint64) for x in blocks.value])
            words, before = _words(b.column("text"))
            rows = list(_overlaps(items, words, before))
            if rows:
                text, item, start, end, equal = (np.array(c, np.int64) for c in zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(pa.array(text)), pa.array(item), pa.array(start), pa.array(end), pa.array(equal),
                     pa.array([len(items.items[i]) for i in item.tolist()], pa.int64())],
                    ["doc_id", "item", "start_word", "end_word", "equal_words", "item_words"])
    return run


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in steps(batches, "text"):
        words, before = _words(b.column("text"))
        yield pa.RecordBatch.from_arrays(
            [b.column("item_id"), pa.array([words[s:e].tobytes() for s, e in zip(before[:-1], before[1:], strict=True)], pa.binary())],
            ["item_id", "words"])


def overlaps(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, item_id, start_word, end_word, equal_words, item_words)``: one
    row for each test item that a document holds, with its best stretch in
    words of the document and the number of the item's words found.

    An item is held if a stretch has ``RUN_WORDS`` equal words, if
    ``ITEM_SHARE`` of its words are equal in place, or if stretches beside
    each other or around words put in or left out cover that share; items of fewer than ``SHORT`` words
    only by a document that has just these words. Of items of ``LONG_FROM``
    words or more only those are looked at that keep four of some five
    neighbouring words: all with more than ``3 * ceil(n / 5)`` of ``n`` words
    in place, and below that nearly all (a test measures at least 0.9).
    Of equally good stretches the first counts. Null, empty and wordless
    texts hold nothing and are held by nothing. Repeated documents give
    repeated rows; of equal items each counts (of equal ones under ``SHORT``
    words, the first). Other columns are ignored. Items beyond
    ``BLOCK_WORDS`` words are taken in blocks, each over all documents.
    """
    prepared(spark)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = benchmark.schema["item_id"].dataType.simpleString()
    items = table(spark, benchmark.select("item_id", "text").mapInArrow(_item_words, f"item_id {kind}, words binary"), "decontaminate-items")
    total = items.agg(F.sum(F.length("words") / 8)).first()[0] or 0
    n_blocks = max(1, math.ceil(total / BLOCK_WORDS * 1.25)) if total > BLOCK_WORDS else 1
    found = None
    for k in range(n_blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "words"), F.lit(n_blocks)) == k).orderBy("item_id", "words").collect()
        blocks = spark.sparkContext.broadcast([bytes(r["words"]) for r in rows])
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], f"item long, item_id {kind}")
        part = docs.mapInArrow(
            _find(blocks), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item long, start_word long, end_word long, equal_words long, item_words long"
        ).join(F.broadcast(names), "item").select("doc_id", "item_id", "start_word", "end_word", "equal_words", "item_words")
        found = part if found is None else found.union(part)
    return found


def decontaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no test item."""
    held = table(spark, overlaps(spark, docs, benchmark).select("doc_id").distinct(), "decontaminate-held")
    return docs.join(small(held), "doc_id", "left_anti").select(*docs.columns)
