"""Spelling variants: near words of a vocabulary by finite-state composition,
and the form that each word is a variant of.

Two words are near if one edit (a code point inserted, deleted or replaced)
leads from one to the other. With ``m`` the length of the shorter one, the edit
lies in its first half or behind it, so that the words share what is behind the
first half or the first half itself. That half leads an acceptor of the whole
vocabulary (or of the reversed one) to a state, and the words are partitioned by
it: a partition is what the acceptor accepts from one initial state. In it, the
minimised acceptor is composed with a one-edit transducer and with the acceptor
again, and the accepted pairs are enumerated. A partition of very many words is
split once more in the same way, by halves of what its words don't share.

Each pair is accepted in one partition only (an insertion into a run of equal
letters counts as one behind the run), and leaves it as a count and a best
partner for each word: pairs are never rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybatch.llm.common import prepared, release, small, table

#: Partitions of more words are split again.
GROUP_WORDS = 4096
#: Words a task gives back at once.
OUT_ROWS = 20_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(docs: DataFrame, min_length: int = 5, min_count: int = 3, dropped: int = 97,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, n)``: letter runs ``[A-Za-z\\u00C0-\\u00FF]+`` of the whole texts with
    A-Z lower-cased, and how often they occur, over all rows.

    Where ``dropped`` divides the crc32 ``h`` of ``<id>:<run>``, the run's code
    point ``h % length`` (from 0) is deleted first (0: nowhere). Words of fewer
    than ``min_length`` code points or ``min_count`` occurrences are left out.
    Null texts have no words, a null id counts as empty, repeated rows count
    each; a frequent word is counted before the shuffle.
    """
    lower = F.translate(F.col(text_col), _UPPER, _LOWER)
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.split(lower, "[^a-zÀ-ÿ]+")).alias("run")).filter(F.length("run") >= min_length)
    word = F.col("run")
    if dropped:
        runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
        at = (F.col("h") % F.length("run")).cast("int")
        cut = F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
        word = F.when(F.col("h") % dropped == 0, cut).otherwise(word)
    words = runs.select(word.alias("word")).filter(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def _part(text: str, start: Column | int, length: Column) -> Column:
    """``length`` code points from ``start`` (from 0)."""
    return F.substring(F.col(text), F.lit(start) + 1 if isinstance(start, int) else start + 1, length)


def _halved(rows: DataFrame) -> DataFrame:
    """Words by the half that they share with what they are near to.

    ``rows``: ``(key, m, inner, rest, word, n)``, where words of one ``key`` share
    all but ``rest``, which has ``m`` code points (the shorter word of a pair)
    or one more (the longer). ``inner``: an insertion at the very end of
    ``rest`` belongs to another partition.
    """
    longer = (F.length("rest") - F.col("m")).cast("int")
    p = F.floor(F.col("m") / 2).cast("int")
    end = F.length("rest")
    by = lambda side, half, m, inner, rest: F.struct(
        F.concat_ws("/", "key", F.lit(side), m.cast("string"), half).alias("key"), m.cast("int").alias("m"), inner.alias("inner"), rest.alias("rest"))
    first = by("<", _part("rest", 0, p), F.col("m") - p, F.col("inner"), _part("rest", p, end))
    last = by(">", _part("rest", p + longer, end), p, F.lit(True), _part("rest", 0, p + longer))
    return rows.select(F.explode(F.array(first, last)).alias("x"), "word", "n").select("x.*", "word", "n")


def partitions(spark: SparkSession, vocab: DataFrame, min_length: int, limit: int = GROUP_WORDS) -> DataFrame:
    """Rows for ``_accepted``: four for each word, as the shorter and as the
    longer one of a pair, for an edit in either half; twice as many again for
    each time that its partition was split."""
    whole = vocab.select("word", "n", F.length("word").alias("length"))
    whole = whole.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("longer")).withColumn("m", F.col("length") - F.col("longer"))
    rows = _halved(whole.filter(F.col("m") >= min_length).select(
        F.lit("").alias("key"), "m", F.lit(False).alias("inner"), F.col("word").alias("rest"), "word", "n"))
    while True:
        large = table(spark, rows.filter("m > 1").groupBy("key").agg(F.count(F.lit(1)).alias("words")).filter(F.col("words") > limit).select("key"), "variant-groups")
        if large.isEmpty():
            return rows
        large = small(large)
        rows = rows.join(large, "key", "left_anti").unionByName(_halved(rows.join(large, "key", "left_semi")))


class Acceptor:
    """The minimal acyclic acceptor of sorted, different texts of one length.
    ``arcs[q]`` maps a letter to the next state and to the number of texts
    before it; so the way to a text also gives its rank among all of them."""

    def __init__(self, texts: list[str]):
        self.arcs: list[dict[str, tuple[int, int]]] = []
        self.count: list[int] = []
        known: dict[tuple, int] = {}
        path: list[dict[str, int]] = [{}]
        before = ""

        def close(depth: int) -> int:
            """States beyond ``depth`` can't change any more: each becomes the known state with the same arcs."""
            q = -1
            while len(path) > depth:
                to = path.pop()
                q = known.setdefault(tuple(to.items()), len(self.arcs))
                if q == len(self.arcs):
                    arcs, n = {}, 0
                    for letter, t in to.items():
                        arcs[letter] = (t, n)
                        n += self.count[t]
                    self.arcs.append(arcs)
                    self.count.append(max(n, 1))
                if path:
                    path[-1][before[len(path) - 1]] = q
            return q

        for text in texts:
            same = 0
            while same < len(before) and before[same] == text[same]:
                same += 1
            close(same + 1)
            path.extend({} for _ in text[same:])
            before = text
        self.start = close(0)


def _common(a: Acceptor, q: int, x: int, b: Acceptor, r: int, y: int) -> Iterator[tuple[int, int]]:
    """Ranks of the texts that both states accept, ``x`` and ``y`` texts being before them."""
    open_ = [(q, x, r, y)]
    while open_:
        q, x, r, y = open_.pop()
        if a is b and q == r:
            yield from zip(range(x, x + a.count[q]), range(y, y + a.count[q]), strict=True)
            continue
        mine, other = a.arcs[q], b.arcs[r]
        if not mine and not other:
            yield x, y
        elif len(mine) <= len(other):
            open_ += [(t, x + i, *_to(other[c], y)) for c, (t, i) in mine.items() if c in other]
        else:
            open_ += [(*_to(mine[c], x), t, y + i) for c, (t, i) in other.items() if c in mine]


def _to(arc: tuple[int, int], rank: int) -> tuple[int, int]:
    return arc[0], rank + arc[1]


def replaced(a: Acceptor) -> Iterator[tuple[int, int]]:
    """Pairs of texts, as ranks, accepted by ``a``, one replacement and ``a`` again."""
    open_ = [(a.start, 0)]
    while open_:
        q, x = open_.pop()
        arcs = list(a.arcs[q].values())
        for k, (to, i) in enumerate(arcs):
            open_.append((to, x + i))
            for other, j in arcs[k + 1:]:
                yield from _common(a, to, x + i, a, other, x + j)


def inserted(a: Acceptor, b: Acceptor, inner: bool) -> Iterator[tuple[int, int]]:
    """Pairs of a text of ``a`` and one of ``b`` that has one letter more.
    The letter counts as inserted behind the run of its equals; ``inner``
    leaves out those that are then at the very end."""
    open_ = [(a.start, 0, b.start, 0)]
    while open_:
        q, x, r, y = open_.pop()
        mine = a.arcs[q]
        for c, (to, i) in b.arcs[r].items():
            if not mine:
                if not inner:
                    yield x, y + i
                continue
            after = b.arcs[to]
            for d, (t, j) in mine.items():
                if d != c and d in after:
                    yield from _common(a, t, x + j, b, *_to(after[d], y + i))
            if c in mine:
                open_.append((*_to(mine[c], x), to, y + i))


def _near(rows: list[tuple]) -> Iterator[tuple[str, int, int, str]]:
    """Of one partition's rows, sorted by ``rest``: each word that has a near
    one, with their number and the best of them."""
    m, inner = rows[0][1], rows[0][2]
    shorter, longer = ([r for r in rows if len(r[3]) == m + k] for k in (0, 1))
    if not shorter or len(rows) < 2:
        return
    found: dict[str, list] = {}

    def add(u: tuple, v: tuple) -> None:
        for (*_, word, n), (*_, other, k) in ((u, v), (v, u)):
            own = found.setdefault(word, [n, 0, 0, ""])
            own[1] += 1
            if (-k, other) < (-own[2], own[3]) or not own[2]:
                own[2:] = k, other

    a = Acceptor([r[3] for r in shorter])
    for i, j in replaced(a):
        add(shorter[i], shorter[j])
    if longer:
        for i, j in inserted(a, Acceptor([r[3] for r in longer]), inner):
            add(shorter[i], longer[j])
    for word, (_, n_near, best_n, best) in found.items():
        yield word, n_near, best_n, best


_NEAR = "word string, n_near long, best_n long, best string"


def _accepted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "m", "inner", "rest", "word", "n"]
    stream = (row for b in batches for row in zip(*(b.column(c).to_pylist() for c in names), strict=True))
    out: list[tuple] = []
    give = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
        zip(*out, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["word", "n_near", "best_n", "best"])
    for _, rows in groupby(stream, key=lambda r: r[0]):
        out += _near(list(rows))
        if len(out) >= OUT_ROWS:
            yield give()
            out.clear()
    if out:
        yield give()
    release()


def near_words(spark: SparkSession, vocab: DataFrame, min_length: int = 5, limit: int = GROUP_WORDS) -> DataFrame:
    """``(word, n_near, best_n, best)`` for each word of ``vocab (word, n)`` that
    has near words: how many, and the one of largest ``n`` (ties: the least).
    Words are different and of ``min_length`` code points or more, ``n`` is
    positive; an empty vocabulary gives no rows."""
    prepared(spark)
    rows = partitions(spark, vocab, min_length, limit).repartition("key").sortWithinPartitions("key", "rest")
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("word")))
    found = rows.mapInArrow(_accepted, _NEAR).groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    return found.select("word", "n_near", (-F.col("b.minus")).alias("best_n"), F.col("b.word").alias("best"))


def _roots(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``(word, root)``: the ends of the chains ``word -> form``, by pointer
    jumping. A form occurs more often than its word, so there is no ring."""
    at = table(spark, links.select("word", F.col("form").alias("root")), "variant-links")
    while True:
        next_ = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = table(spark, at.join(small(next_), "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "variant-roots")
        at = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return at


def variants(spark: SparkSession, vocab: DataFrame, ratio: int = 2, min_length: int = 5, limit: int = GROUP_WORDS) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for each word of ``vocab (word, n)``.

    ``form`` is the near word of largest ``n`` (ties: the least in code-point
    order) if it occurs ``ratio`` times as often as the word or more, else
    null; ``root`` is the end of the chain of forms, the word itself if it has
    none. Null words are ignored.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more: a chain of forms could be a ring")
    vocab = table(spark, vocab.select("word", "n").filter("word is not null"), "variant-words")
    near = near_words(spark, vocab, min_length, limit)
    fits = F.col("best_n") >= F.col("n") * ratio
    words = table(spark, vocab.join(near, "word", "left").select(
        "word", F.when(fits, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(fits, F.col("best_n")).alias("form_n")), "variant-forms")
    roots = _roots(spark, words.filter("form is not null").select("word", "form"))
    return words.join(small(roots), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
