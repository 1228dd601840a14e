"""Language identification with string kernels.

The blended-spectrum presence kernel of two texts counts the n-grams of code
points, n = 1 to ``SPECTRUM``, that both have, normalised by the texts' own
counts. Landmark texts give Nyström features; one ridge regression a language
(one against the rest) is fitted on them. A batch of texts is scored by two
matrix products: presence times landmarks, kernels times weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybatch.llm.common import mix, prepared, ragged, steps

SPECTRUM = 3
#: Labelled texts that the model is fitted on, for each language and in all;
#: landmarks among them; most frequent n-grams that the kernel sees.
TRAIN_EACH, TRAIN_ALL, LANDMARKS, GRAMS = 300, 4_000, 96, 24_000
RIDGE = 1e-2
#: Texts of one matrix product.
BATCH = 64
UNKNOWN = "und"

_TABLE = 1 << 20


@dataclass
class Model:
    """``grams`` ascending, presence of each in each landmark, weights of the
    kernels with the landmarks for each language; for each language which
    n-grams its texts have, and the median share of a text's n-grams that the
    others have (0 for a language of one text)."""

    langs: list[str]
    grams: np.ndarray
    landmarks: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    seen: np.ndarray | None = None
    typical: np.ndarray | None = None

    def __post_init__(self):
        self.slots = np.full(_TABLE, -1, np.int32)
        self.slots[_slot(self.grams)] = np.arange(len(self.grams))
        self.norms = np.sqrt(np.maximum(self.landmarks.sum(0), 1))


def _slot(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(44)).astype(np.int64)


def text_grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of each n-gram of the lower-cased texts; none spans two texts."""
    lower = pc.utf8_lower(pc.fill_null(texts, ""))
    sizes = pc.utf8_length(lower).to_numpy(zero_copy_only=False).astype(np.int64)
    points = np.frombuffer("".join(lower.to_pylist()).encode("utf-32-le"), np.uint32).astype(np.uint64)
    text, place = ragged(sizes)
    left = sizes[text] - place
    out, h = [], np.zeros(len(points), np.uint64)
    with np.errstate(over="ignore"):
        for n in range(1, SPECTRUM + 1):
            h = h * np.uint64(0x9E3779B97F4A7C15)
            h[:len(h) - n + 1] += points[n - 1:] + np.uint64(1)
            keep = left >= n
            out.append((text[keep], mix(h[keep] + np.uint64(n))))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _presence(model: Model, texts: pa.Array) -> np.ndarray:
    """Which of the model's n-grams each text has."""
    present = np.zeros((len(texts), len(model.grams)), np.float32)
    text, h = text_grams(texts)
    at = model.slots[_slot(h)]
    some = np.flatnonzero(at >= 0)
    some = some[model.grams[at[some]] == h[some]]
    present[text[some], at[some]] = 1
    return present


def _kernel(model: Model, present: np.ndarray) -> np.ndarray:
    own = np.sqrt(np.maximum(present.sum(1), 1))
    return (present @ model.landmarks) / own[:, None] / model.norms


def fit(rows: list[tuple[str, np.ndarray]]) -> Model:
    """Fits on ``(language, distinct n-gram hashes)``; with none, everything is ``und``."""
    langs = sorted({lang for lang, _ in rows})
    if not langs:
        return Model([], np.zeros(0, np.uint64), np.zeros((0, 0), np.float32), np.zeros((0, 0)), np.zeros(0))
    rows = sorted(rows, key=lambda r: (len(r[1]) < 200, r[0], r[1].tobytes()[:64]))
    by_lang = {lang: [r for r in rows if r[0] == lang] for lang in langs}
    every, n = np.unique(np.concatenate([*(g for _, g in rows), np.zeros(0, np.uint64)]), return_counts=True)
    often = every[np.argsort(-n, kind="stable")[:GRAMS]]
    grams = np.sort(often[np.unique(_slot(often), return_index=True)[1]])  # of n-grams of one slot the most frequent

    def presence(some):
        out = np.zeros((len(some), len(grams)), np.float32)
        for i, (_, g) in enumerate(some):
            at = np.minimum(np.searchsorted(grams, g), max(len(grams) - 1, 0))
            out[i, at[grams[at] == g]] = 1
        return out

    chosen = []
    for k in range(max((len(v) for v in by_lang.values()), default=0)):
        chosen += [v[k] for v in by_lang.values() if k < len(v)]
        if len(chosen) >= LANDMARKS:
            break
    model = Model(langs, grams, np.ascontiguousarray(presence(chosen[:LANDMARKS]).T), np.zeros((0, 0)), np.zeros(0))
    low = _kernel(model, np.ascontiguousarray(model.landmarks.T)).astype(np.float64)
    values, vectors = np.linalg.eigh(low + 1e-6 * np.eye(len(low)))
    root = vectors / np.sqrt(np.maximum(values, 1e-6))  # K^(-1/2) up to a rotation
    features = np.concatenate([_kernel(model, presence(rows[i:i + 256])) for i in range(0, len(rows), 256)]).astype(np.float64) @ root
    target = np.array([[1.0 if r[0] == lang else -1.0 for lang in langs] for r in rows])
    share = np.array([len(by_lang[r[0]]) for r in rows], np.float64)
    w = (1 / share)[:, None]  # each language counts alike
    x = np.concatenate([features, np.ones((len(rows), 1))], 1)
    scale = np.diag([RIDGE] * features.shape[1] + [1e-9])
    solved = np.linalg.solve(x.T @ (x * w) + scale, x.T @ (target * w))
    model.weights, model.bias = (root @ solved[:-1]).astype(np.float32), solved[-1].astype(np.float32)
    model.seen, model.typical = np.zeros((len(langs), len(grams)), bool), np.zeros(len(langs))
    for k, lang in enumerate(langs):
        own = [(presence([r])[0] > 0, max(1, len(r[1]))) for r in by_lang[lang]]
        many = sum(has.astype(np.int64) for has, _ in own)
        model.seen[k] = many > 0
        model.typical[k] = np.median([np.count_nonzero(has & (many > 1)) / size for has, size in own])
    return model


def known(model: Model, texts: pa.Array, langs: list[str]) -> np.ndarray:
    """The share of each text's longest n-grams, repeats and all, that texts of
    its language have, as a multiple of what is typical of the language. It
    does not depend on the number of languages. 0 for ``und``."""
    out, place = np.zeros(len(texts)), {lang: k for k, lang in enumerate(model.langs)}
    for i in range(0, len(texts), BATCH):
        some = texts.slice(i, BATCH)
        lang = np.array([place.get(x, -1) for x in langs[i:i + BATCH]], np.int64)
        text, h = text_grams(some)
        points = pc.fill_null(pc.utf8_length(pc.utf8_lower(some)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        long = max(0, len(h) - int(np.maximum(points - SPECTRUM + 1, 0).sum()))  # the longest come last
        use = (np.arange(len(h)) >= long) | (points[text] < SPECTRUM)
        text, h = text[use], h[use]
        at = model.slots[_slot(h)]
        hit = (at >= 0) & (lang[text] >= 0)
        hit[hit] = model.grams[at[hit]] == h[hit]
        hit[hit] = model.seen[lang[text[hit]], at[hit]]
        sizes = np.maximum(np.bincount(text, minlength=len(some)), 1)
        share = np.bincount(text[hit], minlength=len(some)) / sizes
        usual = np.where(lang >= 0, model.typical[lang], 1) if len(model.langs) else np.ones(len(some))
        out[i:i + BATCH] = np.where(lang < 0, 0.0, np.where(usual > 0, share / np.maximum(usual, 1e-9), 1.0))
    return out


def predict(model: Model, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of each text. The score is the best language's share
    of the softmax over three times the regressions; 0 for ``und``."""
    n = len(texts)
    letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
    if not model.langs:
        return [UNKNOWN] * n, np.zeros(n)
    margin = np.concatenate([np.zeros((0, len(model.langs))), *(
        _kernel(model, _presence(model, texts.slice(i, BATCH))) @ model.weights + model.bias for i in range(0, n, BATCH))])
    e = np.exp(3 * (margin - margin.max(1, keepdims=True)))
    best = margin.argmax(1)
    share = e[np.arange(n), best] / e.sum(1)
    return [model.langs[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), letters.tolist(), strict=True)], np.where(letters, share, 0.0)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in steps(batches, "text"):
        for i in range(b.num_rows):
            grams = np.unique(text_grams(b.column("text").slice(i, 1))[1])
            yield pa.RecordBatch.from_arrays([b.column("lang").slice(i, 1), pa.array([grams.tobytes()], pa.binary())], ["lang", "grams"])


def train(spark: SparkSession, docs: DataFrame) -> Model:
    """Fits on documents with text and a language whose ``crc32(doc_id) mod 3``
    is not 1: by the least hash of the id, up to ``TRAIN_EACH`` a language and
    ``TRAIN_ALL`` in all. Which they are is settled on ids and languages; only
    their texts are read whole."""
    prepared(spark)
    learn = (docs.filter("doc_id is not null and text is not null and lang is not null")
             .filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1))
    u = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    counts = {r["lang"]: r["n"] for r in learn.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(TRAIN_ALL).collect()}
    each = max(1, min(TRAIN_EACH, TRAIN_ALL // max(1, len(counts))))
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, min(1.0, each / n)).otherwise(share)
    sample = learn.filter(u < share * (1 << 30)).select("lang", "text").mapInArrow(_sampled, "lang string, grams binary")
    return fit([(r["lang"], np.frombuffer(bytes(r["grams"]), np.uint64)) for r in sample.limit(2 * TRAIN_ALL).collect()])


def identify(spark: SparkSession, docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score)`` for each row. Null texts and texts without
    a letter are ``und`` with score 0; repeated rows are judged each; whole
    texts count; other columns are ignored."""
    prepared(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches, "text", 1_000_000):
            lang, score = predict(shared.value, b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(lang, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def in_known_language(spark: SparkSession, docs: DataFrame, model: Model, least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose text is of a learned language and has at
    least ``least`` times the share of the language's n-grams that is typical
    of it, with all their columns."""
    prepared(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches, "text", 1_000_000):
            lang, _ = predict(shared.value, b.column("text"))
            enough = known(shared.value, b.column("text"), lang) >= least
            yield b.filter(pa.array([x != UNKNOWN and ok for x, ok in zip(lang, enough.tolist(), strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
