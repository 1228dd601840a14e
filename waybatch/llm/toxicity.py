"""Toxicity by a factorization machine over hashed terms.

``score = w0 + sum w_t + 1/2 sum_f ((sum v_tf)^2 - sum v_tf^2)`` over a text's
distinct terms: besides a weight for each term, each pair of terms has one, the
product of their factors, such as that of an insult with the group it names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybatch.llm.common import NOT_ALNUM, mix, prepared, steps, text_buffers, word_hashes, word_spans

#: Hash range of terms, terms kept by the model, factors of a term.
RANGE, TERMS, FACTORS = 1 << 20, 2048, 8
#: Bytes of a word's stem, a term of its own.
STEM = 6
#: Labelled documents that the model is fitted on, at most.
MAX_TRAIN = 8_000
#: A term is kept if its share among the toxic differs by so many standard errors.
LEAST_Z = 4.0


@dataclass
class Model:
    """``place`` maps hashed terms to rows of ``w`` and ``v`` (-1: not kept)."""

    place: np.ndarray
    w0: float
    w: np.ndarray
    v: np.ndarray


def text_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hashed term of each word (lower-cased runs of letters
    and digits) and of each word's first ``STEM`` bytes."""
    data, offsets = text_buffers(pc.utf8_lower(texts))
    starts, ends, before = word_spans(data, offsets, NOT_ALNUM)
    whole = word_hashes(data, starts, ends)
    stems = mix(word_hashes(data, starts, np.minimum(ends, starts + STEM)))
    text = np.repeat(np.arange(len(texts)), np.diff(before))
    return np.concatenate([text, text]), (np.concatenate([whole, stems]) >> np.uint64(44)).astype(np.int64)


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in steps(batches, "text"):
        text, term = text_terms(b.column("text"))
        both = np.unique(text * RANGE + term)
        edges = np.searchsorted(both, np.arange(b.num_rows + 1) * RANGE)
        terms = (both % RANGE).astype(np.uint32)
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id").cast(pa.int64()), b.column("toxic").cast(pa.int32()), pa.array([terms[s:e].tobytes() for s, e in zip(edges[:-1], edges[1:], strict=True)], pa.binary())],
            ["doc_id", "toxic", "terms"])


def _choose(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """The terms whose share among the toxic texts differs most surely."""
    flat = np.concatenate([*rows, np.zeros(0, np.uint32)]).astype(np.int64)
    in_toxic = np.repeat(y, [len(r) for r in rows])
    a, n = np.bincount(flat[in_toxic > 0], minlength=RANGE), np.bincount(flat, minlength=RANGE)
    n1, n0 = y.sum(), (1 - y).sum()
    p = (n + 1) / (n1 + n0 + 2)
    z = np.abs((a + 0.5) / (n1 + 1) - (n - a + 0.5) / (n0 + 1)) / np.sqrt(p * (1 - p) * (1 / (n1 + 1) + 1 / (n0 + 1)))
    z[n < 4] = 0
    best = np.argsort(-z, kind="stable")[:TERMS]
    return np.sort(best[z[best] >= LEAST_Z])


def fit(rows: list[np.ndarray], labels: np.ndarray, rounds: int = 200, rate: float = 0.05, shrink: float = 1e-3) -> Model:
    """Fits by Adam on the logistic loss, from fixed starting values. With no
    rows, or labels of one kind only, the model is a constant."""
    y = np.asarray(labels, np.float64)
    place = np.full(RANGE, -1, np.int32)
    if len(y) == 0 or y.min() == y.max():
        return Model(place, 20.0 if len(y) and y[0] else -20.0, np.zeros(0), np.zeros((0, FACTORS)))
    kept = _choose(rows, y)
    place[kept] = np.arange(len(kept))
    x = np.zeros((len(rows), len(kept)), np.float32)
    for i, r in enumerate(rows):
        at = place[r.astype(np.int64)]
        x[i, at[at >= 0]] = 1
    rng = np.random.default_rng(7)
    p = {"w0": np.array([np.log(y.mean() / (1 - y.mean()))]), "w": np.zeros(len(kept)), "v": rng.normal(0, 0.05, (len(kept), FACTORS))}
    m, s = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    for t in range(1, rounds + 1):
        v = p["v"].astype(np.float32)
        sums = x @ v
        z = p["w0"] + x @ p["w"].astype(np.float32) + 0.5 * (sums**2 - x @ v**2).sum(1)
        g = ((1 / (1 + np.exp(-np.clip(z, -30, 30)))) - y).astype(np.float32) / len(y)
        xg = x.T @ g
        grad = {"w0": np.array([g.sum()]), "w": xg + shrink * p["w"] / len(y), "v": x.T @ (g[:, None] * sums) - xg[:, None] * v + shrink * p["v"] / len(y)}
        for k in p:
            m[k] = 0.9 * m[k] + 0.1 * grad[k]
            s[k] = 0.999 * s[k] + 0.001 * grad[k] ** 2
            p[k] -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)
    return Model(place, float(p["w0"][0]), p["w"], p["v"])


def scores(model: Model, texts: pa.Array) -> np.ndarray:
    """Probabilities of the label; texts without known terms get the bias's."""
    n = len(texts)
    z = np.full(n, model.w0)
    if len(model.w):
        text, term = text_terms(texts)
        at = model.place[term]
        both = np.unique((text * len(model.w) + at)[at >= 0])
        text, at = both // len(model.w), both % len(model.w)
        z += np.bincount(text, model.w[at], n)
        for f in range(FACTORS):
            v = model.v[at, f]
            z += 0.5 * (np.bincount(text, v, n) ** 2 - np.bincount(text, v * v, n))
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> Model:
    """Fits on documents with a non-null label whose ``crc32(doc_id) mod 5`` is
    not 0, at most ``MAX_TRAIN`` of them by the least hash of the id. Of
    several labels of a document the highest counts; of several texts with
    one id, one (the least in its terms)."""
    prepared(spark)
    known = (labels.select("doc_id", "toxic").filter("doc_id is not null and toxic is not null")
             .filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_TRAIN))
    sample = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    terms = sample.select("doc_id", "text", "toxic").mapInArrow(_distinct, "doc_id long, toxic int, terms binary")
    one = terms.groupBy("doc_id").agg(F.min(F.struct("terms", "toxic")).alias("r"))  # as many rows as labels
    rows = sorted((bytes(r["r"]["terms"]), r["r"]["toxic"]) for r in one.collect())
    return fit([np.frombuffer(t, np.uint32) for t, _ in rows], np.array([y for _, y in rows]))


def score(spark: SparkSession, docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score)`` for each row; null and empty texts get the model's
    bias. Repeated rows are scored each; other columns are ignored."""
    prepared(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches, "text"):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(scores(shared.value, b.column("text")))], ["doc_id", "score"])

    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, score double")


def not_toxic(spark: SparkSession, docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``limit``, with all their columns."""
    prepared(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches, "text"):
            yield b.filter(pa.array(scores(shared.value, b.column("text")) < limit))

    return docs.mapInArrow(run, docs.schema)
