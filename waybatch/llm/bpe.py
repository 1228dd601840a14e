"""Byte-level BPE over Arrow batches with the tokenizers library.

A rank file (base64 token, rank) becomes a byte-level BPE model: bytes stand
as printable characters, and every split of a token into two tokens is a merge
of that token's rank. Decoding looks up each id's characters, turns them back
into bytes by the reversed byte table, and joins characters that ids split.
"""

from __future__ import annotations

import base64
import codecs
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybatch.llm.chunks import Encoder, Pieces
from waybatch.llm.common import binaries, gather, prepared, release, steps

#: A single space between two other characters: every match of a byte-level
#: pattern of this family ends before it, so texts may be cut there.
_CUT = re.compile("(?<=[^\\s᠎​﻿]) (?=[^\\s᠎​﻿])")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself if it is
    printable in Latin-1, else the next free one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    table = {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(others)}
    return [table[b] for b in range(256)]


def read_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in content.splitlines() if line)}


class Codec:
    """Encodes and decodes with the ranks of ``content``, each match of
    ``pattern`` separately and without special tokens."""

    def __init__(self, content: bytes, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        ranks = read_ranks(content)
        shown = byte_characters()
        name = {token: "".join([shown[b] for b in token]) for token in ranks}
        merges = sorted((rank, k, token) for token, rank in ranks.items() for k in range(1, len(token))
                        if token[:k] in ranks and token[k:] in ranks)
        self.tokenizer = Tokenizer(models.BPE(
            vocab={name[t]: r for t, r in ranks.items()},
            merges=[(name[t[:k]], name[t[k:]]) for _, k, t in merges], ignore_merges=True))
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.pieces = Pieces(self._split, Encoder(self.tokenizer, shown, lower=False))
        back = {c: b for b, c in enumerate(shown)}
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for text, rank in self.tokenizer.get_vocab().items():
            tokens[rank] = bytes([back[c] for c in text])
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.edges = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)
        del merges, name
        release()

    @staticmethod
    def _split(text: str) -> list[str]:
        if not text:
            return []
        first, *rest = _CUT.split(text)
        return [first, *[" " + p for p in rest]]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, joined, and how many each text has."""
        return self.pieces.ids(texts)

    def decode_bytes(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids, joined, and how many each id has."""
        return gather(self.bytes, self.edges, ids.astype(np.int64))

    def decode(self, parts: Iterable[np.ndarray]) -> Iterator[str]:
        """The text of ids that come in parts; a character that is split
        between ids or parts comes whole, with the part that completes it.
        Bytes that are no UTF-8 become U+FFFD."""
        joined = codecs.getincrementaldecoder("utf-8")("replace")
        for ids in parts:
            yield joined.decode(self.decode_bytes(ids)[0].tobytes())
        yield joined.decode(b"", final=True)

    def character_spans(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each id of one text: the first and the end code point that it
        has a byte of; ids that split a character share it."""
        data, lengths = self.decode_bytes(ids)
        begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        ends = np.cumsum(lengths)
        return np.maximum(begins[ends - lengths + 1] - 1, 0), begins[ends]


def _codec(shared, pattern: str) -> Codec:
    """One codec per Python worker and rank file."""
    key = (hash(shared.value), pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(shared.value, pattern)
    return _CODECS[key]


_CODECS: dict[tuple, Codec] = {}


def _run(shared, pattern: str, with_bytes: bool, with_spans: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches, "text"):
            codec = _codec(shared, pattern)
            ids, counts = codec.encode([t or "" for t in b.column("text").to_pylist()])
            columns, names = [b.column("doc_id"), pa.array(counts), binaries(ids.astype("<u4"), counts)], ["doc_id", "n_tokens", "ids"]
            edges = np.concatenate([[0], np.cumsum(counts)])
            if with_bytes:
                data, lengths = codec.decode_bytes(ids)
                before = np.concatenate([[0], np.cumsum(lengths)])
                columns, names = [*columns, binaries(data, np.diff(before[edges]))], [*names, "decoded"]
            if with_spans:
                spans = [codec.character_spans(ids[s:e]) for s, e in zip(edges[:-1], edges[1:], strict=True)]
                columns += [pa.array([s[k].tolist() for s in spans], pa.list_(pa.int64())) for k in (0, 1)]
                names = [*names, "char_starts", "char_ends"]
            yield pa.RecordBatch.from_arrays(columns, names)
        for codec in _CODECS.values():  # the worker lives on; what this task learned need not
            codec.pieces.forget()
        release()
    return run


def encode(spark: SparkSession, docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           with_bytes: bool = False, with_spans: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids)`` for each row; ids are little-endian unsigned
    32-bit integers. ``with_bytes`` adds ``decoded``, the bytes that the ids
    decode to; ``with_spans`` adds each id's code point span in the text.

    Null and empty texts have no ids. Texts are encoded whole, at any length.
    Repeated rows are encoded each; other columns are ignored. The rank file
    is read on the driver (a few MB) and broadcast.
    """
    prepared(spark)
    with open(ranks_path, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids binary"
    schema += ", decoded binary" * with_bytes + ", char_starts array<long>, char_ends array<long>" * with_spans
    return slim.mapInArrow(_run(shared, pattern, with_bytes, with_spans), schema)


def decode(spark: SparkSession, tokens: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``(doc_id, text)`` from ``(doc_id, ids)``; null ids give an empty text,
    bytes that are no UTF-8 give U+FFFD."""
    prepared(spark)
    with open(ranks_path, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codec = _codec(shared, pattern)
            texts = ["".join(codec.decode([np.frombuffer(x or b"", "<u4")])) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, f"doc_id {tokens.schema['doc_id'].dataType.simpleString()}, text string")
