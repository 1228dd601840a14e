"""URL filter: host and path rules, and a list of canonical URLs tested by a
blocked Bloom filter with an exact join behind it. Columns only; no Python
runs on the executors."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the filter for each listed URL; bits and words of a block.
BITS_PER_URL = 16
BLOCK_WORDS = 4
#: Filters of up to so many blocks (40 bytes each) are broadcast.
BROADCAST_BLOCKS = 1_000_000
#: Rules are a bounded list of the caller's.
MAX_RULES = 1_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: str) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
    empty for null or without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path(url: str) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: str) -> Column:
    """Host without ``www.``, path without trailing slashes, and the query
    without tracking parameters; scheme and fragment go. Null and texts
    without ``://`` give an empty text, which is never listed."""
    query = F.regexp_replace(F.regexp_extract(url, "://[^?#]*[?]([^#]*)", 1), "(^|&)(utm_[^&=]*|ref)=[^&]*", "")
    query = F.coalesce(F.regexp_replace(query, "^&+", ""), F.lit(""))
    return F.concat(F.regexp_replace(host(url), "^www[.]", ""), F.regexp_replace(path(url), "/+$", ""),
                    F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def rule_of(rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, as columns over ``host`` and
    ``path``; null where none fits. Of rules of one length the first counts."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(reversed(rules), key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == h) | F.col("host").endswith(f".{h}")) & F.col("path").startswith(p)
        text, verdict = F.when(fits, F.lit(h + p)).otherwise(text), F.when(fits, F.lit(kind)).otherwise(verdict)
    return text, verdict


def _address(key: str, n_blocks: int) -> list[Column]:
    """Block number and, for each of its words, a mask of two bits."""
    h = F.xxhash64(F.lit("bits"), key)
    one = F.lit(1).cast("long")
    bit = [F.call_function("shiftleft", one, F.pmod(F.shiftrightunsigned(h, 6 * i), F.lit(64)).cast("int")) for i in range(2 * BLOCK_WORDS)]
    return [F.pmod(F.xxhash64(key), F.lit(n_blocks)).alias("block"),
            *(bit[2 * w].bitwiseOR(bit[2 * w + 1]).alias(f"m{w}") for w in range(BLOCK_WORDS))]


def build_filter(listed: DataFrame, key: str = "canonical") -> tuple[DataFrame, int]:
    """Blocks ``(block, w0..w3)`` of the filter of ``listed``, and their possible number."""
    n_blocks = 1 << max(4, math.ceil(math.log2(max(1, listed.count()) * BITS_PER_URL / (64 * BLOCK_WORDS))))
    blocks = listed.select(*_address(key, n_blocks)).groupBy("block").agg(
        *(F.bit_or(f"m{w}").alias(f"w{w}") for w in range(BLOCK_WORDS)))
    return blocks, n_blocks


def filter_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]],
                id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row for each row of ``pages``: id, host, path, rule, verdict and
    ``listed`` (whether the canonical URL is in ``listed``, a table with a
    column ``canonical``; nulls and repeats in it don't matter).

    The verdict is the rule's, else ``block`` for listed URLs and ``allow`` for
    all others. Null, empty and odd URLs fit no rule and are allowed; repeated
    rows are judged each. Rows that the Bloom filter clears are never
    shuffled; only possible hits go to the exact join, where AQE can split a
    URL that very many rows have.
    """
    known = listed.select("canonical").filter("canonical <> ''").distinct()
    blocks, n_blocks = build_filter(known)
    if n_blocks <= BROADCAST_BLOCKS:
        blocks = F.broadcast(blocks)
    urls = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    rule, verdict = rule_of(rules)
    urls = (urls.withColumn("host", host("url")).withColumn("path", path("url"))
            .withColumn("canonical", canonical("url"))
            .select("page_id", "host", "path", "canonical", rule.alias("rule"), verdict.alias("ruled")))
    probe = urls.select("*", *_address("canonical", n_blocks)).join(blocks, "block", "left")
    hit = F.lit(True)
    for w in range(BLOCK_WORDS):
        hit = hit & (F.col(f"w{w}").bitwiseAND(F.col(f"m{w}")) == F.col(f"m{w}"))
    probe = probe.select(*urls.columns, F.coalesce(hit, F.lit(False)).alias("possible"))
    exact = probe.filter("possible").join(
        known.withColumn("listed", F.lit(True)).hint("shuffle_hash"), "canonical", "left")
    cleared = probe.filter("not possible").withColumn("listed", F.lit(False))
    return exact.select(*cleared.columns).union(cleared).select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        F.coalesce("listed", F.lit(False)).alias("listed"))

