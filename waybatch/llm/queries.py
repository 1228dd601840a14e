"""The registered queries of the operators, and DuckDB SQL where it says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybatch.llm import (
    bpe, decontaminate, jaccard, language, licenses, oracle, sanitise, token_store, toxicity, trie, url_filter, variants, warc, winnow,
)

RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
)
#: Hosts whose canonical URLs are the listed ones.
LISTED_HOSTS = ("spam-farm", "cheap-pills", "casino-win", "free-bets")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(n: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def listed_urls(pages: DataFrame) -> DataFrame:
    """Canonical URLs of the pages on the listed hosts."""
    bad = url_filter.host("url").rlike("(^|[.])(" + "|".join(LISTED_HOSTS) + ")[.]")
    return pages.filter(bad).select(url_filter.canonical("url").alias("canonical"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return url_filter.filter_urls(pages, listed_urls(pages), RULES)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(spark, read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(spark, read(spark, sf_dir, "documents"))


def bpe_digests(spark: SparkSession, docs: DataFrame) -> DataFrame:
    import public_tokenizers

    coded = bpe.encode(spark, docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, with_bytes=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(spark, read(spark, sf_dir, "documents"))


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    tokens = token_store.stored(spark, read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return tokens.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = language.identify(spark, docs, language.train(spark, docs))
    return found.select("doc_id", (_remainder(3) == 1).alias("held_out"), "lang_pred", "score")


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_classes(spark, read(spark, sf_dir, "documents"), words=4, percent=85)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = toxicity.score(spark, docs, toxicity.train(spark, docs, read(spark, sf_dir, "labels")))
    return found.select("doc_id", (_remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.fingerprints(spark, read(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, read(spark, sf_dir, "pages"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    sequences, _ = trie.turn_sequences(spark, read(spark, sf_dir, "conversations"))
    return trie.prefix_trie(spark, trie.with_shared_heads(sequences))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.digests(sanitise.find_personal_data(spark, read(spark, sf_dir, "documents")))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(spark, variants.vocabulary(read(spark, sf_dir, "documents")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_url_filter, op2_decontamination, op3_license_scan, op4_byte_bpe, op5_token_store,
        op6_language_id, op7_ngram_jaccard, op8_toxicity, op9_winnowing, op10_warc,
        op11_prefix_trie, op12_personal_data, op13_spelling_variants)}


_HOST = "coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '')"


def _op1_sql() -> str:
    fits = lambda h, p: f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))"
    longest = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    case = lambda value: "CASE " + " ".join(f"WHEN {fits(h, p)} THEN {value(k, h, p)}" for k, h, p in longest) + " END"
    hosts = "|".join(LISTED_HOSTS)
    return f"""
WITH u AS (
  SELECT page_id, {_HOST} AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path,
    ltrim(regexp_replace(coalesce(regexp_extract(url, '://[^?#]*[?]([^#]*)', 1), ''), '(^|&)(utm_[^&=]*|ref)=[^&]*', '', 'g'), '&') AS query
  FROM pages),
c AS (
  SELECT *, regexp_replace(host, '^www[.]', '') || rtrim(path, '/') || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS canonical FROM u),
l AS (
  SELECT DISTINCT canonical FROM c WHERE canonical <> '' AND regexp_matches(host, '(^|[.])({hosts})[.]')),
r AS (
  SELECT page_id, host, path, {case(lambda k, h, p: f"'{h}{p}'")} AS rule, {case(lambda k, h, p: f"'{k}'")} AS ruled,
    canonical IN (SELECT canonical FROM l) AS listed
  FROM c)
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, listed FROM r"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_filter": _op1_sql(),
        "op11_prefix_trie": oracle.trie_sql(),
        "op12_personal_data": oracle.personal_data_sql(),
        "op13_spelling_variants": oracle.variants_sql(),
        "op10_warc": f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {warc.REVISIT_BYTES} AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {warc.REVISIT_BYTES} AND first <> page_id THEN first END AS refers_to
FROM g""",
    }
