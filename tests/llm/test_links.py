import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from waybatch.llm import jaccard, queries, warc
from waybatch.llm.components import connected_components


def classes(rows, words, percent):
    """Set sizes and least ids of linked documents, by definition."""
    sets, roots = {}, {}
    for i, text in rows:
        raw = (text or "").encode()
        w = bytes(b + 32 if 65 <= b <= 90 else b for b in raw).split()
        sets[i] = {tuple(w[k:k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()
        roots[i] = i

    def root(i):
        while roots[i] != i:
            i = roots[i]
        return i

    for a, x in sets.items():
        for b, y in sets.items():
            if b < a and x & y and 100 * len(x & y) >= percent * len(x | y):
                p, q = root(a), root(b)
                roots[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), root(i)) for i in sets}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def texts(seed, groups=12, of=10):
    """Groups of near copies around the threshold, chains, and shared passages."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(30)]
    out = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(5, 60))] + (passage if rng.random() < 0.5 else [])
        for _ in range(rng.randint(1, of)):
            base = list(base) if rng.random() < 0.5 else base
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            out.append(" ".join(copy))
            if rng.random() < 0.3:
                base = copy
    return out + ["", None, "  ", "one", "ONE", "one two three", "ÉÉ éé", "a\x0bb\x0cc d", "same " * 500, "same " * 400, "w1 " * 20_000]


@pytest.mark.parametrize("block,words,percent", [(4, 4, 85), (1024, 5, 80), (4, 2, 50)])
def test_classes_equal_brute_force(spark, docs, monkeypatch, block, words, percent):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "BLOCK_ELEMENTS", 40 * block)
    rows = texts(words + block)
    ids = random.Random(block).sample(range(10_000), len(rows))
    want = classes(list(zip(ids, rows, strict=True)), words, percent)
    assert len({c for _, c in want.values()}) < len(want)
    assert result(jaccard.link_classes(spark, docs(rows, ids), words, percent)) == want


def test_classes_on_the_documents(spark, tables):
    rows = [(r.doc_id, r.text) for r in tables("documents").collect()]
    assert result(queries.op7_ngram_jaccard(spark, "/root/testdata/sf0.001")) == classes(rows, 4, 85)


def test_no_documents_and_repeated_rows(spark, docs):
    assert jaccard.link_classes(spark, docs([])).count() == 0
    d = docs(["a b c d e f"] * 3 + ["x y z u v w"] * 2 + [None], [4, 4, 9, 7, 7, 8])
    assert result(jaccard.link_classes(spark, d)) == {4: (2, 4), 9: (2, 4), 7: (2, 7), 8: (0, 8)}
    assert jaccard.link_classes(spark, d).count() == 6
    kept = jaccard.keep_one(spark, d)
    assert sorted(r.doc_id for r in kept.collect()) == [4, 7, 8] and kept.columns == d.columns


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 201), (200, 201)]
    e = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in connected_components(spark, e).collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 200, 201: 200}
    assert got == want
    assert connected_components(spark, e.limit(0)).count() == 0


FAKE = "x\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nX-Page-ID: 99999\r\nContent-Length: 30\r\n\r\n" + "y" * 30 + "\r\n\r\n"
PAYLOADS = [
    None, "", "WARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", FAKE * 5, "é" * 600, "é" * 600, "é" * 499, "é" * 499, "a\r\n", "\r\n\r\n", "\n", "WARC/1.0\r\n",
    "b" * 30_000 + FAKE + "\r\n" + "c\n" * 5000, FAKE + "z" * 90_000, "é\x85 \x00" * 400,
]


@pytest.mark.parametrize("split", ["134217728", "700"])
def test_archives_round_trip(spark, split):
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        pages = spark.createDataFrame([(i, "http://a/\r\nb c", p, 1) for i, p in enumerate(PAYLOADS)], "page_id long, url string, html string, size int").coalesce(2)
        if split == "700":  # the long payloads make too many splits of that size
            pages = pages.filter("coalesce(length(html), 0) < 5000")
        rows = {r.page_id: r.html for r in pages.collect()}
        got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(spark, pages).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = {}
    for i, p in rows.items():
        data = (p or "").encode()
        first = max(k for k, q in rows.items() if (q or "").encode() == data) if len(data) >= 1000 else i
        want[i] = (len(data), hashlib.sha1(data).hexdigest(), "response" if first == i else "revisit", None if first == i else first)
    assert got == want


def test_a_page_without_an_id_keeps_its_payload(spark):
    text = "same " * 300
    pages = spark.createDataFrame([(1, "u", text), (None, "u", text), (3, "u", text)], "page_id long, url string, html string")
    got = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to or 0) for r in warc.round_trip(spark, pages).collect())
    assert got == [(0, 1500, "response", 0), (1, 1500, "revisit", 3), (3, 1500, "response", 0)]


def test_truncated_archive_and_no_pages(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", "p" * 50) for i in range(5)], "page_id long, url string, html string").coalesce(1)
    assert warc.round_trip(spark, pages.limit(0)).count() == 0
    path = str(tmp_path / "w")
    warc.write_archives(pages, path)
    name = next(p for p in (tmp_path / "w").iterdir() if p.name.startswith("part-"))
    for crc in (tmp_path / "w").glob(".*.crc"):
        crc.unlink()
    name.write_bytes(name.read_bytes()[:-60])
    assert sorted(r.fields["X-Page-ID"] for r in warc.read_archives(spark, path).collect()) == ["0", "1", "2", "3"]


def test_archives_with_long_urls(spark):
    """The long headers are in the first of several splits."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
    try:
        urls = {0: "u", 1: "u" * 10_000, 2: "v " * 50_000, 3: None}
        pages = spark.createDataFrame([(i, urls.get(i, "w"), f"page {i} " * 50) for i in range(100)], "page_id long, url string, html string").coalesce(1)
        got = {r.page_id: r.payload_bytes for r in warc.round_trip(spark, pages).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {i: len(f"page {i} " * 50) for i in range(100)}


def raw(i, body, length=None, more=b""):
    return b"WARC/1.0\r\nX-Page-ID: %d\r\n%bContent-Length: %b\r\n\r\n%b\r\n\r\n" % (i, more, str(len(body)).encode() if length is None else length, body)


def test_archive_headers_and_ends(spark, tmp_path):
    many = b"".join(b"X-%d: y\r\n" % i for i in range(9_000))  # a header of many lines, more than 64 KB, over several splits
    records = [raw(0, b"a" * 99), raw(1, b"b", more=many), raw(2, b"c" * 77, length=b" " * 9000 + b"77"), raw(3, b"d")]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        (tmp_path / "good").mkdir()
        (tmp_path / "good" / "whole.warc").write_bytes(b"".join(records))
        for n in (1, 4, 9, 10, 30):  # cut off in the first line or the header
            (tmp_path / "good" / f"cut{n}.warc").write_bytes(records[0] + records[3] + raw(5, b"f")[:n])
        got = {}
        for r in warc.read_archives(spark, str(tmp_path / "good")).collect():
            got.setdefault(r.file.split("/")[-1], set()).add(r.fields["X-Page-ID"])
        assert got == {"whole.warc": {"0", "1", "2", "3"}, **{f"cut{n}.warc": {"0", "3"} for n in (1, 4, 9, 10, 30)}}
        (tmp_path / "wrong").mkdir()
        (tmp_path / "wrong" / "a.warc").write_bytes(records[0] + raw(6, b"g" * 50, length=b"20") + records[3])
        with pytest.raises(ValueError, match="breaks off"):
            warc.read_archives(spark, str(tmp_path / "wrong"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_small_set_leaves_the_bound_of_the_others(spark):
    """Parities are compared at the width of the pair, not of the least set in the list."""
    rng = random.Random(1)
    n = [40] + [2000] * 120
    sets = [np.array([rng.getrandbits(64) for _ in range(k)], np.uint64) for k in n]
    column = lambda x, t: np.array(x, t)
    c = {"at": column([k << 32 for k in n], np.int64), "side": column([0] * len(n), np.int64), "node": column(range(len(n)), np.int64),
         "parity": column([jaccard._parity(s, jaccard._bits(len(s))) for s in sets], object)}
    assert list(jaccard._open(c, slice(0, len(n)), 80)) == []
    c["parity"][50] = c["parity"][7]
    assert [(i, j.tolist()) for i, j in jaccard._open(c, slice(0, len(n)), 80)] == [(7, [50])]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("two_sided", [False, True])
def test_derived_links_equal_brute_force(seed, two_sided):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(200)]
    sets = []
    for _ in range(60):
        kept = set(rng.sample(base, rng.randint(150, 200))) if rng.random() < 0.8 else set()
        sets.append(np.array(sorted(kept | {rng.getrandbits(64) for _ in range(rng.randint(1, 30))}), np.uint64))
    sets += [sets[3], np.zeros(0, np.uint64)]
    side = np.array([i % 2 if two_sided else 0 for i in range(len(sets))])
    got = list(jaccard.derived_links(sets, side, 80))
    linked = lambda x, y: len(x & y) and 100 * len(x & y) >= 80 * len(x | y)
    plain = [set(s.tolist()) for s in sets]
    want = [(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if linked(plain[i], plain[j]) and (not two_sided or side[i] != side[j])]

    def classes_of(pairs):
        roots = list(range(len(sets)))
        for i, j in pairs:
            a, b = roots[i], roots[j]
            roots = [min(a, b) if r in (a, b) else r for r in roots]
        return roots
    assert set(got) <= set(want) and classes_of(got) == classes_of(want) and len(got) < len(sets)


def test_lists_are_cut_where_batches_are(spark):
    batches = [pa.RecordBatch.from_pydict({c: pa.array(x, pa.int64()) for c in ("token", "at", "node")}) for x in
               ([1, 2, 2], [2], [], [3], [4, 4], [4], [5], [6, 7, 7])]
    assert [x for b in jaccard._listed(iter(batches)) for x in b.column("token").to_pylist()] == [2, 2, 2, 4, 4, 4, 7, 7]
