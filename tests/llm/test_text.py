import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from waybatch.llm import bpe, common, language, queries, token_store, winnow

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PARTS = [" ", "  ", "\n", "\t", "a", "aa", "the", "The,", "B", "é", "ß", "İ", "22", "!", "'s", "'", "…", " ", "漢", "́", "😀", "\x85", "\x1c", ".", "-", "\r\n", "²", "|"]
EDGES = ["", None, " ", "   ", "a", "word " * 30_000, "x" * 50_000, "\n\n", "<|endoftext|>"]


def mixed(n, seed=0):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25))) for _ in range(n)]


@pytest.fixture(scope="module")
def codec():
    with open(RANKS, "rb") as f:
        return bpe.Codec(f.read(), public_tokenizers.PATTERN)


def test_bpe_equals_tiktoken(codec):
    with open(RANKS, "rb") as f:
        own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(f.read()), special_tokens={})
    texts = mixed(3000) + [t or "" for t in EDGES]
    ids, counts = codec.encode(texts)
    for text, got in zip(texts, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
        assert got.tolist() == own.encode_ordinary(text)
        assert codec.decode_bytes(got)[0].tobytes() == text.encode()
        for part in (1, 3):
            assert "".join(codec.decode(got[i:i + part] for i in range(0, len(got), part))) == text


def test_bpe_character_spans(codec):
    text = "héllo 漢字😀 end"
    ids, _ = codec.encode([text])
    first, end = codec.character_spans(ids)
    assert first[0] == 0 and end[-1] == len(text) and (first[1:] <= end[:-1]).all() and (np.diff(end) >= 0).all()


def test_bpe_query(spark, docs):
    texts = mixed(50, 1) + EDGES
    rows = {r.doc_id: r for r in queries.bpe_digests(spark, docs(texts)).collect()}
    assert len(rows) == len(texts)
    assert all(rows[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest() for i, t in enumerate(texts))
    assert rows[texts.index(None)].n_tokens == 0
    coded = bpe.encode(spark, docs(texts), RANKS, public_tokenizers.PATTERN, with_spans=True)
    back = {r.doc_id: r.text for r in bpe.decode(spark, coded, RANKS, public_tokenizers.PATTERN).collect()}
    assert back == {i: t or "" for i, t in enumerate(texts)}
    assert queries.bpe_digests(spark, docs([])).count() == 0


def test_variable_length_code():
    rng = np.random.default_rng(0)
    parts = [rng.integers(0, 1 << b, n, dtype=np.uint64).astype(np.uint32) for b, n in ((8, 5), (16, 0), (32, 7), (20, 1), (24, 64))]
    lengths = [len(p) for p in parts]
    block = token_store.block_bytes(lengths, [token_store.pack(p) for p in parts])
    got, values = token_store.read_block(block)
    assert got.tolist() == lengths and (values == np.concatenate(parts)).all()
    with pytest.raises(ValueError):
        token_store.read_block(b"XXXX" + block[4:])


def test_token_files(spark, docs, monkeypatch):
    monkeypatch.setattr(token_store, "BLOCK_TOKENS", 100)
    texts = mixed(60, 2) + EDGES
    ids = [5 * i % 1009 for i in range(len(texts))]
    t = Tokenizer.from_file(WORDS)
    start = 0
    want = {}
    for i, text in sorted(zip(ids, texts, strict=True), key=lambda x: x[0]):
        own = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        want[i] = (start, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        start += len(own)
    got = token_store.stored(spark, docs(texts, ids), WORDS)
    assert {r.doc_id: (r.start, r.n_tokens, zlib.crc32(bytes(r.ids))) for r in got.collect()} == want
    assert token_store.stored(spark, docs([]), WORDS).count() == 0
    twice = token_store.stored(spark, docs(["a b", "a b", "c"], [1, 1, None]), WORDS).collect()
    assert sorted(r.start for r in twice) == [0, 2, 5]


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    d = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op6_language_id(spark, sf).collect()
    held = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert len(rows) == 1000 and {r.doc_id for r in rows if r.held_out} == {i for i in d if zlib.crc32(str(i).encode()) % 3 == 1}
    assert np.mean([r.lang_pred == d[r.doc_id].lang for r in held]) > 0.97


def test_language_edges_and_kernel(spark, docs, tables):
    model = language.train(spark, tables("documents"))
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(spark, docs(["", None, "12 !", "the and of the", "漢字", "der und " * 40_000]), model).collect()}
    assert [got[i] for i in range(3)] == [("und", 0.0)] * 3
    assert got[3][0] == "en" and got[5][0] == "de" and all(0 <= s <= 1 for _, s in got.values())
    assert language.identify(spark, docs([]), model).count() == 0
    assert {r.lang_pred for r in language.identify(spark, docs(["a"]), language.train(spark, docs([]))).collect()} == {"und"}
    texts = pa.array(["the cat sat", "cats and the dog"])
    sets = [{x[i:i + n] for n in (1, 2, 3) for i in range(len(x) - n + 1)} for x in texts.to_pylist()]
    which, h = language.text_grams(texts)
    assert [len(np.unique(h[which == k])) for k in (0, 1)] == [len(s) for s in sets]
    assert len(np.intersect1d(h[which == 0], h[which == 1])) == len(sets[0] & sets[1])


@pytest.mark.parametrize("many", [1, 4, 40])
def test_foreign_texts_go_whatever_the_number_of_languages(spark, many):
    """Languages of random words; a text of none of them goes, their own stay."""
    rng = random.Random(many)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [["".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(40)] for _ in range(many)]
    say = lambda k: " ".join(rng.choice(words[k]) for _ in range(60))
    rows = [(k, np.unique(language.text_grams(pa.array([say(k)]))[1])) for k in range(many) for _ in range(20)]
    model = language.fit([(f"l{k:02}", g) for k, g in rows])
    own = [(k, say(k)) for k in range(many) for _ in range(3)]
    foreign = ["это совсем другой язык, и его никто не учил", "漢字かな交じり文です", "これは, 12 !", "ελληνικά κείμενο", "".join(rng.choice("qxzjvkw") for _ in range(200))]
    d = spark.createDataFrame(list(enumerate([t for _, t in own] + foreign)), "doc_id long, text string")
    assert sorted(r.doc_id for r in language.in_known_language(spark, d, model).collect()) == list(range(len(own)))


def brute_winnow(text, gram, window):
    """Positions by definition, over the same gram hashes."""
    if len(text) < gram:
        return [0] if text else []
    h = [int(winnow.winnow(text[i:i + gram], gram, 1)[0][0]) for i in range(len(text) - gram + 1)]
    kept = set()
    for s in range(max(1, len(h) - window + 1)):
        part = h[s:s + window]
        kept.add(s + max(i for i, x in enumerate(part) if x == min(part)))
    return sorted(kept)


def test_winnow_equals_its_definition():
    rng = random.Random(4)
    for text in ["", "a", "ab", "a" * 60, "漢字" * 20, *["".join(rng.choice("ab c") for _ in range(rng.randint(0, 90))) for _ in range(80)]]:
        assert winnow.winnow(text, 4, 6)[1].tolist() == brute_winnow(text, 4, 6)


def test_winnow_in_stretches(monkeypatch):
    rng = random.Random(5)
    text = "".join(rng.choice("abcdef ") for _ in range(3000))
    monkeypatch.setattr(winnow, "POSITION_BITS", 9)
    places = winnow.winnow(text, 4, 20)[1]
    assert (np.diff(places) <= 20).all() and places[-1] >= len(text) - 3 - 20


def test_fingerprints(spark, docs):
    texts = ["", None, "a", "hello there " * 30, "hello there " * 30, "Ünï 漢字 " * 2000, "z" * 100]
    ids = [3, 9, 4, 8, 2, 7, 1]
    rows = {r.doc_id: r for r in winnow.fingerprints(spark, docs(texts, ids)).collect()}
    order = sorted(ids, reverse=True)
    text = dict(zip(ids, [t or "" for t in texts], strict=True))
    for i, after in zip(order, order[1:] + order[:1], strict=True):
        cut = len(text[i]) // 3
        changed = text[i][:len(text[i]) - cut] + text[after][:cut]
        assert rows[i].n_chars == len(text[i]) and rows[i].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert rows[i].edited_fingerprint == winnow.fingerprint(*winnow.winnow(changed))
        assert rows[i].near_next == winnow.likeness(winnow.winnow(text[i])[0], winnow.winnow(text[after])[0])
    assert rows[8].fingerprint == rows[2].fingerprint
    assert winnow.fingerprints(spark, docs([])).count() == 0
    assert winnow.fingerprints(spark, docs(["one"])).first().near_next == 1.0


def test_fingerprints_over_ranges(spark, docs):
    """Repeated ids and rows, null ids, ids that no double holds."""
    rng = random.Random(9)
    ids = [None] * 40 + [2**62 + k for k in range(60)] + [-7] * 50 + [5, 5, 5]
    texts = ["".join(rng.choice("abcd ") for _ in range(rng.randint(0, 150))) for _ in ids]
    texts[-3:] = ["same text"] * 3
    low = -2**63 - 1
    tie = {r.text: r.h for r in docs(texts, ids).selectExpr("text", "xxhash64(text) AS h").collect()}
    order = sorted(zip(ids, texts, strict=True), key=lambda r: (low if r[0] is None else r[0], tie[r[1]]), reverse=True)
    want = []
    for (i, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        changed = winnow.edited(text, after)
        want.append((i or 0, len(text), hashlib.sha256(changed.encode()).hexdigest()))
    got = [(r.doc_id or 0, r.n_chars, r.edited_sha256) for r in winnow.fingerprints(spark, docs(texts, ids)).collect()]
    assert sorted(got) == sorted(want)


def test_arrow_batches_are_bounded(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        common.prepared(spark)
        assert spark.conf.get(key) == str(common.BATCH_BYTES)
        long = spark.range(40).coalesce(1).selectExpr("id", "repeat('x', 500000) AS text")

        def sizes(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])

        got = long.mapInArrow(sizes, "n long, size long").collect()
        assert sum(r.n for r in got) == 40 and max(r.size for r in got) < common.BATCH_BYTES + 600_000
        spark.conf.set(key, "1m")
        common.prepared(spark)
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.set(key, before)


def test_ranges_of_documents():
    rng = random.Random(4)
    keys = sorted({(rng.choice([None, *range(6)]), rng.randint(-9, 9)) for _ in range(60)}, key=lambda k: (k[0] is not None, k[0] or 0, k[1]))
    firsts = keys[::7]
    got = token_store._range_of(firsts, pa.array([i for i, _ in keys], pa.int64()), np.array([t for _, t in keys]))
    assert got.tolist() == [k // 7 for k in range(len(keys))]


def test_words_are_kept_over_two_generations(codec):
    from waybatch.llm.chunks import Encoder

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    small, large = (Encoder(tokenizer, bpe.byte_characters(), True, n) for n in (6, 10_000))
    words = [f"{a}{b}" for a in ("foo", "bar", "Quux", "éa") for b in ("", "x", "yy", ",", "zzz")]
    rng = random.Random(2)
    for _ in range(30):
        some = rng.choices(words, k=5)
        assert small(some) == large(some)
    assert len(small.words) + len(small.older) < 20


LINES = ["The river runs past the old mill.", "A storm came over the hills at night.", "She reads by the window.",
         "Der Fluss fliesst an der Muehle vorbei.", "In der Nacht kam ein Sturm.", "Sie liest am Fenster.",
         "La riviere passe devant le moulin.", "Un orage est venu dans la nuit."]
LANGS = ["en"] * 3 + ["de"] * 3 + ["fr"] * 2


def _gram_set(text):
    low = text.lower()
    return {low[i:i + n] for n in range(1, language.SPECTRUM + 1) for i in range(len(low) - n + 1)}


def test_language_model_by_brute_force():
    """The kernel from sets of n-grams, the regressions by least squares on
    the landmarks' own kernel: with all texts as landmarks Nystroem is exact."""
    rows = [(lang, np.unique(language.text_grams(pa.array([t]))[1])) for lang, t in zip(LANGS, LINES, strict=True)]
    model = language.fit(rows)
    sets = [_gram_set(t) for t in LINES]
    seen = set().union(*sets)
    assert len(model.grams) == len(seen) and model.landmarks.shape == (len(seen), len(LINES))
    kernel = lambda a, b: len(a & b & seen) / np.sqrt(max(1, len(a & seen)) * max(1, len(b & seen)))
    own = np.array([[kernel(a, b) for b in sets] for a in sets])
    target = np.array([[1.0 if x == lang else -1.0 for lang in sorted(set(LANGS))] for x in LANGS])
    w = np.sqrt([1 / LANGS.count(x) for x in LANGS])[:, None]
    n = len(LINES)
    x = np.concatenate([own, np.ones((n, 1))], 1) * w
    ridge = np.zeros((n + 1, n + 1))
    ridge[:n, :n] = np.sqrt(language.RIDGE) * np.linalg.cholesky(own + 1e-6 * np.eye(n)).T
    ridge[n, n] = 1e-9 ** 0.5
    solved = np.linalg.lstsq(np.concatenate([x, ridge]), np.concatenate([target * w, np.zeros((n + 1, target.shape[1]))]), rcond=None)[0]
    texts = [*LINES, "The mill by the river at night", "Der Sturm in der Nacht", "le moulin", "???", "x" * 3000]
    far = np.array([[kernel(_gram_set(t), s) for s in sets] for t in texts])
    margin = far @ solved[:n] + solved[n]
    present = language._presence(model, pa.array(texts))
    got = language._kernel(model, present) @ model.weights + model.bias
    assert np.abs(got - margin).max() < 1e-3
    langs, score = language.predict(model, pa.array(texts))
    share = np.exp(3 * margin) / np.exp(3 * margin).sum(1, keepdims=True)
    for k, t in enumerate(texts):
        letters = any(c.isalpha() for c in t)
        assert langs[k] == (sorted(set(LANGS))[int(margin[k].argmax())] if letters else "und")
        assert abs(score[k] - (share[k].max() if letters else 0)) < 1e-3
    assert langs[:n] == LANGS
