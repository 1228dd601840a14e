import os

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from waybatch.llm import decontaminate, licenses, queries, toxicity, url_filter

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, key):
    con = duckdb.connect()
    for t in ("pages", "documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.queries()[key](spark, SF)
    want = con.sql(queries.oracle_sql()[key])
    at = [want.columns.index(c) for c in df.columns]
    assert sorted(map(str, (tuple(r) for r in df.collect()))) == sorted(str(tuple(r[i] for i in at)) for r in want.fetchall())


URLS = [None, "", "no scheme", "http://A.ORG/x", "http://org", "http://example.org/es/1", "https://x.example.org/en/12?q",
        "http://a.com/fr/1#top", "http://a.com/de/", "http://a.com/des", "http://www.bad.net/a/?utm_source=f&b=1", "http://bad.net/a?b=1", "http://bad.net/a"]


def test_url_rules_and_list(spark):
    pages = spark.createDataFrame([(i, u, "x", True) for i, u in enumerate(URLS)], "page_id long, url string, host string, listed boolean")
    listed = spark.createDataFrame([("bad.net/a?b=1",), ("bad.net/a?b=1",), (None,), ("",)], "canonical string")
    got = {r.page_id: (r.rule, r.verdict, r.listed) for r in url_filter.filter_urls(pages, listed, queries.RULES).collect()}
    verdicts = [(None, "allow", False)] * 3 + [("org/", "allow", False), (None, "allow", False), ("example.org/es/", "block", False),
                ("example.org/en/1", "block", False), ("com/fr/", "allow", False), ("com/de/", "block", False), (None, "allow", False),
                (None, "block", True), (None, "block", True), (None, "allow", False)]
    assert got == dict(enumerate(verdicts))
    assert url_filter.filter_urls(pages.limit(0), listed.limit(0), queries.RULES).count() == 0


def test_filter_has_no_false_negatives(spark):
    known = spark.range(5000).selectExpr("concat('h.net/', id) as canonical")
    pages = spark.range(10_000).selectExpr("id as page_id", "concat('http://h.net/', id) as url")
    got = url_filter.filter_urls(pages, known, ())
    assert got.filter("listed <> (page_id < 5000)").count() == 0
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


ITEM = "the quick brown fox jumps over the lazy dog while seven green parrots watch from a tall tree"


def test_overlaps_tolerate_substitutions(spark, docs):
    words = ITEM.split()
    changed = [w if i % 6 else "zzz" for i, w in enumerate(words)]
    texts = ["a b c " + ITEM + " d e", " ".join(changed), ITEM.upper().replace(" ", ", "), " ".join(words[:5]), "", None, "...", "no no no", "No."]
    bench = spark.createDataFrame([(1, ITEM, 0), (2, "", 0), (3, None, 0), (4, "no", 0), (5, "!", 0)], "item_id long, text string, doc_id int")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.overlaps(spark, docs(texts), bench).collect()}
    assert set(got) == {(0, 1), (1, 1), (2, 1), (8, 4)}
    assert (got[0, 1].start_word, got[0, 1].end_word, got[0, 1].equal_words) == (3, 21, 18)
    assert got[1, 1].equal_words == 15
    kept = decontaminate.decontaminated(spark, docs(texts), bench)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6, 7] and kept.columns == docs(texts).columns
    assert decontaminate.overlaps(spark, docs([]), bench).count() == 0
    assert decontaminate.overlaps(spark, docs(texts), bench.limit(0)).count() == 0


def test_overlaps_in_blocks_and_by_brute_force(spark, tables, monkeypatch):
    bench, d = tables("benchmark"), tables("documents")
    whole = sorted(map(tuple, decontaminate.overlaps(spark, d, bench).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 300)
    assert sorted(map(tuple, decontaminate.overlaps(spark, d, bench).collect())) == whole
    norm = lambda t: "".join(c if c.isalnum() or ord(c) > 127 else " " for c in t.lower()).split()
    held = set()
    items = [(r.item_id, norm(r.text)) for r in bench.collect()]
    for r in d.collect():
        text = " " + " ".join(norm(r.text)) + " "
        held |= {(r.doc_id, i) for i, w in items if f" {' '.join(w)} " in text}
    assert held <= {t[:2] for t in whole} and {t[0] for t in whole} == {i for i, _ in held}


def test_best_stretch_is_the_best_of_all():
    rng = np.random.default_rng(1)
    for _ in range(200):
        equal = rng.random(rng.integers(1, 20)) < 0.7
        value = np.where(equal, 1, decontaminate.MISMATCH)
        s, e = decontaminate.best_stretch(equal)
        assert value[s:e].sum() == max(value[a:b].sum() for a in range(len(value) + 1) for b in range(a, len(value) + 1))


def test_overlaps_of_edited_items_by_brute_force(spark, docs):
    """Every item that has a stretch the masks can see and its share equal in place."""
    rng = np.random.default_rng(3)
    held, texts, bench = set(), [], []
    for k in range(60):
        item = [f"i{k}w{j}" for j in range(int(rng.integers(24, 60)))]
        n, kept = len(item), np.ones(len(item), bool)
        while kept.mean() > 0.75:  # longer edits, so that no stretch reaches far
            at = int(rng.integers(12, n))  # the first 12 words stay
            kept[at:at + int(rng.integers(2, 7))] = False
        bench.append((k, " ".join(item), 0))
        texts.append("before it " + " ".join(w if ok else f"x{j}" for j, (w, ok) in enumerate(zip(item, kept, strict=True))) + " behind")
        runs = max(len(r) for r in "".join("1" if ok else "0" for ok in kept).split("0"))
        if kept.mean() >= decontaminate.ITEM_SHARE or runs >= decontaminate.RUN_WORDS:
            held.add((k, k, int(kept.sum())))
    got = decontaminate.overlaps(spark, docs(texts), spark.createDataFrame(bench, "item_id long, text string, doc_id int")).collect()
    assert len(held) > 40 and {(r.doc_id, r.item_id, r.equal_words) for r in got} >= held
    replaced = [f"w{j}" if j < 12 or j >= 18 else "x" for j in range(30)]  # the middle replaced
    inserted = [f"w{j}" if j < 8 or j >= 11 else "x" for j in range(15)] + ["y"] + [f"w{j}" for j in range(15, 23)]
    bench = spark.createDataFrame([(1, " ".join(f"w{j}" for j in range(30)), 0)], "item_id long, text string, doc_id int")
    got = {r.doc_id: r.equal_words for r in decontaminate.overlaps(spark, docs([" ".join(replaced), " ".join(inserted)]), bench).collect()}
    assert got == {0: 24, 1: 20}


def test_overlaps_of_short_items_by_brute_force(spark, docs):
    """Held are just the items with their share of words in place, whichever words are replaced."""
    rng = np.random.default_rng(4)
    held, texts, bench = set(), [], []
    for n in range(decontaminate.SHORT, decontaminate.LONG_FROM + 1):
        item = [f"n{n}w{j}" for j in range(n)]
        bench.append((n, " ".join(item), 0))
        for edits in range(1, n):
            for _ in range(1 if n == decontaminate.LONG_FROM else 6):
                gone = set(rng.permutation(n)[:edits].tolist()) if n < decontaminate.LONG_FROM else set(range(edits))
                if n < decontaminate.LONG_FROM and n - edits >= decontaminate.ITEM_SHARE * n:
                    held.add((len(texts), n, n - edits))
                texts.append("some " + " ".join("x" if j in gone else w for j, w in enumerate(item)) + " more")
    got = decontaminate.overlaps(spark, docs(texts), spark.createDataFrame(bench, "item_id long, text string, doc_id int")).collect()
    assert {(r.doc_id, r.item_id, r.equal_words) for r in got if r.item_id < decontaminate.LONG_FROM} == held


def test_overlaps_of_long_items_with_scattered_edits(spark, docs):
    """Random and periodic edits anywhere: items with over three of five words in place are all found, of all that are held at least 0.9."""
    rng = np.random.default_rng(6)
    texts, bench, held, certain, apart = [], [], {}, set(), set()
    for k in range(900):
        n = int(rng.integers(decontaminate.LONG_FROM, 61))
        if k % 3:
            kept = np.ones(n, bool)
            kept[rng.permutation(n)[:round(n * rng.uniform(0.2, 0.6))]] = False
        else:
            kept = (np.arange(n) + k) % (3 + k % 4) != 0
        bench.append((k, " ".join(f"i{k}w{j}" for j in range(n)), 0))
        texts.append("before it " + " ".join(f"i{k}w{j}" if ok else f"x{j}" for j, ok in enumerate(kept)) + " behind")
        share = int(kept.sum()) / n
        if share >= decontaminate.ITEM_SHARE:
            held[k] = share
            if kept.sum() > 3 * -(-n // 5):
                certain.add(k)
        else:
            start, end = decontaminate.best_stretch(kept)  # the best of all, see above
            if kept[start:end].sum() < decontaminate.RUN_WORDS:
                apart.add(k)
    got = {(r.doc_id, r.item_id) for r in decontaminate.overlaps(
        spark, docs(texts), spark.createDataFrame(bench, "item_id long, text string, doc_id int")).collect()}
    found = {i for d, i in got if d == i}
    assert len(got) == len(found) and certain <= found and not apart & found and len(certain) > 300 and len(apart) > 100
    for low, high in ((0.6, 0.65), (0.65, 0.7), (0.7, 0.8), (0.8, 1.0)):
        band = {k for k, share in held.items() if low <= share < high}
        assert len(band) > 30 and len(band & found) >= 0.9 * len(band), (low, len(band & found), len(band))


def test_overlaps_ties_long_texts_and_clashing_columns(spark, docs):
    words = " ".join(f"w{j}" for j in range(20))
    bench = spark.createDataFrame([(1, words, 0, 9), (2, words, 0, 9)], "item_id long, text string, item int, equal_words int")
    texts = [f"{words} and {words}", "filler " * 200_000 + words, words, words]
    got = {(r.doc_id, r.item_id): (r.start_word, r.end_word, r.equal_words) for r in decontaminate.overlaps(
        spark, docs(texts).selectExpr("doc_id", "text", "1 AS item_id", "2 AS item", "3 AS equal_words"), bench).collect()}
    assert got == {(d, i): (at, at + 20, 20) for d, at in ((0, 0), (1, 200_000), (2, 0), (3, 0)) for i in (1, 2)}


def test_overlaps_in_scripts_without_spaces(spark, docs):
    items = ["下列哪一座城市是法国的首都，而不是德国的？", "日本で一番高い山は何ですか。", "เมืองหลวงของประเทศไทยคืออะไร", "quelle est la capitale de la France d’aujourd’hui"]
    other = "今天天气很好。"
    texts = [other + items[0] + other, items[0].replace("法国", "英国"), "これは" + items[1] + "「はい」", "ก" + items[2] + "ข", "«" + items[3] + "…»", other * 3, "日本の川"]
    bench = spark.createDataFrame([(i, t, 0) for i, t in enumerate(items)], "item_id long, text string, doc_id int")
    got = {(r.doc_id, r.item_id) for r in decontaminate.overlaps(spark, docs(texts), bench).collect()}
    assert got == {(0, 0), (1, 0), (2, 1), (3, 2), (4, 3)}


def test_patience_alignment():
    assert licenses.align("abcde", "abcde") == [(i, i) for i in range(5)]
    assert licenses.align("xxaqbyycz", "abc") == [(2, 0), (4, 1), (7, 2)]
    assert licenses.align("", "abc") == [] and licenses.align("zzz", "abc") == []
    rng = np.random.default_rng(2)
    for _ in range(300):  # rising, equal, and never more than a longest common subsequence
        a, b = (rng.integers(0, 8, rng.integers(0, 12)).tolist() for _ in range(2))
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        lcs = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                lcs[i + 1, j + 1] = lcs[i, j] + 1 if x == y else max(lcs[i, j + 1], lcs[i + 1, j])
        assert len(pairs) <= lcs[-1, -1]


def test_license_scan(spark, docs):
    mit = licenses.TEMPLATES["MIT"]
    statement = licenses.TEMPLATES["MIT-statement"]
    texts = ["code here\n" + mit + "\nmore", mit.replace("free of charge", "gratis"), statement * 3, "word " * 50_000 + statement, "", None, "?", "permission is granted"]
    got = {(r.doc_id, r.license): r for r in licenses.scan(spark, docs(texts)).collect()}
    assert set(got) == {(0, "MIT"), (1, "MIT"), (2, "MIT-statement"), (3, "MIT-statement")}
    assert got[0, "MIT"].coverage == 1.0 and got[0, "MIT"].start_word == 2 and got[1, "MIT"].coverage < 1
    assert got[3, "MIT-statement"].start_word == 50_000
    assert licenses.scan(spark, docs([])).count() == 0


def test_longest_rising_by_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(200):
        values = rng.permutation(int(rng.integers(0, 9))).tolist()
        at = licenses._longest_rising(values)
        assert at == sorted(at) and all(values[i] < values[j] for i, j in zip(at, at[1:]))
        subsets = ([v for k, v in enumerate(values) if m >> k & 1] for m in range(1 << len(values)))
        assert len(at) == max(len(x) for x in subsets if x == sorted(x))


def test_dense_run_by_brute_force():
    rng = np.random.default_rng(6)
    for _ in range(300):
        places = np.flatnonzero(rng.random(int(rng.integers(1, 40))) < rng.choice([0.2, 0.8])).tolist() or [0]
        pairs = [(p, k) for k, p in enumerate(places)]
        runs = [pairs[a:b] for a in range(len(pairs)) for b in range(a + 1, len(pairs) + 1)]
        got = licenses._dense(pairs, 1)
        assert licenses._value(got, 0) == max(licenses._value(r, 0) for r in runs)
        assert licenses._dense(pairs, len(pairs) + 1) == pairs


def test_licenses_with_edits_are_named_once(spark, docs):
    """Every template, as it is and with words replaced: it alone is named, at
    its place, and covered by a longest common subsequence but for a few words."""
    rng = np.random.default_rng(7)
    texts, want = [], []
    for name, template in licenses.TEMPLATES.items():
        words = licenses._words(pa.array([template]))[0].tolist()
        for share in (0.0, 0.06, 0.12):
            plain = "".join(c if c.isalnum() else " " for c in template).split()
            gone = set(rng.permutation(np.arange(1, len(words) - 1))[:int(share * (len(words) - 2))].tolist())
            if name.startswith(("GPL", "LGPL", "AGPL", "CC", "BSD", "0BSD", "ISC")):
                gone = {k for k in gone if plain.count(plain[k]) > 1 and len(plain) > 40 and k > 60}  # what tells relatives apart stays
            texts.append("junk0 junk1 " + " ".join(f"zz{k}" if k in gone else w for k, w in enumerate(plain)) + " junk2")
            want.append((name, len(words), len(gone)))
    got: dict[int, list] = {}
    for r in licenses.scan(spark, docs(texts)).collect():
        got.setdefault(r.doc_id, []).append(r)
    for k, (name, n, gone) in enumerate(want):
        assert [r.license for r in got[k]] == [name], (name, gone, got[k])
        r = got[k][0]
        assert (r.start_word, r.end_word) == (2, 2 + n) and (n - gone) / n - 0.03 <= r.coverage <= (n - gone) / n + 1e-9


def test_licenses_nested_and_apart(spark, docs):
    t = licenses.TEMPLATES
    between = " " + " ".join(f"filler{k}" for k in range(300)) + " "
    texts = [t["Apache-2.0-notice"], t["Apache-2.0-notice"] + between + t["Apache-2.0-statement"], t["MIT-statement"] + " " + t["MIT"],
             t["BSD-3-Clause"] + between + t["BSD-2-Clause"], t["MIT"] + between + t["MIT"]]
    got = sorted((r.doc_id, r.license) for r in licenses.scan(spark, docs(texts)).collect())
    assert got == [(0, "Apache-2.0-notice"), (1, "Apache-2.0-notice"), (1, "Apache-2.0-statement"), (2, "MIT"), (2, "MIT-statement"),
                   (3, "BSD-2-Clause"), (3, "BSD-3-Clause"), (4, "MIT")]
    same = docs(["x " + t["MIT-statement"]] * 3)
    assert [(r.license, r.coverage) for r in licenses.scan(spark, same).collect()] == [("MIT-statement", 1.0)] * 3
    assert [r.license for r in licenses.scan(spark, same, {"b": "under the MIT", "a": "under the MIT"}).collect()] == ["a"] * 3


def test_license_scan_finds_the_statements_of_the_documents(spark, tables):
    d = tables("documents")
    got = {(r.doc_id, r.license) for r in licenses.scan(spark, d).collect()}
    want = {(r.doc_id, k) for r in d.collect() for k, t in licenses.TEMPLATES.items() if k.endswith("statement") and t in r.text}
    assert want and got == want


def test_toxicity_held_out(spark):
    sf = SF.replace("0.001", "0.1")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op8_toxicity(spark, sf).collect()
    assert len(rows) == 10_000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    clean = [r.predicted for r in rows if r.held_out and labels.get(r.doc_id) == 0]
    assert np.mean(clean) < 0.05
    toxic = [r.predicted for r in rows if r.held_out and labels.get(r.doc_id) == 1]
    assert len(toxic) > 50 and np.mean(toxic) > 0.8


def test_toxicity_scores_equal_the_sum_over_pairs():
    """The fast form of the pair term against each pair by itself."""
    rng = np.random.default_rng(1)
    texts = ["you people are vile", "vile", "", None, "nice people people nice", "unknownword " * 50 + "you are"]
    _, term = toxicity.text_terms(pa.array(texts))
    used = np.unique(term)
    place = np.full(toxicity.RANGE, -1, np.int64)
    place[used] = np.arange(len(used))
    model = toxicity.Model(place, 0.3, rng.normal(size=len(used)), rng.normal(size=(len(used), toxicity.FACTORS)) / 3)
    for text, got in zip(texts, toxicity.scores(model, pa.array(texts)), strict=True):
        own = sorted({int(place[t]) for t in toxicity.text_terms(pa.array([text], pa.string()))[1]})
        z = model.w0 + sum(model.w[a] for a in own) + sum(float(model.v[a] @ model.v[b]) for k, a in enumerate(own) for b in own[k + 1:])
        assert abs(got - 1 / (1 + np.exp(-np.clip(z, -30, 30)))) < 1e-9


def test_toxicity_takes_one_text_an_id(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda rows, y: seen.append((len(rows), y.tolist())))
    docs = spark.createDataFrame([(3, f"text number {i}") for i in range(500)] + [(4, "other")], "doc_id long, text string")
    labels = spark.createDataFrame([(3, 1), (3, 0), (4, 0)], "doc_id long, toxic int")
    toxicity.train(spark, docs, labels)
    assert [(n, sorted(y)) for n, y in seen] == [(2, [0, 1])]


def test_toxicity_learns_pairs_and_edge_cases(spark, docs):
    rng = np.random.default_rng(0)
    rows, y = [], []
    for _ in range(1500):  # only both terms together are toxic
        a, b = rng.random(2) < 0.5
        rows.append(np.array(sorted({int(x) for x in rng.integers(100, 120, 4)} | ({5} if a else set()) | ({9} if b else set())), np.uint32))
        y.append(int(a and b))
    model = toxicity.fit(rows, np.array(y))
    z = lambda *t: model.w0 + model.w[[model.place[i] for i in t]].sum() + 0.5 * (
        model.v[[model.place[i] for i in t]].sum(0) ** 2 - (model.v[[model.place[i] for i in t]] ** 2).sum(0)).sum()
    assert z(5, 9) > 0 > max(z(5), z(9))
    d = docs(["", None, "hello", "hello", "!" * 10])
    assert all(r.score < 1e-6 for r in toxicity.score(spark, d, toxicity.fit([], np.array([]))).collect())
    got = toxicity.score(spark, d, model).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(spark, docs([]), model).count() == 0
    assert sorted(toxicity.not_toxic(spark, d, model).columns) == sorted(d.columns)


def test_subpackage_can_be_deleted():
    """Nothing else in the library imports it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for at, _, names in os.walk(os.path.join(root, "waybatch")):
        for name in names:
            if name.endswith(".py") and os.path.basename(at) != "llm":
                assert "waybatch.llm" not in open(os.path.join(at, name), encoding="utf-8").read()
