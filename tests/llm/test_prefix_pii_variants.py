"""Conversation trie, personal data, spelling variants."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from waybatch.llm import sanitise, trie, variants


# ------------------------------------------------------------------- trie
def trie_by_definition(sequences, sizes):
    members = collections.defaultdict(list)
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    kids = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * sizes[p[-1]] if p else 0
    ends = lambda p, m: hashlib.sha256(",".join(str(c) for c in sorted(m) if len(sequences[c]) == len(p)).encode()).hexdigest()
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), kids[p], leaves[p], saved[p], ends(p, m)) for p, m in members.items())


def trie_rows(df):
    return sorted(tuple(-1 if x is None else x for x in r) for r in df.collect())


@pytest.mark.parametrize("shard_turns", [3, 40, 200_000])
def test_trie_equals_its_definition(spark, monkeypatch, shard_turns):
    monkeypatch.setattr(trie, "CHUNK_IDS", 3)
    rng = random.Random(shard_turns)
    sizes = {i: i % 4 for i in range(9)}
    sequences = {}
    for c in rng.sample(range(10_000), 120):
        old = rng.choice(list(sequences.values())) if sequences and rng.random() < 0.7 else []
        sequences[c] = (old[:rng.randint(0, len(old))] if rng.random() < 0.6 else old) + [rng.randrange(9) for _ in range(rng.choice([0, 0, 1, 2, 5]))]
    sequences[1] = [7] * 600
    sequences[2] = [7] * 300 + [1] * 200
    rows = [(c, s, [sizes[i] for i in s], "x") for c, s in sequences.items()]
    df = spark.createDataFrame(rows, "conv_id long, ids array<long>, sizes array<long>, depth string").drop("depth")
    assert trie_rows(trie.prefix_trie(spark, df, shard_turns)) == trie_by_definition(sequences, sizes)


def test_trie_of_a_hot_sequence_and_of_nothing(spark):
    same = spark.range(500).select(F.col("id").alias("conv_id"), F.array(F.lit(4).cast("long")).alias("ids"), F.array(F.lit(10).cast("long")).alias("sizes"))
    every = hashlib.sha256(",".join(map(str, range(500))).encode()).hexdigest()
    assert trie_rows(trie.prefix_trie(spark, same)) == [
        (0, 0, -1, 500, 1, 1, 4990, trie.NO_MEMBERS), (0, 1, 0, 500, 0, 1, 4990, every)]
    assert trie.prefix_trie(spark, same.filter("false")).count() == 0
    turnless = same.limit(1).select("conv_id", *(F.array().cast("array<long>").alias(c) for c in ("ids", "sizes")))
    assert trie_rows(trie.prefix_trie(spark, turnless)) == [(0, 0, -1, 1, 0, 1, 0, hashlib.sha256(b"0").hexdigest())]


def test_rebuilt_conversations(spark):
    rows = [(c, t, r, x, "clash", 0) for c, t, r, x in [
        (5, 1, "b", "2"), (5, None, None, "1"), (5, 2, None, None), (6, 0, "a", "own"), (6, 1, "a", "own2"), (13, 3, "a", "é"),
        (None, 0, "a", "lost"), (-3, 0, "a", "minus"), (6, 1, "a", "own2")]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, ids string, depth int")
    sequences, words = trie.turn_sequences(spark, df)
    text = {r.id: (r.role, r.text) for r in words.collect()}
    whole = {r.conv_id: [text[i] for i in r.ids] for r in sequences.collect()}
    assert whole == {5: [("", "1"), ("b", "2"), ("", "")], 6: [("a", "own"), ("a", "own2"), ("a", "own2")], 13: [("a", "é")], -3: [("a", "minus")]}
    rebuilt = {r.conv_id: ([text[i] for i in r.ids], r.sizes) for r in trie.with_shared_heads(sequences).collect()}
    for c, (s, sizes) in rebuilt.items():
        h = zlib.crc32(str(c).encode()) % 9
        assert s == whole.get(c - int(math.fmod(c, 5)), [])[:h] + whole[c][h:]
        assert sizes == [len(x.encode()) for _, x in s]


def test_median_first_is_balanced():
    assert sorted(trie.median_first(100)) == list(range(100))
    tree = trie.TernaryTree()
    ends = {i: tree.insert([i], [1]) for i in trie.median_first(1000)}
    deep, level = 0, [tree.equal[0]]
    while level:
        deep, level = deep + 1, [w for v in level for w in (tree.low[v], tree.high[v]) if w > 0]
    assert deep <= 10 and len(set(ends.values())) == 1000


# ---------------------------------------------------------- personal data
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def plain_spans(text):
    def fits(kind, value):
        digits = re.sub("[^0-9]", "", value)
        return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in value.split(".")),
                "card": lambda: 12 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]()
    found = [(m.start(), m.end(), i, k, m[0]) for i, (k, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text or "") if fits(k, m[0])]
    return [(k, a, b, v) for a, b, _, k, v in sorted(found)]


def odd_texts(seed, n=300):
    rng = random.Random(seed)
    bits = ["a@b.co", "x.y@z", "@", ".", "-", " ", "+1 (555) 123-4567", "4111 1111 1111 1111", "4111111111111112", "1.2.3.4", "256.1.1.1",
            "01.002.0003.4", "_", "é", "😀", "ab", "9", "+", "%", "(", "..", "\n", "1.2.3", "5500-0000-0000-0004", "@d.com", "\x01", "0" * 30]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(1, 25))) for _ in range(n)]


def test_patterns_equal_plain_search(spark, docs):
    texts = odd_texts(3) + [None, "", "a@b.co" * 700, "9" * 50_000, "a" * 100_000 + "@", "x" * 100_000 + "@y" + ".z" * 50_000, "1.2.3.4 " * 1500]
    found = {r.doc_id: [(s.label, s.start, s.end, s.value) for s in r.spans if s.kind < 4] for r in sanitise.find_personal_data(spark, docs(texts)).collect()}
    for i, t in enumerate(texts):
        if t and len(t) > 90_000:  # the plain patterns need quadratic time here
            assert [s[:3] for s in found[i]] == ([("email", 0, len(t))] if t.endswith(".z") else [])
        else:
            assert found[i] == plain_spans(t), t


def revealed_by_definition(texts, threshold, support):
    fold = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s)
    gap = r"[^\w@.%+-]+"
    entities, pairs, words, hits = (collections.Counter() for _ in range(4))
    places = []
    for text in texts:
        text, own, near = text or "", set(), set()
        for kind in PLAIN:
            matches = list(re.finditer(PLAIN[kind], text))
            for i, m in enumerate(matches):
                if (kind, m.start(), m.end(), m[0]) not in plain_spans(text):
                    continue
                e = (kind, re.sub("[^0-9]", "", m[0]) if kind in ("card", "phone") else fold(m[0]))
                own.add(e)
                low, high = (matches[i - 1].end() if i else 0), (matches[i + 1].start() if i + 1 < len(matches) else len(text))
                for a, b in ((max(low, m.start() - sanitise.CONTEXT), m.start()), (m.end(), min(high, m.end() + sanitise.CONTEXT))):
                    gaps = list(re.finditer(gap, text[a:b]))
                    for x, y in zip(gaps, gaps[1:]):
                        w = re.fullmatch(r"([^\W\d_]{4,})[._%+-]*", text[a + x.end():a + y.start()])
                        if w:
                            near.add((e, fold(w[1]), a + x.end()))
        said = {w for w in (s.rstrip("._%+-") for s in re.split(gap, fold(text))) if len(w) > 3}
        words.update(said | {w[:3] for w in said})
        entities.update(own)
        pairs.update({(e, t) for e, w, _ in near for t in (w, w[:3])})
        places.append(near)
    n = len(texts)
    strong = lambda e, t: (pairs[e, t] >= support and entities[e] < n
                           and math.log(n * pairs[e, t] / (entities[e] * words[t])) / math.log(n / entities[e]) >= threshold)
    out = []
    for near in places:
        marks = collections.defaultdict(set)
        for e, w, a in near:
            if strong(e, w):
                marks[a, a + len(w)].add("removed" if strong(e, w[:3]) else "generalised")
        out.append(sorted((a, b, max(k)) for (a, b), k in marks.items()))
    return out


def test_revealing_terms_equal_their_definition(spark, docs):
    rng = random.Random(5)
    vocabulary = [a + b for a in ("over", "under", "with", "cast", "quiz") for b in ("time", "land", "éclair", "all", "x")] + ["the", "of", "Theology"]
    people = ["ann@x.org", "BOB@y.example.com", "+1 (555) 123-4567", "10.0.0.7", "4111 1111 1111 1111"]
    habits = {p: rng.sample(vocabulary, 4) + [f"secret{chr(97 + i)}word"] for i, p in enumerate(people)}
    texts = []
    for _ in range(80):
        say = lambda k: [rng.choice(vocabulary) + rng.choice(["", "", ".", ","]) for _ in range(k)]
        words = say(rng.randint(0, 12))
        for p in rng.sample(people, rng.choice([0, 0, 1, 1, 2])):
            words += rng.sample(habits[p], 3) + [p] + rng.sample(habits[p], 2) + say(3)
        texts.append(" ".join(words))
    texts += [texts[-1], None, ""]
    for threshold, support in ((0.6, 2), (0.2, 3)):
        found = {r.doc_id: [(s.start, s.end, s.label) for s in r.spans if s.kind >= 4] for r in sanitise.find_personal_data(spark, docs(texts), threshold, support).collect()}
        expected = revealed_by_definition(texts, threshold, support)
        assert [sorted(found[i]) for i in range(len(texts))] == expected
        assert {k for marks in expected for *_, k in marks} == {"generalised", "removed"} or threshold > 0.5


def test_personal_data_edge_cases(spark, docs):
    assert sanitise.digests(sanitise.find_personal_data(spark, docs(["x"]).filter("false"))).count() == 0
    ids = [None, 3, 3, 4]
    got = sanitise.digests(sanitise.find_personal_data(spark, docs(["a@b.co"] * 3 + [None], ids))).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_email, r.spans) for r in got) == [
        (False, 3, 1, "email:0:6"), (False, 3, 1, "email:0:6"), (False, 4, 0, ""), (True, 0, 1, "email:0:6")]
    assert {r.base_sha256 for r in got if r.doc_id == 4} == {hashlib.sha256(b"").hexdigest()}


def test_sanitised_text(spark, docs):
    found = sanitise.find_personal_data(spark, docs(["Mail ann@x.org or +1 (555) 123-4567!", None]))
    shown = found.join(docs(["Mail ann@x.org or +1 (555) 123-4567!", None]).select("doc_id", "text"), "doc_id").select(sanitise.sanitised(F.col("text"), F.col("spans")).alias("t"))
    assert sorted(r.t or "" for r in shown.collect()) == ["", "Mail [EMAIL] or [PHONE]!"]


def test_personal_data_plan_has_no_python(spark, docs):
    plan = sanitise.digests(sanitise.find_personal_data(spark, docs(["a@b.co x"])))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# ------------------------------------------------------- spelling variants
def variants_by_definition(n):
    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if a == b or len(b) - len(a) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    out = {}
    for w in n:
        by = [v for v in n if near(w, v)]
        best = min(by, key=lambda v: (-n[v], v), default=None)
        out[w] = (best if best is not None and n[best] >= 2 * n[w] else None, len(by))
    roots = {}
    for w in n:
        r = w
        while out[r][0] is not None:
            r = out[r][0]
        roots[w] = r
    return {w: (f, roots[w], n[w], k, n[f] if f else None) for w, (f, k) in out.items()}


@pytest.mark.parametrize("limit", [2, 12, 4096])
def test_variants_equal_their_definition(spark, limit):
    rng = random.Random(limit)
    n = {}
    for _ in range(40):
        w = "".join(rng.choice("abcé") for _ in range(rng.randint(5, 9)))
        for _ in range(8):
            i = rng.randrange(len(w) + 1)
            w = rng.choice([w[:i] + rng.choice("abcé") + w[i:], w[:i] + w[i + 1:], w[:i] + rng.choice("abcé") + w[i + 1:]])
            if len(w) >= 5:
                n[w] = rng.randint(3, 60)
    n |= {"a" * 5: 3, "a" * 6: 7, "a" * 7: 20, "ab" * 400: 3, "ab" * 400 + "c": 9, "b" + "ab" * 400: 9}
    df = spark.createDataFrame([(*x, "clash") for x in n.items()] + [(None, 9, "")], "word string, n long, form string")
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in variants.variants(spark, df, limit=limit).collect()}
    assert got == variants_by_definition(n)


def test_acceptor_is_minimal_and_ranks():
    words = sorted({a + b + c for a in "abc" for b in "xy" for c in "pqr"} | {"dzz"})
    a = variants.Acceptor(words)
    assert len(a.arcs) == 6 and a.count[a.start] == len(words)  # start; "dz"; x, y; p, q, r; "z" of dzz and the end
    for i, w in enumerate(words):
        q, rank = a.start, 0
        for letter in w:
            q, k = a.arcs[q][letter]
            rank += k
        assert rank == i and not a.arcs[q]


def test_vocabulary(spark, docs):
    texts = ["Hello, HELLO hello", "ÉCOLES ÉCOLES ÉCOLES écoles", None, "", "word " * 3, "x" * 5000 + " " + "x" * 5000 + " " + "x" * 5000, "a1b " * 9]
    ids = [*range(len(texts))]

    def cut(i, run):
        h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
        return run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run

    ids[0] = None
    n = collections.Counter()
    for i, t in zip(ids, texts, strict=True):
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = cut(i, "".join(c.lower() if "A" <= c <= "Z" else c for c in run))
            n[w] += len(w) >= 5
    assert {r.word: r.n for r in variants.vocabulary(docs(texts, ids)).collect()} == {w: k for w, k in n.items() if k >= 3}
    assert variants.variants(spark, variants.vocabulary(docs(["x"]).filter("false"))).count() == 0
