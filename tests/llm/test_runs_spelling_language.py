"""Periodic runs, spelling variants and language identification."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from martlet.llm import language_id, periodic_runs, spelling

SF = "/root/testdata/sf0.001"
LONG = "word " * 6000
EDGES = [(900, None), (901, ""), (902, " \n\t "), (903, "one"), (904, LONG), (904, LONG), (None, "no id here"), (904, "another text of the id")]


@pytest.fixture(scope="module")
def docs_of(spark):
    """A documents table from (id, text) pairs, with columns whose names clash with helper columns."""
    def make(rows, partitions=3):
        df = spark.createDataFrame([(i, t, "x", 1, "y", "z") for i, t in rows], "doc_id long, text string, __text string, n int, word string, id string")
        return df.repartition(partitions) if rows else df
    return make


def brute_runs(w, least=12):
    """All maximal stretches, lag by lag: (start, length, smallest period)."""
    out = {}
    for d in range(1, len(w) // 2 + 1):
        i = d
        while i < len(w):
            s = i
            while i < len(w) and w[i] == w[i - d]:
                i += 1
            if i - s >= d and i - s + d >= least:
                out.setdefault((s - d, i), d)
            i += i == s
    return sorted(((s, e - s, d) for (s, e), d in out.items()), key=lambda r: (r[0], r[2]))


def collapsed_words(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def test_runs_equal_brute_force():
    rnd = random.Random(7)
    for case in range(1500):
        w = [rnd.randrange(rnd.choice([1, 2, 2, 3, 40])) for _ in range(rnd.randint(0, 150))]
        for _ in range(rnd.randint(0, 4)):
            if len(w) > 10:
                a = rnd.randrange(len(w))
                p, e = rnd.randint(1, max(1, (len(w) - a) // 2)), rnd.randint(a, len(w))
                for i in range(a, e):
                    w[i] = w[a + (i - a) % p]
        if case % 3 == 0:  # powers of powers
            w = ((w[:rnd.randint(1, 4)] * rnd.randint(1, 6) + w[:2]) * rnd.randint(1, 5))[:400]
        least = rnd.choice([2, 8, 12, 30])
        got = [(s, e - s, q) for s, e, q in periodic_runs.find_runs(np.array(w, np.int32), least).tolist()]
        assert got == brute_runs(w, least), (w, least)


def test_runs_of_long_texts():
    one = periodic_runs.find_runs(np.zeros(400_000, np.int32))
    assert one.tolist() == [[0, 400_000, 1]]
    a, b = [0], [0, 1]  # a Fibonacci word has a run about every fifth place
    while len(b) < 20_000:
        a, b = b, b + a
    assert len(periodic_runs.find_runs(np.array(b, np.int32))) > 2000
    text = (b"some words " * 3 + b"\n" + b"x y z " * 2_000_000 + b"end")  # 12 MB
    runs, left = periodic_runs._texts_runs([text], 12)
    assert runs[0].tolist() == [[6, 6_000_000, 3]] and left == [b"some words some words some words x y z end"]


def test_runs_as_columns(spark, docs_of):
    rows = [*EDGES, (1, "a b " * 7 + "c"), (2, "a b " * 5)]
    got = periodic_runs.periodic_runs(docs_of(rows))
    assert got.columns == ["doc_id", "text", "__text", "n", "word", "id", "runs", "collapsed"]
    for r in got.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        runs = brute_runs(words) if len(words) < 100 else [(0, 6000, 1)]
        assert [tuple(x) for x in r.runs] == runs
        assert r.collapsed == (None if r.text is None else collapsed_words(words, runs))
    again = periodic_runs.periodic_runs(got.select("doc_id", "collapsed", "runs"), text="collapsed", runs="runs", collapsed="collapsed")
    assert again.columns == ["doc_id", "runs", "collapsed"]
    assert periodic_runs.periodic_runs(docs_of([])).collect() == []


def test_op12_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = periodic_runs.op12_periodic_runs(spark, SF).collect()
    assert len(got) == len(docs)
    found = 0
    for r in got:
        w = re.findall(r"[^\x20\x09-\x0D]+", docs[r.doc_id] or "")
        h, n = zlib.crc32(str(r.doc_id).encode()), len(w)
        if n > 2500:
            continue
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(w)
        found += len(runs)
        top = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        want = (len(runs), *((top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else [None] * 4),
                hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest(),
                hashlib.sha256(collapsed_words(w, runs).encode()).hexdigest())
        assert tuple(r)[1:] == want
    assert found > 10


def near(a, b):
    """One character inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:j] + b[j + 1:] == a for j in range(len(b)))


def brute_groups(n, factor=10):
    out, form = {}, {}
    by = defaultdict(list)
    for w in n:
        by[len(w)].append(w)
    for w in n:
        close = [v for k in (-1, 0, 1) for v in by[len(w) + k] if near(w, v)]
        best = min(close, key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= factor * n[w]:
            form[w] = best
        out[w] = len(close)
    rows = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        rows.add((w, form.get(w), root, n[w], out[w], n[form[w]] if w in form else None))
    return rows


def test_spelling_groups_equal_brute_force(spark):
    rnd = random.Random(3)
    n = {}
    for _ in range(400):
        w = "".join(rnd.choice("aabé÷") for _ in range(rnd.randint(1, 6)))
        n[w] = rnd.choice([1, 2, 2, 3, 20, 25, 200, 300, 3000, 40000])
    n.update({"hello": 5, "helo": 50, "heelo": 4, "aaaa": 2, "aaaaa": 21, "aaaaaa": 210, "aaaaaaa": 2100, "aaaaaaaa": 21000})
    words = spark.createDataFrame(list(n.items()), "word string, n long").repartition(4)
    for often in (1, 2):
        got = spelling.spelling_groups(words, often=often).collect()
        assert {tuple(r) for r in got} == brute_groups({w: c for w, c in n.items() if c >= often})
        assert len(got) == len({r.word for r in got})
    assert spelling.spelling_groups(words.limit(0)).collect() == []


def test_a_range_with_every_letter_yields_no_pairs(spark):
    letters = [chr(c) for c in [*range(ord("a"), ord("z") + 1), *range(0xE0, 0x100)]]
    n = {f"word{x}ing": 30 for x in letters} | {"wording": 400}
    got = {r.word: r for r in spelling.spelling_groups(spark.createDataFrame(list(n.items()), "word string, n long")).collect()}
    assert {r.n_near for r in got.values()} == {len(letters)} and all(r.root == "wording" for r in got.values())
    assert got["wording"].form is None and got["wordaing"].form == "wording" and got["wordaing"].form_n == 400


def test_word_counts_and_op13(spark, docs_of):
    rows = [*EDGES, (1, "Élongated élongated ELONGATED×x naïvement--naïvement"), (1, "Élongated"), (2, "abcdefg abcdef ABCDEFG")]
    got = {r.word: r.n for r in spelling.word_counts(docs_of(rows)).collect()}
    assert got == {"Élongated": 2, "élongated": 1, "elongated×x": 1, "naïvement": 2, "abcdefg": 2, "another": 1} or pytest.fail(str(got))
    n = Counter()
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{r.doc_id}:{run}".encode())
            n[run if h % 31 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    want = brute_groups({w: c for w, c in n.items() if len(w) >= 7 and c >= 2})
    got = spelling.op13_spelling_variants(spark, SF).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_codewords_are_far_apart():
    for k in range(2, 30):
        m = language_id.code(k)
        least = min(int((m[a] != m[b]).sum()) for a in range(k) for b in range(a))
        assert len(m) == k and least >= (m.shape[1] + 1) // 2 if k <= language_id.EXHAUSTIVE else least >= 7
        assert (np.abs(m.sum(axis=0)) < k).all()


def test_a_wrong_bit_is_corrected():
    m = language_id.code(5)
    trust = np.full(m.shape, 1 / m.shape[1])
    for k in range(5):
        for wrong in range(m.shape[1]):
            f = m[k].astype(float)
            f[wrong] *= -1
            best, score, gap = language_id.decode(f[None], m, trust)
            assert best[0] == k and 0 <= score[0] <= 1 and gap[0] > 0
    assert language_id.decode(np.zeros((1, m.shape[1])), m, trust)[2][0] == 0


def test_languages_of_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.op11_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in got if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_only_the_text_decides(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.train(docs.filter(language_id.remainder(F.col("doc_id")) != 2))
    some = docs.limit(40).select("doc_id", "text")
    a = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(some, model).collect()}
    b = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(some.withColumn("lang", F.lit("xx")).repartition(7), model).collect()}
    assert a == b


def test_language_edges(spark, docs_of):
    texts = [(k, "the cat sat on the mat with the dog") for k in range(30)] + [(k, "der hund und die katze sind nicht hier") for k in range(30, 60)]
    labelled = docs_of([*EDGES, *texts]).withColumn("lang", F.when(F.col("doc_id") < 30, "en").when(F.col("doc_id") < 60, "de"))
    model = language_id.train(labelled)
    assert model.languages == ["de", "en"]
    got = language_id.predict(labelled.withColumn("score", F.lit(7)), model)
    assert got.columns == ["doc_id", "text", "__text", "n", "word", "id", "lang", "lang_pred", "score", "ambiguous"]
    for r in got.collect():
        if not re.search("[a-z]", r.text or ""):
            assert (r.lang_pred, r.score, r.ambiguous) == ("und", 0.0, False)
        else:
            assert r.lang_pred in ("de", "en") and (r.lang is None or r.lang == r.lang_pred)
    odd = language_id.predict(docs_of([(1, "123 -- ½ ²"), (2, "第一"), (3, "1 b")]), model).collect()
    assert {r.doc_id: r.lang_pred == "und" for r in odd} == {1: True, 2: False, 3: False}
    assert language_id.predict(docs_of([]), model).collect() == [] and language_id.train(docs_of([]).withColumn("lang", F.lit("en"))) is None
    assert {r.lang_pred for r in language_id.predict(docs_of(texts), None).collect()} == {"und"}
    single = language_id.train(labelled.filter("lang = 'de'"))
    assert {(r.lang_pred, r.score) for r in language_id.predict(docs_of(texts), single).collect()} == {("de", 1.0)}


def test_margins_equal_the_features():
    rnd = random.Random(5)
    texts = ["", "a", "é", *["".join(rnd.choice("abÉé .12\n") for _ in range(rnd.randint(0, 90))) for _ in range(60)]]
    raw = [t.encode() for t in texts]
    offs = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    data = np.frombuffer(b"".join(raw), np.uint8)
    weights = np.random.default_rng(1).normal(size=(1 << language_id.BITS, 3))
    doc, at, value = language_id.features(data, offs)
    want = np.zeros((len(texts), 3))
    np.add.at(want, doc, value[:, None] * weights[at])
    assert np.allclose(language_id.margins(weights, data, offs), want, atol=1e-6)
    big = (b"some text of many words " * 500_000)  # 12 MB in one piece
    f = language_id.margins(weights, np.frombuffer(big, np.uint8), np.array([0, len(big)]))
    assert np.isfinite(f).all()
