"""Line dedup, substring dedup and the Jaccard join against brute force on small tables."""

import hashlib
import random
import re

import numpy as np
import pytest

from martlet.llm import jaccard_join
from martlet.llm.jaccard_join import jaccard_components
from martlet.llm.line_dedup import SHORT, line_dedup
from martlet.llm.substring_dedup import GROUP, LENGTH, dedup_substrings

EDGES = [(900, None), (901, ""), (902, " \n\t "), (903, "one"), (904, "two words"), (905, "two words"), (906, "x" * 30_000)]


@pytest.fixture(scope="module")
def docs_of(spark):
    """A documents table from (id, text) pairs, with columns whose names clash with helper columns."""
    def make(rows, partitions=3):
        df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], "doc_id long, text string, id string, n int, h1 string")
        return df.repartition(partitions) if rows else df
    return make


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def brute_lines(rows):
    first = {}
    for i, k, line in sorted((i, k, x) for i, t in rows for k, x in enumerate((t or "").split("\n")) if x.strip()):
        first.setdefault(line, (i, k))
    near = {a: min([first[b] for b in first if b != a and len(b) >= SHORT and one_edit(a, b)], default=(1 << 60, 0)) for a in first if len(a) >= SHORT}
    out = {}
    for i, t in rows:
        out[i] = t and "\n".join(x for k, x in enumerate(t.split("\n"))
                                 if not x.strip() or not (first[x] < (i, k) or near.get(x, (1 << 60, 0)) < (i, k)))
    return out


def line_rows(seed):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abcdef gh") for _ in range(rnd.randint(5, 40))) for _ in range(40)]

    def edited(x):
        p, r = rnd.randint(0, len(x)), rnd.random()
        return x if r < .5 else x[:p] + "é" + x[p:] if r < .7 else x[:p] + x[p + 1:] if r < .85 else x[:p] + "z" + x[p + 1:]
    return [(i, "\n".join(edited(rnd.choice(base)) for _ in range(rnd.randint(0, 10)))) for i in range(120)]


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_equal_brute_force(docs_of, seed):
    rows = line_rows(seed) + EDGES
    got = line_dedup(docs_of(rows, 5))
    assert got.columns[:5] == ["doc_id", "text", "id", "n", "h1"]
    assert {r.doc_id: r.text for r in got.collect()} == brute_lines(rows)


def test_lines_of_empty_table_and_repeated_rows(docs_of):
    assert line_dedup(docs_of([])).collect() == []
    got = line_dedup(docs_of([(1, "a line that repeats"), (1, "a line that repeats"), (2, "a line that repeats"), (None, "a line that repeats")])).collect()
    assert sorted((r.doc_id or 9, r.text) for r in got) == [(1, "a line that repeats")] * 2 + [(2, ""), (9, "")]


def test_lines_of_rows_without_an_id(docs_of):
    rows = [(1, "first common line\nan own line of one"), (None, "first common line\nsecond common line"), (None, "second common line\nfirst common lime"),
            (None, "a line but once"), (None, None)]
    got = line_dedup(docs_of(rows, 4)).collect()
    assert [r.text for r in got if r.doc_id] == [rows[0][1]]
    texts = [r.text for r in got if r.doc_id is None]
    assert sorted(texts, key=str) == ["", None, "a line but once", "second common line"]


def brute_bytes(rows):
    seen, out = set(), {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        covered = bytearray(len(b))
        for p in range(len(b) - LENGTH + 1):
            w = b[p:p + LENGTH]
            if w in seen:
                covered[p:p + LENGTH] = b"\x01" * LENGTH
            seen.add(w)
        rest = bytes(x for x, c in zip(b, covered) if not c)
        runs = sum(1 for k in range(len(b)) if covered[k] and (k == 0 or not covered[k - 1]))
        out[i] = (len(b), sum(covered), runs, hashlib.sha256(rest).hexdigest())
    return out


@pytest.mark.parametrize("seed, group", [(1, GROUP), (2, GROUP), (2, 1), (3, 3)])
def test_substrings_equal_brute_force(docs_of, seed, group):
    rnd = random.Random(seed)
    pool = ["".join(rnd.choice("abcdé \n") for _ in range(rnd.randint(50, 400))) for _ in range(10)]
    rows = []
    for i in range(80):
        parts = [rnd.choice(pool)[rnd.randint(0, 60):] if rnd.random() < .6 else "".join(rnd.choice("abcxyz") for _ in range(rnd.randint(0, 150)))
                 for _ in range(rnd.randint(0, 6))]
        rows.append((i * 3, "ab" * rnd.randint(0, 300) if i % 19 == 0 else "".join(parts)))
    rows += EDGES[:-1] + [(950, "y" * (LENGTH - 1)), (951, "z" * 700)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in dedup_substrings(docs_of(rows, 4), group=group).collect()}
    assert got == brute_bytes(rows)


def test_substrings_of_empty_table_and_repeated_rows(docs_of):
    assert dedup_substrings(docs_of([])).collect() == []
    rnd = random.Random(7)
    text = "".join(rnd.choice("abcdefgh") for _ in range(300))
    got = dedup_substrings(docs_of([(1, text), (1, text), (1, "other"), (2, text), (None, text)])).collect()
    assert sorted((r.doc_id or 9, r.n_bytes, r.n_removed) for r in got) == [(1, 5, 0), (1, 300, 0), (1, 300, 0), (2, 300, 300), (9, 300, 0)]


def shingles(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[k:k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def brute_components(rows, size, num, den):
    sets = {i: shingles(t, size) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                inter = len(sets[a] & sets[b])
                if den * inter >= num * (len(sets[a]) + len(sets[b]) - inter):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("size,num", [(3, 90), (5, 80), (1, 50)])
def test_jaccard_equals_brute_force(docs_of, size, num):
    rnd = random.Random(size)
    vocab = [f"W{k}" for k in range(300)]
    common = [rnd.choice(vocab) for _ in range(15)]
    base = [[rnd.choice(vocab) for _ in range(rnd.randint(2, 80))] for _ in range(25)]
    rows = []
    for i in range(220):
        w = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 5])):
            w[rnd.randrange(len(w))] = rnd.choice(vocab)
        rows.append((i, " ".join(w + (common if rnd.random() < .3 else [])).lower() if i % 2 else "  ".join(w)))
    rows += EDGES
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(docs_of(rows, 4), size=size, num=num).collect()}
    assert got == brute_components(rows, size, num, 100)


def test_signatures_bound_the_difference_and_spare_candidates(docs_of, monkeypatch):
    rnd = np.random.default_rng(5)
    for n in (0, 1, 7, 100, 3000):
        a = np.unique(rnd.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[n // 9:], rnd.integers(0, 1 << 63, n // 7, dtype=np.uint64)]))
        far = sum(int(x).bit_count() for x in (jaccard_join.signature(a) ^ jaccard_join.signature(b)).view(np.uint64))
        assert far <= len(np.setxor1d(a, b))
    # texts that differ in their last words only, so much that none are linked: of one length, with
    # the frequent beginnings in all prefixes
    asked, verified = [], jaccard_join._verified
    monkeypatch.setattr(jaccard_join, "_verified", lambda pairs, *rest: asked.append(pairs.distinct().count()) or verified(pairs, *rest))
    monkeypatch.setattr(jaccard_join, "sketch", lambda *_: np.zeros(1 << jaccard_join.SKETCH_BITS, np.uint8))
    rows = [(i, " ".join([f"c{k}" for k in range(60)] + [f"d{i}x{k}" for k in range(15)])) for i in range(40)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(docs_of(rows, 4)).collect()}
    assert got == brute_components(rows, 3, 90, 100) == {i: (73, i) for i, _ in rows}
    assert asked[1] == 0, asked


def star(n_one, n_two, words, seed=11):
    """A text and copies of it, each with one or two words replaced by words of its own: copies of the
    first kind are linked to the text and to each other, of the second to the text or to nothing."""
    rnd = random.Random(seed)
    base = [f"b{k}" for k in range(words)]
    rows = [(50, " ".join(base))]
    for i in range(n_one + n_two):
        w = list(base)
        for p in rnd.sample(range(5, words - 5, 5), 1 if i < n_one else 2):
            w[p] = f"own{i}x{p}"
        rows.append((100 + i, " ".join(w)))
    return rows


@pytest.mark.parametrize("words, linked", [(122, True), (80, False)])
def test_copies_of_one_text_are_not_paired_with_each_other(docs_of, monkeypatch, words, linked):
    asked, verified = [], jaccard_join._verified
    monkeypatch.setattr(jaccard_join, "_verified", lambda pairs, *rest: asked.append(pairs.distinct().count()) or verified(pairs, *rest))
    rows = star(30, 60, words)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(docs_of(rows, 3)).collect()}
    assert got == brute_components(rows, 3, 90, 100)
    assert (sum(c == 50 for _, c in got.values()) == len(rows)) == linked
    assert asked[1] <= 10, asked  # of some 2000 pairs of copies


def test_lists_of_one_shingle_with_sizes_that_do_not_fit(docs_of):
    # all share a passage; sizes on both sides of the bound, and next to none that fits
    rows = [(i, " ".join([f"p{k}" for k in range(30)] + [f"q{k}" for k in range(m)])) for i, m in enumerate([0, 1, 2, 3, 4, 10, 30, 33, 34, 100, 200, 223])]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(docs_of(rows, 4)).collect()}
    assert got == brute_components(rows, 3, 90, 100)


def test_jaccard_of_empty_table(docs_of):
    assert jaccard_components(docs_of([])).collect() == []
    got = jaccard_components(docs_of([(1, "a b c d"), (1, "a b c d"), (2, "a b c d"), (None, "a b c d"), (4, None)])).collect()
    assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id) == [(1, 1), (2, 1), (4, 4)]
