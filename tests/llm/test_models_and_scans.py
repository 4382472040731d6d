"""Toxicity, token counts, licences, urls, tokens, neighbours, decontamination and the pipeline."""

import random
import subprocess
import sys
import textwrap
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from martlet.llm import decontaminate, license_scan, nearest, sentencepiece_codec, token_counts, toxicity, url_filter

SF = "/root/testdata/sf0.001"
EDGES = [(900, None), (901, ""), (902, " \n\t "), (903, "one"), (904, "word " * 6000), (905, "word " * 6000)]


@pytest.fixture(scope="module")
def docs_of(spark):
    """A documents table from (id, text) pairs, with columns whose names clash with helper columns."""
    def make(rows, partitions=3):
        df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], "doc_id long, text string, id string, n int, h1 string")
        return df.repartition(partitions) if rows else df
    return make


def test_chain_learns_and_keeps_clean_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    train, held = labels.filter("doc_id % 4 <> 0"), labels.filter("doc_id % 4 = 0")
    chain, oof = toxicity.train(docs, train, toxicity.label_columns())
    assert all(len(r.oof) == 2 for r in oof.collect())
    got = toxicity.score(docs, chain, ["a", "b"]).join(held, "doc_id").select("toxic", (F.col("b") >= toxicity.THRESHOLD).alias("found")).collect()
    toxic = [r.found for r in got if r.toxic]
    clean = [r.found for r in got if not r.toxic]
    assert sum(toxic) >= 0.85 * len(toxic) and sum(clean) <= 0.01 * len(clean)


def test_chain_edges(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    chain, _ = toxicity.train(docs_of(EDGES), none, toxicity.label_columns())
    got = toxicity.score(docs_of(EDGES), chain, ["n", "p"])
    assert got.columns == ["doc_id", "text", "id", "h1", "n", "p"] and {r.p for r in got.collect()} == {0.0}
    assert toxicity.score(docs_of([]), chain, ["p"]).collect() == []


def test_counts_after_edits_equal_a_new_count(spark, docs_of):
    counter = token_counts.Counter(*token_counts.default_tokenizer())
    rnd = random.Random(4)
    letters = "ab  \n\n'rtesv.,12é "
    for _ in range(400):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 300)))
        tree = token_counts.build(counter, text)
        for _ in range(4):
            a = rnd.randint(0, len(text))
            text = token_counts.edit(counter, tree, text, a, a + rnd.randint(0, 6), "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 5))))
            new = token_counts.build(counter, text)
            assert new.total == tree.total and np.array_equal(new.chars, tree.chars)
            assert all(np.array_equal(x, y) for x, y in zip(new.sums, tree.sums, strict=True))
            assert tree.total[1] == len(counter.encoding.encode_ordinary(text))
    trees = token_counts.build_trees(docs_of([*EDGES, (1, "some text, to edit")]))
    edits = spark.createDataFrame([(1, 0, 5, 9, "words"), (1, 1, 0, 4, None), (901, 0, 0, 9, "new"), (77, 0, 0, 1, "x")],
                                  "doc_id long, seq int, start int, end int, replacement string")
    got = {r.doc_id: r for r in token_counts.apply_edits(trees, edits).collect()}
    assert got[1].text == " words, to edit" and got[901].text == "new" and got[900].n_tokens == 0
    assert all(r.n_tokens == len(counter.encoding.encode_ordinary(r.text or "")) for r in got.values())
    again = token_counts.count_with_edits(docs_of(EDGES), token_counts.cleaning_edits()).collect()
    assert len(again) == len(EDGES) and token_counts.count_with_edits(docs_of([]), token_counts.cleaning_edits()).collect() == []


def test_licences(docs_of):
    mit = license_scan.KNOWN[0][1]
    rows = [*EDGES, (1, "Copyright (c) 2020 A. Person\n\n" + mit.upper().replace("\n", "\r\n  ")), (2, "x\nReleased  under the M.I.T. licence\nx"),
            (3, "words\nreleased under the mit Licence!\n(c) me\nLicensed under CC BY-NC 4.0."), (4, mit + " And more.")]
    got = {r.doc_id: (r.text_license, r.n_license_lines, r.line_licenses) for r in license_scan.scan_licenses(docs_of(rows)).collect()}
    assert got[1][0] == "MIT" and got[2] == (None, 0, "") and got[3] == (None, 2, "CC-BY-NC-4.0,MIT") and got[4] == (None, 0, "")
    assert len(got) == len(rows) and got[900] == (None, 0, "")
    assert license_scan.scan_licenses(docs_of([])).collect() == []


def test_whole_licences_with_title_copyright_and_comment_signs(docs_of):
    title = {"MIT": "The MIT License (MIT)", "ISC": "ISC License", "BSD-2-Clause": "BSD 2-Clause License", "BSD-3-Clause": "BSD 3-Clause License"}
    texts = [*license_scan.KNOWN[:2], *license_scan.whole_texts()]
    assert {n for n, _ in texts} >= {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "CC-BY-SA-4.0"}
    rows, want = [], {}
    for name, text in texts:
        for sign in ("", "# ", "// ", " * ", "dnl ", "REM "):
            lines = [title.get(name, ""), "", "Copyright (c) 2020 A. Person", "(c) 2021 B. Person", *text.split("\n")]
            want[len(rows)] = name
            rows.append((len(rows), "\n".join(sign + x for x in lines)))
    mit, bsd = license_scan.KNOWN[0][1], dict(license_scan.whole_texts())["BSD-3-Clause"]
    narrow = "\n".join("\n".join(textwrap.wrap(p, 30)) for p in mit.split("\n\n"))
    other = bsd.replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ").replace("the University", "Some Company, Inc.")
    for name, text in [("MIT", "MIT License\n" + narrow), ("BSD-3-Clause", other), ("ISC", " ".join(license_scan.KNOWN[1][1].split())),
                       (None, mit + "\nbut not on Sundays"), (None, "MIT License")]:
        want[len(rows)] = name
        rows.append((len(rows), text))
    got = {r.doc_id: r.text_license for r in license_scan.scan_licenses(docs_of(rows)).collect()}
    assert {k: (want[k], got[k]) for k in want if want[k] != got[k]} == {}


def test_no_spelling_changes_first_characters():
    assert all(a[:license_scan.KEY] == b[:license_scan.KEY] for a, b in license_scan.SPELLINGS)


def test_urls(spark):
    urls = ["http://Example.COM/en/x?a=/en/", "https://www.example.com/en/1", "http://a.net/fr/", "http://net/es/x", "http://a.net/en/", "ftp://x.org",
            "no url", None, "", "http://", "http://example.com", "http://notexample.com/en/", "http://a.example.com/en/#x", "http://com/", "a://b.com/c://d"]
    df = spark.createDataFrame([(k, u, "h") for k, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: tuple(r)[1:] for r in url_filter.filter_urls(df, url_filter.RULES).collect()}

    def plain(u):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
        fit = [(len(r), len(r.split("/")[0]), r, v) for v, r in url_filter.RULES
               if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/"):])]
        return (host, path, *(max(fit)[2:] if fit else (None, "allow")))
    assert got == {k: plain(u) for k, u in enumerate(urls)}
    assert url_filter.filter_urls(df.limit(0), url_filter.RULES).collect() == []


def test_digest_collisions_are_confirmed(tmp_path):
    files = url_filter.write_index([("block", "a.com/"), ("allow", "b.com/x")], str(tmp_path), "r")
    index = url_filter.RuleIndex(*files)
    index.keys = np.zeros(2, np.uint64) + np.sort(index.records["key"])[0]  # all digests alike
    assert index.find([b"c.com/"]) == [None]


def test_codec_equals_the_library(docs_of):
    import sentencepiece
    model = sentencepiece_codec.default_model()
    lib, own = sentencepiece.SentencePieceProcessor(model_file=model), sentencepiece_codec.piece_table(model)
    rnd = random.Random(3)
    letters = list("abcdefgh     \n\t\r.,!?'\"-_#*()[]{}0123456789ABCÉéßñüö漢字かなабв😀▁\x00\x85 ²") + ["\t\t", "    ", "==", "**"]
    texts = ["", " ", "  x ", "a▁b", "<s></s><0x41>"] + ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    texts += ["".join(rnd.choice(" \n.-=*#/_a") for _ in range(rnd.randint(0, 60))) for _ in range(500)] + ["ab" * 5000, " " * 3000, "漢" * 500]
    for t in texts:
        ids = lib.encode(t)
        assert own.encode(t, end=False) == ids and own.decode(ids) == lib.decode(ids)
    assert own.decode([own.byte_id[0xE6], 5000, own.byte_id[0x80]]) == lib.decode([own.byte_id[0xE6], 5000, own.byte_id[0x80]])
    ids = sentencepiece_codec.encode_column(docs_of(EDGES), model)
    got = sentencepiece_codec.decode_column(ids, model).collect()
    assert {r.doc_id: r.decoded for r in got} == {i: t or "" for i, t in EDGES} and all(r.ids[-1] == 2 for r in got)
    assert sentencepiece_codec.round_trip(docs_of([]), model).collect() == []


def test_neighbours(spark):
    rnd = np.random.default_rng(1)
    x = rnd.standard_normal((900, 16))
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)] + [(i, x[0].tolist(), 1) for i in range(2000, 2300)]
    bad = [(3000, None, 0), (3100, [], 0), (3200, [0.0] * 16, 0), (3300, [float("nan")] * 16, 0), (3400, [None, *[1.0] * 15], 0), (3500, [1.0] * 4, 0),
           (None, x[1].tolist(), 0)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, score int").repartition(4)
    got = nearest.nearest(df, F.col("vec_id") % 100 == 0).collect()
    ids, m = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    hits = total = 0
    for q in {r.query_id for r in got}:
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        d = np.sqrt(((m - m[ids == q][0]) ** 2).sum(axis=1))
        best = [(ids[k], d[k]) for k in np.lexsort((ids, d)) if ids[k] != q][:10]
        assert [r for r, _, _ in mine] == list(range(1, 11)) and [s for *_, s in mine] == sorted(s for *_, s in mine)
        assert all(abs(d[ids == v][0] - s) < 1e-12 for _, v, s in mine)
        hits, total = hits + len({v for _, v, _ in mine} & {v for v, _ in best}), total + 10
    assert hits >= 0.9 * total and {r.query_id for r in got} == {i for i in ids.tolist() if i % 100 == 0}
    assert nearest.nearest(df.limit(0), F.col("vec_id") % 100 == 0).collect() == []


def test_recall_on_the_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.collect()
    ids, m = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    got = {}
    for r in nearest.nearest(df, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in got:
        d = ((m - m[ids == q][0]) ** 2).sum(axis=1)
        hits += len(got[q] & {ids[k] for k in np.argsort(d, kind="stable")[:11] if ids[k] != q})
    assert hits >= 0.9 * 10 * len(got)


def greedy(a, b, size):
    """Greedy string tiling by definition."""
    marked_a, marked_b, total = set(), set(), 0
    while True:
        best = (size - 1, 0, 0)
        for j in range(len(b)):
            for i in range(len(a)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and i + n not in marked_a and j + n not in marked_b:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < size:
            return total
        marked_a |= set(range(i, i + n))
        marked_b |= set(range(j, j + n))
        total += n


def test_tiling_by_definition():
    rnd = random.Random(6)
    for _ in range(150):
        a, b = ([rnd.randint(1, 4) for _ in range(rnd.randint(0, 40))] for _ in range(2))
        tiles = decontaminate.tile(np.array(a, np.uint64), np.array(b, np.uint64), 3)
        assert sum(t[0] for t in tiles) == greedy(a, b, 3)


def test_reordered_passages_are_found(spark, docs_of):
    rnd = random.Random(8)
    w = [f"w{rnd.randint(0, 5000)}" for _ in range(4000)]
    item = w[:40]
    rows = [*EDGES, (1, " ".join(w[100:200] + item + w[200:300])), (2, " ".join(w[300:400] + item[20:] + w[400:450] + item[:20])),
            (3, " ".join(w[500:700] + item[:12])), (4, " ".join(w[800:3900])), (5, "Short, item!"), (6, " ".join(item[:20] * 9))]
    bench = spark.createDataFrame([(7, " ".join(item).upper(), 1), (8, "short ITEM", 1), (9, None, 1), (10, "", 1), (7, " ".join(item), 1)],
                                  "item_id long, text string, n_words int")
    got = {(r.doc_id, r.item_id): r.coverage for r in decontaminate.match_items(docs_of(rows), bench).collect()}
    assert got == {(1, 7): 1.0, (2, 7): 1.0, (3, 7): 0.3, (5, 8): 1.0, (6, 7): 0.5}
    assert decontaminate.match_items(docs_of([]), bench).collect() == []
    assert decontaminate.contaminated(docs_of(rows), bench.limit(0)).collect() == []


def test_every_passage_of_an_item_is_searched(spark, docs_of):
    a, b, c = (" ".join(f"{x}{k}" for k in range(20)) for x in "abc")
    rows = [(1, f"x {a} y"), (2, f"x {b} y"), (3, f"x {c} y"), (4, "nothing of them"), (5, " ".join(a.split()[:12]) + " x " + b)]
    bench = spark.createDataFrame([(7, a), (7, b), (7, a), (None, c), (None, None)], "item_id long, text string").repartition(3)
    got = sorted(map(tuple, decontaminate.contaminated(docs_of(rows), bench).collect()), key=str)
    assert got == [(1, 7, 20, 20, 1, 1.0), (2, 7, 20, 20, 1, 1.0), (3, None, 20, 20, 1, 1.0), (5, 7, 20, 20, 1, 1.0)]


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    edge = spark.createDataFrame([(10_000, None, "en", None, 0), (10_001, "", "en", "s", 0), (10_002, None, None, "s", None)], docs.schema)
    docs = docs.unionByName(edge).cache()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF).cache()
        before, after = {r[0] for r in docs.select("doc_id").collect()}, [r[0] for r in out.select("doc_id").collect()]
        assert len(after) == len(set(after)) and set(after) <= before
        if name != "tokens":
            assert out.schema.names == docs.schema.names
            assert {10_000, 10_001, 10_002} <= set(after)
        if name in ("line_dedup", "tokens"):
            assert set(after) == before
        docs = out
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_pipeline_stages_on_null_and_repeated_ids(spark):
    import corpus_pipeline

    item = next(r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").collect() if r.text)
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(40)) for x in "abcd")
    docs = spark.createDataFrame(
        [(None, a), (5, a), (3, a), (None, b), (None, b + " more"), (7, c), (7, c), (7, d), (8, d), (None, ""), (None, None), (9, "x " + item), (None, "y " + item)],
        "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("int")})
    docs = docs.select(*spark.read.parquet(f"{SF}/documents.parquet").columns).repartition(4)

    def left(out):
        assert out.columns == docs.columns
        return sorted(((r.doc_id, (r.text or "")[:2]) for r in out.collect()), key=str)

    near = left(corpus_pipeline.near_duplicates(spark, docs.filter("doc_id IS NULL OR doc_id <> 9"), SF))
    assert near == sorted([(3, "a0"), (None, "b0"), (7, "c0"), (7, "d0"), (None, ""), (None, ""), (None, "y ")], key=str)
    clean = left(corpus_pipeline.benchmark_leaks(spark, docs, SF))
    assert len(clean) == 11 and not {(9, "x "), (None, "y ")} & set(clean)


def test_pipeline_stages_keep_columns_of_helper_names(spark):
    import corpus_pipeline

    names = ["__own", "__id", "__gone", "__h", "__at", "__n_lines", "__n_removed", "__p_poor", "__p_toxic"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 40")
    docs = docs.unionByName(spark.createDataFrame([(None, "a line of its own", "en", "s", 17)], docs.schema))
    docs = docs.withColumns({c: F.coalesce(F.col("doc_id"), F.lit(-1)) * 10 + k for k, c in enumerate(names)})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows and all(r[c] == (-1 if r.doc_id is None else r.doc_id) * 10 + k for r in rows for k, c in enumerate(names)), name


@pytest.mark.parametrize("name", ["op3_license_scan", "op5_url_filter"])
def test_sql(spark, duck, name):
    from martlet.llm.queries import ORACLE, QUERIES
    duck.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    duck.execute(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM read_parquet('{SF}/pages.parquet')")
    df = QUERIES[name](spark, SF)
    rel = duck.execute(ORACLE[name])
    names = [c[0] for c in rel.description]
    assert sorted(map(str, (tuple(r[c] for c in names) for r in df.collect()))) == sorted(map(str, rel.fetchall()))


def test_release_gives_arrow_memory_back():
    # in a process of its own: 100 MB of Arrow arrays are made and dropped
    code = """
import ctypes, gc, re
import pyarrow as pa
from martlet.llm._common import release
def held():
    return sum(map(int, re.findall(r"\\nPss_(?:Anon|Shmem):\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) / 1024
release()
before = held()
arrays = [pa.array(range(2000)) for _ in range(6500)]
most = held() - before
del arrays
release()
print(most, held() - before)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=Path(__file__).resolve().parents[2])
    most, rest = map(float, out.stdout.split())
    assert most > 90 and rest < most / 2
