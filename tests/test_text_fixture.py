"""Text-measure jobs vs their SQL twins on a crafted corpus that trips every rule."""

import math

import duckdb

import __spark_entry__ as E

TEXTS = [
    "aBcDé xYzÉ ÀbÇdÈ plain words here and there, AbCdEfGhÍ",
    "Привет мир Hellо Wоrld смешанный Latinтекст Ωμέγαalpha",
    "control\x07chars\x01here​ and   separators\x1a ok",
    "!!! ??? $$$ ¢¢ §§ «ok» ... --- *** ### @@@ %%% ^^^ !?!?$¢§«»*#@%^&",
    "ﻻ ﻼ ﺍﺏ arabic isolated forms ﻻﻻ text",
    "ÉÉ éé ÈÈ àà ÀÁ çç ññ ÜÜ double accents everywhere ÖÖ öö",
    "日本語のテキストと한국어 mixed with English and 中文",
    "x",
    "",
    "ÀÉÎÕÜ àéîõü ÀÉÎÕÜ àéîõü ÀÉÎÕÜ àéîõü accentuated heavy ÀÉÎÕÜ",
    "camelCaseWordsÀndMore aXbYcZ dÉfÉgÉ tEsTé",
    "one two three four five six seven eight nine ten eleven twelve crÈmE caf€ x日本y ça$va",
    "a" * 30 + "é " + "Ωμέγαλφαβητααααααααααααααααα tail",
]


def test_text_jobs_match_sql_on_fixture(spark, tmp_path):
    d = str(tmp_path)
    rows = [(i, t, "en", "fx", len(t)) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long") \
        .coalesce(1).write.parquet(f"{d}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{d}/documents.parquet/*.parquet')")
    jobs, sql = E.queries(), E.oracle_sql()
    for name in ("g1_char_noise", "g4_case_flip", "g2_g12_accent_isolated", "g11_weird_words",
                 "g1_noise_scores"):
        df = jobs[name](spark, d)
        got = {r.doc_id: r.asDict() for r in df.collect()}
        cur = con.execute(sql[name])
        cols = [c[0] for c in cur.description]
        want = {r[0]: dict(zip(cols, r)) for r in cur.fetchall()}
        assert set(got) == set(want), name
        for k in got:
            for c in cols:
                a, b = got[k][c], want[k][c]
                if isinstance(a, float) and math.isnan(a):
                    assert isinstance(b, float) and math.isnan(b)
                else:
                    assert a == b, (name, k, c, a, b)
    # the fixture really exercises the rules
    flips = {r.doc_id: r.n_flip_points for r in jobs["g4_case_flip"](spark, d).collect()}
    chars = {r.doc_id: r for r in jobs["g1_char_noise"](spark, d).collect()}
    assert flips[0] > 0 and flips[10] > 0
    assert chars[2].n_unprintable > 0 and chars[1].n_script_pairs > 0 and chars[3].symbol_noise > 0
    assert chars[4].isolated_form_noise > 0 and chars[5].duplicate_accent_noise > 0
    weird = {r.doc_id: r.weird_word_noise for r in jobs["g11_weird_words"](spark, d).collect()}
    assert weird[11] > 0 and weird[12] > 0
