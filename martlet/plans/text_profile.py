"""Corpus text profiling (G1-G12): per-document noise measures, a per-source
noise report, per-language letter profiles and a language-coherence score.

Every measure reads the whole text of every document. Counts come from regular
expressions evaluated in the JVM (``regexp_count`` and higher-order array
functions); there is no Python per row. Letter profiles explode characters and
count them with a partial + final aggregate (the word-count pattern), so one
language holding a third of the corpus is combined map-side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

# Characters treated as ordinary ASCII markup (not counted as
# punctuation noise), and the noise-measure thresholds.
SAFE_ASCII = "<>=:/&;{}[],|\"-()"
SYMBOL_MIN_RATIO = 0.3
ACCENT_MIN_RATIO = 0.35
ACCENT_MIN_CHARS = 8
SCRIPT_MIN_CHARS = 13
WEIRD_MIN_WORDS = 10
MESS_THRESHOLD = 0.2
COHERENCE_MIN = 0.1
COHERENCE_MIN_LETTERS = 32

_SAFE_CLASS = "".join("\\" + ch if ch in "[]\\-^&" else ch for ch in SAFE_ASCII)
PUNCT = f"[\\p{{P}}&&[^{_SAFE_CLASS}]]"
SYMBOL = f"[\\p{{S}}\\p{{No}}\\p{{Nl}}&&[^{_SAFE_CLASS}\\x{{1F300}}-\\x{{1FAFF}}]]"


def _accented_letters() -> tuple[str, str]:
    """Latin letters (U+00C0-U+024F) whose canonical decomposition is a base letter
    plus combining marks, and their base letters - derived from the Unicode data,
    not listed by hand."""
    import unicodedata
    acc, base = [], []
    for cp in range(0x00C0, 0x0250):
        ch = chr(cp)
        d = unicodedata.normalize("NFD", ch)
        if len(d) > 1 and ch.isalpha() and all(unicodedata.combining(m) for m in d[1:]):
            acc.append(ch)
            base.append(d[0])
    return "".join(acc), "".join(base)


def _ranges(chars: str) -> str:
    """Regex class body of a character set as compressed code-point ranges (a long
    list of single characters is slow to test in Java regular expressions)."""
    cps = sorted({ord(c) for c in chars})
    out, i = [], 0
    while i < len(cps):
        j = i
        while j + 1 < len(cps) and cps[j + 1] == cps[j] + 1:
            j += 1
        out.append(f"\\x{{{cps[i]:X}}}" + (f"-\\x{{{cps[j]:X}}}" if j > i else ""))
        i = j + 1
    return "".join(out)


ACCENTED_CHARS, ACCENTED_BASES = _accented_letters()
ACCENTED = "[" + _ranges(ACCENTED_CHARS) + "]"
ACCENTED_UPPER_CHARS = "".join(c for c in ACCENTED_CHARS if c.isupper())
ACCENTED_UPPER = "[" + _ranges(ACCENTED_UPPER_CHARS) + "]"
# each accented letter -> a private-use code point carrying its base letter (with case)
_PUA = 0xE000
ACCENTED_CODES = "".join(chr(_PUA + ord(b)) for b in ACCENTED_BASES)
# CJK ideographs, kana and Hangul as code-point blocks (faster than script lookups)
GLYPH = ("[\\x{1100}-\\x{11FF}\\x{3040}-\\x{30FF}\\x{3400}-\\x{4DBF}\\x{4E00}-\\x{9FFF}"
         "\\x{AC00}-\\x{D7AF}\\x{F900}-\\x{FAFF}\\x{20000}-\\x{2FA1F}]")
WORD_SEPARATORS = "[\\s\\p{Z}\\p{P}｜+<>]+"
WORD_SYMBOL = "[\\p{S}\\p{No}\\p{Nl}&&[^<>\\-=~|_]]"
UNPRINTABLE = "[\\p{Cc}\\p{Cf}\\p{Co}\\p{Cn}\\p{Zl}\\p{Zp}&&[^\\s\\x{1A}\\x{FEFF}]]"
SCRIPTS = ("Latin", "Cyrillic", "Greek", "Arabic", "Hebrew", "Han", "Hiragana", "Katakana",
           "Hangul", "Thai", "Devanagari")
ARABIC_ISOLATED = "[\\x{FE70}-\\x{FEFF}\\x{FB50}-\\x{FDFF}]"
CJK = "[\\p{IsHan}]"


def _n(c: Column) -> Column:
    return F.length(c).cast("double")


def _count(text: Column, pattern: str) -> Column:
    """Matches of a pattern that consumes exactly one character (look-arounds
    allowed): the length lost when they are removed. No per-match strings, unlike
    regexp_count."""
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("double")


def _count_set(text: Column, chars: str) -> Column:
    """Occurrences of any character of a fixed set (a char map, no regex)."""
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("double")



def _non_ascii(text: Column) -> Column:
    """Cheap gate: a text without any non-ASCII character cannot score on the
    accent, case, script, Arabic or CJK measures (the scan stops at the first hit)."""
    return text.rlike("[^\\x00-\\x7F]")


def symbol_noise(text: Column) -> Column:
    """G1: (punctuation + 2·symbols) / chars, a run of one repeated character counted
    once (the run's last character: it is not followed by itself); 0 below 0.3."""
    punct = _count(text, f"({PUNCT})(?!\\1)")
    sym = _count(text, f"({SYMBOL})(?!\\1)")
    r = F.try_divide(punct + 2 * sym, _n(text))
    return F.when(r >= SYMBOL_MIN_RATIO, r).otherwise(F.lit(0.0))


def accent_noise(text: Column) -> Column:
    """Accented letters / chars for texts of at least 8 chars; 0 below 0.35."""
    r = F.try_divide(_count_set(text, ACCENTED_CHARS), _n(text))
    keep = _non_ascii(text) & (_n(text) >= ACCENT_MIN_CHARS)
    return F.when(keep, F.when(r >= ACCENT_MIN_RATIO, r).otherwise(F.lit(0.0))).otherwise(F.lit(0.0))


def unprintable_noise(text: Column) -> Column:
    """8 · unprintable / chars."""
    return F.coalesce(F.try_divide(8 * _count(text, UNPRINTABLE), _n(text)), F.lit(0.0))


def case_flip_noise(text: Column) -> Column:
    """Inside each chunk of cased letters (at most 64 long, holding a non-ASCII
    letter, not cut by a digit) every two successive upper/lower flips add 2; an
    alternating run of m letters holds m - 1 flips. Total over chars."""
    chunks = F.filter(F.regexp_extract_all(text, F.lit("[\\p{Lu}\\p{Ll}]++(?!\\d)"), 0),
                      lambda w: (F.length(w) <= 64) & w.rlike("[^\\x00-\\x7F]"))
    runs = F.flatten(F.transform(chunks, lambda w: F.regexp_extract_all(
        w, F.lit("(?:\\p{Lu}\\p{Ll})+\\p{Lu}?|(?:\\p{Ll}\\p{Lu})+\\p{Ll}?"), 0)))
    flips = F.aggregate(runs, F.lit(0), lambda acc, r: acc + 2 * F.floor((F.length(r) - 1) / 2).cast("int"))
    r = F.coalesce(F.try_divide(flips.cast("double"), _n(text)), F.lit(0.0))
    return F.when(_non_ascii(text), r).otherwise(F.lit(0.0))


def duplicate_accent_noise(text: Column) -> Column:
    """2 · (successive accented letters: +1 when both are upper case, +1 when
    they share a base letter) / chars. Non-accented characters are blanked first,
    so both tests become short patterns over accented letters only."""
    coded = F.translate(text, ACCENTED_CHARS, ACCENTED_CODES)
    up = f"[\\x{{{_PUA + 65:X}}}-\\x{{{_PUA + 90:X}}}]"
    both_upper = _count(coded, f"{up}(?={up})")
    same = _count(coded, f"([\\x{{{_PUA:X}}}-\\x{{{_PUA + 0xFF:X}}}])(?=\\1)")
    r = F.coalesce(F.try_divide(2 * (both_upper + same), _n(text)), F.lit(0.0))
    return F.when(_non_ascii(text), r).otherwise(F.lit(0.0))


_CJK_SCRIPTS = {"Han", "Hiragana", "Katakana"}


def _script_pairs() -> str:
    """One branch per script: a letter of it followed by a letter of a clashing script."""
    alts = []
    for a in SCRIPTS:
        others = [b for b in SCRIPTS if b != a and not ({a, b} <= _CJK_SCRIPTS)]
        cls = "".join(f"\\p{{Is{b}}}" for b in others)
        alts.append(f"\\p{{Is{a}}}(?=[{cls}])")
    return "|".join(alts)


_NON_LATIN_LETTER = "[\\p{L}&&[^\\p{IsLatin}]]"


def script_mix_noise(text: Column) -> Column:
    """2 · neighbouring letters from clashing scripts / chars, texts over 13 chars.
    A text without any non-Latin letter cannot mix scripts: one cheap scan decides."""
    r = F.try_divide(2 * _count(text, _script_pairs()), _n(text))
    mixed = text.rlike(_NON_LATIN_LETTER)
    return F.when((_n(text) > SCRIPT_MIN_CHARS) & mixed, r).otherwise(F.lit(0.0))


def weird_word_noise(text: Column) -> Column:
    """G11 for one text column (see ``weird_tokens``)."""
    return weird_from_tokens(weird_tokens(text))


def weird_tokens(text: Column) -> Column:
    """Letters of suspicious words / letters of words, when there are more than
    10 words or a long foreign word. A word (letters plus embedded symbols, split
    at spaces, punctuation and separators) is suspicious when it holds a symbol; or
    it has >= 4 letters and half are accented, or it ends in an accented capital
    without being all capitals, or it holds exactly one CJK/Hangul/kana glyph; or it
    has >= 24 letters with a foreign letter and is not camel case."""
    tokens = F.split(text, WORD_SEPARATORS)
    ascii_letters = "".join(chr(c) for c in range(65, 91)) + "".join(chr(c) for c in range(97, 123))
    camel_free = f"[\\p{{L}}&&[^\\p{{IsLatin}}\\p{{IsHan}}\\p{{IsHangul}}\\p{{IsHiragana}}\\p{{IsKatakana}}]]|{ACCENTED}"

    def measure(w):
        # stage 1: per-word quantities, each computed once; character-set counts
        # use translate (a char map), not a regular expression
        plain = F.length(F.translate(w, ascii_letters, "")) == 0
        n = F.when(plain, F.length(w)).otherwise(
            F.length(F.regexp_replace(w, f"[^\\p{{L}}{WORD_SYMBOL[1:-1]}]", "")))
        acc = F.length(w) - F.length(F.translate(w, ACCENTED_CHARS, ""))
        return F.struct(w.alias("w"), plain.alias("plain"), n.alias("n"), acc.alias("acc"))

    def rules(t):
        # stage 2: the rules, cheapest tests first (AND / OR short-circuit)
        w, n, acc = t["w"], t["n"], t["acc"]
        upper = F.length(w) - F.length(F.regexp_replace(w, "\\p{Lu}", ""))
        sym = w.rlike(WORD_SYMBOL)
        r1 = (n >= 4) & (acc * 2 >= n)
        r2 = (n >= 4) & (acc * 2 < n) & (acc > 0) & w.rlike(ACCENTED_UPPER + "[^\\p{L}]*$") & (upper != n)
        glyph1 = w.rlike(GLYPH) & (F.regexp_count(w, F.lit(GLYPH)) == 1)
        r3 = (n >= 4) & (acc * 2 < n) & ~F.coalesce(r2, F.lit(False)) & glyph1
        r4 = (n >= 24) & w.rlike(camel_free) & ~((upper > 0) & (upper * 10 <= n * 3))
        bad = F.when(t["plain"], F.lit(False)).otherwise(sym | r1 | r2 | r3 | r4)
        fl = F.when(t["plain"], F.lit(0)).otherwise(r2.cast("int") + r3.cast("int") + r4.cast("int"))
        return F.struct(n.alias("n"), bad.alias("bad"), fl.alias("fl"))

    staged = F.transform(tokens, measure)
    return F.filter(F.transform(staged, rules), lambda t: t["n"] > 0)


def weird_word_table(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """G11 per document as rows: words exploded to rows (code-generated regex work),
    then summed back per document. The explode keeps a document's words in its
    partition, so partial aggregation ships one row per document."""
    ascii_letters = "".join(chr(c) for c in range(65, 91)) + "".join(chr(c) for c in range(97, 123))
    camel_free = f"[\\p{{L}}&&[^\\p{{IsLatin}}\\p{{IsHan}}\\p{{IsHangul}}\\p{{IsHiragana}}\\p{{IsKatakana}}]]|{ACCENTED}"
    w = F.col("w")
    words = docs.select(key, F.explode(F.split(F.col(text), WORD_SEPARATORS)).alias("w"))
    plain = F.length(F.translate(w, ascii_letters, "")) == 0
    letters_only = w.rlike("^\\p{L}+$")
    n = F.when(plain | letters_only, F.length(w)).otherwise(
        F.length(F.regexp_replace(w, f"[^\\p{{L}}{WORD_SYMBOL[1:-1]}]", "")))
    words = words.select(key, "w", plain.alias("plain"), letters_only.alias("letters_only"), n.alias("n"),
                         (F.length(w) - F.length(F.translate(w, ACCENTED_CHARS, ""))).alias("acc")) \
                 .filter(F.col("n") > 0)
    n, acc = F.col("n"), F.col("acc")
    upper = F.length(w) - F.length(F.regexp_replace(w, "\\p{Lu}", ""))
    r1 = (n >= 4) & (acc * 2 >= n)
    # last letter is an accented capital: membership by translate, not a regex scan
    last = F.substring(F.regexp_replace(w, "[^\\p{L}]+$", ""), -1, 1)
    last_acc_upper = (F.length(last) == 1) & (F.length(F.translate(last, ACCENTED_UPPER_CHARS, "")) == 0)
    r2 = (n >= 4) & (acc * 2 < n) & (acc > 0) & last_acc_upper & (upper != n)
    r3 = (n >= 4) & (acc * 2 < n) & ~F.coalesce(r2, F.lit(False)) & w.rlike(GLYPH) & \
        (F.regexp_count(w, F.lit(GLYPH)) == 1)
    r4 = (n >= 24) & w.rlike(camel_free) & ~((upper > 0) & (upper * 10 <= n * 3))
    sym = ~F.col("letters_only") & w.rlike(WORD_SYMBOL)
    bad = F.when(F.col("plain"), F.lit(False)).otherwise(sym | r1 | r2 | r3 | r4)
    fl = F.when(F.col("plain"), F.lit(0)).otherwise(r2.cast("int") + r3.cast("int") + r4.cast("int"))
    per = words.groupBy(key).agg(F.count(F.lit(1)).alias("_words"), F.sum("n").alias("_chars"),
                                 F.sum(F.when(bad, n).otherwise(F.lit(0))).alias("_bad"),
                                 F.sum(fl).alias("_fl"))
    r = F.coalesce(F.try_divide(F.col("_bad").cast("double"), F.col("_chars").cast("double")), F.lit(0.0))
    score = F.when((F.col("_words") <= WEIRD_MIN_WORDS) & (F.col("_fl") == 0), F.lit(0.0)).otherwise(r)
    return per.select(key, score.alias("weird_word_noise"))


def weird_from_tokens(ws: Column) -> Column:
    """G11 totals from the per-word (n, bad, fl) array of ``weird_tokens``."""
    chars = F.aggregate(ws, F.lit(0), lambda acc, t: acc + t["n"])
    bad_chars = F.aggregate(ws, F.lit(0), lambda acc, t: acc + F.when(t["bad"], t["n"]).otherwise(F.lit(0)))
    foreign = F.aggregate(ws, F.lit(0), lambda acc, t: acc + t["fl"])
    r = F.coalesce(F.try_divide(bad_chars.cast("double"), chars.cast("double")), F.lit(0.0))
    return F.when((F.size(ws) <= WEIRD_MIN_WORDS) & (foreign == 0), F.lit(0.0)).otherwise(r)


def isolated_form_noise(text: Column) -> Column:
    """Isolated Arabic presentation forms / chars (texts of at least 8 chars)."""
    r = F.try_divide(_count(text, ARABIC_ISOLATED), _n(text))
    return F.when(_non_ascii(text) & (_n(text) >= 8), r).otherwise(F.lit(0.0))


def rare_cjk_noise(rare: Column, cjk: Column) -> Column:
    """Share of CJK characters that are not common, from a text's counts of both;
    reported / 10 when the share is above 0.5 and the text holds at least 8 of them."""
    share = F.try_divide(rare.cast("double"), cjk.cast("double"))
    return F.when((cjk >= 8) & (share > 0.5), share / 10).otherwise(F.lit(0.0))


MEASURES = {
    "symbol_noise": symbol_noise, "accent_noise": accent_noise,
    "unprintable_noise": unprintable_noise, "case_flip_noise": case_flip_noise,
    "duplicate_accent_noise": duplicate_accent_noise, "script_mix_noise": script_mix_noise,
    "weird_word_noise": weird_word_noise, "isolated_form_noise": isolated_form_noise,
    "rare_cjk_noise": rare_cjk_noise,
}
# G11 and G12 are not expressions of one text alone
_BY_TABLE = ("weird_word_noise", "rare_cjk_noise")


# Tenths of all CJK occurrences that the common characters make up.
COMMON_CJK_TENTHS = 9


def cjk_counts(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, ch, n) of the CJK characters of every text that has any."""
    han = F.regexp_replace(F.col(text), "[^\\p{IsHan}]", "")
    return docs.filter(F.col(text).rlike(CJK)).select(key, F.explode(F.split(han, "")).alias("ch")) \
        .filter(F.col("ch") != "").groupBy(key, "ch").agg(F.count(F.lit(1)).alias("n"))


def common_cjk(counts: DataFrame) -> DataFrame:
    """(ch) of the corpus's common CJK characters: the most frequent ones that together
    make up ``COMMON_CJK_TENTHS`` tenths of all occurrences. However large the corpus, its
    clean texts stay common; nothing is collected."""
    per = counts.groupBy("ch").agg(F.sum("n").alias("n"))
    # one row per character: bounded by the script, not by the corpus
    w = Window.orderBy(F.desc("n"), "ch").rowsBetween(Window.unboundedPreceding, -1)
    ranked = per.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0))).withColumn("total", F.sum("n").over(Window.partitionBy()))
    return ranked.filter(F.col("before") * 10 < F.col("total") * COMMON_CJK_TENTHS).select("ch")


def noise_scores(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "source", "lang"),
                 cjk_common: DataFrame | None = None) -> DataFrame:
    """G1-G4, G9-G12 per document plus their sum ``mess``. The rare-CJK measure's
    common characters (column ``ch``) come from the corpus itself unless given."""
    t = F.col(text)
    per_text = docs.select(*[F.col(k) for k in keep], *[fn(t).alias(name) for name, fn in MEASURES.items() if name not in _BY_TABLE])
    # G11 works per word, G12 per character: as rows, summed back per document, joined on
    # the key (both sides hold one small row per document, no text)
    ww = weird_word_table(docs, text, keep[0])
    counts = cut_lineage(cjk_counts(docs, text, keep[0]))
    common = (common_cjk(counts) if cjk_common is None else cjk_common.select("ch").distinct()).withColumn("common", F.lit(True))
    cjk = counts.join(common, "ch", "left").groupBy(keep[0]).agg(F.sum("n").alias("_cjk"), F.sum(F.when(F.col("common").isNull(), F.col("n")).otherwise(0)).alias("_rare"))
    out = per_text.join(ww, keep[0], "left").join(cjk, keep[0], "left") \
                  .withColumn("weird_word_noise", F.coalesce(F.col("weird_word_noise"), F.lit(0.0))) \
                  .withColumn("rare_cjk_noise", rare_cjk_noise(F.col("_rare"), F.col("_cjk"))) \
                  .select(*keep, *MEASURES)
    mess = sum((F.col(n) for n in MEASURES), F.lit(0.0))
    return out.withColumn("mess", mess)


def noise_report(docs: DataFrame, by: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """Documents, mean mess and share of documents above 0.2, per group."""
    s = noise_scores(docs)
    return s.groupBy(*by).agg(
        F.count(F.lit(1)).alias("docs"),
        F.avg("mess").alias("mean_mess"),
        (F.avg((F.col("mess") > MESS_THRESHOLD).cast("double")) * 100).alias("noisy_pct"))


def letters(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "lang")) -> DataFrame:
    """One row per letter occurrence (lower case), whole text."""
    only = F.regexp_replace(F.lower(F.col(text)), "[^\\p{L}]", "")
    return docs.select(*keep, F.explode(F.split(only, "")).alias("letter")).filter(F.col("letter") != "")


def letter_profile(docs: DataFrame, top: int | None = None) -> DataFrame:
    """Letters ranked by frequency per language (ties by letter)."""
    counts = letters(docs, keep=("lang",)).groupBy("lang", "letter").agg(F.count(F.lit(1)).alias("n"))
    # one row per (language, letter): bounded by the alphabet, not by the corpus
    w = Window.partitionBy("lang").orderBy(F.desc("n"), "letter")
    out = counts.withColumn("rank", F.row_number().over(w))
    return out.filter(F.col("rank") <= top) if top else out


def language_coherence(docs: DataFrame, max_shift: int = 4) -> DataFrame:
    """Score each document against each language profile: share of the
    document's letters whose rank differs by at most ``max_shift`` from the
    language's rank (our definition); scores >= 0.1 kept, best first per document.
    Documents with 32 letters or fewer are skipped. The texts are read once: letters
    per document are counted, and the profiles are sums of these counts."""
    # (language, document, letter) counts, read by the profiles and the documents
    counts = cut_lineage(letters(docs, keep=("lang", "doc_id")).groupBy("lang", "doc_id", "letter")
                         .agg(F.count(F.lit(1)).alias("n")))
    by_lang = Window.partitionBy("lang").orderBy(F.desc("n"), "letter")
    profile = counts.groupBy("lang", "letter").agg(F.sum("n").alias("n")) \
        .select(F.col("lang").alias("profile_lang"), "letter", F.row_number().over(by_lang).alias("p_rank"))
    per_doc = counts.groupBy("doc_id", "letter").agg(F.sum("n").alias("n"))
    tot = per_doc.groupBy("doc_id").agg(F.sum("n").alias("n_letters"))
    # per-document window: one row per distinct letter of the document
    w = Window.partitionBy("doc_id").orderBy(F.desc("n"), "letter")
    ranked = per_doc.withColumn("d_rank", F.row_number().over(w))
    ranked = ranked.join(tot, "doc_id").filter(F.col("n_letters") > COHERENCE_MIN_LETTERS)
    n_top = ranked.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_top"))
    j = ranked.join(profile, "letter")
    close = (F.abs(F.col("d_rank") - F.col("p_rank")) <= max_shift).cast("int")
    score = j.groupBy("doc_id", "profile_lang").agg(F.sum(close).alias("hits")) \
             .join(n_top, "doc_id") \
             .select("doc_id", F.col("profile_lang").alias("lang"),
                     (F.col("hits") / F.col("n_top")).alias("score"))
    score = score.filter(F.col("score") >= COHERENCE_MIN)
    best = Window.partitionBy("doc_id").orderBy(F.desc("score"), "lang")
    return score.withColumn("rank", F.row_number().over(best))


def coherence_accuracy(docs: DataFrame) -> DataFrame:
    """G7 summary: how often the best-scoring profile equals the labelled language."""
    best = language_coherence(docs).filter(F.col("rank") == 1) \
        .select("doc_id", F.col("lang").alias("predicted"))
    j = docs.select("doc_id", "lang").join(best, "doc_id")
    return j.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"),
                                 F.avg((F.col("lang") == F.col("predicted")).cast("double")).alias("accuracy"))


def utf8_audit(df: DataFrame, bytes_col: str, by: str) -> DataFrame:
    """Valid / repaired / rejected byte strings per group (rejected = not valid
    and still unreadable after repair)."""
    b = F.col(bytes_col)
    valid = F.is_valid_utf8(b)
    repaired = F.make_valid_utf8(b)
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(valid.cast("int")).alias("valid"),
        F.sum((~valid & repaired.isNotNull()).cast("int")).alias("repaired"),
        F.sum((~valid & repaired.isNull()).cast("int")).alias("rejected"))
