"""Grouping of spelling variants by permuterm rotations.

A word is closed by a terminator and rotated: ``cat`` gives ``cat$``, ``at$c``, ``t$ca``, ``$cat``.
In the rotation that begins behind a character, that character stands last, so all words that share
the rest are one prefix range of the sorted rotations. Two words that differ by one replaced
character thus meet in the range of the rotation that skips it; a word with one character more meets
the other one where its rotation without the last character is the whole of the other's. Sorted by
that prefix, every range is scanned once: its words are neighbours.

A range is named by all characters of the words but one. It holds at most one word per character
that can stand there, and the one word without it: 91 members for the letters used here, whatever
the number of words. A pair meets in exactly one range: one place for a replacement, and for an
insertion the first place of a row of equal characters. So each range yields one row per member,
with the number of its neighbours there and the most frequent of them, and no pairs are written.

Words are counted per document and task first, so a very frequent word is a few rows. Words that
occur once leave after the count. What is shuffled then is the rotations of the distinct words.

From a word its form (a much more frequent neighbour) leads on to the form's form; frequencies grow
by ``factor`` each time, and the way to the last one is halved in every round of joins.

Defined cases: null and empty texts hold no words; a null id counts as an empty one; repeated rows
are counted each; a word without neighbours is its own root; ties go to the word that is smallest in
code-point order; further columns are not looked at; an empty table gives an empty table. A text is
read whole by one task and needs memory for its distinct words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import cut, prepare, stored, table

#: Letters of a word (capitals A-Z are lower-cased first), and the sign that closes a rotation.
LETTERS, END = "a-zÀ-ÿ", "$"
#: Fewest characters and occurrences of a word, and how much more frequent a word's form is.
LONG, OFTEN, FACTOR = 7, 2, 10
#: Distinct words that a task counts before it hands them on.
_HELD = 200_000


def word_counts(df: DataFrame, id_column: str = "doc_id", text: str = "text", long: int = LONG,
                change: Callable[[str, str], str] | None = None) -> DataFrame:
    """(word, n) of all runs of letters with ``long`` characters or more, A-Z lower-cased.
    ``change`` (id, word) may give another word for it."""
    prepare(df.sparkSession)
    find = re.compile(f"[{LETTERS}]{{{long},}}").findall

    def run(batches):
        held: Counter = Counter()

        def handed():
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for b in batches:
            ids = b.column(0).to_pylist()
            for k, x in enumerate(b.column(1).cast(pa.large_binary())):
                if not x.is_valid:
                    continue
                found = Counter(find(x.as_py().lower().decode()))
                if change is None:
                    held.update(found)
                else:
                    for w, n in found.items():
                        w = change(ids[k], w)
                        if len(w) >= long:
                            held[w] += n
                if len(held) >= _HELD:
                    yield handed()
        if held:
            yield handed()

    rows = df.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, word, n, skips, first) of every rotation of every word: without its last character
    (``skips``; ``first`` unless the character before it is the same) and whole."""
    n = F.length("word")

    def turned(j, start):
        return F.concat(F.substring(F.col("word"), start, n), F.lit(END), F.substring(F.col("word"), F.lit(1), j))

    def char(j):
        return F.substring(F.col("word"), j, F.lit(1))

    skipping = F.transform(F.sequence(F.lit(0), n - 1), lambda j: F.struct(
        turned(j, j + 2).alias("prefix"), F.lit(True).alias("skips"), ((j == 0) | (char(j) != char(j + 1))).alias("first")))
    whole = F.transform(F.sequence(F.lit(0), n), lambda j: F.struct(turned(j, j + 1).alias("prefix"), F.lit(False).alias("skips"), F.lit(True).alias("first")))
    return words.select("word", "n", F.explode(F.concat(skipping, whole)).alias("r")).select("r.prefix", "word", "n", "r.skips", "r.first")


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, near: (less: minus its count, word)) of every word of ``words`` (word, n:
    distinct) with words that one inserted, deleted or replaced character away; ``near`` is the most
    frequent of them."""
    member = F.struct("word", "n", "skips", "first")
    ranges = (rotations(words).groupBy("prefix").agg(F.collect_list(member).alias("all"))  # 91 members at most
              .filter((F.size("all") > 1) & F.exists("all", lambda x: x["skips"])))

    def beside(x):
        return F.filter("all", lambda y: (y["word"] != x["word"]) & F.when(x["skips"] & y["skips"], F.lit(True))
                        .otherwise((x["skips"] != y["skips"]) & x["first"] & y["first"]))

    each = ranges.select(F.explode(F.transform("all", lambda x: F.struct(x["word"].alias("word"), beside(x).alias("near")))).alias("m"))
    best = F.array_min(F.transform("m.near", lambda y: F.struct((-y["n"]).alias("less"), y["word"].alias("word"))))
    return (each.filter(F.size("m.near") > 0).select("m.word", F.size("m.near").alias("c"), best.alias("near"))
            .groupBy("word").agg(F.sum("c").alias("n_near"), F.min("near").alias("near")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the words of ``forms`` (word, form), which holds no circle: the last word
    that forms lead to. Each round doubles the steps taken."""
    at = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("on"))
        new = stored(at.join(on, "root", "left").select("word", F.coalesce("on", "root").alias("root"), F.col("on").isNotNull().alias("moved")))
        at = new.select("word", "root")
        if new.filter("moved").isEmpty():
            return at


def spelling_groups(words: DataFrame, often: int = OFTEN, factor: int = FACTOR) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words (word, n: distinct) that occur ``often``
    times: ``form`` is the near word of largest count if that is ``factor`` times the word's own."""
    kept = cut(words.filter(F.col("n") >= often))
    near = neighbours(kept)
    judged = kept.join(near, "word", "left")
    is_form = -F.col("near.less") >= factor * F.col("n")
    table_ = stored(judged.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
                                  F.when(is_form, F.col("near.word")).alias("form"), F.when(is_form, -F.col("near.less")).alias("form_n")))
    root = roots(table_.filter("form IS NOT NULL"))
    return table_.join(root, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def with_lost_letter(doc_id: str, word: str) -> str:
    """The word that the query counts: where 31 divides h = crc32("<doc_id>:<word>"), character
    h % length is gone."""
    h = zlib.crc32(f"{doc_id}:{word}".encode())
    if h % 31:
        return word
    j = h % len(word)
    return word[:j] + word[j + 1:]


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its neighbours, form and root."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling_groups(word_counts(docs, change=with_lost_letter))


QUERIES = {"op13_spelling_variants": op13_spelling_variants}
ORACLE: dict[str, str] = {}
