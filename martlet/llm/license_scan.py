"""Licence scan: digests of canonical texts, hash-joined to the digests of known licences.

A text is made canonical - lower case, comment signs, copyright lines and title lines at its head
dropped, punctuation and layout reduced to single blanks, equivalent spellings and the places of
names made one - and the SHA-256 of the result is looked up among the digests of the known licence
texts, which go through the very same expressions. Two units are looked up: the whole document, and
each of its lines as a text of its own (notices stand on a line amid other text). No spelling changes
the first characters of a word, so a unit that begins like no known text needs no digest: its first
characters are part of the key. Everything is DataFrame expressions and one join on the digest; the
side of the known licences has as many rows as the fixed list below and the files in ``licenses``
(whole texts, some 170 KB, read by the driver; only their digests go into the join).

Defined cases: a null or empty text, or one of nothing but copyright lines and punctuation, is no
licence; repeated rows of one id count as one document with all their lines; a table without rows
gives none. Other columns of the table are ignored.
"""

from __future__ import annotations

from functools import reduce
from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import prepare, table

#: Spellings that count as the same in licence texts (from, to). Blanks matter.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"),
    ("capitalisations", "capitalizations"), ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"),
    ("emphasised", "emphasized"), ("favour", "favor"), ("fulfilment", "fulfillment"), ("initialise", "initialize"),
    ("judgement", "judgment"), ("labelling", "labeling"), ("labour", "labor"), ("licence", "license"), ("maximise", "maximize"),
    ("modelled", "modeled"), ("modelling", "modeling"), ("offence", "offense"), ("optimise", "optimize"),
    ("organisation", "organization"), ("organise", "organize"), ("practise", "practice"), ("programme", "program"),
    ("realise", "realize"), ("recognise", "recognize"), ("signalling", "signaling"), ("sub license", "sublicense"),
    ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"), ("non commercial", "noncommercial"),
    ("per cent", "percent"), ("copyright holder", "copyright owner"), ("https", "http"),
)

#: Licence name and text of the known licences.
KNOWN = (
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES
OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR
IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
)

#: Copyright lines: a whole line that begins with the word or its sign.
COPYRIGHT_LINE = r"(?m)^[ \t]*(copyright|\(c\)|©|all rights reserved)[^\n]*$"
#: The same behind comment signs, and without lines that a layout lets begin with the word or sign
#: ("copyright notice", "(c) You must").
COPYRIGHT_START = (
    r"^[\s/#*;%!\"'.<>|:=~+_\-{\[\\]*(?:\(\*+\s*)?(?:(?:rem|dnl)\b[\s/#*;%!\"'.<>|:=~+_\-{\[\\]*)?(?:"
    r"copyright(?!ed|able|[\"'”’])(?!\s+(?:notices?|holders?|owners?|licen[cs]es?|law|laws|statement|treaty|interest|disclaimer|and|or|in|on|to|of)\b)"
    r"|\(c\)(?!\s+(?:you|under)\b(?!.*\d{4}))|©|all rights reserved|spdx-filecopyrighttext)")
#: Comment signs that are words, and title lines of licences, as plain lines.
COMMENT_WORDS = ("rem ", "dnl ")
TITLES = tuple(t.replace("license", word) for word in ("license", "licence") for t in (
    "license", "mit license", "the mit license", "mit license mit", "the mit license mit", "expat license",
    "isc license", "the isc license", "isc license isc", "the isc license isc",
    "bsd license", "the bsd license", "new bsd license", "modified bsd license", "revised bsd license", "simplified bsd license",
    "freebsd license", "bsd 2 clause license", "bsd 3 clause license", "the bsd 2 clause license", "the bsd 3 clause license",
    "bsd 2 clause simplified license", "bsd 3 clause new or revised license",
    "bsd 2 clause", "bsd 3 clause", "the 2 clause bsd license", "the 3 clause bsd license", "2 clause bsd license", "3 clause bsd license",
    "apache license", "apache license 2 0", "apache license version 2 0", "apache license version 2 0 january 2004", "version 2 0 january 2004",
    "http www apache org licenses", "https www apache org licenses",
    "gnu general public license", "gnu general public license version 2", "gnu general public license version 3", "version 2 june 1991",
    "version 3 29 june 2007", "gnu lesser general public license", "gnu lesser general public license version 2 1",
    "gnu lesser general public license version 3", "version 2 1 february 1999",
    "mozilla public license version 2 0", "mozilla public license version 1 1", "mozilla public license", "version 2 0", "version 1 1",
    "creative commons legal code", "cc0 1 0 universal", "creative commons cc0 1 0 universal",
    "creative commons attribution sharealike 4 0 international", "attribution sharealike 4 0 international"))
#: List marks and places of names in whole texts (pattern, replacement).
PLACES = (
    (r"\b[12] (redistributions (?:of source|in binary))", "$1"), (r"\b3 (neither the names? of)", "$1"),
    (r"neither the names? of .{1,120}? nor the names of (?:its|their|the|any) contributors", "neither the name of the owner nor the names of its contributors"),
    (r"\bprovided by .{1,80}? as is\b", "provided by the owner as is"), (r"\bin no event shall .{1,100}? be liable\b", "in no event shall the owner be liable"),
)
#: Punctuation and white space; letters and digits of any script stay.
LAYOUT = "[\\x00-/:-@\\[-`{-\\x7F «»‐-―‘-‟…  ]+"
#: No spelling above changes the first characters of what it replaces, so these are a key too.
KEY = 3
#: Characters without which no unit is one of the known texts of twice as many (spellings change less).
LONG = 100


def whole_texts() -> list[tuple[str, str]]:
    """(licence, text) of the files in ``licenses``; those with an appendix also without it."""
    out = []
    for f in sorted((files(__package__) / "licenses").iterdir(), key=lambda f: f.name):
        name, text = f.name.removesuffix(".txt"), f.read_text("utf-8")
        head, end, _ = text.partition("END OF TERMS AND CONDITIONS")
        out += [(name, text), *([(name, head), (name, head + end)] if end else [])]
    return out


def plain_lines(text: Column) -> Column:
    """The lines of a text in lower case, without comment signs, copyright lines, punctuation and
    layout; lines of which nothing is left are dropped. Joined by a blank they are the plain text."""
    def plain(line: Column) -> Column:
        low = F.lower(line)
        return F.when(low.rlike(COPYRIGHT_START), "").otherwise(
            F.trim(F.regexp_replace(F.replace(low, F.lit("&"), F.lit(" and ")), LAYOUT, " ")))

    def uncommented(x: Column) -> Column:
        return F.when(reduce(lambda a, b: a | b, [x.startswith(w) | (x == w.strip()) for w in COMMENT_WORDS]), F.substring(x, 5, 1 << 30)).otherwise(x)

    return F.filter(F.transform(F.transform(F.split(text, "\n", -1), plain), uncommented), lambda x: x != "")


def plain_text(lines: Column) -> Column:
    """The plain text of plain lines, without title lines at its head (if there is anything else)."""
    first = F.array_position(F.transform(lines, lambda x: ~x.isin(*TITLES)), True)
    return F.array_join(F.slice(lines, F.greatest(first, F.lit(1)).cast("int"), F.greatest(F.size(lines), F.lit(1))), " ")


def digest(plain: Column) -> Column:
    """SHA-256 of a plain text in one spelling and with one name in its places, null if it is empty."""
    one = reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), SPELLINGS, plain)
    one = reduce(lambda c, pair: F.regexp_replace(c, *pair), PLACES, one)
    return F.when(plain != "", F.sha2(one, 256))


def known_digests(spark: SparkSession) -> DataFrame:
    """(digest, key: first characters, long: whether of 2 * LONG characters, license) of the known
    texts: one row per text."""
    fixed = F.array(*[F.struct(F.lit(n).alias("license"), F.lit(t).alias("known")) for n, t in (*KNOWN, *whole_texts())])
    rows = spark.range(1).select(F.explode(fixed).alias("k")).select("k.*")
    plain = plain_text(plain_lines(F.col("known")))
    return rows.select(digest(plain).alias("digest"), F.substring(plain, 1, KEY).alias("key"), (F.length(plain) >= 2 * LONG).alias("long"),
                       "license").distinct()


def scan_licenses(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: (id, text_license: licence that the whole text is, n_license_lines: lines that
    are a licence or notice, line_licenses: their names, sorted)."""
    fixed = known_digests(prepare(df.sparkSession)).collect()  # of the fixed list
    known = df.sparkSession.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(r.digest).alias("digest"), F.lit(r.license).alias("license")) for r in fixed])).alias("k")).select("k.*")
    short, long = (sorted({r.key for r in fixed if r.long == kind}) for kind in (False, True))

    def begins(u: Column) -> Column:
        key = F.substring(u, 1, KEY)
        return key.isin(*short) | (key.isin(*long) & (F.length(u) >= LONG))

    docs = df.select(F.col(id_column).alias("id"), plain_lines(F.coalesce(F.col(text), F.lit(""))).alias("lines"))
    # the text itself, and those of its lines that begin like a known text
    units = docs.select("id", F.explode(F.concat(
        F.array(F.struct(F.lit(True).alias("whole"), plain_text(F.col("lines")).alias("u"))),
        F.transform(F.filter("lines", begins), lambda x: F.struct(F.lit(False).alias("whole"), x.alias("u"))))).alias("x"))
    found = F.when(begins(F.col("x.u")), digest(F.col("x.u")))
    hits = (units.select("id", "x.whole", found.alias("digest"))
            .join(F.broadcast(known), "digest", "left"))  # as many rows as known texts
    one = F.when(F.col("whole"), F.col("license"))
    line = F.when(~F.col("whole"), F.col("license"))
    return hits.groupBy(F.col("id").alias(id_column)).agg(
        F.max(one).alias("text_license"),
        F.count(line).alias("n_license_lines"),
        F.array_join(F.array_sort(F.collect_set(line)), ",").alias("line_licenses"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every document: as its whole text, and on its lines."""
    return scan_licenses(table(spark, sf_dir, "documents"))


def _sql_literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql_canonical(text: str) -> str:
    layout = "[\\x00-/:-@\\[-`{-\\x7F «»‐-―‘-‟…  ]+"
    kept = f"regexp_replace(lower({text}), {_sql_literal(COPYRIGHT_LINE)}, '', 'g')"
    plain = f"trim(regexp_replace(replace({kept}, '&', ' and '), {_sql_literal(layout)}, ' ', 'g'))"
    return reduce(lambda c, pair: f"replace({c}, {_sql_literal(pair[0])}, {_sql_literal(pair[1])})", SPELLINGS, plain)


QUERIES = {"op3_license_scan": op3_license_scan}
ORACLE = {"op3_license_scan": f"""
WITH known AS (
  SELECT DISTINCT license, {_sql_canonical('known')} AS c
  FROM (VALUES {', '.join(f'({_sql_literal(n)}, {_sql_literal(t)})' for n, t in KNOWN)}) AS k(license, known)
), units AS (
  SELECT doc_id, true AS whole, coalesce(text, '') AS u FROM documents
  UNION ALL
  SELECT doc_id, false, unnest(string_split(coalesce(text, ''), chr(10))) FROM documents
), plain AS (SELECT doc_id, whole, {_sql_canonical('u')} AS c FROM units),
hits AS (SELECT doc_id, whole, license FROM plain LEFT JOIN known ON plain.c = known.c AND plain.c <> '')
SELECT doc_id, max(license) FILTER (WHERE whole) AS text_license,
       count(license) FILTER (WHERE NOT whole) AS n_license_lines,
       coalesce(string_agg(DISTINCT license, ',' ORDER BY license) FILTER (WHERE NOT whole), '') AS line_licenses
FROM hits GROUP BY doc_id
"""}
