"""Token counts that follow edits without encoding whole texts again.

A text's pre-tokens (the pieces the byte-level BPE works in) are the leaves of a segment tree; every
node holds the characters and the tokens below it. An edit replaces characters of the text. Going
down the tree by character sums finds the leaves it touches; from the first pre-token that the
change can affect, the pattern runs on over the new text until a border falls on a border of the
old text again, and only what lies between is encoded. The leaves are spliced and the sums of the
touched subtrees updated; the root then holds the new count.

Trees live in ordinary columns (``pieces``: per leaf its characters and tokens), so they can be
written with the documents and met by later edits. Documents are independent rows: one Arrow pass,
no shuffle; edits that come as a table are first gathered per document.

The pattern never looks back and at most two characters ahead (the last blank before a word, an
apostrophe's ending), so a pre-token depends on its own characters and the next two only: this is
what bounds the boundary context.

Defined cases: a null or empty text has no leaves and no tokens; null edits are none; edits refer to
the text as it is when they are applied, one after the other, and are cut to its ends; a null
replacement deletes; rows are independent, so repeated rows repeat; an empty table gives an empty
table.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import prepare, table

#: Pre-tokens below one leaf of the stored tree, pre-tokens kept in a worker's table of counts, and
#: the longest one that is kept.
LEAF, KEEP, KEEP_LENGTH = 32, 200_000, 40
EDITS = "array<struct<start:int,end:int,replacement:string>>"


class Counter:
    """Pre-tokens of a text and their token counts, for one rank file and pattern."""

    def __init__(self, rank_file: str, pattern: str):
        import regex
        import tiktoken

        with open(rank_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.known: dict[str, int] = {}
        self.encoded = 0  # pre-tokens counted so far, for reports

    def count(self, pieces: list[str]) -> list[int]:
        self.encoded += len(pieces)
        out = list(map(self.known.get, pieces))
        if None in out:
            new = {p for p, n in zip(pieces, out) if n is None}
            if len(self.known) > KEEP:
                self.known.clear()
            got = {p: len(self.encoding.encode_ordinary(p)) for p in new}
            self.known.update((p, n) for p, n in got.items() if len(p) <= KEEP_LENGTH)
            out = [got[p] if n is None else n for p, n in zip(pieces, out)]
        return out


class Tree:
    """Segment tree over blocks of pre-tokens: ``sums[k]`` has the (characters, tokens) of the nodes
    of level k, level 0 being the blocks and the last level the root."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.chars, self.tokens = chars, tokens
        self._levels()

    def _levels(self) -> None:
        if not len(self.chars):
            self.sums = [np.zeros((1, 2), np.int64)]
            return
        at = np.arange(0, len(self.chars), LEAF)
        self.sums = [np.stack([np.add.reduceat(self.chars, at), np.add.reduceat(self.tokens, at)], axis=1)]
        while len(self.sums[-1]) > 1:
            below = self.sums[-1]
            self.sums.append(np.add.reduceat(below, np.arange(0, len(below), 2), axis=0))

    @property
    def total(self) -> tuple[int, int]:
        c, t = self.sums[-1][0]
        return int(c), int(t)

    def locate(self, char: int) -> tuple[int, int]:
        """(pre-token, its first character) of the pre-token that holds the character, going down
        from the root; the end of the text belongs to one past the last."""
        if char >= self.total[0]:
            return len(self.chars), self.total[0]
        node, begin = 0, 0
        for level in self.sums[-2::-1]:
            node *= 2
            if char >= begin + level[node][0]:
                begin += int(level[node][0])
                node += 1
        first = node * LEAF
        ends = begin + np.cumsum(self.chars[first:first + LEAF])
        k = int(np.searchsorted(ends, char, "right"))
        return first + k, int(ends[k] - self.chars[first + k])

    def splice(self, lo: int, hi: int, chars: Iterable[int], tokens: Iterable[int]) -> None:
        """Replace the pre-tokens lo:hi. With as many as before, the sums above them are corrected
        on their paths to the root; otherwise blocks behind them move and their sums are made anew
        from the counts, without encoding anything."""
        c, t = np.array(list(chars), np.int64), np.array(list(tokens), np.int64)
        if len(c) == hi - lo:
            change = np.stack([c - self.chars[lo:hi], t - self.tokens[lo:hi]], axis=1)
            self.chars[lo:hi], self.tokens[lo:hi] = c, t
            at = np.arange(lo, hi) // LEAF
            for level in self.sums:
                np.add.at(level, at, change)
                at = at // 2
            return
        self.chars = np.concatenate([self.chars[:lo], c, self.chars[hi:]])
        self.tokens = np.concatenate([self.tokens[:lo], t, self.tokens[hi:]])
        self._levels()


def build(counter: Counter, text: str) -> Tree:
    pieces = counter.pattern.findall(text)
    return Tree(np.fromiter(map(len, pieces), np.int64, len(pieces)), np.array(counter.count(pieces), np.int64))


def edit(counter: Counter, tree: Tree, text: str, start: int, end: int, replacement: str) -> str:
    """Apply one edit to the text and its tree; returns the new text."""
    start = min(max(start, 0), len(text))
    end = min(max(end, start), len(text))
    if start == end and not replacement:
        return text
    new = text[:start] + replacement + text[end:]
    # a pre-token that ends two characters before ``start`` saw nothing of the change
    first, begin = tree.locate(max(start - 2, 0)) if len(tree.chars) else (0, 0)
    shift = len(new) - len(text)
    old, border = tree.locate(end) if end < len(text) else (len(tree.chars), len(text))
    if border < end:  # the first old border at or behind the edit's end
        border += int(tree.chars[old])
        old += 1
    pieces, at = [], begin
    while at < len(new):
        while border + shift < at and old < len(tree.chars):
            border += int(tree.chars[old])
            old += 1
        if border + shift == at and at >= start + len(replacement):
            break
        m = counter.pattern.match(new, at)
        pieces.append(m[0])
        at = m.end()
    else:
        old = len(tree.chars)
    tree.splice(first, old, map(len, pieces), counter.count(pieces))
    return new


_COUNTERS: dict[tuple[str, str], Counter] = {}


def _counter(rank_file: str, pattern: str) -> Counter:
    key = (rank_file, pattern)
    if key not in _COUNTERS:
        _COUNTERS[key] = Counter(*key)
    return _COUNTERS[key]


def default_tokenizer() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def _run(df: DataFrame, schema: str, names: list[str], row, tokenizer: tuple[str, str]) -> DataFrame:
    """Rows through ``row(counter, *values)``, which gives the columns after the first."""
    prepare(df.sparkSession)

    def run(batches):
        counter = _counter(*tokenizer)
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                part = b.slice(lo, 64)
                got = [row(counter, *(c[i].as_py() for c in part.columns[1:])) for i in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x, t) for x, t in zip(zip(*got), kinds))], names=names)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    kinds = [f.type for f in to_arrow_schema(_parse_datatype_string(schema))][1:]
    return df.mapInArrow(run, schema)


def build_trees(df: DataFrame, id_column: str = "doc_id", text: str = "text", tokenizer: tuple[str, str] | None = None) -> DataFrame:
    """(id, text, pieces: the leaves' characters and tokens, n_tokens) of every text."""
    kind = df.schema[id_column].dataType.simpleString()

    def row(counter, t):
        tree = build(counter, t or "")
        return t, [{"chars": int(c), "tokens": int(n)} for c, n in zip(tree.chars, tree.tokens)], tree.total[1]

    return _run(df.select(id_column, text), f"{id_column} {kind}, text string, pieces array<struct<chars:int,tokens:int>>, n_tokens bigint",
                [id_column, "text", "pieces", "n_tokens"], row, tokenizer or default_tokenizer())


def apply_edits(trees: DataFrame, edits: DataFrame, id_column: str = "doc_id", tokenizer: tuple[str, str] | None = None) -> DataFrame:
    """Trees after the edits of a table (id, seq, start, end, replacement), in the order of seq."""
    one = F.struct("seq", F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"), "replacement")
    per = edits.groupBy(F.col(id_column).alias("__id")).agg(F.array_sort(F.collect_list(one)).alias("__edits"))
    rows = trees.join(per, trees[id_column] == per["__id"], "left").select(id_column, "text", "pieces", "__edits")
    kind = trees.schema[id_column].dataType.simpleString()

    def row(counter, t, pieces, todo):
        tree = Tree(np.array([p["chars"] for p in pieces or []], np.int64), np.array([p["tokens"] for p in pieces or []], np.int64))
        t = t or ""
        for e in todo or []:
            t = edit(counter, tree, t, e["start"], e["end"], e["replacement"] or "")
        return t, [{"chars": int(c), "tokens": int(n)} for c, n in zip(tree.chars, tree.tokens)], tree.total[1]

    return _run(rows, f"{id_column} {kind}, text string, pieces array<struct<chars:int,tokens:int>>, n_tokens bigint",
                [id_column, "text", "pieces", "n_tokens"], row, tokenizer or default_tokenizer())


def count_with_edits(df: DataFrame, edits: Column, id_column: str = "doc_id", text: str = "text",
                     tokenizer: tuple[str, str] | None = None) -> DataFrame:
    """(id, n_pretokens, n_tokens, n_edits, n_tokens_after, n_encoded_again): the tree of every text
    is built and a column of edits applied to it, without storing the trees."""
    kind = df.schema[id_column].dataType.simpleString()
    rows = df.select(F.col(id_column), F.col(text).alias("text"), edits.cast(EDITS).alias("edits"))

    def row(counter, t, todo):
        t = t or ""
        tree = build(counter, t)
        before, size, seen = tree.total[1], len(tree.chars), counter.encoded
        todo = [e for e in todo or [] if e]
        for e in todo:
            t = edit(counter, tree, t, e["start"] or 0, e["end"] or 0, e["replacement"] or "")
        return size, before, len(todo), tree.total[1], counter.encoded - seen

    return _run(rows, f"{id_column} {kind}, n_pretokens bigint, n_tokens bigint, n_edits int, n_tokens_after bigint, n_encoded_again bigint",
                [id_column, "n_pretokens", "n_tokens", "n_edits", "n_tokens_after", "n_encoded_again"], row, tokenizer or default_tokenizer())


def cleaning_edits(text: str = "text") -> Column:
    """The edits of a small cleaning step, from each text itself: its first word is put before its
    last character, the middle third's first ten characters go, and its first line feed becomes a
    blank line. Later edits stand first in the text, so offsets of the given text stay right."""
    n = F.length(F.coalesce(F.col(text), F.lit("")))
    word = F.regexp_extract(F.coalesce(F.col(text), F.lit("")), r"^(\S{1,40})", 1)
    feed = F.locate("\n", F.col(text))
    third = F.floor(n / 3).cast("int")
    tail = F.struct(F.greatest(n - 1, F.lit(0)).alias("start"), F.greatest(n - 1, F.lit(0)).alias("end"), word.alias("replacement"))
    drop = F.struct(third.alias("start"), F.least(third + 10, n).alias("end"), F.lit("").alias("replacement"))
    line = F.struct((feed - 1).alias("start"), feed.alias("end"), F.lit("\n\n").alias("replacement"))
    early = F.when((feed > 0) & (feed - 1 < third), F.array(tail, drop, line))
    return F.when(n > 0, F.coalesce(early, F.array(tail, drop)))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after its cleaning edits."""
    return count_with_edits(table(spark, sf_dir, "documents"), cleaning_edits())


QUERIES = {"op2_token_counts": op2_token_counts}
ORACLE: dict[str, str] = {}
