"""URL filter: a sorted array of 64-bit digests, memory-mapped and probed by binary search.

A rule is a host and a path (``example.com/en/``). It fits a url if the url's host is the rule's
host or a subdomain of it and the url's path starts with the rule's path; the longest fitting rule
decides. The keys of all rules are hashed with xxhash64 into one sorted array. For a url, every
host suffix is paired with every path prefix whose length some rule has; all these candidates of a
batch are hashed and looked up in the array by one vectorised binary search per path length, and
every hit is confirmed against the stored rule text, so a collision of digests decides nothing.

The array is a file that Spark ships to each executor (``SparkContext.addFile``) and that workers
map into memory, so its pages are shared and read on demand. Rules are configuration: the driver
holds them, pages are never gathered anywhere. One pass over the pages, no shuffle.

Defined cases: a null url, or one without ``://``, has an empty host and path and fits no rule;
without a fitting rule the verdict is that of the method: ``allow``, as the url isn't in the
array. Among fitting rules of one length the one with the longer host wins. Rows are judged one by
one, so repeated rows repeat and an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import prepare, table

#: The rules of the query: (verdict, rule).
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)

_RECORD = np.dtype([("key", "<u8"), ("at", "<u8"), ("size", "<u4"), ("block", "<u4")])


def write_index(rules: Iterable[tuple[str, str]], folder: str, name: str) -> list[str]:
    """Two files: the records sorted by digest, and the rule texts they point into. The lengths
    that rule paths have are the last records' companion, kept in the text file's head."""
    rules = {rule: verdict for verdict, rule in rules}
    texts, records, lengths = [], [], set()
    at = 0
    for rule, verdict in rules.items():
        if "/" not in rule or verdict not in ("allow", "block"):
            raise ValueError(f"not a rule: {verdict} {rule}")
        raw = rule.encode()
        records.append((xxhash.xxh64_intdigest(raw), at, len(raw), verdict == "block"))
        lengths.add(len(raw) - raw.index(b"/"))
        texts.append(raw)
        at += len(raw)
    out = np.sort(np.array(records, _RECORD), order=["key", "at"])
    paths = [os.path.join(folder, f"{name}.{x}") for x in ("digests", "texts", "lengths")]
    out.tofile(paths[0])
    with open(paths[1], "wb") as f:
        f.write(b"".join(texts))
    np.array(sorted(lengths), np.int64).tofile(paths[2])
    return paths


class RuleIndex:
    """The mapped files, and lookups of many candidates at once."""

    def __init__(self, digests: str, texts: str, lengths: str):
        size = os.path.getsize(digests)
        self.records = np.memmap(digests, _RECORD, "r") if size else np.zeros(0, _RECORD)
        self.keys = self.records["key"]
        self.texts = np.memmap(texts, np.uint8, "r") if os.path.getsize(texts) else np.zeros(0, np.uint8)
        self.lengths = np.fromfile(lengths, np.int64).tolist()

    def find(self, candidates: list[bytes]) -> list[tuple[str, str] | None]:
        """(rule, verdict) of each candidate that is a rule, else None."""
        out: list[tuple[str, str] | None] = [None] * len(candidates)
        if not len(self.keys):
            return out
        hashes = np.fromiter((xxhash.xxh64_intdigest(c) for c in candidates), np.uint64, len(candidates))
        first = np.searchsorted(self.keys, hashes)
        last = np.searchsorted(self.keys, hashes, "right")
        for i in np.flatnonzero(first < last):
            for k in range(first[i], last[i]):  # more than one record only if digests collide
                r = self.records[k]
                text = self.texts[int(r["at"]):int(r["at"]) + int(r["size"])].tobytes()
                if text == candidates[i]:
                    out[i] = (text.decode(), "block" if r["block"] else "allow")
        return out

    def judge(self, hosts: list[str], paths: list[str]) -> list[tuple[str, str] | None]:
        """The longest fitting rule of each (host, path)."""
        owner, candidates = [], []
        for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
            if not host:
                continue
            h, p = host.encode(), path.encode()
            suffixes = [h]
            dot = h.find(b".")
            while dot >= 0:
                suffixes.append(h[dot + 1:])
                dot = h.find(b".", dot + 1)
            for n in self.lengths:
                if n <= len(p):
                    for s in suffixes:
                        if s:
                            owner.append(i)
                            candidates.append(s + p[:n])
        best: list[tuple[str, str] | None] = [None] * len(hosts)
        order: dict[int, tuple[int, int]] = {}
        for i, c, hit in zip(owner, candidates, self.find(candidates), strict=True):
            if hit:
                rank = (len(c), c.index(b"/"))
                if i not in order or rank > order[i]:
                    order[i], best[i] = rank, hit
        return best


_OPEN: dict[str, RuleIndex] = {}


def url_parts(url: str = "url") -> tuple:
    """Host and path columns of a url column."""
    u = F.coalesce(F.col(url), F.lit(""))
    rest = F.when(F.instr(u, "://") > 0, F.expr(f"substring(coalesce(`{url}`, ''), instr(coalesce(`{url}`, ''), '://') + 3)")).otherwise("")
    raw = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    host = F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)", 1)
    return host, path


def filter_urls(df: DataFrame, rules: Iterable[tuple[str, str]], id_column: str = "page_id", url: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict) of every row of ``df``."""
    spark = prepare(df.sparkSession)
    sc = spark.sparkContext
    rules = sorted((rule, verdict) for verdict, rule in rules)
    name = f"rules-{xxhash.xxh64_hexdigest(repr(rules).encode())}"
    if f"{name}.digests" not in _SENT.get(sc.applicationId, set()):
        for p in write_index([(v, r) for r, v in rules], tempfile.mkdtemp(prefix="martlet-rules-"), name):
            sc.addFile(p)
            _SENT.setdefault(sc.applicationId, set()).add(os.path.basename(p))
    host, path = url_parts(url)
    parts = df.select(F.col(id_column), host.alias("host"), path.alias("path"))
    schema = T.StructType([*parts.schema.fields, T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])

    def run(batches):
        index = _OPEN.get(name)
        if index is None:
            index = _OPEN[name] = RuleIndex(*(SparkFiles.get(f"{name}.{x}") for x in ("digests", "texts", "lengths")))
        for b in batches:
            got = index.judge(b.column(1).to_pylist(), b.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([g and g[0] for g in got], pa.string()), pa.array([g[1] if g else "allow" for g in got], pa.string())],
                names=[*b.schema.names, "rule", "verdict"])

    return parts.mapInArrow(run, schema)


_SENT: dict[str, set[str]] = {}


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, deciding rule and verdict of every page."""
    return filter_urls(table(spark, sf_dir, "pages"), RULES)


QUERIES = {"op5_url_filter": op5_url_filter}
ORACLE = {"op5_url_filter": """
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages
), parts AS (
  SELECT page_id,
         translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '(?s)^[^/?#]*(/[^?#]*)', 1) AS path
  FROM rest
), rules(verdict, rule, rhost, rpath) AS (VALUES
  ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
  ('allow', 'www.example.com/en/', 'www.example.com', '/en/'),
  ('block', 'net/es/', 'net', '/es/'), ('block', 'net/fr/', 'net', '/fr/')
), fits AS (
  SELECT page_id, host, path, rule, verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC, length(rhost) DESC) AS k
  FROM parts LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE k = 1
"""}
