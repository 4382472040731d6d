"""SentencePiece (merge-type) encoding and decoding with a prefix table.

For every prefix of a text, the encoding of that prefix ends in one unique token. The table of
these last tokens is filled from left to right: an automaton lists the pieces that end at a
position, and the one piece that is *compatible* with the last token of the prefix before it is
stored. The ids are then recovered backwards. Two tokens are compatible if no merge would join
across their border; this is decided from the merge trees of the two pieces.

No piece of the vocabulary continues past the end of a word into the next blank (checked when the
model is loaded), so a text is encoded word by word, and a bounded table keeps the ids of frequent
words. Work is one Arrow pass over the rows, without a shuffle.

Defined cases: a null text counts as empty; the empty text has the end id only (if asked for);
characters outside the vocabulary become byte tokens; rows are independent, so repeated rows and
extra columns pass through unchanged, and an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ._common import prepare, release, table

BLANK = "▁"
#: Words in each of the two halves of a worker's table of frequent words, and the longest word that
#: is kept. When the young half is full it becomes the old one, so words in use are never lost.
KEEP_WORDS, KEEP_LENGTH = 60_000, 48
#: Answers about pairs of pieces that a worker keeps.
KEEP_PAIRS = 100_000
#: Words that ``round_trip`` keeps (some 300 bytes each).
ROUND_TRIP_WORDS = 400_000
_NEVER = float("inf")


class PieceTable:
    """Vocabulary, merge trees, pair compatibility and the prefix table of one model."""

    def __init__(self, model_file: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = sp.get_piece_size()
        plain = [i for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.pieces = {i: sp.id_to_piece(i) for i in plain}
        self.ids = {p: i for i, p in self.pieces.items()}
        self.rank = {p: -sp.get_score(i) for i, p in self.pieces.items()}
        self.byte_id = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_of = {i: b for b, i in enumerate(self.byte_id)}
        self.end_id = sp.eos_id()
        self.length = {i: len(p) for i, p in self.pieces.items()}
        long_pieces = [p for p in self.ids if len(p) > 1]
        if any(BLANK in p.lstrip(BLANK) for p in long_pieces):
            raise ValueError("a piece of this model continues past a word's end")
        pairs = {p[k:k + 2] for p in long_pieces for k in range(len(p) - 1)}
        # blanks start a word; a letter run ends one where no piece joins a letter to what follows;
        # a line feed that no longer piece holds stands alone
        feed = "" if any("\n" in p for p in pairs) else "\n"
        letter, odd = "", {"_"}
        while odd:
            letter = rf"[^\W\d{letter[6:-1]}{''.join(map(re.escape, sorted(odd)))}]"
            odd = {p[0] for p in pairs if re.match(letter, p) and not re.match(letter, p[1])}
        other = rf"(?:(?!{letter})[^{BLANK}{feed}])"
        self.word = re.compile(f"{BLANK}*{other}*{letter}+|{BLANK}*{other}+|{BLANK}+|\n")
        self.left, self.right = {}, {}  # spines: (piece, when it is made) from the outer character to the root
        self.made = {}
        for p in sorted(self.ids, key=len):
            self._tree(p)
        self.found = ahocorasick.Automaton()
        for p, i in self.ids.items():
            if p in self.made:
                self.found.add_word(p, (i, len(p)))
        self.found.make_automaton()
        self.fits: dict[tuple[int, int], bool] = {}
        self.meant = {i: self.pieces[i].replace(BLANK, " ").encode("utf-8", "surrogatepass") if i in self.pieces else b"" for i in range(size)}
        self.meant |= {i: bytes([b]) for i, b in self.byte_of.items()}
        self.differs: dict[str, bytes] = {}  # words whose ids decode to something else
        self.said = {i: f"{i} " for i in range(size)}
        self.young: dict[str, str] = {}
        self.old: dict[str, str] = {}

    def _tree(self, piece: str) -> None:
        """Merge a piece's own characters; pieces that don't come out whole never occur."""
        parts: list[tuple[str, float]] = [(c, 0.0) for c in piece]
        lefts, rights = [[(c, 0.0)] for c in piece], [[(c, 0.0)] for c in piece]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda k: (self.rank.get(parts[k][0] + parts[k + 1][0], _NEVER), k))
            whole = parts[best][0] + parts[best + 1][0]
            r = self.rank.get(whole, _NEVER)
            if r == _NEVER:
                return
            node = (whole, max(r, parts[best][1], parts[best + 1][1]))
            parts[best:best + 2] = [node]
            lefts[best:best + 2] = [lefts[best] + [node]]
            rights[best:best + 2] = [rights[best + 1] + [node]]
        self.made[piece], self.left[piece], self.right[piece] = True, lefts[0], rights[0]

    def compatible(self, one: int, two: int) -> bool:
        """Whether the text of the two tokens is encoded as just these two."""
        key = (one, two)
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) > KEEP_PAIRS:
                self.fits.clear()
            known = self.fits[key] = self._compatible(self.right[self.pieces[one]], self.left[self.pieces[two]])
        return known

    def _compatible(self, a: list, b: list) -> bool:
        i = k = 0
        while True:
            here = self.rank.get(a[i][0] + b[k][0], _NEVER)
            next_a = a[i + 1][1] if i + 1 < len(a) else _NEVER
            next_b = b[k + 1][1] if k + 1 < len(b) else _NEVER
            # the merge across the border comes before either side grows: ties go to the left one
            if here < next_a and here <= next_b and here < _NEVER:
                return False
            if next_a == _NEVER and next_b == _NEVER:
                return True
            if next_a <= next_b:
                i += 1
            else:
                k += 1

    def _fill(self, word: str, last: list[int | None], known: int) -> None:
        """Complete the prefix table ``last`` of ``word``, of which ``known`` characters are done.
        -1 stands for a character that no piece holds."""
        ids, fits, fit = self.ids, self.fits, self.compatible
        for i in range(known, len(word)):
            if word[i] not in ids:
                last[i + 1] = -1
        for end, (piece, size) in self.found.iter(word):
            end += 1
            if last[end] is not None:  # the one last token of this prefix is known
                continue
            start = end - size
            if start:
                before = last[start]
                if before is None:
                    continue
                if before != -1:
                    ok = fits.get((before, piece))
                    if not (fit(before, piece) if ok is None else ok):
                        continue
            last[end] = piece

    def _recover(self, word: str, last: list[int | None]) -> list[int]:
        """The ids from the last one back to the first."""
        out: list[int] = []
        i = len(word)
        while i:
            piece = last[i]
            if piece == -1:
                out.extend(reversed([self.byte_id[x] for x in word[i - 1].encode("utf-8", "surrogatepass")]))
                i -= 1
            else:
                out.append(piece)
                i -= self.length[piece]
        out.reverse()
        return out

    def encode_words(self, words: set[str]) -> dict[str, str]:
        """Ids (as text, each with a blank behind it) of distinct words. In sorted order,
        neighbours share the table of their common prefix."""
        got: dict[str, str] = {}
        before: str = ""
        last: list[int | None] = [None]
        said = self.said
        for w in sorted(words):
            k = 0
            for x, y in zip(w, before):
                if x != y:
                    break
                k += 1
            del last[k + 1:]
            last.extend([None] * (len(w) - k))
            self._fill(w, last, k)
            ids = self._recover(w, last)
            got[w] = "".join([said[i] for i in ids])
            if (back := self.bytes_of(ids)) != w.replace(BLANK, " ").encode("utf-8", "surrogatepass"):
                self.differs[w] = back
            before = w
        return got

    #: Words kept before the older half goes; a job that has the memory raises it.
    keep = KEEP_WORDS

    def forget(self) -> None:
        """Drop the words and pairs kept: between tasks a worker holds the vocabulary only."""
        self.young, self.old, self.fits, self.differs = {}, {}, {}, {}

    def words_of(self, texts: list[str]) -> Iterator[tuple[list[str], list[str]]]:
        """The words of each text, and the ids of each word as text with a blank behind each id."""
        lists = [self.word.findall(BLANK + t.replace(" ", BLANK)) if t else [] for t in texts]
        need = set().union(*lists)
        if len(self.young) >= self.keep:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        need = need.difference(young)
        for w in [w for w in need if w in old]:
            young[w] = old.pop(w)
            need.discard(w)
        young.update(self.encode_words(need))
        get = young.__getitem__
        for words in lists:
            yield words, list(map(get, words))
        for w in need:
            if len(w) > KEEP_LENGTH:
                del young[w]

    def encode(self, text: str | None, end: bool = True) -> list[int]:
        return [int(i) for _, said in self.words_of([text or ""]) for w in said for i in w.split()] + ([self.end_id] if end else [])

    def bytes_of(self, ids: list[int]) -> bytes:
        """Pieces joined, byte tokens as they are, other ids as nothing."""
        return b"".join(map(self.meant.__getitem__, ids))

    def decoded(self, words: list[str]) -> bytes:
        """Bytes that the ids of these words decode to: the words' own but for those in ``differs``."""
        if not self.differs.keys().isdisjoint(words):
            return b"".join([self.differs.get(w) or w.replace(BLANK, " ").encode() for w in words])
        return "".join(words).replace(BLANK, " ").encode("utf-8", "surrogatepass")

    @staticmethod
    def finish(out: bytes) -> bytes:
        """The first blank dropped; bytes that are no UTF-8 become U+FFFD."""
        if out.startswith(b" "):
            out = out[1:]
        try:
            out.decode()
        except UnicodeDecodeError:
            out = b"".join(_one_by_one(out))
        return out

    def decode(self, ids: list[int]) -> str:
        return self.finish(self.bytes_of(ids)).decode()


def _one_by_one(data: bytes) -> Iterator[bytes]:
    """Valid characters as they are, every other byte as U+FFFD."""
    i = 0
    while i < len(data):
        for n in (1, 2, 3, 4):
            try:
                data[i:i + n].decode()
            except UnicodeDecodeError:
                continue
            yield data[i:i + n]
            i += n
            break
        else:
            yield b"\xef\xbf\xbd"
            i += 1


_TABLES: dict[str, PieceTable] = {}


def piece_table(model_file: str) -> PieceTable:
    """One table per worker process and model."""
    if model_file not in _TABLES:
        _TABLES[model_file] = PieceTable(model_file)
    return _TABLES[model_file]


#: Characters of text that are encoded together.
CHUNK = 400_000


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[list[str]]:
    """The texts (null: empty) of consecutive rows, about CHUNK characters at a time."""
    out, size = [], 0
    for x in batch.column(column):
        out.append(x.as_py() or "")
        size += len(out[-1])
        if size >= CHUNK:
            yield out
            out, size = [], 0
    yield out


def encode_column(df: DataFrame, model_file: str, text: str = "text", ids: str = "ids", end: bool = True) -> DataFrame:
    """``df`` with a column of token ids (replaces a column of that name)."""
    prepare(df.sparkSession)
    df = df.drop(ids)
    at = df.columns.index(text)
    schema = T.StructType([*df.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def run(batches):
        codec = piece_table(model_file)
        codec.keep = KEEP_WORDS
        for b in batches:
            tail = str(codec.end_id) if end else ""
            got = pa.array([np.fromstring("".join(said) + tail, np.int32, sep=" ") for part in _texts(b, at) for _, said in codec.words_of(part)],
                           pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*b.columns, got], names=[*b.schema.names, ids])
        codec.forget()
        release()

    return df.mapInArrow(run, schema)


def decode_column(df: DataFrame, model_file: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of a column of token ids (null ids: empty text)."""
    prepare(df.sparkSession)
    df = df.drop(text)
    at = df.columns.index(ids)
    schema = T.StructType([*df.schema.fields, T.StructField(text, T.StringType())])

    def run(batches):
        codec = piece_table(model_file)
        for b in batches:
            got = pa.array([codec.decode(x.as_py() or []) for x in b.column(at)], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, got], names=[*b.schema.names, text])

    return df.mapInArrow(run, schema)


def round_trip(df: DataFrame, model_file: str, id_column: str = "doc_id", text: str = "text", keep: int = ROUND_TRIP_WORDS) -> DataFrame:
    """Encode every text with the end id, decode the ids, and return sizes and digests of both:
    (id, n_tokens, ids_sha256, decoded_sha256). One pass; the id lists themselves are not kept.
    A worker holds up to twice ``keep`` words, also from one task to its next."""
    prepare(df.sparkSession)
    df = df.select(id_column, text)
    schema = T.StructType([df.schema[0], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                           T.StructField("decoded_sha256", T.StringType())])

    def run(batches):
        codec = piece_table(model_file)
        codec.keep = keep
        tail = str(codec.end_id)
        for b in batches:
            count, a, z = [], [], []
            for words, got in (x for part in _texts(b, 1) for x in codec.words_of(part)):
                line = "".join(got) + tail
                count.append(line.count(" ") + 1)
                a.append(hashlib.sha256(line.encode()).hexdigest())
                z.append(hashlib.sha256(codec.finish(codec.decoded(words))).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(count, pa.int64()), pa.array(a), pa.array(z)],
                                             names=[id_column, "n_tokens", "ids_sha256", "decoded_sha256"])

    return df.mapInArrow(run, schema)


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and digests of ids and decoded text of every document."""
    return round_trip(table(spark, sf_dir, "documents"), default_model())


QUERIES = {"op8_sentencepiece": op8_sentencepiece}
ORACLE: dict[str, str] = {}
