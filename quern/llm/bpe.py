"""BPE encoding and decoding by dynamic programming over prefixes.

For a pair-merge vocabulary every prefix of a word has exactly one token that
its encoding can end with.  An automaton over the vocabulary lists, for each
prefix, the tokens that are suffixes of it; the last token of the prefix is the
one that covers it alone or is compatible with the last token of what comes
before it.  Following the stored tokens back from the end gives the ids that
merging pairs by rank gives, in time linear in the word's length.

Two tokens are compatible when no merge across their border would have come
before the merges that made them.  Left of the border stand, in the order of
their making, the right edges of the first token (its right part, that one's
right part, ...), right of it the left edges of the second.  A merge of such a
pair of edges comes first if its rank is below that of the next edge on the
left and not above that of the next edge on the right (equal ranks go left to
right).

The tokenizer is a file of the ``tokenizers`` library (its path is a
parameter; nothing is trained): special tokens are cut out of the raw text,
the rest is put in NFC, lower-cased and split into words by its pattern, and
words become byte characters whose last one carries the end-of-word mark.
Texts are encoded whole, where they are read; a word met before is looked up
in the worker's table of encoded words, whose older half goes when it is full.

Defined results: a null or empty text has no ids and decodes to an empty text;
ids outside the vocabulary decode to nothing; null ids (of documents) and
repeated rows each get their row; an empty table gives an empty one; other
columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex
from tokenizers.normalizers import NFC, Lowercase, Replace, Sequence
from tokenizers.pre_tokenizers import Split

_PLAIN_RANGES = ((0, 0x52F), (0x1E00, 0x205F))
_ODD = re.compile("[^" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in _PLAIN_RANGES) + "]").search
_END = "\x00"  # stands for the end-of-word suffix; no byte is written as this character
_TABLE_WORDS = 240_000
_TABLE_LENGTH = 64
_BATCH_IDS = 1_000_000


def byte_characters() -> list[str]:
    """The printable character of each byte: itself where it prints in Latin-1,
    else the next character from 256 on."""
    own = set(range(33, 127)) | set(range(161, 173)) | set(range(174, 256))
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def _plain_pattern(pattern: str) -> str:
    """The word pattern for plain texts, its classes written out as ranges."""
    plain = [chr(c) for lo, hi in _PLAIN_RANGES for c in range(lo, hi + 1)]
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        if name == r"\s":
            inside = [c for c in plain if regex.match(r"\p{White_Space}", c)]
        else:
            inside = [c for c in plain if unicodedata.category(c)[0] == name[3]]
        ranges: list[list[int]] = []
        for c in map(ord, inside):
            if ranges and ranges[-1][1] == c - 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
        pattern = pattern.replace(name, "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges))
    return pattern


class WordBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        ids: dict[str, int] = model["vocab"]
        self.tokens = {i: t for t, i in ids.items()} | {a["id"]: a["content"] for a in spec["added_tokens"]}
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self._cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self._words = re.compile(_plain_pattern(pattern)).findall
        self._split = Split(Regex(pattern), behavior="removed", invert=True)
        self._normal = Sequence([NFC(), Replace(Regex(r"\s+"), " "), Lowercase()])
        self._bytes = dict(enumerate(byte_characters()))
        # rank of a token's making (its place among the merges, none for a unit), its parts, and the merges by parts
        self.rank: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.merges: dict[tuple[int, int], int] = {}
        for r, (a, b) in enumerate(model["merges"]):
            t = ids[a + b]
            self.merges[ids[a], ids[b]] = r
            if t not in self.rank:
                self.rank[t], self.parts[t] = r, (ids[a], ids[b])
        self._edges: dict[tuple[int, int], list[tuple[int, float]]] = {}
        self._fits: dict[int, bool] = {}
        alone: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for text, t in sorted(ids.items(), key=lambda x: self.rank.get(x[1], -1)):
            # A token is the encoding of its own text if its parts are and nothing merges across them earlier.
            alone[t] = t not in self.parts or (all(alone[p] for p in self.parts[t]) and self._first_merge(*self.parts[t]) == self.rank[t])
            if alone[t]:
                ended = text.endswith(suffix) and len(text) > len(suffix)
                body = text[: -len(suffix)] if ended else text
                self.automaton.add_word(body + _END if ended else body, (t, len(body)))
        self.automaton.make_automaton()
        self._table: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def _edge(self, t: int, side: int) -> list[tuple[int, float]]:
        """(edge, rank of the next larger edge) of a token on its left (0) or right (1)."""
        found = self._edges.get((t, side))
        if found is None:
            found, above, e = [], float("inf"), t
            while True:
                found.append((e, above))
                if e not in self.parts:
                    break
                above, e = self.rank[e], self.parts[e][side]
            self._edges[t, side] = found
        return found

    def _first_merge(self, a: int, b: int) -> float:
        """Rank of the first merge across the border of two tokens, if one comes."""
        return min((r for x, above_x in self._edge(a, 1) for y, above_y in self._edge(b, 0)
                    if (r := self.merges.get((x, y))) is not None and r < above_x and r <= above_y), default=float("inf"))

    def fits(self, a: int, b: int) -> bool:
        if len(self._fits) > 300_000:
            self._fits.clear()
        known = self._fits[a << 32 | b] = self._first_merge(a, b) == float("inf")
        return known

    def encode_word(self, word: str) -> list[int]:
        """Ids of one word of the pattern."""
        units = word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self._bytes)
        n = len(units)
        last = [-1] * (n + 1)
        size = [0] * (n + 1)
        known, fits = self._fits.get, self.fits
        for end, (t, k) in self.automaton.iter(units + _END):
            i = end if end == n else end + 1  # the mark is no unit of its own
            if last[i] >= 0 or (i == n and end != n):
                continue
            if i != k:
                before = last[i - k]
                ok = known(before << 32 | t)
                if not (fits(before, t) if ok is None else ok):
                    continue
            last[i], size[i] = t, k
        out, i = [], n
        while i:
            out.append(last[i])
            i -= size[i]
        return out[::-1]

    def words(self, text: str) -> list[str | int]:
        """Words of the pattern, and ids of special tokens, in order."""
        out: list[str | int] = []
        for k, part in enumerate(self._cut.split(text) if self._cut else [text]):
            if k % 2:
                out.append(self.special[part])
                continue
            low = unicodedata.normalize("NFC", part)
            low = low.lower() if "Σ" not in low else "".join(map(str.lower, low))  # a final sigma is not special
            if low.isascii() or not _ODD(low):
                out += self._words(low)
            else:  # letters that Unicode versions class differently: the library's own cut
                out += [w for w, _ in self._split.pre_tokenize_str(self._normal.normalize_str(part))]
        return out

    def _ids(self, word: str | int) -> bytes:
        """Ids of a word that the younger half of the table lacks."""
        if isinstance(word, int):
            return np.int32(word).tobytes()
        got = self._older.get(word)
        if got is None:
            got = np.array(self.encode_word(word), np.int32).tobytes()
        if len(word) <= _TABLE_LENGTH:
            if len(self._table) >= _TABLE_WORDS // 2:
                self._older, self._table = self._table, {}
            self._table[word] = got
        return got

    def encode(self, text: str | None) -> np.ndarray:
        words = self.words(text or "")
        out = list(map(self._table.get, words))
        if None in out:
            out = [self._ids(w) if got is None else got for w, got in zip(words, out)]
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids) -> str:
        """As the library decodes without a decoder: tokens with blanks between."""
        return " ".join([t for t in map(self.tokens.get, ids) if t is not None])


def _lists(column: pa.ListArray) -> Iterator[list[int]]:
    """The id lists of a column; a null is an empty one."""
    values, ends = column.values.to_numpy(), column.offsets.to_numpy().tolist()
    yield from (values[a:b].tolist() for a, b in zip(ends, ends[1:]))


@functools.lru_cache(maxsize=4)  # once per Python worker
def load(path: str) -> WordBpe:
    return WordBpe(path)


def _encoded(bpe: WordBpe, batch: pa.RecordBatch) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Ids and encoded texts of a (doc_id, text) batch, a bounded number of ids at a time."""
    keys, rows, n = [], [], 0
    for key, text in zip(batch.column(0), batch.column(1)):
        keys.append(key.as_py())
        rows.append(bpe.encode(text.as_py()))
        n += len(rows[-1])
        if n >= _BATCH_IDS:
            yield keys, rows
            keys, rows, n = [], [], 0
    yield keys, rows


def _list_array(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*rows, np.empty(0, np.int32)])))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of every row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in batches:
            for keys, rows in _encoded(bpe, b):
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), _list_array(rows)], ["doc_id", "ids"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids) rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in batches:
            texts = pa.array([bpe.decode(ids) for ids in _lists(b.column(1))], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), texts], ["doc_id", "text"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def encode_and_decode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, n_tokens, text) of every row: ids and the text they decode
    to, in one pass of one Python worker."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in batches:
            for keys, rows in _encoded(bpe, b):
                texts = pa.array([bpe.decode(r.tolist()) for r in rows], pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), _list_array(rows), pa.array(map(len, rows), pa.int64()), texts],
                                                 ["doc_id", "ids", "n_tokens", "text"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, ids array<int>, n_tokens long, text string")


def digests(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of (doc_id, ids) rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        digits = [str(i) for i in range(max(bpe.tokens) + 1)]
        sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
        for b in batches:
            n, ids_sha, text_sha = [], [], []
            for ids in _lists(b.column(1)):
                n.append(len(ids))
                ids_sha.append(sha(" ".join([digits[i] for i in ids])))
                text_sha.append(sha(bpe.decode(ids)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
