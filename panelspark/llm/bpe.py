"""BPE encoding and decoding with a vocabulary of words that carry an end mark.

The text is normalised (NFC, lower case), split into words at white space and classes, and each
word's symbols are merged: a doubly linked list holds the symbols, a heap holds the mergeable
neighbours by merge rank, and entries whose symbols have changed meanwhile are skipped.

Null and empty texts have no ids and decode to the empty text. Rows are independent: repeated
rows repeat, an empty table stays empty, and columns named like the results are an error of
the caller's choice of names, reported before the job starts.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from collections import defaultdict
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import Batches, map_batches, texts_of

#: White space as Unicode defines it, and characters that only Python counts as such.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_ONLY_PYTHON = re.compile(r"[\x1c-\x1f]")


@cache
def _class(category: str) -> str:
    """The characters of a Unicode category (L, N) as ranges of a character class."""
    ranges, start = [], None
    for code in range(sys.maxunicode + 2):
        hit = code <= sys.maxunicode and unicodedata.category(chr(code))[0] == category
        if hit and start is None:
            start = code
        elif not hit and start is not None:
            ranges.append(f"\\U{start:08x}-\\U{code - 1:08x}")
            start = None
    return "".join(ranges)


@cache
def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(moved)}


class Generations(defaultdict):
    """A cache of bounded size: when full, it starts anew and keeps the last generation to look into."""

    def __init__(self, make, limit: int = 300_000):
        super().__init__()
        self.make, self.limit, self.last = make, limit, {}

    def __missing__(self, key):
        value = self.last.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.last = dict(self)
            self.clear()
        self[key] = value
        return value


class WordBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"]
        self.merges = {}
        for rank, (left, right) in enumerate(model["merges"]):
            self.merges[self.ids[left], self.ids[right]] = rank, self.ids[left + right]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in (self.ids | self.special).items()}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        letters, numbers = _class("L"), _class("N")
        self.words = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{_SPACE}{letters}{numbers}]+")
        self.by_word = Generations(lambda word: np.array(self.merge(word), "<u4").tobytes())
        self.by_chunk = Generations(lambda chunk: b"".join(map(self.by_word.__getitem__, self.words.findall(chunk))))

    def merge(self, word: str) -> list[int]:
        """The ids of one word."""
        table = byte_symbols()
        symbols = [table[b] for b in word.encode("utf-8", "surrogatepass")]
        symbols[-1] += self.end
        ids = [self.ids[s] for s in symbols if s in self.ids]
        before = list(range(-1, len(ids) - 1))
        after = [*range(1, len(ids)), -1]
        heap = []

        def offer(at: int) -> None:
            to = after[at]
            if to >= 0 and (found := self.merges.get((ids[at], ids[to]))):
                heapq.heappush(heap, (found[0], at, ids[at], ids[to], found[1]))

        for at in range(len(ids) - 1):
            offer(at)
        while heap:
            _, at, left, right, made = heapq.heappop(heap)
            to = after[at]
            if ids[at] != left or to < 0 or ids[to] != right:
                continue  # stale: one of the two has been merged since
            ids[at], ids[to] = made, -1
            after[at] = after[to]
            if after[to] >= 0:
                before[after[to]] = at
            after[to] = -1
            if before[at] >= 0:
                offer(before[at])
            offer(at)
        return [i for i in ids if i >= 0]

    def _ordinary(self, text: str) -> bytes:
        """Ids of a text without special tokens. White space only separates, so runs need no folding."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
        if _ONLY_PYTHON.search(text):
            return b"".join(map(self.by_word.__getitem__, self.words.findall(text)))
        return b"".join(map(self.by_chunk.__getitem__, text.split()))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not any(s in text for s in self.special):
            return self._ordinary(text)
        parts = filter(None, self.split_special.split(text))
        return b"".join(
            self.special[p].to_bytes(4, "little") if p in self.special else self._ordinary(p) for p in parts
        )

    def decode(self, ids: bytes) -> str:
        """Vocabulary strings of the ids, joined by blanks as the vocabulary names no decoder."""
        return " ".join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_loaded: dict[str, WordBpe] = {}


def load(path: str) -> WordBpe:
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]


def bpe_encode(df: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids", decoded: str | None = "decoded") -> DataFrame:
    """Add the packed ids (binary, 4 little-endian bytes each) and, unless None, the decoded text.

    ``vocabulary`` is the path of a tokenizer file that every worker can read.
    """
    added = [ids] + ([decoded] if decoded else [])
    clash = {c.lower() for c in df.columns} & {c.lower() for c in added}
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already")

    def run(batches: Batches) -> Batches:
        bpe = load(vocabulary)
        for batch in batches:
            packed = [bpe.encode(t) for t in texts_of(batch, text)]
            columns = [*batch.columns, pa.array(packed, pa.binary())]
            if decoded:
                columns.append(pa.array([bpe.decode(p) for p in packed], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *added])

    schema = ", ".join([
        *(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields),
        f"`{ids}` binary", *([f"`{decoded}` string"] if decoded else []),
    ])
    return map_batches(df, run, schema)


def digests(df: DataFrame) -> DataFrame:
    """The contract columns of the encoding query."""
    return df.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )
