"""Token files: directly addressable codes over the ids of many documents.

A file row (segment) holds the ids of consecutive documents. Each id is cut into chunks of
8 bits, lowest first. Level 0 holds the first chunk of every id, a bitmap tells which ids go on,
level 1 holds the second chunk of those, and so on. A directory of ones before every 512 bits
gives the rank of a position, which is its place in the next level; so any token is read
without decoding its neighbours.

Null and empty texts hold the end id alone. Rows with a null id come first; rows of equal id
follow each other in order of their text. An empty table gives no segment and no row back.
Other columns of the input are not stored.
"""

from __future__ import annotations

import os
import re
import struct
import sys
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm.bpe import Generations, byte_symbols
from panelspark.llm.common import Batches, byte_slices, map_batches, texts_of

#: Bytes of text that are encoded at once, so that a piece that comes often is met once.
CHUNK = 4 << 20
#: A segment is closed at the first document that reaches this many tokens.
SEGMENT_TOKENS = 1 << 20
_BLOCK = 512
_PIECES = regex.compile(public_tokenizers.PATTERN)
_LITTLE = sys.byteorder == "little" and array("I").itemsize == 4
#: Characters below this one are letters, digits or none in all versions of Unicode in use.
_SETTLED = "\u0500"
#: The kind of white space; letters, digits and others have 0 to 2.
_WHITE = 3
_SHORT = np.zeros(256, bool)
_SHORT[[*b"stmd"]] = True


def pack(ids: np.ndarray) -> bytes:
    """Directly addressable codes of unsigned 32-bit ids."""
    levels, rest = [], np.ascontiguousarray(ids, np.uint32)
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (_BLOCK // 8), np.uint8)])
        ones = np.bitwise_count(bits).reshape(-1, _BLOCK // 8).sum(1, dtype=np.uint32)
        ranks = np.zeros(len(ones) + 1, "<u4")
        np.cumsum(ones, out=ranks[1:])
        levels.append((len(rest), (rest & 0xFF).astype(np.uint8).tobytes(), bits.tobytes(), ranks.tobytes()))
        if not more.any():
            break
        rest = rest[more] >> np.uint32(8)
    out = [struct.pack("<B", len(levels))]
    for n, chunks, bits, ranks in levels:
        out += [struct.pack("<QQQ", n, len(bits), len(ranks)), chunks, bits, ranks]
    return b"".join(out)


class Packed:
    """Random access to packed ids."""

    def __init__(self, data: bytes):
        self.levels, at = [], 1
        for _ in range(data[0]):
            n, n_bits, n_ranks = struct.unpack_from("<QQQ", data, at)
            at += 24
            chunks = np.frombuffer(data, np.uint8, n, at)
            bits = np.frombuffer(data, np.uint8, n_bits, at + n)
            ranks = np.frombuffer(data, "<u4", n_ranks // 4, at + n + n_bits)
            self.levels.append((chunks, bits, ranks))
            at += n + n_bits + n_ranks

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def get(self, positions: np.ndarray) -> np.ndarray:
        """The ids at any positions, by way of the rank directories."""
        positions = np.asarray(positions, np.int64)
        out = np.zeros(len(positions), np.uint32)
        where = np.arange(len(positions))
        for level, (chunks, bits, ranks) in enumerate(self.levels):
            out[where] |= chunks[positions].astype(np.uint32) << np.uint32(8 * level)
            more = (bits[positions >> 3] >> (positions & 7).astype(np.uint8)) & 1 == 1
            if not more.any():
                break
            positions, where = positions[more], where[more]
            positions = self._rank(bits, ranks, positions)
        return out

    @staticmethod
    def _rank(bits: np.ndarray, ranks: np.ndarray, positions: np.ndarray) -> np.ndarray:
        block = positions // _BLOCK
        inside = bits.reshape(-1, _BLOCK // 8)[block]
        mask = np.arange(_BLOCK)[None, :] < (positions % _BLOCK)[:, None]
        ones = (np.unpackbits(inside, axis=1, bitorder="little").astype(bool) & mask).sum(1)
        return ranks[block].astype(np.int64) + ones

    def range(self, begin: int, end: int) -> np.ndarray:
        """The ids of a range: one rank a level, then all of it in a sweep."""
        out = np.zeros(end - begin, np.uint32)
        where: np.ndarray | slice = slice(None)
        for level, (chunks, bits, ranks) in enumerate(self.levels):
            out[where] |= chunks[begin:end].astype(np.uint32) << np.uint32(8 * level)
            first = begin >> 3
            more = np.unpackbits(bits[first:-(-end >> 3)], bitorder="little")[begin - 8 * first : end - 8 * first]
            more = more.astype(bool)
            n = int(np.count_nonzero(more))
            if not n:
                break
            where = np.flatnonzero(more) if isinstance(where, slice) else where[more]
            begin = int(self._rank(bits, ranks, np.array([begin]))[0])
            end = begin + n
        return out


class Encoder:
    """The tokenizers library on the distinct pieces of the texts."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        added = self.library.get_added_tokens_decoder().values()
        self.special = [t.content for t in added]
        self.model, self.symbols = self.library.model, byte_symbols()
        cut = self.library.pre_tokenizer
        self.plain = self.library.normalizer is None and isinstance(cut, ByteLevel) and cut.use_regex and not cut.add_prefix_space
        self.by_piece = Generations(self._piece, 400_000)
        self.by_word = Generations(self._chunk)
        self.kinds = self._kinds() if self.plain else None

    def _kinds(self) -> np.ndarray:
        """Letter, digit, other or white space, as the library's own cut of two characters tells, for settled characters."""
        def joins(pair: str) -> bool:
            return len(self.library.pre_tokenizer.pre_tokenize_str(pair)) == 1

        settled = map(chr, range(ord(_SETTLED)))
        return np.array([next((k for k, x in enumerate("a1!") if joins(x + c)), _WHITE) for c in settled], np.uint8)

    def _library(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: bytes) -> bytes:
        """Packed ids of a piece, from the library's model alone where its other steps would pass the piece on whole."""
        if not (self.plain and (piece.isascii() or max(piece.decode()) < _SETTLED)):
            return self._library(piece.decode())
        tokens = self.model.tokenize(piece.decode("latin-1").translate(self.symbols))
        return array("I", [t.id for t in tokens]).tobytes() if _LITTLE else np.array([t.id for t in tokens], "<u4").tobytes()

    def _chunk(self, word: str) -> bytes:
        """Packed ids of a blank and what follows it up to the next one."""
        if word.isascii() and word.isalpha():  # one piece
            return self.by_piece[b" " + word.encode()]
        return self._cut(" " + word)

    def _cut(self, chunk: str) -> bytes:
        return b"".join([self.by_piece[p.encode()] for p in _PIECES.findall(chunk)])

    def _unsettled(self, text: str) -> bytes:
        """Packed ids of a text by itself.

        The vocabulary's words begin at a blank, so a text without runs of white space can be cut
        there, and chunks and their pieces of the pattern be encoded once. Texts with such runs, which the word pattern
        treats as a whole, and texts with special tokens go to the library in one piece.
        """
        if not text or _runs(text) or any(s in text for s in self.special):
            return self._library(text)
        first, *rest = text.split(" ")
        return self._cut(first) + b"".join(map(self.by_word.__getitem__, rest))

    def encode_all(self, texts: list[str], end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """The ids of several texts, ``end`` behind each, and how many each has.

        Texts of settled characters are cut into pieces together, and each different piece is encoded once.
        """
        alone = {
            i: self._unsettled(x) for i, x in enumerate(texts)
            if self.kinds is None or x and (not (x.isascii() or max(x) < _SETTLED) or any(s in x for s in self.special))
        }
        parts = [b"" if i in alone else x.encode() for i, x in enumerate(texts)]
        edges = np.zeros(len(parts) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)), out=edges[1:])
        joined = b"".join(parts)
        starts = _piece_starts(np.frombuffer(joined, np.uint8), edges[:-1], self.kinds)
        offsets = np.append(starts, len(joined)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(joined)]).dictionary_encode()
        entries = list(map(self.by_piece.__getitem__, pieces.dictionary.to_numpy(zero_copy_only=False).tolist()))
        # Behind the pieces of each text comes its end, with the ids of a text encoded alone ahead of it.
        tails = np.full(len(texts), len(entries))
        tails[list(alone)] = len(entries) + 1 + np.arange(len(alone))
        entries += [end, *(ids + end for ids in alone.values())]
        behind = np.searchsorted(starts, edges[1:]) + np.arange(len(texts))
        code = np.zeros(len(starts) + len(texts), np.int64)
        inside = np.ones(len(code), bool)
        inside[behind] = False
        code[inside], code[behind] = pieces.indices.to_numpy(), tails
        sizes = np.fromiter(map(len, entries), np.int64, len(entries)) // 4
        ids = np.frombuffer(b"".join(entries), "<u4")
        counts = sizes[code]
        closes = np.cumsum(counts)
        at = np.repeat((np.cumsum(sizes) - sizes)[code] - closes + counts, counts)
        at += np.arange(len(at))
        return ids[at], np.diff(closes[behind], prepend=0)

    def encode(self, text: str) -> bytes:
        """Packed ids of a text."""
        return self.encode_all([text])[0].tobytes()


def _piece_starts(data: np.ndarray, texts: np.ndarray, kinds: np.ndarray | None) -> np.ndarray:
    """Where the pieces of the word pattern start in texts of settled characters; ``texts`` tells where the texts start."""
    if not len(data):
        return np.zeros(0, np.int64)
    kind = kinds[data]
    lead = np.flatnonzero(data >= 0xC0)  # all of two bytes
    if len(lead):
        kind[lead] = kinds[(data[lead] & 0x1F).astype(np.int64) << 6 | data[lead + 1] & 0x3F]
        kind[lead + 1] = kind[lead]
    first = np.zeros(len(data) + 1, bool)
    first[texts] = first[-1] = True
    opens = first.copy()
    opens[1:-1] |= kind[1:] != kind[:-1]
    # The last white space of a run stands by itself, or with what follows if it is a blank.
    follow = np.flatnonzero(opens[1:] & ~first[1:] & (kind == _WHITE)) + 1
    last = follow - 1 - (data[follow - 1] >> 6 == 2)
    opens[last] = True
    opens[follow[data[last] == 0x20]] = False
    # 's, 't, 'm, 'd, 're, 've and 'll are pieces where a piece starts.
    quote = np.flatnonzero((data == 0x27) & opens[:-1])
    quote = quote[~first[quote + 1]]
    if len(quote):
        one = data[quote + 1]
        two = np.where(first[quote + 2], 0, data[np.minimum(quote + 2, len(data) - 1)])
        short = _SHORT[one]
        long = ((one == 0x72) | (one == 0x76)) & (two == 0x65) | (one == 0x6C) & (two == 0x6C)
        opens[quote[short | long] + 1] = False
        opens[quote[short] + 2] = True
        opens[quote[long] + 3] = True
    return np.flatnonzero(opens[:-1])


def _runs(text: str) -> bool:
    return bool(re.search(r"\s\s", text))


_loaded: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


SEGMENT_SCHEMA = "part int, first long, n_tokens long, doc_ids array<long>, ends array<long>, payload binary"


def write_token_files(df: DataFrame, path: str, vocabulary: str, end_id: int = 0, doc_id: str = "doc_id", text: str = "text", partitions: int | None = None) -> None:
    """Encode every text, append the end id and write segments in ascending order of the id.

    The rows are dealt out by ranges of the id before they are encoded, so the texts move once
    and a lost task is simply run again; Spark commits each task's files whole.
    """
    spark = df.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
        .repartitionByRange(partitions, "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    end = end_id.to_bytes(4, "little")

    def run(batches: Batches) -> Batches:
        encoder, part, first = _encoder(vocabulary), TaskContext.get().partitionId(), 0
        doc_ids: list = []
        ends: list[int] = []
        parts: list[np.ndarray] = []
        size = 0

        def segment() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([first], pa.int64()), pa.array([size], pa.int64()),
                pa.array([doc_ids], pa.list_(pa.int64())), pa.array([ends], pa.list_(pa.int64())),
                pa.array([pack(ids)], pa.binary()),
            ], names=["part", "first", "n_tokens", "doc_ids", "ends", "payload"])

        for batch in byte_slices(batches, "text", limit=CHUNK):
            ids, counts = encoder.encode_all(texts_of(batch, "text"), end)
            at = 0
            for key, count in zip(batch.column("doc_id").to_pylist(), counts.tolist(), strict=True):
                size += count
                doc_ids.append(key)
                ends.append(size)
                parts.append(ids[at : at + count])
                at += count
                if size >= SEGMENT_TOKENS:
                    yield segment()
                    first, size, doc_ids, ends, parts = first + size, 0, [], [], []
        if doc_ids:
            yield segment()

    map_batches(ordered, run, SEGMENT_SCHEMA).write.option("compression", "zstd").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Read the files back: doc_id, start (tokens ahead of the document), n_tokens, ids (packed).

    A segment knows the tokens ahead of it in its own partition; those of the partitions before
    are summed on the driver, one number for each write task.
    """
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    totals = segments.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    bases, base = {}, 0
    for row in totals:
        bases[row.part] = base
        base += row.n

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for part_id, first, keys, ends, payload in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                first += bases[part_id]
                codes = Packed(payload)
                edges = np.array([0, *ends], np.int64)
                for at in range(0, len(keys), 1000):
                    part = edges[at : at + 1001]
                    ids = codes.range(int(part[0]), int(part[-1])).astype("<u4", copy=False)
                    offsets = ((part - part[0]) * 4).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(keys[at : at + 1000], pa.int64()), pa.array(first + part[:-1], pa.int64()), pa.array(np.diff(part), pa.int64()),
                        pa.Array.from_buffers(pa.binary(), len(part) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(ids)]),
                    ], names=["doc_id", "start", "n_tokens", "ids"])

    names = ["part", "first", "doc_ids", "ends", "payload"]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return segments.select(*names).mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
