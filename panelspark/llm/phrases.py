"""Collocated phrases by partitioned mining (SON): mine shards at lowered support, then count the union exactly.

Rows are dealt to SHARDS shards by a hash of their text. A phrase that occurs ``least`` times in a language
occurs in some shard at least ``least`` times that shard's share of the language's words, so mining every shard
completely at that support, rounded up, misses none. A shard is mined level by level: phrases of a length are
counted only if both phrases one word shorter are candidates. Of what is frequent in shards, phrases whose shards
together stay below ``least`` are dropped, as their hashes count all their occurrences or more. The rest is a bit
set of hashed phrases of fixed size (BITS), which drivers and workers hold; a
collision adds a candidate and loses none. Last, all occurrences of the candidates are counted by their words,
so counts, and with them the result, don't depend on any hash. Tasks add up the occurrences of a chunk of
text before they are shuffled, so frequent phrases cost a row per chunk, or an entry of one while shards are mined.

Null texts are empty, null languages are ``und``, repeated rows count each time, and texts without words and
empty tables give no phrases. Ties are broken by the phrase. Long texts are cut at piece ends, so memory depends on
the chunk unless one piece is longer. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelspark.llm.common import Batches, Bytes, forget_shuffles, map_batches, mix
from panelspark.session import broadcast_if_small, materialize

SHARDS = 4

#: Bytes of text that are mined at once, and bits of the set of candidates.
CHUNK = 2 << 20
BITS = 1 << 27

#: Occurrences of phrases whose keys are added up at once, and the least number of such ranges of keys. They follow the
#: words only: rows by chunk and range must not grow with shuffle partitions.
RANGE = 1_000_000
RANGES = 256

#: Keys that a frequent phrase part or a language is spread over.
SALTS = 16

_KIND = np.zeros(256, np.uint8)  # 0 word, 1 blank, 2 end of a piece
_KIND[[0x09, 0x20]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: A word, for Java's expressions: no blank and no end of a piece.
WORD = r"[^ \t.,;:!?\n-\r]+"

_STEP = np.uint64(0x9E3779B97F4A7C15)


class Words:
    """The words of a chunk: vocabulary, a code and a part for each word, and whether the next word follows in its piece."""

    def __init__(self, parts: list[bytes]):
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        data = _LOWER[np.frombuffer(b"\n".join(parts), np.uint8)]  # line feeds end pieces
        kind = _KIND[data]
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = kind == 0
        begin, end = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(~inside[1:] & inside[:-1])
        offsets = np.zeros(len(begin) + 1, np.int32)
        np.cumsum(end - begin, out=offsets[1:])
        words = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside[1:-1]])])
        coded = words.dictionary_encode()
        self.vocabulary: pa.Array = coded.dictionary
        self.codes = coded.indices.to_numpy()
        ends = np.cumsum(kind == 2, dtype=np.int32)
        piece = ends[begin] if len(begin) else np.zeros(0, np.int32)
        self.follows = piece[1:] == piece[:-1]
        self.parts = np.searchsorted(np.cumsum(sizes + 1), begin, "right").astype(np.int32)

    @cached_property
    def hashes(self) -> np.ndarray:
        """A hash of each word."""
        _, offsets, data = self.vocabulary.buffers()
        at = np.frombuffer(offsets, np.int32)[: len(self.vocabulary) + 1]
        return Bytes([data.to_pybytes()]).hashes(at[:-1], at[1:])[self.codes]

    def starts(self, size: int) -> np.ndarray:
        """Words that begin a phrase of ``size`` words."""
        whole = np.ones(max(len(self.codes) - size + 1, 0), bool)
        for i in range(size - 1):
            whole &= self.follows[i : i + len(whole)]
        return np.flatnonzero(whole)


def _chunks(batches: Batches) -> Iterator[tuple[list[tuple], Words]]:
    """Words of about CHUNK bytes of text at a time, and the other columns of each part's row.

    Texts that pass a chunk are cut behind a piece end.
    """
    parts: list[bytes] = []
    others: list[tuple] = []
    size = 0
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in batch.schema.names if c != "text"), strict=True)
        for text, other in zip(batch.column("text"), rows, strict=True):
            data = (text.as_py() or "").encode("utf-8", "surrogatepass")
            while data:
                cut = len(data)
                if cut > CHUNK:
                    ends = np.flatnonzero(_KIND[np.frombuffer(data, np.uint8)] == 2)
                    behind = int(np.searchsorted(ends, CHUNK))
                    cut = len(data) if not len(ends) else int(ends[behind - 1 if behind else 0]) + 1
                parts.append(data[:cut])
                others.append(other)
                size += cut
                data = data[cut:]
                if size >= CHUNK:
                    words = Words(parts)
                    if len(words.codes):
                        yield others, words
                    parts, others, size = [], [], 0
    words = Words(parts)
    if len(words.codes):
        yield others, words


@lru_cache(1 << 16)
def _language_hash(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def _keys(words: Words, languages: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the phrases of ``size`` words at every word (of no use where none begins), the last two bits free."""
    hashes = words.hashes
    n = max(len(hashes) - size + 1, 0)
    key = hashes[:n]
    for i in range(1, size):
        key = mix(key * _STEP + hashes[i : i + n])
    return mix(key * _STEP ^ languages[words.parts[:n]]) & ~np.uint64(3)


def _in(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = (keys >> np.uint64(2)) & np.uint64(BITS - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _frequent_starts(words: Words, languages: np.ndarray, sets: list[np.ndarray], size: int) -> np.ndarray:
    """Where phrases of ``size`` words begin both of whose parts one word shorter are candidates."""
    at = words.starts(size)
    if size > 1 and len(at):
        known = _in(sets[size - 2], _keys(words, languages, size - 1))
        at = at[known[at] & known[at + 1]]
    return at


def _languages(names: Iterable[str]) -> np.ndarray:
    return np.array([_language_hash(x) for x in names], np.uint64)


def _mine(rows: DataFrame, sets: list[Broadcast], size: int, least: int, ranges: int) -> DataFrame:
    """key of the phrases of ``size`` words that reach a shard's support and, by hash, ``least`` in all shards.

    Tasks send the sorted keys of a chunk, with the shard in the last two bits, as one row for each of ``ranges`` (a
    power of two) ranges of keys; a range, with all shards of its phrases, is added up at once.
    """
    shift = np.uint64(64 - ranges.bit_length() + 1)

    def run(batches: Batches) -> Batches:
        found = [s.value for s in sets]
        for others, words in _chunks(batches):
            names, shards, supports = zip(*others, strict=True)
            languages = _languages(names)
            at = _frequent_starts(words, languages, found, size)
            keys = _keys(words, languages, size)[at] | np.array(shards, np.uint64)[words.parts[at]]
            needed = np.array(supports, np.int32)[words.parts[at]]
            for support in np.unique(needed).tolist():
                met, counts = np.unique(keys[needed == support], return_counts=True)
                bucket = (met >> shift).astype(np.int32)
                first = np.flatnonzero(np.diff(bucket, prepend=-1))
                edges = np.append(first, len(met))
                yield pa.RecordBatch.from_arrays([
                    pa.array(bucket[first]), pa.array(np.full(len(first), support, np.int32)),
                    _packed(met, edges), _packed(counts.astype(np.int32), edges),
                ], names=["bucket", "support", "keys", "n"])

    def add_up(table: pa.Table) -> pa.Table:
        supports = table.column("support").to_numpy()
        keys, counts = (np.frombuffer(b"".join(table.column(c).to_pylist()), t) for c, t in (("keys", np.uint64), ("n", np.int32)))
        support = np.repeat(supports, pc.binary_length(table.column("keys")).to_numpy() // 8)
        order = np.argsort(keys)
        keys, counts, support = keys[order], counts[order].astype(np.int64), support[order]
        in_shard = np.flatnonzero(np.diff(keys, prepend=keys[:1] + np.uint64(1)))
        counts = np.add.reduceat(counts, in_shard)
        reached = counts >= np.minimum.reduceat(support, in_shard)
        phrases = keys[in_shard] & ~np.uint64(3)
        whole = np.flatnonzero(np.diff(phrases, prepend=phrases[:1] + np.uint64(1)))
        kept = np.logical_or.reduceat(reached, whole) & (np.add.reduceat(counts, whole) >= least)
        return pa.table({"key": phrases[whole][kept].view(np.int64)})

    met = map_batches(rows.select("lang", "shard", "support", "text"), run, "bucket int, support int, keys binary, n binary")
    return met.groupBy("bucket").applyInArrow(add_up, "key long")


def _packed(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Slices of an array as binary values."""
    offsets = (edges * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _bit_set(keys: DataFrame) -> np.ndarray:
    """The keys as a set of BITS bits, at 64 bits a row: of fixed size whatever their number."""
    bit = F.shiftrightunsigned("key", 2).bitwiseAND(F.lit(BITS - 1))
    words = (
        keys.select(bit.alias("bit"))
        .groupBy(F.shiftrightunsigned("bit", 6).alias("at"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 AS INT))")).alias("bits"))
        .toArrow()
    )
    out = np.zeros(BITS // 64, np.uint64)
    out[words.column("at").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def _distinct(words: Words, lang_of: np.ndarray, keys: np.ndarray, at: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Where each different phrase of ``size`` words among those at ``at`` first stands, and how often it occurs."""
    while len(at):
        _, first, group, counts = np.unique(keys[at], return_index=True, return_inverse=True, return_counts=True)
        spoken = at[first]
        same = lang_of[at] == lang_of[spoken[group]]
        for i in range(size):
            same &= words.codes[at + i] == words.codes[spoken[group] + i]
        if not same.all():
            counts = np.bincount(group[same], minlength=len(first))
        yield spoken, counts
        at = at[~same]  # other phrases of equal hash


def _count(rows: DataFrame, sets: list[Broadcast], longest: int) -> DataFrame:
    """lang, size, phrase and n of a chunk's candidates, counted by their words."""

    def run(batches: Batches) -> Batches:
        found = [s.value for s in sets]
        for others, words in _chunks(batches):
            names, lang_of = np.unique(np.array([lang for lang, in others], object), return_inverse=True)
            languages, lang_of = _languages(names)[lang_of], lang_of[words.parts]
            vocabulary = words.vocabulary.cast(pa.string())
            for size in range(1, longest + 1):
                at = _frequent_starts(words, languages, found, size)
                keys = _keys(words, languages, size)
                for spoken, counts in _distinct(words, lang_of, keys, at[_in(found[size - 1], keys[at])], size):
                    parts = [vocabulary.take(pa.array(words.codes[spoken + i])) for i in range(size)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(names[lang_of[spoken]], pa.string()), pa.array(np.full(len(spoken), size, np.int32)),
                        pc.binary_join_element_wise(*parts, " ") if size > 1 else parts[0], pa.array(counts.astype(np.int64)),
                    ], names=["lang", "size", "phrase", "n"])

    return map_batches(rows.select("lang", "text"), run, "lang string, size int, phrase string, n long")


def frequent_phrases(
    df: DataFrame, longest: int = 3, least: int = 10, lang: str = "lang", text: str = "text", shards: int = SHARDS,
) -> tuple[DataFrame, DataFrame]:
    """Phrases of up to ``longest`` words with ``least`` occurrences or more in a language (lang, size, phrase, n), and
    the words of each language (lang, n). ``shards`` is at most 4: a shard's number takes two bits of a key."""
    spark = df.sparkSession
    rows = df.select(F.coalesce(lang, F.lit("und")).alias("lang"), F.coalesce(text, F.lit("")).alias("text")).withColumn(
        "shard", F.pmod(F.xxhash64("text"), F.lit(min(shards, 4))).cast("int"))
    counted_words = F.regexp_count("text", F.lit(WORD))
    shares = materialize(rows.groupBy("lang", "shard").agg(F.sum(counted_words).alias("n")), "phrase-shares")
    totals = shares.groupBy("lang").agg(F.sum("n").alias("n"))
    # ceil(least * part / whole) in whole numbers
    support = F.expr(f"cast(({least}L * s.n + t.n - 1) div t.n AS INT)")
    supports = shares.alias("s").join(totals.alias("t"), "lang").filter("s.n > 0").select("lang", "shard", support.alias("support"))
    rows = rows.join(broadcast_if_small(supports), ["lang", "shard"])
    n_words = shares.agg(F.sum("n")).first()[0] or 0
    ranges = 1 << (max(n_words // RANGE, RANGES) - 1).bit_length()
    sets: list[Broadcast] = []
    for size in range(1, longest + 1):
        sets.append(spark.sparkContext.broadcast(_bit_set(_mine(rows, sets, size, least, ranges))))
        forget_shuffles(spark)
    counted = _count(rows, sets, longest).groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    found = materialize(counted, "phrase-counts")
    for s in sets:
        s.destroy()
    del counted
    forget_shuffles(spark)
    return found, totals


def _part(begin: Column | int, size: Column | int) -> Column:
    return F.array_join(F.slice("words", begin, size), " ")


def _looked_up(cuts: DataFrame, counts: DataFrame, part: str, name: str) -> DataFrame:
    """Add the count of a part. A part that many phrases share is spread over salts."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    spread = counts.select("lang", F.col("phrase").alias(part), F.col("n").alias(name), salts.alias("salt"))
    return cuts.join(spread, ["lang", part, "salt"])


def collocations(
    df: DataFrame, longest: int = 3, least: int = 10, within: int = 50, top: int = 2000, lang: str = "lang", text: str = "text",
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of 2 words or more.

    ``a`` counts the phrase; of its cuts in two the one of least floor(1000000 a a / (l r)) gives ``l``, ``r`` and
    the score (ties: the first cut). A phrase goes if a longer one that contains it has ``within`` percent of its
    occurrences. ``n`` counts the language's words. Products have 38 digits, exact for ``a`` below 10^15.
    """
    found, totals = frequent_phrases(df, longest, least, lang, text)
    phrases = found.filter("size > 1").withColumnRenamed("n", "a").withColumn("words", F.split("phrase", " "))
    cuts = (
        phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
        .select(
            "lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("first"), _part(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"),
            F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int").alias("salt"))
    )
    parts = found.filter(F.col("size") < longest)
    cuts = _looked_up(_looked_up(cuts, parts, "first", "l"), parts, "rest", "r")
    score = F.expr("(cast(a AS DECIMAL(19,0)) * cast(a AS DECIMAL(19,0)) * 1000000BD) div (cast(l AS DECIMAL(19,0)) * cast(r AS DECIMAL(19,0)))")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner_size = F.explode(F.sequence(F.lit(2), F.col("size") - 1))
    inner = (
        phrases.filter("size > 2").withColumn("inner_size", inner_size)
        .withColumn("begin", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("inner_size") + 1)))
        .groupBy("lang", _part(F.col("begin"), F.col("inner_size")).alias("phrase")).agg(F.max("a").alias("longer"))
    )
    kept = scored.join(inner, ["lang", "phrase"], "left").filter(F.expr(f"longer IS NULL OR 100 * longer < {within} * a"))
    kept = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    # The best of a language are the best of the best of its parts.
    order = [F.desc("score"), F.desc("a"), "phrase"]
    spread = F.pmod(F.xxhash64("phrase"), F.lit(4 * SALTS))
    best = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", spread).orderBy(*order))).filter(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return best.join(broadcast_if_small(totals), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
