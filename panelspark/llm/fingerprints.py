"""Document fingerprints by winnowing, and the likeness of documents by them.

Every run of K code points (a gram) of a text is hashed. Of each WINDOW consecutive grams the one of least hash
is chosen, the rightmost of equal ones, and kept with its position. So two texts that share
K + WINDOW - 1 code points in a row share a fingerprint there, and none is chosen by texts that
share fewer than K. Likeness is the share of common fingerprints among all of two texts, each as often as it is chosen.

A text shorter than K is one gram; an empty or null text has no fingerprint. A text of fewer than WINDOW
grams has one window. Two texts without fingerprints are alike (1.0). Equal texts have equal fingerprints,
repeated rows give rows as any. Long texts are hashed whole, one at a time, at about 60 bytes of memory a code
point. Empty tables give no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import Batches, mix, texts_of

K = 8
WINDOW = 12

#: Code points hashed at once, but for a longer text.
CHUNK = 1 << 20

#: Rows that fix the cuts between parts of the id order; a bound of the sample, not of the parts' rows.
SAMPLE = 50_000

_BASE = 0x9E3779B97F4A7C15
_NONE = np.uint64((1 << 64) - 1)
_PAD = 0x110000  # no code point


def gram_hashes(points: np.ndarray, k: int) -> np.ndarray:
    """Hashes of 32 bits of all runs of ``k`` code points, rolled together from runs of half their length."""
    run, length = points.astype(np.uint64) + np.uint64(1), 1
    for bit in bin(k)[3:]:
        shift = np.uint64(pow(_BASE, length, 1 << 64))
        run = run[:-length] * shift + run[length:]
        length *= 2
        if bit == "1":
            run = run[:-1] * np.uint64(_BASE) + points[length : length + len(run) - 1].astype(np.uint64) + np.uint64(1)
            length += 1
    return mix(run) >> np.uint64(32)


def winnow(texts: list[str], k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chosen hashes of several texts, their positions in code points, and where each text's begin (one more entry)."""
    least = k + window - 1
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    padded = np.maximum(lengths, least)
    starts = np.concatenate([[0], np.cumsum(padded)])
    points = np.full(int(starts[-1]), _PAD, np.uint32)
    for text, start, n in zip(texts, starts.tolist(), lengths.tolist(), strict=False):
        if n:
            points[start : start + n] = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    if not len(points):
        return np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    grams = gram_hashes(points, k)
    at = np.arange(len(grams), dtype=np.uint64)
    # The least of these is the least hash, and the rightmost of equal ones. Grams of padding are never chosen.
    low = (grams << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - at)
    text_of = np.repeat(np.arange(len(texts)), padded)[: len(grams)]
    inside = at.astype(np.int64) - starts[text_of]
    low[(inside > np.maximum(lengths - k, 0)[text_of]) | (lengths[text_of] == 0)] = _NONE
    span = 1
    while 2 * span <= window:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < window:
        low = np.minimum(low[: len(low) - (window - span)], low[window - span :])
    n = len(low)
    low = low[(inside[:n] <= (padded - least)[text_of[:n]]) & (low != _NONE)]
    low = low[np.concatenate([[True], low[1:] != low[:-1]])] if len(low) else low
    place = np.int64(0xFFFFFFFF) - (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    bounds = np.searchsorted(place, starts)
    return (low >> np.uint64(32)).astype(np.uint32), place - np.repeat(starts[:-1], np.diff(bounds)), bounds


def _hex(hashes: np.ndarray, bounds: np.ndarray) -> list[str]:
    """Each text's hashes in order of position, 8 hexadecimal digits each."""
    digits = hashes.astype(">u4").tobytes().hex()
    return [digits[8 * a : 8 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def _counts(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct pairs of text number and hash, as one number, and how often each is chosen."""
    text_of = np.repeat(np.arange(len(bounds) - 1, dtype=np.uint64), np.diff(bounds))
    return np.unique(text_of << np.uint64(32) | hashes.astype(np.uint64), return_counts=True)


def _likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], n: int) -> np.ndarray:
    """Common fingerprints among all, text by text, each counted as often as it is chosen."""

    def total(pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return np.bincount((pairs >> np.uint64(32)).astype(np.int64), counts, n)

    shared, in_a, in_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = total(shared, np.minimum(a[1][in_a], b[1][in_b]))
    most = total(*a) + total(*b) - common
    return np.where(most > 0, common / np.maximum(most, 1), 1.0)


def _runs(texts: list[str], limit: int) -> Iterator[slice]:
    """Consecutive texts of about ``limit`` code points together, and at least one."""
    begin = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield slice(begin, i)
            begin = i
            size = 0
        size += len(text) + K
    if begin < len(texts):
        yield slice(begin, len(texts))


def fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K, window: int = WINDOW) -> DataFrame:
    """doc_id, hashes and their positions in code points, for each row."""
    key = df.schema[doc_id].dataType.simpleString()

    def run(batches: Batches) -> Batches:
        for batch in batches:
            texts = texts_of(batch, "text")
            for part in _runs(texts, CHUNK):
                hashes, places, bounds = winnow(texts[part], k, window)
                offsets = pa.array(bounds.astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(part.start, part.stop - part.start),
                    pa.ListArray.from_arrays(offsets, pa.array(hashes.astype(np.int64))),
                    pa.ListArray.from_arrays(offsets, pa.array(places)),
                ], names=["doc_id", "hashes", "positions"])

    named = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return named.mapInArrow(run, f"doc_id {key}, hashes array<long>, positions array<long>")


COMPARED = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited(text: str, following: str) -> str:
    """The text with the last third of its code points replaced by as many first ones of another (or all)."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def _compare(texts: list[str]) -> list[pa.Array]:
    """The columns of COMPARED for all texts but the last, each against the one behind it."""
    n = len(texts) - 1
    changed = [edited(a, b) for a, b in zip(texts[:-1], texts[1:], strict=True)]
    hashes, _, bounds = winnow(texts)
    changed_hashes, _, changed_bounds = winnow(changed)
    own, after = _counts(hashes[: bounds[n]], bounds[: n + 1]), _counts(hashes[bounds[1] :], bounds[1:] - bounds[1])
    return [
        pa.array([len(t) for t in texts[:-1]], pa.int64()),
        pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed], pa.string()),
        pa.array(_hex(hashes, bounds)[:n], pa.string()), pa.array(_hex(changed_hashes, changed_bounds), pa.string()),
        pa.array(_likeness(own, _counts(changed_hashes, changed_bounds), n)), pa.array(_likeness(own, after, n)),
    ]


def _sortable(ids: np.ndarray, known: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Keys as bytes that sort by falling id, rows without one last, then by hash."""
    top = np.uint64(1 << 63)
    falling = ~(ids.astype(np.int64).view(np.uint64) ^ top)
    out = np.zeros(len(ids), dtype=[("last", "u1"), ("id", ">u8"), ("hash", ">u8"), ("end", "u1")])
    out["last"], out["id"] = ~known, np.where(known, falling, np.uint64(0))
    out["hash"], out["end"] = hashes.astype(np.int64).view(np.uint64) ^ top, 1
    return np.frombuffer(out.tobytes(), "S18")


def next_compared(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row by falling id, its fingerprint against its edited text's and the next row's.

    Rows of equal id follow by a hash of their text, rows without an id come last, and the row behind the last
    is the first. Ids are whole numbers. The order is cut into parts of like size at sampled rows. The first
    row of a part goes to the part before it too, so that each part has all neighbours, and texts are
    shuffled once. Only a group of equal rows (id and text) is never cut; a task streams through it.
    """
    spark = df.sparkSession
    key = df.schema[doc_id].dataType.simpleString()
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("hash"))
    id_, known, hash_ = F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNotNull().alias("known"), F.col("hash")
    n = df.count()
    if not n:
        return spark.createDataFrame([], f"doc_id {key}, {COMPARED}")
    n_parts = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    sampled = docs.sample(min(1.0, 100 * n_parts / n, SAMPLE / n), seed=7).select(id_, known, hash_).toPandas()
    last_id = docs.agg(F.max("doc_id")).first()[0]
    first = docs.filter(F.col("doc_id").eqNullSafe(F.lit(last_id))).select(id_, known, hash_).orderBy("hash").limit(1).toPandas()
    top, others = (np.unique(_sortable(*(x[c].to_numpy() for c in ("id", "known", "hash")))) for x in (first, sampled))
    cuts = others[:: max(1, len(others) // n_parts)]
    cuts = np.concatenate([top, cuts[cuts > top[0]]])  # the first rows of the parts

    @F.pandas_udf("array<int>")
    def parts_of(ids: pd.Series, known: pd.Series, hashes: pd.Series) -> pd.Series:
        own = _sortable(ids.to_numpy(), known.to_numpy(), hashes.to_numpy())
        part = np.searchsorted(cuts, own, "right") - 1
        heads = cuts[part] == own
        return pd.Series([[p, -1 - (p - 1) % len(cuts)] if h else [p] for p, h in zip(part.tolist(), heads.tolist(), strict=True)])

    placed = (
        docs.withColumn("at", F.explode(parts_of(id_, known, hash_)))
        .select("doc_id", "text", "hash", F.when(F.col("at") < 0, -1 - F.col("at")).otherwise(F.col("at")).alias("part"), (F.col("at") < 0).alias("after"))
    )
    # A part's copy of the next part's first row sorts behind its own rows.
    ordered = placed.repartition("part").sortWithinPartitions("part", "after", F.col("doc_id").desc_nulls_last(), "hash")

    def run(batches: Batches) -> Batches:
        waiting: tuple | None = None  # the last row, whose successor is still to come
        for batch in batches:
            texts, parts, after = texts_of(batch, "text"), batch.column("part").to_pylist(), batch.column("after").to_pylist()
            ids = batch.column("doc_id").to_pylist()
            for cut in _runs(texts, CHUNK):
                rows = list(zip(ids[cut], texts[cut], parts[cut], after[cut], strict=True))
                rows = [waiting, *rows] if waiting is not None else rows
                # A row has a successor here unless it is the copy that ends its part.
                columns = _compare([r[1] for r in rows])
                keep = pa.array([not a[3] and a[2] == b[2] for a, b in zip(rows[:-1], rows[1:], strict=True)], pa.bool_())
                found = pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows[:-1]], pa.int64()), *columns], names=["doc_id", *(c.split()[0] for c in COMPARED.split(", "))])
                yield found.filter(keep)
                waiting = rows[-1]

    compared = ordered.select("doc_id", "text", "part", "after").mapInArrow(run, f"doc_id long, {COMPARED}")
    return compared.withColumn("doc_id", F.col("doc_id").cast(key))
