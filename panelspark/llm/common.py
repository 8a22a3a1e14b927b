"""Helpers shared by the training-data operators: tables, folds, batches, byte-level hashing."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch. A batch of the usual web texts is a few MB.
BATCH_ROWS = 1000

#: Multipliers of the two polynomial hashes modulo 2**64.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

Batches = Iterator[pa.RecordBatch]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_column: str, folds: int) -> Column:
    """The fold of a row: crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.col(id_column).cast("string")) % F.lit(folds)


def map_batches(df: DataFrame, function: Callable[[Batches], Batches], schema: str) -> DataFrame:
    """``mapInArrow`` over batches of at most BATCH_ROWS rows, so that long texts fit in a worker."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(function, schema)


def free_models(*others: str) -> None:
    """Drop what other operators' modules keep in this worker between tasks, and give their memory back."""
    held = [m._loaded for m in (sys.modules.get(f"panelspark.llm.{name}") for name in others) if m is not None and m._loaded]
    for models in held:
        models.clear()
    if held:
        gc.collect()
        with contextlib.suppress(OSError, AttributeError):  # not every C library can
            ctypes.CDLL(None).malloc_trim(0)


def forget_shuffles(spark: SparkSession) -> None:
    """Have Spark's cleaner drop the shuffle files of plans that nothing refers to any more; else they wait for chance."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def texts_of(batch: pa.RecordBatch, name: str) -> list[str]:
    """A text column; null becomes the empty text."""
    return [x or "" for x in batch.column(name).to_pylist()]


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that all bits depend on all bits."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(30))


_powers: dict[int, np.ndarray] = {}


def powers(value: int, n: int) -> np.ndarray:
    """The first ``n`` powers of a value modulo 2**64."""
    if len(_powers.get(value, ())) < n:
        steps = np.full(max(n, 1 << 20), value, np.uint64)
        steps[0] = 1
        _powers[value] = np.cumprod(steps)
    return _powers[value][:n]


class Bytes:
    """The UTF-8 bytes of several texts in one array, with hashes of any of their substrings."""

    def __init__(self, texts: list[str] | list[bytes], fold_case: bool = False):
        parts = [t if isinstance(t, bytes) else t.encode("utf-8", "surrogatepass") for t in texts]
        self.sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        self.starts = np.zeros(len(parts) + 1, np.int64)
        np.cumsum(self.sizes, out=self.starts[1:])
        self.data = np.frombuffer(b"".join(parts), np.uint8)
        if fold_case:
            self.data = _LOWER[self.data]
        self._sums: dict[int, np.ndarray] = {}

    def hashes(self, begin: np.ndarray | slice, end: np.ndarray | slice, which: int = 0) -> np.ndarray:
        """Hashes of the byte ranges [begin, end); equal content has equal hashes."""
        base = _BASES[which]
        if which not in self._sums:
            sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * powers(base, len(self.data)), out=sums[1:])
            self._sums[which] = sums
        sums = self._sums[which]
        return mix((sums[end] - sums[begin]) * powers(pow(base, -1, 1 << 64), len(sums))[begin])


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[0x30:0x3A] = _IS_WORD[0x61:0x7B] = _IS_WORD[0x80:] = True


#: Bytes of words that are hashed at once, so that a long text needs no powers of its length.
_WORD_BLOCK = 1 << 20


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of several texts, and where each text's words begin (one more entry).

    A-Z are lower-cased; words are runs of 0-9, a-z and characters beyond ASCII.
    """
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    starts = np.zeros(len(parts) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)), out=starts[1:])
    data = _LOWER[np.frombuffer(b"".join(parts), np.uint8)]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _IS_WORD[data]
    opens = inside[1:] & ~inside[:-1]
    closes = ~inside[1:] & inside[:-1]
    edges = starts[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    joined = edges[inside[edges] & inside[edges + 1]]  # words that touch across two texts
    opens[joined] = closes[joined] = True
    begin, end = np.flatnonzero(opens), np.flatnonzero(closes)
    hashes = np.zeros(len(begin), np.uint64)
    first = 0
    while first < len(begin):
        last = max(first + 1, int(np.searchsorted(end, begin[first] + _WORD_BLOCK, "right")))
        low = begin[first]
        block = Bytes([data[low : end[last - 1]].tobytes()])
        hashes[first:last] = block.hashes(begin[first:last] - low, end[first:last] - low)
        first = last
    return hashes, np.searchsorted(begin, starts)


def byte_slices(batches: Batches, *columns: str, limit: int = 1 << 20) -> Batches:
    """The batches in slices of rows with about ``limit`` bytes in these columns; a longer text is a slice of its own."""
    for batch in batches:
        sizes = np.zeros(batch.num_rows, np.int64)
        for column in columns:
            sizes += pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        parts = np.cumsum(sizes) // limit
        edges = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), batch.num_rows]
        for begin, end in zip(edges, edges[1:], strict=False):
            if end > begin:
                yield batch.slice(begin, end - begin)
