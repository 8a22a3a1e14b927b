"""Removal of byte strings that occur earlier in the corpus.

A byte is removed where some LENGTH-byte string that covers it also starts earlier: in a smaller
id, or in the same document ahead. Strings are judged on the input.

Suffixes are sampled where the hash of the next SEED bytes is least among all seeds of a window,
so that equal windows share their sampled suffix. Consecutive windows with one sampled suffix
are a zone. Zones carry (key, content, id, start, length) tuples through Spark's external sorts
and aggregates: keys that occur once are dropped, save where the sampled seed stands twice in the zone,
as in a periodic run that may repeat its own windows; of zones with equal content the first stays and
windows of the others are all repeats; where one key has different contents, or its seed stands twice,
the first zone of each content is cut out and sampled anew by longer seeds. What is open after that is decided by comparing windows,
of which each cut out run sends different ones only.
Copies of whole documents are settled ahead by their digest.

Null and empty texts have no bytes. Texts shorter than LENGTH lose nothing. Rows with a null id
take no part and are returned whole. Repeated rows of one id are one document: neither is
earlier than the other. An empty table gives no rows. Extra columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import Batches, Bytes, forget_shuffles, map_batches, texts_of
from panelspark.session import broadcast_if_small, materialize

LENGTH = 100
#: Seed of the first sampling, and of the second, whose zones are shorter and rarely share a key by chance.
SEED, LONG_SEED = 40, 90
#: Bytes of text that are hashed at once; their arrays take about a hundred times that.
PART_BYTES = 1 << 20


def _parts(batches: Batches, column: str) -> Batches:
    """The batches in slices of rows with about PART_BYTES in a column."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        parts = np.cumsum(sizes.astype(np.int64)) // PART_BYTES
        edges = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), batch.num_rows]
        for begin, end in zip(edges, edges[1:], strict=False):
            if end > begin:
                yield batch.slice(begin, end - begin)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of ``width`` consecutive values, by doubling."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _stands_twice(seeds: np.ndarray, least: np.ndarray, begin: np.ndarray, end: np.ndarray, width: int) -> np.ndarray:
    """Whether the least seed of each zone stands at two places in it; only then can windows of one zone be equal."""
    key = least[begin]
    first, last = np.zeros_like(begin), np.zeros_like(begin)
    for place, edge, order in ((first, begin, range(width)), (last, end - 1, range(width - 1, -1, -1))):
        left = np.arange(len(begin))
        for k in order:
            at = edge[left] + k
            hit = seeds[at] == key[left]
            place[left[hit]] = at[hit]
            left = left[~hit]
    return first < last


def zones_of(texts: list[str] | list[bytes], seed: int = SEED) -> tuple[np.ndarray, ...]:
    """Zones of several texts: text number, start, windows, key, two content hashes and whether the seed stands twice."""
    bytes_ = Bytes(texts)
    n = len(bytes_.data)
    if n < LENGTH:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.int64, np.int64, bool))
    seeds = bytes_.hashes(slice(0, n - seed + 1), slice(seed, n + 1))
    least = _sliding_min(seeds, LENGTH - seed + 1)
    starts = bytes_.starts
    owner = np.repeat(np.arange(len(texts)), bytes_.sizes)[: len(least)]
    inside = np.arange(len(least)) + LENGTH <= starts[owner + 1]
    change = np.ones(len(least), bool)
    change[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1]) | (inside[1:] != inside[:-1])
    begin = np.flatnonzero(change)
    end = np.append(begin[1:], len(least))
    begin, end = begin[inside[begin]], end[inside[begin]]
    signed = lambda x: x.view(np.int64)
    return (
        owner[begin], begin - starts[owner[begin]], end - begin, signed(least[begin]),
        signed(bytes_.hashes(begin, end + LENGTH - 1)), signed(bytes_.hashes(begin, end + LENGTH - 1, 1)),
        _stands_twice(seeds, least, begin, end, LENGTH - seed + 1),
    )


def _zones(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """Zones of the texts, or of runs cut out of them at ``base``."""
    column = "text" if "text" in docs.columns else "cut"

    def run(batches: Batches) -> Batches:
        for batch in _parts(batches, column):
            ids, base = (np.array(batch.column(c).to_pylist(), np.int64) for c in ("doc_id", "base"))
            texts = texts_of(batch, "text") if column == "text" else batch.column("cut").to_pylist()
            owner, start, n, key, content, check, twice = zones_of(texts, seed)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (key, content, check, ids[owner], base[owner], start + base[owner], n, twice)],
                names=["key", "content", "check", "doc_id", "base", "start", "n", "twice"])

    return map_batches(
        docs.select("doc_id", "base", column), run, "key long, content long, check long, doc_id long, base long, start long, n long, twice boolean")


def _cuts(docs: DataFrame) -> DataFrame:
    """The bytes of the listed zones, those of zones side by side in one: doc_id, base, cut."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            keys, bases, cuts = [], [], []
            for key, text, zones in zip(
                    batch.column("doc_id").to_pylist(), texts_of(batch, "text"), batch.column("zones").to_pylist(), strict=True):
                data = text.encode("utf-8", "surrogatepass")
                for start, end in _joined(zones):
                    keys.append(key)
                    bases.append(start)
                    cuts.append(data[start : end + LENGTH - 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(bases, pa.int64()), pa.array(cuts, pa.binary())], names=["doc_id", "base", "cut"])

    return map_batches(docs.select("doc_id", "text", "zones"), run, "doc_id long, base long, cut binary")


def _joined(zones: list[dict]) -> list[list[int]]:
    """Start and end of runs of windows from zones, where one begins at another's end in one."""
    out: list[list[int]] = []
    for start, n in sorted({(z["start"], z["n"]) for z in zones}):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], start + n)
        else:
            out.append([start, start + n])
    return out


def _windows(cuts: DataFrame) -> DataFrame:
    """Every different window of the listed zones: two hashes, doc_id, start. Those that a cut repeats come without hashes, as runs."""

    def run(batches: Batches) -> Batches:
        for batch in _parts(batches, "cut"):
            bytes_ = Bytes(batch.column("cut").to_pylist())
            bases, ids = (np.array(batch.column(c).to_pylist(), np.int64) for c in ("base", "doc_id"))
            spans = [(i, a, b) for i, zones in enumerate(batch.column("zones").to_pylist()) for a, b in _joined(zones)]
            row, start, end = np.array(spans, np.int64).reshape(-1, 3).T
            sizes = end - start
            owner = np.repeat(row, sizes)
            at = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes - start, sizes)
            begin = at - bases[owner] + bytes_.starts[owner]
            content, check = (bytes_.hashes(begin, begin + LENGTH, which).view(np.int64) for which in (0, 1))
            order = np.lexsort((at, check, content, owner))
            same = np.ones((3, max(len(order) - 1, 0)), bool)
            for k, x in enumerate((owner, content, check)):
                same[k] = x[order[1:]] == x[order[:-1]]
            repeated = np.zeros(len(order), bool)
            repeated[order[1:]] = same.all(0)
            first, again = np.flatnonzero(~repeated), np.flatnonzero(repeated)
            new = np.ones(len(again), bool)
            new[1:] = (np.diff(at[again]) != 1) | (np.diff(owner[again]) != 0)
            runs = np.flatnonzero(new)
            lengths = np.diff(np.append(runs, len(again)))
            runs = again[runs]
            places = np.concatenate([first, runs])
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([pa.array(x[first]), pa.nulls(len(runs), pa.int64())]) for x in (content, check)
            ] + [
                pa.array(ids[owner[places]]), pa.array(at[places]),
                pa.array(np.concatenate([np.ones(len(first), np.int64), lengths])),
            ], names=["content", "check", "doc_id", "start", "n"])

    return map_batches(cuts.select("doc_id", "base", "cut", "zones"), run, "content long, check long, doc_id long, start long, n long")


def _stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a stored table, without the shuffle files that led to them."""
    table = materialize(df, name)
    forget_shuffles(df.sparkSession)
    return table


def _later(rows: DataFrame) -> DataFrame:
    """The rows whose content also occurs at an earlier place."""
    place = F.struct("doc_id", "start")
    first = rows.groupBy("content", "check").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("k"))
    first = first.filter("k > 1").drop("k")
    return rows.join(first, ["content", "check"]).filter(place > F.col("first"))


def _several(zones: DataFrame) -> DataFrame:
    """The keys of several rows, or of a seed that stands twice in a zone."""
    return zones.groupBy("key").agg(F.count(F.lit(1)).alias("k"), F.max("twice").alias("twice")).filter("k > 1 or twice").select("key")


def _open(zones: DataFrame) -> DataFrame:
    """The first zone of each content, where a key has several contents or its seed stands twice."""
    one = zones.groupBy("key", "content", "check").agg(
        F.min(F.struct("doc_id", "start", "n", "base")).alias("z"), F.max("twice").alias("twice"))
    one = _stored(one, "repeats-contents")
    mixed = _several(one)
    return one.join(mixed, "key").select("z.*")


def find_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and the repeated windows of each document that has some, as (start, n) runs."""
    docs = docs.filter(F.col("doc_id").isNotNull() & (F.octet_length("text") >= LENGTH))
    keyed = docs.select("doc_id", F.octet_length("text").alias("size"), F.md5("text").alias("digest"))
    firsts = keyed.groupBy("digest", "size").agg(F.min("doc_id").alias("doc_id"))
    copies = _stored(keyed.join(firsts.select("doc_id"), "doc_id", "left_anti").select("doc_id", "size"), "repeats-copies")
    own = docs.join(broadcast_if_small(copies.select("doc_id")), "doc_id", "left_anti")

    own = own.withColumn("base", F.lit(0).cast("long"))
    shared = _stored(_several(_zones(own)), "repeats-keys")
    zones = _stored(_zones(own).join(broadcast_if_small(shared, 2_000_000), "key"), "repeats-zones")
    edges = _open(zones).groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("zones"))
    cuts = _stored(_cuts(own.join(edges, "doc_id")), "repeats-cuts")

    inner = _stored(_zones(cuts, LONG_SEED), "repeats-inner-zones")
    left = _open(inner).groupBy("doc_id", "base").agg(F.collect_list(F.struct("start", "n")).alias("zones"))
    windows = _stored(_windows(cuts.join(left, ["doc_id", "base"])), "repeats-windows")

    later = [
        _stored(_later(rows).select("doc_id", "start", "n"), "repeats-later")
        for rows in (zones, inner, windows.filter("content is not null"))
    ]
    runs = (
        later[0].unionByName(later[1]).unionByName(later[2])
        .unionByName(windows.filter("content is null").select("doc_id", "start", "n"))
        .unionByName(copies.select("doc_id", F.lit(0).cast("long").alias("start"), (F.col("size") - LENGTH + 1).cast("long").alias("n")))
    )
    return _stored(runs.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "n"))).alias("runs")), "repeats-runs")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (start and end of removed runs) and the bytes kept."""
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    joined = own.join(find_repeats(own), "doc_id", "left")

    def run(batches: Batches) -> Batches:
        for batch in batches:
            out: list[tuple] = []
            for key, value, runs in zip(batch.column("doc_id").to_pylist(), texts_of(batch, "text"), batch.column("runs").to_pylist(), strict=True):
                data = value.encode("utf-8", "surrogatepass")
                spans: list[list[int]] = []
                for r in runs or ():
                    start, end = r["start"], r["start"] + r["n"] + LENGTH - 1
                    if spans and start <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], end)
                    else:
                        spans.append([start, end])
                kept, at = [], 0
                for start, end in spans:
                    kept.append(data[at:start])
                    at = end
                kept.append(data[at:])
                out.append((key, len(data), sum(b - a for a, b in spans), spans, b"".join(kept)))
            yield pa.RecordBatch.from_arrays([
                pa.array([r[i] for r in out], t) for i, t in
                enumerate((pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.binary()))
            ], names=["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    return map_batches(joined, run, "doc_id long, n_bytes long, n_removed long, spans array<array<long>>, kept binary")
