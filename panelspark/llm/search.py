"""Exact top-k inner-product search by MaxScore over shards of vectors.

A query's terms are its components. In a shard, a term's bound is the most that it can add to the
score of any vector there. For each group of queries the terms are split by these bounds: the postings of the
essential ones (a shard's columns of those components) are traversed first, and the other terms
are probed only for vectors whose score so far, with the bounds of the others, can still beat
the k-th best score known. The split is where a sample of the shard makes the least work; where bounds
rule too few vectors out, all terms are essential. Shards hand their k-th best scores on to the next of
their lane. Lanes return k rows for each query, and a window merges them.

Vectors that are null or hold null or non-finite components take no part. Ties go to the
smaller id. Fewer than k candidates give all. A query does not meet rows of its own id; other
rows with equal vectors are candidates as any. Vectors of another length than the query's are
padded with zeros. An empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import Batches, map_batches
from panelspark.session import materialize

#: Vectors of a stored shard, and queries that are scored against one at once.
SHARD = 8192
QUERIES = 512

#: Vectors of a shard that are scored by all terms to get a first score to beat.
SEED = 1024

#: Parts that queries and shards are dealt into, and the least and most bytes of a part: a tile of queries, a lane of shards.
PARTS = 8
TILE_BYTES = 256 << 10, 4 << 20
LANE_BYTES = 512 << 10, 32 << 20
MAX_TASKS = 2_000

#: What probing one vector costs, in vectors that are traversed, and a split at all, in shares of a traversal by all terms.
PROBE, SPLIT = 10, 0.1

#: No score yet.
_NONE = np.iinfo(np.int64).min // 2

Vectors = tuple[np.ndarray, np.ndarray]


def quantise(df: DataFrame, scale: int = 64, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """floor(scale * x) of every component; rows that take no part are left out."""
    wide = F.col(embedding).cast("array<double>")
    good = F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & F.forall(
        wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return df.filter(good).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.transform(wide, lambda x: F.floor(x * F.lit(float(scale))).cast("long")).alias("vector"),
    )


def _blocks(df: DataFrame, size: int, name: str) -> DataFrame:
    """Rows packed into blocks of at most ``size`` vectors: block, n, ids, width, kind of number and vectors as binary."""

    def run(batches: Batches) -> Batches:
        ids: list[np.ndarray] = []
        values: list[np.ndarray] = []
        lengths: list[np.ndarray] = []

        def packed(keys: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
            width, low, high = int(sizes.max(initial=0)), flat.min(initial=0), flat.max(initial=0)
            kind = next(k for k in ("<i1", "<i2", "<i4", "<i8") if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
            grid = np.zeros((len(keys), width), kind)
            grid[np.arange(width) < sizes[:, None]] = flat
            return pa.RecordBatch.from_arrays([
                pa.array([len(keys)], pa.int32()), pa.array([keys.astype("<i8").tobytes()], pa.binary()), pa.array([width], pa.int32()),
                pa.array([kind]), pa.array([grid.tobytes()], pa.binary()),
            ], names=["n", "ids", "width", "kind", "grid"])

        def blocks(last: bool) -> Batches:
            keys, flat, sizes = (np.concatenate([np.empty(0, "i8"), *x]) for x in (ids, values, lengths))
            ends = np.concatenate([[0], np.cumsum(sizes)])
            at = 0
            while len(keys) - at >= size or (last and at < len(keys)):
                to = min(at + size, len(keys))
                yield packed(keys[at:to], flat[ends[at] : ends[to]], sizes[at:to])
                at = to
            ids[:], values[:], lengths[:] = [keys[at:]], [flat[ends[at] :]], [sizes[at:]]

        for batch in batches:
            vectors = batch.column("vector")
            ids.append(batch.column("vec_id").to_numpy())
            values.append(vectors.flatten().to_numpy())
            lengths.append(pc.list_value_length(vectors).to_numpy().astype("i8"))
            if sum(map(len, ids)) >= size:
                yield from blocks(last=False)
        yield from blocks(last=True)

    rows = map_batches(df, run, "n int, ids binary, width int, kind string, grid binary")
    return materialize(rows.withColumn("block", F.monotonically_increasing_id()), name)


def _deal(blocks: DataFrame, part: str, least: int, most: int) -> tuple[DataFrame, int]:
    """The blocks with the part each is dealt to, and the number of parts; a part has bounded bytes."""
    sizes = blocks.selectExpr("block", "n * CAST(width * CAST(right(kind, 1) AS INT) + 8 AS BIGINT) AS bytes").orderBy("block").collect()
    each = min(max(sum(r.bytes for r in sizes) // PARTS, least), most)
    dealt, taken = [], 0
    for r in sizes:
        dealt.append((r.block, taken // each))
        taken += r.bytes
    parts = blocks.sparkSession.createDataFrame(dealt, f"block long, {part} int")
    return blocks.join(F.broadcast(parts), "block").drop("block", "n"), max(taken - 1, 0) // each + 1


def _read(blocks: pa.Table) -> list[Vectors]:
    """The blocks' ids and vectors, by id."""
    out = []
    for ids, width, kind, grid in zip(*(blocks[c].to_pylist() for c in ("ids", "width", "kind", "grid")), strict=True):
        keys = np.frombuffer(ids, "<i8")
        order = np.argsort(keys, kind="stable")
        out.append((keys[order], np.frombuffer(grid, kind).reshape(len(keys), width)[order]))
    return sorted(out, key=lambda x: int(x[0][0]))


def _joined(blocks: list[Vectors]) -> Vectors:
    width = max(x.shape[1] for _, x in blocks)
    return np.concatenate([ids for ids, _ in blocks]), np.concatenate([_padded(x.astype("i8"), width) for _, x in blocks])


def _padded(x: np.ndarray, width: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, width - x.shape[1]))) if x.shape[1] < width else x


class Best:
    """The k best rows so far of each query, and the score that others have to reach."""

    def __init__(self, queries: int, k: int):
        self.k, self.queries = k, queries
        self.to_beat = np.full(queries, _NONE)
        self.last_id = np.full(queries, np.iinfo(np.int64).max)
        self.kept = [np.empty(0, "i8")] * 3  # query, id, score
        self.found: list[tuple[np.ndarray, ...]] = []
        self.waiting = 0

    def add(self, at: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Rows found, by query and id."""
        self.found.append((at, ids, scores))
        self.waiting += len(at)
        if self.waiting > self.queries * self.k:
            self.merge()

    def merge(self) -> list[np.ndarray]:
        at, ids, scores = (np.concatenate(x) for x in zip(self.kept, *self.found, strict=True))
        order = np.lexsort((ids, -scores, at))
        at, ids, scores = at[order], ids[order], scores[order]
        first = np.searchsorted(at, np.arange(self.queries))
        best = np.arange(len(at)) - first[at] < self.k
        self.kept, self.found, self.waiting = [at[best], ids[best], scores[best]], [], 0
        full = np.flatnonzero(np.bincount(at, minlength=self.queries) >= self.k)
        self.to_beat[full], self.last_id[full] = scores[first[full] + self.k - 1], ids[first[full] + self.k - 1]
        return self.kept


def _essential(q: np.ndarray, postings: np.ndarray, rest: np.ndarray, to_beat: np.ndarray) -> int:
    """How many terms to traverse first: of the splits, the one with the least work for a sample of the shard.

    Terms come by falling bound; ``rest`` is what those behind each can still add.
    """
    width = q.shape[1]
    if width < 2:
        return width
    some, few = slice(None, None, len(q) // 16 + 1), slice(None, None, postings.shape[1] // 32 + 1)
    so_far = np.cumsum(q[some, :, None] * postings[None, :, few], 1)
    share = (so_far + rest[some, :, None] >= to_beat[some, None, None]).mean((0, 2))
    done = np.arange(1, width + 1) / width
    return int(np.argmin(done + np.where(done < 1, SPLIT + PROBE * share * (1 - done), 0))) + 1


def tile_top(queries: Vectors, shards: Iterable[Vectors], k: int) -> list[np.ndarray]:
    """The k best rows of some shards for each of some queries: query ids, ids and scores. A shard's rows come by id."""
    query_ids, whole = queries
    best = Best(len(query_ids), k)
    for ids, x in shards:
        width = max(whole.shape[1], x.shape[1])
        whole, x = _padded(whole, width), _padded(x, width)
        largest = int(np.abs(whole).max(initial=0)) * int(np.abs(x.astype("i8")).max(initial=0)) * max(width, 1)
        # Sums of scores and bounds are whole numbers, and exact in any of these.
        kind = np.float32 if largest < 1 << 23 else np.float64 if largest < 1 << 52 else np.int64
        postings = np.ascontiguousarray(x.T).astype(kind)
        low, high = postings.min(1, initial=0), postings.max(1, initial=0)
        for begin in range(0, len(query_ids), QUERIES):
            rows = slice(begin, begin + QUERIES)
            own, q, to_beat = query_ids[rows], whole[rows].astype(kind), best.to_beat[rows]
            if (to_beat == _NONE).any():
                to_beat = np.maximum(to_beat, _kth(q @ postings[:, : max(SEED, k + 1)], own, ids[: max(SEED, k + 1)], k))
            most = np.maximum(q * low, q * high)  # what a term can add, by query and term
            order = np.argsort(-most.sum(0), kind="stable")
            q, by_bound = q[:, order], postings[order]
            rest = most.sum(1, keepdims=True) - np.cumsum(most[:, order], 1)
            n = _essential(q, by_bound, rest, to_beat)
            scores = q[:, :n] @ by_bound[:n]
            behind = rest[:, n - 1] if n else np.zeros(len(q), kind)
            at, to = np.divmod(np.flatnonzero(scores >= (to_beat - behind.astype("i8")).astype(kind)[:, None]), max(len(ids), 1))
            found = np.empty(len(at), np.int64)
            for part in range(0, len(at), 1 << 16):
                a, t = at[part : part + (1 << 16)], to[part : part + (1 << 16)]
                found[part : part + (1 << 16)] = scores[a, t] + (np.einsum("pd,dp->p", q[a, n:], by_bound[n:, t]) if n < width else 0)
            # Of equal scores only the k smallest ids of a shard can be among the best, and none behind the last one kept.
            above, equal = found > to_beat[at], found == to_beat[at]
            equal &= (ids[to] < best.last_id[rows][at]) | (best.to_beat[rows][at] < to_beat[at])
            other = ids[to] != own[at]
            ranks = np.cumsum(equal & other)
            before = np.concatenate([[0], ranks])[np.searchsorted(at, np.arange(len(own)))]
            good = other & (above | (equal & (ranks - before[at] <= k)))
            best.add(at[good] + begin, ids[to[good]], found[good])
    at, ids, scores = best.merge()
    return [query_ids[at], ids, scores]


def _kth(scores: np.ndarray, query_ids: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The k-th best of these scores without a query's own rows; _NONE if there are fewer."""
    if scores.shape[1] < k:
        return np.full(len(scores), _NONE)
    least = _NONE if scores.dtype == np.int64 else -np.inf
    kth = np.partition(np.where(query_ids[:, None] == ids[None, :], least, scores), -k, 1)[:, -k]
    return np.where(kth == least, _NONE, kth).astype(np.int64)


def top_k(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of each query.

    ``vectors`` has vec_id and an integer vector. Tiles of queries meet all lanes of shards, which is the
    work asked for; a task sees one tile and one lane, of bounded size, whatever the input.
    """
    tiled, tiles = _deal(_blocks(vectors.filter(is_query), SHARD, "search-queries"), "tile", *TILE_BYTES)
    laned, lanes = _deal(_blocks(vectors, SHARD, "search-shards"), "lane", *LANE_BYTES)
    key, tasks = ["tile", "lane"], min(MAX_TASKS, 2 * tiles * lanes)

    def every(df: DataFrame, part: str, parts: int):
        return df.withColumn(part, F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).repartition(tasks, *key).groupBy(*key)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        both = left.num_rows and right.num_rows
        found = tile_top(_joined(_read(left)), _read(right), k) if both else [np.empty(0, "i8")] * 3
        return pa.table(dict(zip(("query_id", "vec_id", "score"), found, strict=True)))

    pairs = every(tiled, "lane", lanes).cogroup(every(laned, "tile", tiles))
    found = pairs.applyInArrow(run, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
