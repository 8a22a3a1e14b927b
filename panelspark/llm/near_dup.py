"""Near-duplicate classes by improved consistent weighted sampling.

Texts become multisets of shingles of SHINGLE consecutive words (all words, where there are
fewer). A shingle weighs its count times its inverse document frequency; frequencies are
counted over all documents in DF_BUCKETS hashed counters, so the table has one size
at any scale. Consistent weighted samples of that multiset are grouped into bands; texts that
share a band are candidates, and those whose weighted Jaccard similarity reaches the
threshold are linked. Classes are the connected components of the links.

Texts with equal words are one class from the start and take part as one. In a band's bucket every text
is compared with the one that has most neighbours over all bands; what is not yet in that one's component
is then compared with those of the bucket's other components whose folded weights allow the similarity, so
that no link between components is lost though a group is not expanded into all its pairs.

Texts without words (null, empty, symbols) are each a class of their own. Long texts are worked on one at a time,
at about forty times their bytes. Rows with a null id have
a null class. Repeated rows repeat with the same class. An empty table gives no rows; extra
columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import Batches, byte_slices, map_batches, mix, texts_of, word_hashes
from panelspark.session import broadcast_if_small, materialize

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 6
DF_BUCKETS = 1 << 16

#: How much more a unique shingle weighs than one in every document. A text copied a thousand times makes its
#: own shingles frequent, so a large emphasis would hide the copies behind their few edits.
EMPHASIS = 0.1

#: Random triples (r, log c, beta) of the sampling, drawn once; a shingle and a sample number pick one.
POOL = 1 << 16

#: Shingles folded by hash into so many sums of weights. Folding never lowers a weighted Jaccard similarity, so
#: texts whose folded sums stay below the threshold are told apart without reading them.
FOLDS = 128


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles and counts of each text, where each text's begin, and its word sequence's hash."""
    hashes, starts = word_hashes(texts)
    sizes = np.diff(starts)
    n = np.where(sizes >= SHINGLE, sizes - SHINGLE + 1, np.minimum(sizes, 1))
    owner = np.repeat(np.arange(len(texts)), n)
    first = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(first[-1]) - first[owner] + starts[owner]
    value = np.zeros(len(at), np.uint64)
    for step in range(SHINGLE):
        there = at + step < starts[owner + 1]
        word = hashes[np.minimum(at + step, max(len(hashes) - 1, 0))] if len(hashes) else value
        value = np.where(there, mix(value * np.uint64(0x9E3779B97F4A7C15) + word), value)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(value)))
    return value[at], counts, np.searchsorted(owner[at], np.arange(len(texts) + 1)), sizes


def copy_keys(texts: list[str]) -> list[tuple[int, int]]:
    """Two hashes of each text's word sequence."""
    hashes, starts = word_hashes(texts)
    out = []
    for seed in (1, 2):
        position = np.arange(len(hashes)) - np.repeat(starts[:-1], np.diff(starts))
        mixed = mix(hashes + mix(position.astype(np.uint64) * np.uint64(2) + np.uint64(seed)))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed)])
        out.append((sums[starts[1:]] - sums[starts[:-1]]).view(np.int64).tolist())
    return list(zip(*out, strict=True))


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Counters of shingles by hash bucket over all documents, and the number of documents with words."""

    def run(batches: Batches) -> Batches:
        counts, n = np.zeros(DF_BUCKETS + 1, np.int64), 0
        for batch in byte_slices(batches, "text"):
            value, _, _, sizes = shingles(texts_of(batch, "text"))
            counts[:-1] += np.bincount((value >> np.uint64(48)).astype(np.int64) % DF_BUCKETS, minlength=DF_BUCKETS)
            n += int(np.count_nonzero(sizes))
        counts[-1] = n
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["bucket", "n"])

    counted = map_batches(docs.select("text"), run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    table = np.zeros(DF_BUCKETS + 1, np.int64)
    for row in counted.collect():  # DF_BUCKETS rows at most
        table[row.bucket] = row.n
    return table[:-1], int(table[-1])


def inverse_frequencies(counts: np.ndarray, n: int) -> np.ndarray:
    """1 + EMPHASIS * log(n / df) / log(n) by bucket: from 1 for a shingle in all documents to 1 + EMPHASIS.

    The usual load of a bucket, which rare shingles share, counts as one document.
    """
    load = float(np.median(counts))
    usual = load + 4 * np.sqrt(load) + 1
    frequency = np.minimum(np.where(counts > usual, counts - load, 1.0), max(n, 1))
    share = np.log(max(n, 1) / np.maximum(frequency, 1.0)) / np.log(max(n, 2))
    return (1 + EMPHASIS * share).astype(np.float32)


class Sampler:
    """BANDS * ROWS consistent weighted samples of a multiset.

    A sample is the shingle with the least log c - r * (floor(log w / r + beta) - beta) - r. It depends
    on the weight only through the floor, so its value with the shingle's own bits is the sample.
    """

    def __init__(self, usual: float):
        random = np.random.default_rng(20)
        self.r = random.gamma(2, 1, POOL)
        self.log_c = np.log(random.gamma(2, 1, POOL))
        self.beta = random.random(POOL)
        self.odd = random.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
        self.usual = usual
        self.table = self.order(self.log_a(np.full(POOL, np.log(usual)), np.arange(POOL)))

    def log_a(self, log_w: np.ndarray, at: np.ndarray) -> np.ndarray:
        t = np.floor(log_w / self.r[at] + self.beta[at])
        return self.log_c[at] - self.r[at] * (t - self.beta[at]) - self.r[at]

    @staticmethod
    def order(values: np.ndarray) -> np.ndarray:
        """Values as unsigned integers of the same order, in the upper 32 bits."""
        bits = values.astype(np.float32).view(np.uint32)
        bits = np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31))
        return bits.astype(np.uint64) << np.uint64(32)

    def sample(self, value: np.ndarray, weight: np.ndarray, first: np.ndarray) -> np.ndarray:
        """All samples: a row for each text with shingles. Texts go in runs whose arrays stay in the processor's cache."""
        out = np.zeros((len(first), BANDS * ROWS), np.uint64)
        ends = np.append(first[1:], len(value))
        begin = 0
        while begin < len(first):
            end = max(begin + 1, int(np.searchsorted(ends, first[begin] + 16_384, side="right")))
            part = slice(int(first[begin]), int(ends[end - 1]))
            self._run(value[part], weight[part], first[begin:end] - first[begin], out[begin:end])
            begin = end
        return out

    def _run(self, value: np.ndarray, weight: np.ndarray, first: np.ndarray, out: np.ndarray) -> None:
        odd = np.flatnonzero(weight != np.float32(self.usual))
        log_w = np.log(weight[odd].astype(np.float64))
        x, at, sample = np.empty_like(value), np.empty_like(value), np.empty_like(value)
        for k in range(BANDS * ROWS):
            np.multiply(value, self.odd[k], out=x)
            np.right_shift(x, np.uint64(48), out=at)
            np.take(self.table, at.view(np.int64), out=sample, mode="clip")
            if len(odd):
                sample[odd] = self.order(self.log_a(log_w, at[odd].view(np.int64)))
            np.right_shift(x, np.uint64(8), out=x)
            np.bitwise_and(x, np.uint64(0xFFFFFFFF), out=x)
            np.bitwise_or(sample, x, out=sample)
            out[:, k] = np.minimum.reduceat(sample, first)


def band_keys(samples: np.ndarray) -> np.ndarray:
    """A key of the ROWS samples of each band."""
    keys = np.zeros((len(samples), BANDS), np.uint64)
    for row in range(ROWS):
        keys = mix(keys * np.uint64(3) + samples[:, row::ROWS] + np.uint64(row))
    return keys + np.arange(BANDS, dtype=np.uint64)


def signatures(docs: DataFrame, idf: np.ndarray) -> DataFrame:
    """doc_id, the hashes of its word sequence, its band keys (null without words) and its folded weights."""

    def run(batches: Batches) -> Batches:
        sampler = Sampler(float(np.float32(idf.max(initial=1.0))))
        for batch in byte_slices(batches, "text"):
            texts = texts_of(batch, "text")
            value, counts, first, sizes = shingles(texts)
            weight = counts.astype(np.float32) * idf[(value >> np.uint64(48)).astype(np.int64) % DF_BUCKETS]
            some = np.flatnonzero(sizes)
            bands: list = [None] * len(texts)
            if len(some):
                samples = sampler.sample(value, weight, first[some])
                for i, row in zip(some.tolist(), band_keys(samples).view(np.int64), strict=True):
                    bands[i] = row
            keys = copy_keys(texts)
            at = np.repeat(np.arange(len(texts)) * FOLDS, np.diff(first)) + (value % np.uint64(FOLDS)).astype(np.int64)
            folded = np.bincount(at, weights=weight, minlength=len(texts) * FOLDS).astype(np.float32)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
                pa.array(bands, pa.list_(pa.int64())),
                pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * FOLDS, pa.int32()), pa.array(folded)),
            ], names=["doc_id", "key", "check", "bands", "folded"])

    return map_batches(docs, run, "doc_id long, key long, check long, bands array<long>, folded array<float>")


def similarities(left: list[str], right: list[str], idf: np.ndarray) -> list[float]:
    """Weighted Jaccard similarities of the texts side by side."""
    distinct = {t: i for i, t in enumerate(dict.fromkeys(left + right))}
    value, counts, first, _ = shingles(list(distinct))
    weight = counts * idf[(value >> np.uint64(48)).astype(np.int64) % DF_BUCKETS].astype(np.float64)
    out = []
    for a, b in zip(left, right, strict=True):
        i, j = distinct[a], distinct[b]
        va, wa = value[first[i] : first[i + 1]], weight[first[i] : first[i + 1]]
        vb, wb = value[first[j] : first[j + 1]], weight[first[j] : first[j + 1]]
        at = np.searchsorted(vb, va)
        hit = np.zeros(len(va), bool)
        inside = at < len(vb)
        hit[inside] = vb[at[inside]] == va[inside]
        common = np.minimum(wa[hit], wb[at[hit]]).sum()
        whole = wa.sum() + wb.sum() - common
        out.append(float(common / whole) if whole else 0.0)
    return out


def links(pairs: DataFrame, docs: DataFrame, idf: np.ndarray) -> DataFrame:
    """The pairs (a, b) whose texts reach the similarity."""
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    needed = materialize(docs.join(broadcast_if_small(ids, 500_000), "doc_id", "left_semi").dropDuplicates(["doc_id"]), "near-dup-texts")
    joined = (
        pairs.join(needed.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
        .join(needed.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    )

    def run(batches: Batches) -> Batches:
        for batch in byte_slices(batches, "text_a", "text_b"):
            near = np.array(similarities(texts_of(batch, "text_a"), texts_of(batch, "text_b"), idf))
            keep = pa.array(near >= SIMILARITY, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    return materialize(map_batches(joined.select("a", "b", "text_a", "text_b"), run, "a long, b long"), "near-dup-links")


def components(edges: DataFrame) -> DataFrame:
    """doc_id, component: the least id that links lead to, for every id in a link.

    Each round every node takes the least label around it, then the label of its label, so chains
    shorten by half at least. Rounds are written tables; nothing of a component is collected.
    """
    both = materialize(edges.union(edges.select("b", "a")).distinct().toDF("u", "v"), "near-dup-edges")
    label = materialize(both.groupBy("u").agg(F.least("u", F.min("v")).alias("label")), "near-dup-labels")
    while True:
        around = both.join(label.withColumnRenamed("u", "v"), "v").groupBy("u").agg(F.min("label").alias("near"))
        lower = label.join(around, "u").select("u", F.least("label", "near").alias("label"), F.col("label").alias("before"))
        jumped = lower.join(label.select(F.col("u").alias("label"), F.col("label").alias("next")), "label", "left")
        stepped = materialize(jumped.select("u", F.least("label", "next").alias("label"), "before"), "near-dup-labels")
        done = stepped.filter("label <> before").isEmpty()
        label = stepped.select("u", "label")
        if done:
            return label.toDF("doc_id", "component")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and class_id, the least id of its near-duplicate class, for every row."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    counts, n = document_frequencies(rows)
    idf = inverse_frequencies(counts, n)
    signed = materialize(signatures(rows, idf), "near-dup-signatures")
    worded = signed.filter(F.col("bands").isNotNull() & F.col("doc_id").isNotNull())
    # Equal words: one of each stands for all.
    groups = materialize(worded.groupBy("key", "check").agg(
        F.min("doc_id").alias("own"), F.first("bands").alias("bands"), F.first("folded").alias("folded")), "near-dup-groups")
    buckets = groups.select(F.col("own").alias("id"), F.posexplode("bands").alias("band", "bucket"))
    sizes = buckets.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = materialize(buckets.join(sizes, ["band", "bucket"]), "near-dup-sizes")
    # The text with most neighbours is the one its bucket is compared with, so a group meets its middle.
    mates = shared.groupBy("id").agg(F.sum("size").alias("mates"))
    first = shared.join(mates, "id").groupBy("band", "bucket").agg(F.min_by("id", F.struct(-F.col("mates"), "id")).alias("first"))
    shared = materialize(shared.drop("size").join(first, ["band", "bucket"]), "near-dup-buckets")
    stars = materialize(shared.filter("id <> first").select(F.least("first", "id").alias("a"), F.greatest("first", "id").alias("b")).distinct(), "near-dup-stars")
    label = components(links(stars, rows, idf))
    rest = _other_pairs(shared, label, stars, groups.select(F.col("own").alias("id"), "folded", "bands"))
    if not rest.isEmpty():
        label = _joined(label, links(rest, rows, idf))
    named = worded.join(groups.select("key", "check", "own"), ["key", "check"]).select("doc_id", "own").distinct()
    found_class = named.join(label.select(F.col("doc_id").alias("own"), "component"), "own", "left").select(
        "doc_id", F.coalesce("component", "own").alias("class_id"))
    return rows.select("doc_id").join(found_class, "doc_id", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))


def _joined(label: DataFrame, found: DataFrame) -> DataFrame:
    """Labels after further links, which are between components only."""
    def renamed(df: DataFrame, name: str) -> DataFrame:
        known = label.select(F.col("doc_id").alias(name), F.col("component").alias("known"))
        return df.join(known, name, "left").withColumn(name, F.coalesce("known", name)).drop("known")

    top = components(renamed(renamed(found, "a"), "b").select("a", "b").distinct())
    single = top.join(label.select(F.col("component").alias("doc_id")), "doc_id", "left_anti")
    moved = label.join(top.toDF("component", "upper"), "component", "left").select("doc_id", F.coalesce("upper", "component").alias("component"))
    return materialize(moved.union(single), "near-dup-labels")


def may_be_near(a: str, b: str) -> Column:
    """Can texts of these folded weights reach the similarity? A millionth part is left for rounding."""
    larger = F.aggregate(F.zip_with(a, b, lambda x, y: F.greatest(x, y).cast("double")), F.lit(0.0), lambda s, x: s + x)
    smaller = F.aggregate(F.zip_with(a, b, lambda x, y: F.least(x, y).cast("double")), F.lit(0.0), lambda s, x: s + x)
    return smaller >= larger * (SIMILARITY * (1 - 1e-6))


def _other_pairs(shared: DataFrame, label: DataFrame, tried: DataFrame, folded: DataFrame) -> DataFrame:
    """Pairs of a bucket in different components that were not compared yet and may be near.

    Members of the chosen one's component meet only the others, of which a bucket has few. A pair
    is made in the first band that it shares: in any bucket it shares, one of the two is not in the chosen
    one's component, so the pair is met there.
    """
    marked = shared.join(label.withColumnRenamed("doc_id", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    main = label.select(F.col("doc_id").alias("first"), F.col("component").alias("main"))
    marked = materialize(marked.join(main, "first", "left").withColumn("main", F.coalesce("main", "first")), "near-dup-marked")
    open_ = marked.filter(F.col("component") != F.col("main"))
    marked = marked.join(open_.select("band", "bucket").distinct(), ["band", "bucket"]).join(folded, "id")
    others = marked.filter(F.col("component") != F.col("main"))
    left = others.select("band", "bucket", F.col("id").alias("x"), F.col("component").alias("cx"), F.col("folded").alias("fx"), F.col("bands").alias("bx"))
    right = marked.select(
        "band", "bucket", F.col("id").alias("y"), F.col("component").alias("cy"), F.col("folded").alias("fy"), F.col("bands").alias("by"),
        (F.col("component") == F.col("main")).alias("in_main"))
    first_shared = F.array_position(F.zip_with("bx", "by", lambda p, q: p == q), F.lit(True)) == F.col("band") + 1
    meets = (F.col("cx") != F.col("cy")) & (F.col("in_main") | (F.col("x") < F.col("y"))) & first_shared & may_be_near("fx", "fy")
    pairs = left.join(right, ["band", "bucket"]).filter(meets)
    pairs = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    return materialize(pairs.join(tried, ["a", "b"], "left_anti"), "near-dup-rest")


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each class, the one of least id. Rows with a null id stay."""
    rest = classes(docs, doc_id, text).filter(F.col("doc_id") != F.col("class_id")).select(F.col("doc_id").alias(doc_id)).distinct()
    return docs.join(rest, doc_id, "left_anti")
