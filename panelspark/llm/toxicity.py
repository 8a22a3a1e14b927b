"""Toxicity scores from a learned lexicon, read with Levenshtein automata.

From a bounded sample of labelled rows, words and word beginnings that mark toxic texts become a
lexicon. It is kept as a trie, and one automaton walks the trie and a word of the text together
with up to as many edits as the term's length allows (none below 5 letters, 1 below 9, else 2); its
states are sets of (trie node, edits), made when first met. Terms whose misspellings also occur in clean
texts match exactly only. Each hit has a context window: hits inside quotation marks or after a reporting
word count apart from abuse, and hits close together count more. A logistic regression on
these counts, fitted to the same sample, gives the score.

Null and empty texts have no hits and get the score of such texts. Rows are independent: repeated rows
repeat, an empty table stays empty, extra columns stay. Without labels of both kinds the
score is the share of toxic labels, or 0.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.bpe import Generations
from panelspark.llm.common import Batches, map_batches, texts_of
from panelspark.session import broadcast_if_small, materialize

#: Labelled rows learned from, and terms of the lexicon.
SAMPLE_ROWS = 30_000
TERMS = 2_000
#: A term occurs in so many toxic texts at least, and its log-odds are so high.
LEAST_TEXTS = 3
LEAST_ODDS = 2.5
#: Words of a hit's context on either side.
CONTEXT = 12
THRESHOLD = 0.3
_FEATURES = 6

_PIECES = re.compile(r"\w+")
_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "“”„«»‘’‹›…–—¡¿"
_QUOTES = re.compile("[\"“”„«»]")
# Words that introduce someone else's words.
_REPORTING = frozenset("said says wrote writes called calls quote quoted quoting dit écrit sagte schrieb dijo escribió".split())


def tokens(text: str) -> list[str]:
    """Lower-case words between blanks, without punctuation around them."""
    return [t for t in (c.strip(_EDGES) for c in text.lower().split()) if t]


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 5 or term.endswith("*") else 1 if len(term) < 9 else 2


class FuzzyTrie:
    """The product of a lexicon trie with Levenshtein automata, made deterministic as it is walked."""

    def __init__(self, limits: dict[str, int]):
        self.children: list[dict[str, int]] = [{}]
        self.terms: list[list[str]] = [[]]
        self.beginnings: list[list[str]] = [[]]
        self.limit = [0]
        self.limits = limits
        for term, limit in limits.items():
            node = 0
            self.limit[0] = max(self.limit[0], limit)
            for letter in term.rstrip("*"):
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.terms.append([])
                    self.beginnings.append([])
                    self.limit.append(0)
                node = self.children[node][letter]
                self.limit[node] = max(self.limit[node], limit)
            (self.beginnings if term.endswith("*") else self.terms)[node].append(term)
        self.start = self._closed({0: 0})
        self.steps: dict[tuple[frozenset, str], frozenset] = {}
        self.ends: dict[frozenset, list[tuple[str, int]]] = {}

    def _closed(self, state: dict[int, int]) -> frozenset:
        """With letters of the lexicon left out by the text."""
        todo = list(state.items())
        while todo:
            node, edits = todo.pop()
            for child in self.children[node].values():
                if edits < self.limit[child] and edits + 1 < state.get(child, 9):
                    state[child] = edits + 1
                    todo.append((child, edits + 1))
        return frozenset(state.items())

    def _step(self, state: frozenset, letter: str) -> frozenset:
        out: dict[int, int] = {}
        for node, edits in state:
            for other, child in self.children[node].items():
                cost = edits + (other != letter)
                if cost <= self.limit[child] and cost < out.get(child, 9):
                    out[child] = cost
            if edits < self.limit[node] and edits + 1 < out.get(node, 9):
                out[node] = edits + 1
        return self._closed(out)

    def match(self, word: str) -> tuple[str, int] | None:
        """The best term for a word: fewest edits, then whole words, then first in order."""
        state, begun = self.start, []
        for letter in word:
            key = (state, letter)
            found = self.steps.get(key)
            if found is None:
                if len(self.steps) > 200_000:
                    self.steps.clear()
                found = self.steps[key] = self._step(state, letter)
            state = found
            if not state:
                break
            for node, edits in state:
                if not edits and self.beginnings[node]:
                    begun += self.beginnings[node]
        best = None
        for node, edits in state:
            for term in self.terms[node]:
                if edits <= self.limits[term] and (best is None or (edits, term) < (best[1], best[0])):
                    best = (term, edits)
        if best and best[1] == 0 or not begun:
            return best
        longest = max(begun, key=len)
        return None if longest[:-1] == word else (longest, 0)


@dataclass(frozen=True)
class Model:
    """Terms with their log-odds and edits, and the regression's weights (constant first)."""

    odds: dict[str, float]
    edits: dict[str, int]
    weights: tuple[float, ...]


class Reader:
    def __init__(self, model: Model):
        self.model = model
        self.trie = FuzzyTrie(model.edits)
        self.cache = Generations(self._chunk)

    def _chunk(self, chunk: str) -> tuple[str, int] | bool:
        whole = chunk.strip(_EDGES)
        found = self.trie.match(whole) if whole else None
        if not found:
            pieces = _PIECES.findall(whole)
            found = next((m for m in map(self.trie.match, pieces) if m), None) if len(pieces) > 1 else None
        return found or False

    def features(self, text: str) -> list[float]:
        chunks = text.lower().split()
        hits = [(i, h) for i, h in enumerate(map(self.cache.__getitem__, chunks)) if h]
        if not hits:
            return [0.0] * _FEATURES
        marks = [i for i, c in enumerate(chunks) for _ in _QUOTES.findall(c)]
        exact = fuzzy = quoted = 0
        strongest, window, near = 0.0, 0.0, []
        for i, (term, edits) in hits:
            before = sum(m < i for m in marks)
            reported = any(c.strip(_EDGES) in _REPORTING for c in chunks[max(0, i - 5) : i])
            # An odd number of marks ahead, or one on the word itself, with more behind: inside a quotation.
            inside = bool(marks) and (before % 2 == 1 and any(m >= i for m in marks) or i in marks)
            if inside or reported and marks:
                quoted += 1
                continue
            exact += edits == 0
            fuzzy += edits > 0
            odds = self.model.odds[term] / (1 + edits)
            strongest = max(strongest, odds)
            near = [(j, o) for j, o in near if i - j <= CONTEXT] + [(i, odds)]
            window = max(window, sum(o for _, o in near))
        rate = (exact + fuzzy) / len(chunks)
        return [strongest, float(np.log1p(exact)), float(np.log1p(fuzzy)), float(np.log1p(quoted)), float(np.log1p(window)), float(np.log1p(100 * rate))]

    def score(self, texts: list[str]) -> list[float]:
        x = np.array([self.features(t) for t in texts]).reshape(len(texts), _FEATURES)
        w = np.array(self.model.weights)
        return (1 / (1 + np.exp(-np.clip(x @ w[1:] + w[0], -30, 30)))).tolist()


def _fit(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic regression with a little shrinkage, by Newton's method."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    shrink = np.diag([1e-6] + [1e-2] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + shrink @ w
        step = np.linalg.solve(x.T * (p * (1 - p)) @ x + shrink + 1e-9 * np.eye(len(w)), gradient)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(w.tolist())


def _word_counts(rows: DataFrame) -> DataFrame:
    """term, toxic, clean: in how many texts of either label a word or beginning occurs."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            toxic: Counter = Counter()
            clean: Counter = Counter()
            for text, label in zip(texts_of(batch, "text"), batch.column("toxic").to_pylist(), strict=True):
                words = {w for w in tokens(text) if len(w) <= 40}
                words |= {w[:n] + "*" for w in words for n in range(4, min(9, len(w)))}
                (toxic if label else clean).update(words)
            terms = list(toxic | clean)
            yield pa.RecordBatch.from_arrays([
                pa.array(terms, pa.string()), pa.array([toxic[t] for t in terms], pa.int64()), pa.array([clean[t] for t in terms], pa.int64()),
            ], names=["term", "toxic", "clean"])

    counted = map_batches(rows, run, "term string, toxic long, clean long")
    return counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _misspelt(counts: DataFrame, edits: dict[str, int]) -> dict[str, tuple[int, int]]:
    """For each term, texts of either label with a word that differs from it by allowed edits."""

    def run(batches: Batches) -> Batches:
        trie = FuzzyTrie(edits)
        for batch in batches:
            words = batch.column("term").to_pylist()
            found = [None if w.endswith("*") else trie.match(w) for w in words]
            hit = [i for i, f in enumerate(found) if f and f[1]]
            yield pa.RecordBatch.from_arrays([
                pa.array([found[i][0] for i in hit], pa.string()), batch.column("toxic").take(pa.array(hit, pa.int32())),
                batch.column("clean").take(pa.array(hit, pa.int32())),
            ], names=["term", "toxic", "clean"])

    near = map_batches(counts.select("term", "toxic", "clean"), run, "term string, toxic long, clean long")
    return {r.term: (r.toxic, r.clean) for r in near.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).collect()}


def learn(docs: DataFrame, labels: DataFrame, use: Column) -> Model:
    """The lexicon and the weights, from at most about SAMPLE_ROWS labelled rows for which ``use`` holds.

    Rows are drawn by the hash of their id ahead of the join; what reaches the driver are TERMS
    terms and six numbers for each drawn row.
    """
    marked = labels.filter(F.col("toxic").isin(0, 1) & use).select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct()
    n = marked.count()
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / float(1 << 40)
    rate = min(1.0, SAMPLE_ROWS / max(n, 1))
    # The drawn ids are few, so the documents are filtered where they lie, and the drawn ones stored once.
    drawn = broadcast_if_small(marked.filter(draw < rate), 2 * SAMPLE_ROWS)
    rows = materialize(docs.select("doc_id", "text").filter(draw < rate).join(drawn, "doc_id").select("text", "toxic"), "toxic-sample")
    totals = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    t, c = totals.get(1, 0), totals.get(0, 0)
    if not t or not c:
        share = min(max(t / max(t + c, 1), 1e-9), 1 - 1e-9)
        return Model({}, {}, (float(np.log(share / (1 - share))), *[0.0] * _FEATURES))
    counts = materialize(_word_counts(rows).filter((F.col("toxic") > 0) | (F.col("clean") > 0)), "toxic-words")
    odds = F.log((F.col("toxic") + 0.5) / (t + 1)) - F.log((F.col("clean") + 0.5) / (c + 1))
    top = (
        counts.filter(F.col("toxic") >= LEAST_TEXTS).withColumn("odds", odds).filter(F.col("odds") >= LEAST_ODDS)
        .orderBy(F.desc(F.col("odds") * F.log1p("toxic")), "term").limit(TERMS).collect()
    )
    whole = {r.term: r.toxic for r in top if not r.term.endswith("*")}
    best: dict[str, int] = {}
    for term, texts in whole.items():
        for k in range(4, min(9, len(term))):
            best[term[:k]] = max(best.get(term[:k], 0), texts)
    # A beginning that one word explains says no more than the word.
    chosen = {r.term: float(r.odds) for r in top if not r.term.endswith("*") or best.get(r.term[:-1], 0) < 0.8 * r.toxic}
    edits = {term: edits_allowed(term) for term in chosen}
    for term, (toxic, clean) in _misspelt(counts, edits).items():
        if clean and (toxic + 0.5) / (t + 1) < 6 * (clean + 0.5) / (c + 1):
            edits[term] = 0
    unfitted = Model(chosen, edits, (0.0,) * (_FEATURES + 1))

    def run(batches: Batches) -> Batches:
        reader = Reader(unfitted)
        for batch in batches:
            x = [reader.features(text) for text in texts_of(batch, "text")]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column("toxic")], names=["x", "toxic"])

    fitted = map_batches(rows, run, "x array<double>, toxic int").groupBy("x", "toxic").count().collect()
    x = np.repeat(np.array([r.x for r in fitted]), [r["count"] for r in fitted], axis=0)
    y = np.repeat(np.array([r.toxic for r in fitted], float), [r["count"] for r in fitted])
    return Model(chosen, edits, _fit(x, y))


_loaded: list[tuple[Model, Reader]] = []


def _reader(model: Model) -> Reader:
    if not _loaded or _loaded[0][0] != model:
        _loaded[:] = [(model, Reader(model))]
    return _loaded[0][1]


def score_texts(df: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """Add the toxicity score of every row."""
    if score.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"column {score} exists already")

    def run(batches: Batches) -> Batches:
        reader = _reader(model)
        for batch in batches:
            found = pa.array(reader.score(texts_of(batch, text)), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, score])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]
    return map_batches(df, run, ", ".join([*fields, f"`{score}` double"]))
