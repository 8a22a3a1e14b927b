"""Language identification by cross-parsing entropy.

Each language's labelled sample becomes a suffix automaton. A text is cut into phrases, each the
longest match with the sample from where the last phrase ended; the fewer phrases a text
needs, the better the sample describes it. Phrases are normalised to bits per character
(phrases * log2(sample length) / characters), and the language needing fewest wins. Equal
languages go to the one first in text order.

Null texts and texts without a letter are `und` with score 0. Rows are independent of each
other; labels, sources and ids are not looked at in a prediction. With no labelled sample
every text is `und`. Repeated rows repeat, extra columns stay.
"""

from __future__ import annotations

import sys
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import Batches, byte_slices, free_models, map_batches, texts_of

#: The learned sample: so many labelled rows of a language, whole, and at most so many of their
#: characters in the automaton. Letters beyond the most frequent of the samples match nothing.
SAMPLE_ROWS = 200
SAMPLE_CHARACTERS = 40_000
ALPHABET = 250

#: Texts are parsed in blocks of this length; a phrase ends at the end of its block.
BLOCK = 512

#: Bits per character that divide the confidence of two languages by two.
HALVING = 0.25

_PAD, _GAP, _OTHER = 0, 1, 2


@lru_cache(1)
def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """The transitions of the automaton that accepts all substrings of ``codes``."""
    step, link, length = [{}], [-1], [0]
    last = 0
    for code in codes:
        new = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and code not in step[at]:
            step[at][code] = new
            at = link[at]
        if at >= 0:
            to = step[at][code]
            if length[at] + 1 == length[to]:
                link[new] = to
            else:
                copy = len(step)
                step.append(dict(step[to]))
                link.append(link[to])
                length.append(length[at] + 1)
                while at >= 0 and step[at].get(code) == to:
                    step[at][code] = copy
                    at = link[at]
                link[to] = link[new] = copy
        last = new
    return step


class Parser:
    """The automata of all languages in one table, walked by many blocks of text at a time."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        joined = "".join(samples.values()).lower()
        points, counts = np.unique(np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4"), return_counts=True)
        keep = _letters()[points]
        points, counts = points[keep], counts[keep]
        points = np.sort(points[np.argsort(-counts, kind="stable")[:ALPHABET]])
        self.codes = np.where(_letters(), _OTHER, _GAP).astype(np.uint8)
        self.codes[points] = np.arange(len(points), dtype=np.uint8) + 3
        self.width = len(points) + 3
        tables, self.roots, self.bits, base = [], [], [], 0
        for language in self.languages:
            codes = self.encode([samples[language]])[0]
            steps = suffix_automaton(codes.tolist())
            # An entry is twice the row of the next state, plus one where the letter begins a new phrase.
            # The last row is that of a letter which the sample lacks: whatever follows begins anew.
            rows = (np.arange(len(steps) + 1) * self.width + base).tolist()
            table = np.full((len(rows), self.width), 2 * rows[-1] + 1, np.int64)
            for code, to in steps[0].items():
                if code != _OTHER:
                    table[:, code] = 2 * rows[to] + 1
            table[0] -= 1
            for at, step in enumerate(steps):
                for code, to in step.items():
                    if code != _OTHER:
                        table[at, code] = 2 * rows[to]
            table[:, _PAD] = 2 * base
            tables.append(table.reshape(-1).astype(np.int32))
            self.roots.append(base)
            self.bits.append(np.log2(max(len(codes), 2)))
            base += table.size
        self.table = np.concatenate(tables)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Letter codes of lower-cased texts; what lies between words is one gap."""
        lowered = [t.lower() for t in texts]
        sizes = np.fromiter(map(len, lowered), np.int64, len(lowered))
        codes = self.codes[np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4")]
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != _GAP) | (codes[:-1] != _GAP)
        ends = np.concatenate([[0], np.cumsum(keep)])[np.cumsum(sizes)] if len(codes) else np.zeros(len(texts), np.int64)
        return np.split(codes[keep], ends[:-1])

    def bits_per_character(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each text and language the normalised phrases, and for each text whether it has a letter."""
        coded = self.encode(texts)
        has_letter = np.array([bool((c > _GAP).any()) for c in coded], bool)
        sizes = np.array([len(c) for c in coded], np.int64)
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(texts)), blocks)
        grid = np.zeros((len(owner), BLOCK), np.uint8)
        row = 0
        for codes, n in zip(coded, blocks.tolist(), strict=True):
            grid[row : row + n].reshape(-1)[: len(codes)] = codes
            row += n
        order = np.argsort(-(grid != _PAD).sum(1), kind="stable")
        grid, owner = grid[order], owner[order]
        width = (grid != _PAD).sum(1)
        phrases = np.zeros((len(self.languages), len(texts)), np.float64)
        columns = np.ascontiguousarray(grid.T).astype(np.int32)
        active = np.searchsorted(-width, -np.arange(BLOCK), side="left")
        for i, root in enumerate(self.roots):
            at = np.full(len(owner), 2 * root, np.int32)
            count = np.ones(len(owner), np.int32)
            for position in range(BLOCK):
                n = active[position]
                if not n:
                    break
                at[:n] = self.table[(at[:n] >> 1) + columns[position, :n]]
                count[:n] += at[:n] & 1
            phrases[i] = np.bincount(owner, count, len(texts))
        bits = phrases * np.array(self.bits)[:, None] / np.maximum(sizes, 1)
        return bits.T, has_letter

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        bits, has_letter = self.bits_per_character(texts)
        best = bits.argmin(1)
        weight = np.exp2((bits.min(1)[:, None] - bits) / HALVING)
        score = np.where(has_letter, 1 / weight.sum(1), 0.0)
        names = [self.languages[b] if ok else "und" for b, ok in zip(best, has_letter, strict=True)]
        return names, score.tolist()


_loaded: dict[int, Parser] = {}


def _parser(samples: dict[str, str]) -> Parser:
    key = hash(tuple(sorted(samples.items())))
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Parser(samples)
    return _loaded[key]


def learn(df: DataFrame, use: Column, text: str = "text", lang: str = "lang", order: str = "doc_id") -> dict[str, str]:
    """A bounded sample of the labelled rows where ``use`` holds: SAMPLE_ROWS rows of each language.

    Rows are drawn by the hash of their id, at a rate taken from the language's count, so that
    one scan returns little more than the sample. Long rows give their first SAMPLE_CHARACTERS / 20
    characters each, for variety.
    """
    rows = df.filter(use & F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}
    if not counts:
        return {}
    draw = F.pmod(F.xxhash64(F.col(order)), F.lit(1 << 40)) / float(1 << 40)
    rate = F.coalesce(*(F.when(F.col(lang) == k, F.lit(min(1.0, 1.5 * SAMPLE_ROWS / n))) for k, n in counts.items()))
    part = SAMPLE_CHARACTERS // 20
    drawn = rows.filter(draw < rate).select(F.col(lang).alias("lang"), F.substring(text, 1, part).alias("text"), draw.alias("draw"))
    samples: dict[str, list[str]] = {}
    for row in sorted(drawn.collect(), key=lambda r: (r.draw, r.text)):
        taken = samples.setdefault(row.lang, [])
        if len(taken) < SAMPLE_ROWS and sum(map(len, taken)) < SAMPLE_CHARACTERS:
            taken.append(row.text)
    return {k: "\n".join(v)[:SAMPLE_CHARACTERS] for k, v in samples.items()}


def identify(df: DataFrame, samples: dict[str, str], text: str = "text", lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """Add the predicted language and its confidence to every row."""
    clash = {c.lower() for c in df.columns} & {lang_pred.lower(), score.lower()}
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already")

    def run(batches: Batches) -> Batches:
        free_models("bpe", "token_files", "toxicity")
        parser = _parser(samples) if samples else None
        for batch in byte_slices(batches, text, limit=4 << 20):
            texts = texts_of(batch, text)
            names, scores = parser.predict(texts) if parser and texts else (["und"] * len(texts), [0.0] * len(texts))
            columns = [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, lang_pred, score])
        del parser
        free_models("language")  # the automata are soon built again, and what follows needs the memory

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]
    return map_batches(df, run, ", ".join([*fields, f"`{lang_pred}` string", f"`{score}` double"]))
