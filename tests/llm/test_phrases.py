"""Collocations against counting every phrase, over tables with odd rows."""

import random
import re
import unittest.mock as mock
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from panelspark.llm import phrases

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
SCHEMA = "doc_id long, text string, lang string, phrase string, n int, score long, shard int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, "p", 1, 2, 3) for i, (t, g) in enumerate(rows)], SCHEMA).repartition(5)


def counted(rows, longest):
    found = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    found[lang if lang is not None else "und"][" ".join(words[i : i + size])] += 1
    return found


def brute(rows, longest=3, least=10, within=50, top=2000):
    out = []
    for lang, f in counted(rows, longest).items():
        n = sum(c for p, c in f.items() if " " not in p)
        candidates = {p: c for p, c in f.items() if " " in p and c >= least}
        kept = []
        for p, a in candidates.items():
            if any(f" {p} " in f" {q} " and q != p and 100 * c >= within * a for q, c in candidates.items()):
                continue
            w = p.split(" ")
            cuts = []
            for k in range(1, len(w)):
                left, right = f[" ".join(w[:k])], f[" ".join(w[k:])]
                cuts.append((1_000_000 * a * a // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            kept.append((-score, -a, p.encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return sorted(out)


def check(spark, rows, **options):
    got = sorted(tuple(r) for r in phrases.collocations(frame(spark, rows), **options).collect())
    assert got == brute(rows, **options)
    return got


ODD = [
    (None, "en"), ("", "en"), (" \t \n", None), ("...,,,", "x"), ("Éa b\xa0c İx", "und"), ("a b c " * 400, None), ("ok\vOK\fok\rok;A B c!a  b\tc", ""),
    ("word", "en"), ("tail without end " * 12, "zz"), ("\x00 \x1c \x1d " * 20, "ctl"),
]


def corpus(seed, n=150):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "New", "york", "city", "a", "b", "ß", "東", "x'y", "I", "-"]
    weights = [9, 7, 3, 3, 2, 5, 4, 1, 1, 1, 2, 1]
    rows = list(ODD)
    for _ in range(n):
        words = rng.choices(vocabulary, weights, k=rng.randint(0, 60))
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n"]) for w in words)
        rows.append((text + " new york city" * rng.randint(0, 2), rng.choice(["en", "en", "en", "de", None, "und"])))
    return rows + rows[-1:] * 40


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_counting(spark, seed):
    assert len(check(spark, corpus(seed))) > 50


def test_other_bounds(spark):
    rows = corpus(3, 60)
    check(spark, rows, longest=4, least=5, within=80, top=20)
    check(spark, rows, longest=2, least=25)


def test_chunks_and_equal_hashes(monkeypatch):
    """Texts cut into many chunks, and phrases whose hashes are all equal, are counted right."""
    monkeypatch.setattr(phrases, "CHUNK", 64)
    rows = [(t, g) for t, g in corpus(4, 30) if g is not None]
    batch = pa.RecordBatch.from_pydict({"text": [t for t, _ in rows], "lang": [g for _, g in rows]})
    found = defaultdict(Counter)
    chunks = list(phrases._chunks(iter([batch])))
    for others, words in chunks:
        lang_of = words.parts  # parts in place of languages
        vocabulary = [x.decode() for x in words.vocabulary.to_pylist()]
        for size in (1, 2, 3):
            at = words.starts(size)
            for spoken, counts in phrases._distinct(words, lang_of, np.zeros(len(words.codes), np.uint64), at, size):
                for p, c in zip(spoken.tolist(), counts.tolist(), strict=True):
                    found[others[words.parts[p]][0]][" ".join(vocabulary[words.codes[p + i]] for i in range(size))] += c
    assert len(chunks) > 50
    assert {k: v for k, v in found.items() if v} == {k: v for k, v in counted(rows, 3).items() if v}


def test_words():
    words = phrases.Words([b"a b c d a b"])
    assert words.follows.all() and words.codes.tolist() == [0, 1, 2, 3, 0, 1]
    assert len(phrases.Words([b"", b".", b" "]).codes) == 0
    words = phrases.Words([b"a b", b"", b"c"])
    assert words.parts.tolist() == [0, 0, 2] and words.follows.tolist() == [True, False]


def test_large_counts(spark):
    """Squares of counts pass what 64 bits hold."""
    counts = spark.createDataFrame([("en", 2, "a b", 3 * 10**9)], "lang string, size int, phrase string, n long")
    singles = spark.createDataFrame([("en", 1, "a", 4 * 10**9), ("en", 1, "b", 5 * 10**9)], counts.schema)
    totals = spark.createDataFrame([("en", 10**12)], "lang string, n long")
    with mock.patch.object(phrases, "frequent_phrases", return_value=(counts.union(singles), totals)):
        row = phrases.collocations(counts).collect()
    assert [tuple(r) for r in row] == [("en", 1, "a b", 3 * 10**9, 4 * 10**9, 5 * 10**9, 10**12, 450_000)]


@pytest.mark.parametrize("rows", [[], [(None, None)], [("one two", "en")]])
def test_nothing_frequent(spark, rows):
    assert check(spark, rows) == []


def test_rare_phrases_are_no_candidates(spark, monkeypatch):
    """What a shard's lowered support lets through goes where all shards together hold too few."""
    rows = [(f"x{i} rare{i % 60} pair{i % 60}. common words here", "en") for i in range(300)]
    whole = counted(rows, 3)["en"]
    sizes = []
    count = phrases._count
    monkeypatch.setattr(phrases, "_count", lambda rows, sets, longest: sizes.extend(
        int(np.bitwise_count(s.value).sum()) for s in sets) or count(rows, sets, longest))
    check(spark, rows)
    assert sizes == [sum(n >= 10 and p.count(" ") == k for p, n in whole.items()) for k in range(3)] == [3, 2, 1]


def test_key_ranges(spark, monkeypatch):
    """Any number of key ranges gives the same phrases."""
    for words, least in ((3, 256), (10**6, 2)):
        monkeypatch.setattr(phrases, "RANGE", words)
        monkeypatch.setattr(phrases, "RANGES", least)
        check(spark, corpus(6, 40))


def test_bit_set(spark):
    keys = [0, 4, 8, 2**62 + 12, -(2**63), -4]
    bits = phrases._bit_set(spark.createDataFrame([(k,) for k in keys], "key long"))
    have = phrases._in(bits, np.array(keys, np.int64).view(np.uint64))
    assert have.all() and not phrases._in(bits, np.array([16, 400], np.uint64)).any()
