"""Winnowing against a window-by-window version, and documents against their successors."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from panelspark.llm import fingerprints as P
from panelspark.llm.common import table

SF = "/root/testdata/sf0.001"
ODD = ["", "a", "abcdefg", "abcdefgh", "x" * 200, "ab" * 100, "ünï©ode 😀😀 text, longer than a gram", " " * 40, "same text twice over", "y" * 18, "line\n" * 4000]


def brute(text, k=P.K, window=P.WINDOW):
    """(position, hash) of the rightmost least gram of each window."""
    if not text:
        return []
    points = np.array([ord(c) for c in text] + [P._PAD] * max(0, k - len(text)), np.uint32)
    grams = [int(P.gram_hashes(points[i : i + k], k)[0]) for i in range(len(points) - k + 1)]
    out = []
    for i in range(max(1, len(grams) - window + 1)):
        part = grams[i : i + window]
        at = i + max(j for j, x in enumerate(part) if x == min(part))
        if not out or out[-1][0] != at:
            out.append((at, grams[at]))
    return out


@pytest.mark.parametrize(("k", "window"), [(P.K, P.WINDOW), (5, 1), (7, 4), (1, 3)])
def test_winnow(k, window):
    texts = [t[:300] for t in ODD]
    hashes, places, bounds = P.winnow(texts, k, window)
    for i, text in enumerate(texts):
        own = slice(bounds[i], bounds[i + 1])
        assert list(zip(places[own].tolist(), hashes[own].tolist(), strict=True)) == brute(text, k, window)


def test_shared_passage_is_found():
    rng = np.random.default_rng(1)
    letters = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    for _ in range(50):
        shared = letters(P.K + P.WINDOW - 1)
        hashes, _, bounds = P.winnow([letters(60) + shared + letters(9), letters(5) + shared + letters(80)])
        assert set(hashes[: bounds[1]].tolist()) & set(hashes[bounds[1] :].tolist())


def likeness(a, b):
    a, b = (Counter(h for _, h in brute(t)) for t in (a, b))
    return (a & b).total() / (a | b).total() if a or b else 1.0


def check(spark, rows, extra=", fingerprint string, part int, hash long"):
    """Rows are (id, text), in an order where equal ids only come with equal texts or are few."""
    df = spark.createDataFrame([(i, t, "f", 1, 2) for i, t in rows], f"doc_id long, text string{extra}").repartition(4)
    got = P.next_compared(df).collect()
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    want = []
    for (doc_id, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        text, after = text or "", after or ""
        new = P.edited(text, after)
        fp, new_fp = ("".join(f"{h:08x}" for _, h in brute(t)) for t in (text, new))
        want.append((doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), fp, new_fp, round(likeness(text, new), 9), round(likeness(text, after), 9)))
    have = [(r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in got]
    assert Counter(have) == Counter(want)


def test_odd_rows(spark):
    texts = [None, *ODD, "same text twice over"]
    check(spark, [(10 * i, t) for i, t in enumerate(texts)])


@pytest.mark.parametrize("rows", [[(5, "alone in the table, with itself behind it")], [(1, "a b c"), (2, None)], [(None, "no id here at all"), (3, "one")]])
def test_few_rows(spark, rows):
    check(spark, rows)


def test_equal_rows_and_large_ids(spark):
    rows = [(7, "a text that many rows have in common")] * 300 + [(2**62 + 1, "next to it"), (2**62, "another one"), (-5, "below"), (8, "above")]
    check(spark, rows)


def test_rows_of_one_id_keep_a_fixed_order(spark):
    rows = [(1, f"text number {i}") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    first = sorted(r.edited_sha256 for r in P.next_compared(df.repartition(7)).collect())
    assert first == sorted(r.edited_sha256 for r in P.next_compared(df.coalesce(1)).collect())
    assert len(first) == 50


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert P.next_compared(df).collect() == [] and P.fingerprints(df).collect() == []


def test_documents(spark, monkeypatch):
    monkeypatch.setattr(P, "CHUNK", 3000)
    check(spark, [(r.doc_id, r.text[:2000] if r.text else None) for r in table(spark, SF, "documents").limit(60).collect()])


def test_fingerprints_keep_positions(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([None, *ODD[:-1]])], "doc_id long, text string")
    for r in P.fingerprints(df).collect():
        assert list(zip(r.positions, r.hashes, strict=True)) == brute(([None, *ODD][r.doc_id]) or "")
