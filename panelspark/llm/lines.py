"""Line deduplication by hashes of line windows.

A document's lines are trimmed of blanks; empty ones do not count. A window begins at a line and
is the fewest lines that hold WORDS words, LINES at most. Every window is kept with the least of its
line hashes; windows whose least hash occurs once are dropped ahead, others are compared by content. Every
line covered by a window that also occurs earlier (in a smaller id, or in the same document ahead) is
deleted. So a run of LINES lines, or of lines with WORDS words, stays only where it occurs first.

With ``extend`` matches go on both ways while the lines agree: every line goes that lies in a run
of lines which also occurs earlier and holds a window. Backwards the windows do that by themselves,
since one that begins a line ahead of a matched window ends no later or with it. Forwards at most two lines
follow the last window of a run; for each line that ends no window, the lines from the last window
that ends ahead of it up to it are compared as well. Runs without any window stay.

Null texts stay null, empty ones empty. Rows with a null id take no part and stay whole. Repeated
rows of one id are one document. An empty table stays empty; extra columns stay.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import Batches, Bytes, map_batches, mix, texts_of
from panelspark.session import broadcast_if_small, materialize

LINES = 3
WORDS = 40
_BLANKS = " \t\r"
_WORD = re.compile(r"[^ \t\r]+")


def windows_of(texts: list[str], extend: bool = False) -> tuple[np.ndarray, ...]:
    """Windows of several texts: text number, first line, lines, fingerprint, content hash.

    With ``extend`` also those made longer, one for each line that is not the end of a window but follows one.
    """
    lines, owner, words = [], [], []
    for i, text in enumerate(texts):
        own = [s for s in (x.strip(_BLANKS) for x in text.split("\n")) if s]
        lines += own
        owner += [i] * len(own)
        words += [len(_WORD.findall(s)) for s in own]
    bytes_ = Bytes(lines)
    hashes = bytes_.hashes(bytes_.starts[:-1], bytes_.starts[1:])
    owner_, total = np.array(owner, np.int64), len(lines)
    first = np.searchsorted(owner_, owner_)
    size = np.zeros(total, np.int64)
    held = np.zeros(total, np.int64)
    content = np.zeros(total, np.uint64)
    least = np.full(total, np.iinfo(np.uint64).max, np.uint64)
    count = np.array(words, np.int64)
    for step in range(LINES):
        open_ = np.flatnonzero(size == 0)
        open_ = open_[open_ + step < total]
        open_ = open_[owner_[open_ + step] == owner_[open_]]
        held[open_] += count[open_ + step]
        content[open_] = mix(content[open_] * np.uint64(31) + hashes[open_ + step])
        least[open_] = np.minimum(least[open_], hashes[open_ + step])
        done = open_[(held[open_] >= WORDS) | (step == LINES - 1)]
        size[done] = step + 1
    at = np.flatnonzero(size)
    if extend:
        end = at + size[at]
        follows = np.append(at[1:], -1) == at + 1
        follows[:-1] &= owner_[at[1:]] == owner_[at[:-1]]
        limit = np.searchsorted(owner_, owner_[at], "right")
        limit[follows] = np.minimum(limit, np.append(end[1:], 0) - 1)[follows]
        size, least, content = size[at], least[at], content[at]
        parts = [(at, size, least, content)]
        while (go := np.flatnonzero(end < limit)).size:
            at, end, limit = at[go], end[go], limit[go]
            content = mix(content[go] * np.uint64(31) + hashes[end])
            least = np.minimum(least[go], hashes[end])
            end = end + 1
            parts.append((at, end - at, least, content))
        at, size, least, content = (np.concatenate(x) for x in zip(*parts, strict=True))
        return owner_[at], at - first[at], size, least.view(np.int64), content.view(np.int64)
    return owner_[at], at - first[at], size[at], least[at].view(np.int64), content[at].view(np.int64)


def _windows(docs: DataFrame, extend: bool) -> DataFrame:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            ids = np.array(batch.column("doc_id").to_pylist(), np.int64)
            owner, line, n, mark, content = windows_of(texts_of(batch, "text"), extend)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (mark, content, ids[owner], line, n)], names=["mark", "content", "doc_id", "line", "n"])

    return map_batches(docs, run, "mark long, content long, doc_id long, line long, n long")


def find_runs(docs: DataFrame, extend: bool = False) -> DataFrame:
    """doc_id and its repeated windows (line, n), for documents that have some."""
    windows = materialize(_windows(docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()), extend), "line-windows")
    marks = windows.groupBy("mark").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("mark")
    near = windows.join(broadcast_if_small(materialize(marks, "line-marks"), 1_000_000), "mark")
    place = F.struct("doc_id", "line")
    first = near.groupBy("content").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    first = materialize(first.filter(F.col("first") < F.col("last")).drop("last"), "line-firsts")
    later = near.join(first, "content").filter(place > F.col("first"))
    return later.groupBy("doc_id").agg(F.collect_list(F.struct("line", "n")).alias("runs"))


def remove_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", removed: str = "removed_lines", kept: str = "kept_text",
                 extend: bool = False) -> DataFrame:
    """Add the numbers of the deleted lines (of those not empty, from 0) and the text that stays."""
    clash = {c.lower() for c in df.columns} & {removed.lower(), kept.lower(), "__runs"}
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already")
    found = find_runs(df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), extend)
    found = found.withColumnsRenamed({"doc_id": "__id", "runs": "__runs"})
    joined = df.join(found, F.col(doc_id).cast("long") == F.col("__id"), "left").drop("__id")

    names = df.columns

    def run(batches: Batches) -> Batches:
        for batch in batches:
            gone_, texts = [], []
            for value, runs in zip(batch.column(text).to_pylist(), batch.column("__runs").to_pylist(), strict=True):
                gone = {i for r in runs or () for i in range(r["line"], r["line"] + r["n"])}
                if gone:
                    lines, number = [], 0
                    for line in value.split("\n"):
                        counts = bool(line.strip(_BLANKS))
                        if not (counts and number in gone):
                            lines.append(line)
                        number += counts
                    value = "\n".join(lines)
                gone_.append(sorted(gone))
                texts.append(value)
            columns = [batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(gone_, pa.list_(pa.int32())), pa.array(texts, pa.string())], names=[*names, removed, kept])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]
    return map_batches(joined, run, ", ".join([*fields, f"`{removed}` array<int>", f"`{kept}` string"]))
