"""Benchmark decontamination in DataFrame functions alone.

Words are the runs of 0-9, a-z and non-ASCII characters after lower-casing A-Z. A window is WIDTH
consecutive words of an item, or the whole item where it has fewer. The windows are a broadcast
hash set keyed by one word of each, guarded by its size; documents' words are scanned against
it, windows are verified word by word, and every word inside an occurrence is hit.

Null and empty texts have no words, and so no windows and no hits. Items with equal windows are
all reported. Repeated documents are reported each. An empty item table leaves all documents
clean; an empty document table gives no rows. Extra columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.session import materialize

WIDTH = 10
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_EDGES = "".join(chr(c) for c in range(128) if not chr(c).isalnum())

#: Bytes of the window set that are broadcast; a larger set is joined by a shuffle on the anchor word.
BROADCAST_BYTES = 64 << 20


def words(text: str | Column) -> Column:
    """The words of a text; none for null."""
    text = F.col(text) if isinstance(text, str) else text
    ascii_only = F.octet_length(text) == F.char_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))
    trimmed = F.btrim(lowered, F.lit(_EDGES))
    none = F.array().cast("array<string>")
    return F.when(F.octet_length(trimmed) > 0, F.split(trimmed, _BETWEEN)).otherwise(none)


def item_windows(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """anchor, offset, n, window, items: each distinct window with the ids of the items that hold it.

    The anchor is the window's longest word, the first of equals, since long words are rare; the
    set is keyed by it, so that most words of a text fail at the first probe.
    """
    split = items.select(F.col(item_id).cast("string").alias("item"), words(text).alias("w")).filter(F.size("w") > 0)
    last = F.greatest(F.size("w") - F.lit(WIDTH - 1), F.lit(1))
    windows = split.select("item", F.explode(
        F.transform(F.sequence(F.lit(1), last), lambda i: F.slice("w", i, WIDTH))).alias("window"))
    longest = F.array_max(F.transform("window", lambda x: F.char_length(x)))
    offset = F.array_position(F.transform("window", lambda x: F.char_length(x)), longest).cast("int")
    return windows.groupBy("window").agg(F.collect_set("item").alias("items")).select(
        F.element_at("window", offset).alias("anchor"), offset.alias("offset"), F.size("window").alias("n"), "window", "items")


def find_hits(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for every document: doc_key, n_words, hits (start and length of occurring windows), items.

    The documents are split into words once, and never leave their task: a word that is an anchor
    meets the windows around it, which are compared whole. Each document also sends the empty
    word, which meets a row of its own, so that clean documents come through the same join. What is
    grouped holds no words: a sort of rows with all words of their documents takes several times the text.
    """
    spark = docs.sparkSession
    found = materialize(item_windows(items), "benchmark-windows")
    size = found.agg(F.sum(F.octet_length(F.array_join("window", "")) + F.size("items") * 16 + 100)).first()[0] or 0
    mark = spark.createDataFrame([("", 0, 0, [], [])], found.schema)
    known = found.unionByName(mark)
    few = size <= BROADCAST_BYTES
    split = docs.select(F.col(doc_id).alias("doc_key"), words(text).alias("w"))
    scanned = split.select("doc_key", "w", F.size("w").alias("n_words"), F.posexplode(F.concat(F.array(F.lit("")), "w")).alias("position", "word"))
    first = F.lit(1)
    if few:
        known = F.broadcast(known)
    else:  # a word is sent with as much as a window can hold around it
        first = F.greatest(F.col("position") - (WIDTH - 1), F.lit(1))
        scanned = scanned.withColumn("w", F.slice("w", first, 2 * WIDTH - 1))
    begin = F.col("position") - F.col("offset") + 1
    same = (F.col("n") == 0) | ((begin >= 1) & (F.slice("w", F.greatest(begin - first + 1, F.lit(1)), F.greatest("n", F.lit(1))) == F.col("window")))
    met = scanned.join(known, (F.col("word") == F.col("anchor")) & same).select(
        "doc_key", "n_words", F.when(F.col("n") > 0, F.struct(begin.alias("at"), "n")).alias("hit"), "items")
    return met.groupBy("doc_key").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.array_sort(F.collect_set("hit")).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )


def hit_words(hits: str | Column) -> Column:
    """How many words the union of sorted hits covers."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(
        hits, zero,
        lambda acc, h: F.struct(
            F.greatest(acc["end"], h["at"] + h["n"]).alias("end"),
            (acc["n"] + F.greatest(h["at"] + h["n"] - F.greatest(acc["end"], h["at"]), F.lit(0))).alias("n")),
        lambda acc: acc["n"].cast("long"),
    )


def report(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The contract columns: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    n_hit = hit_words("hits")
    return find_hits(docs, items, doc_id, text).select(
        F.col("doc_key").alias(doc_id), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def remove_contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without any hit."""
    hit = find_hits(docs, items, doc_id, text).filter(F.size("hits") > 0).select(F.col("doc_key").alias(doc_id))
    return docs.join(hit, doc_id, "left_anti")
