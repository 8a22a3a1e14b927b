"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the last
return the columns of ``documents``; the last returns a row of token digests for each document.
Nulls, empty texts and repeated rows are treated as the operators state: texts without a
letter are rejected first, and empty tables pass through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import bpe, decontaminate, language, lines, near_dup
from panelspark.llm.common import fold, table
from panelspark.llm.queries import WORD_BPE
from panelspark.session import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language. Texts without one (null, or no letter) are rejected."""
    samples = language.learn(docs, fold("doc_id", 5) != 0)
    found = language.identify(docs, samples, lang_pred="__lang", score="__score")
    return found.filter(F.col("__lang") != "und").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of lines that repeat earlier ones, extended both ways. A document of which nothing stays goes."""
    found = lines.remove_lines(docs, removed="__removed", kept="__kept", extend=True)
    emptied = (F.size("__removed") > 0) & (F.octet_length(F.btrim("__kept", F.lit(" \t\r\n"))) == 0)
    own = {"text": F.col("__kept").alias("text"), "n_chars": F.char_length("__kept").cast("long").alias("n_chars")}
    return found.filter(~F.coalesce(emptied, F.lit(False))).select(*(own.get(c, F.col(c)) for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one of least id."""
    return near_dup.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text."""
    return bpe.digests(bpe.bpe_encode(docs.select("doc_id", "text"), WORD_BPE))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: Learned languages, sampled signatures and merges can't be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
