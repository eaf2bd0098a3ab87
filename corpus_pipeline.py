"""Corpus pipeline: toxicity, near-duplicates, repeated passages, benchmark leaks, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next stage's docs.  All but the last return the columns of ``documents``.
Scratch tables of a stage are dropped when the next stage starts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import op3_bpe, op6_suffix_dedup, op7_minhash, op8_decontam, op10_toxicity
from panelspark.llm.common import Scratch, wrapped
from panelspark.llm.queries import table, tokenizer_path

_LAST: list[Scratch] = []


def _scratch(spark: SparkSession) -> Scratch:
    """A new scratch; that of the stage before, whose output has been written by now, goes."""
    while _LAST:
        old = _LAST.pop()
        if old.spark.sparkContext is spark.sparkContext:
            old.drop()
    _LAST.append(Scratch(spark))
    return _LAST[-1]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (score of 0.5 or more) go."""
    _scratch(spark)
    model = op10_toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return op10_toxicity.score(wrapped(docs, text="text"), model).where("predicted = 0").select("__row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (similarity of 0.8 or more) stays."""
    return op7_minhash.dedup(docs, percent=80, scratch=_scratch(spark))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings of 200 that stand in several places are cut; documents stay, n_chars follows."""
    cut = op6_suffix_dedup.dedup(wrapped(docs, text="text"), as_text=True, scratch=_scratch(spark))
    new = {"text": F.when(F.col("text").isNotNull(), F.col("kept")), "n_chars": F.length("kept").cast("long")}
    return cut.select(*[new.get(c, F.col("__row")[c]).alias(c) for c in docs.columns])


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with any 10 words of a benchmark item (or a whole shorter item) go."""
    _scratch(spark)
    return op8_decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the digest of what they decode to."""
    _scratch(spark)
    done = op3_bpe.encode(docs.select("doc_id", "text", "lang", "source"), tokenizer_path(), decoded=True)
    return done.select("doc_id", "lang", "source", "ids", *op3_bpe.digests())


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("token_ids", token_ids),
]

#: The learned classifier and the vocabulary's merges have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's result."""
    docs, between = table(spark, sf_dir, "documents"), Scratch(spark)
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if stage is not STAGES[-1][1]:
            docs = between.write(docs, f"stage-{name}")
    return docs
