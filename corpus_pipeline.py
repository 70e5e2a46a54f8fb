"""A training-corpus pipeline: each stage applies one operator to all that its predecessor kept.

Every stage is a function of (spark, docs, sf_dir) that returns a DataFrame; all but the last return the columns of
documents. `run` writes each result as Parquet to the shared folder and reads it again as the next stage's input, so a lost
executor never costs more than the stage at hand.

Defined results of all stages: columns of documents beside COLUMNS don't go on; empty tables give empty ones; rows without doc_id
pass through as rows of their own (only the Jaccard join links none of them); rows with the same doc_id are judged each by its
text, but a doc_id that the join or the decontamination drops goes with all its rows. A null or empty text has no words,
so the quality rules drop it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import op2_bpe, op4_decontaminate, op7_linededup, op8_quality, op10_jaccard
from tessera.llm.common import Scratch, table
from tessera.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the trees reject go."""
    model = op8_quality.fit(docs, table(spark, sf_dir, "labels"))
    return op8_quality.judge(docs, model, COLUMNS).where("kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go from every text; n_chars follows the text."""
    kept = op7_linededup.dedup(docs, least_documents=10, carried=["doc_id", "lang", "source"])
    return kept.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group of near copies stays."""
    return op10_jaccard.one_of_each(docs).select(*COLUMNS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return op4_decontaminate.clean(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def bpe_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return op2_bpe.encode_documents(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_codec", bpe_codec),
]

#: Trees, exact set similarity over components and the tokenizer aren't expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table documents."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"{k}-{name}")
        if k:
            scratch.drop(f"{k - 1}-{STAGES[k - 1][0]}")
    return docs
