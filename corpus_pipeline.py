"""A corpus from raw documents to token ids, in five stages.

Each stage takes ``(spark, docs, sf_dir)``, calls one operator of ``pricelens.llm`` over all that the stage
before it kept, and returns a DataFrame that is written and read again as the next one's ``docs``:

1. ``quality``: the co-trained classifier rejects poor documents
2. ``lines``: lines that many documents hold stay in one of them
3. ``near_duplicates``: one document of each SimHash group stays
4. ``mixture``: words of the sources in proportion to the target weights; a document that is taken in part
   keeps the words taken, one that is taken twice has a row for each time
5. ``tokens``: SentencePiece ids, decoded again

All but the last return the columns of ``documents``; the last returns a row per row of the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricelens.llm import line_dedup, mixture, quality, simhash, sp_encode
from pricelens.llm.common import prepare, table, written
from pricelens.llm.queries import PIECE_MODEL


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return line_dedup.without_repeated_lines(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash.one_of_each_group(docs)


def mixture_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixture.mixed_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return sp_encode.token_report(docs, PIECE_MODEL)


STAGES = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("mixture", mixture_stage),
    ("tokens", token_stage),
]

#: Fingerprints, trained weights and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the whole of ``documents``."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
