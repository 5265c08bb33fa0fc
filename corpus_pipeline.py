"""The corpus pipeline: documents through the operators of ``tidylake.llm``.

``STAGES`` lists (name, function) in order; a function takes (spark, docs,
sf_dir) and returns a DataFrame that is written as Parquet and read again as the
next stage's ``docs``.  ``run`` applies all stages to the documents table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidylake.llm import bpe, mixing, quality, token_groups, toxicity
from tidylake.llm.common import DOCUMENT_COLUMNS, stored
from tidylake.llm.queries import WORD_FILE


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.compression_bands(docs).where("kept").select(*DOCUMENT_COLUMNS)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; the model learns from the labelled
    documents of ``sf_dir``."""
    model = toxicity.train(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                           spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.toxicity(docs, model).where("predicted = 0").select(*DOCUMENT_COLUMNS)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return token_groups.deduplicated(docs).select(*DOCUMENT_COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: every document as often as it is taken."""
    return mixing.mixed(docs).select(*DOCUMENT_COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix."""
    ids = bpe.encoded(docs.select("doc_id", "text"), public_tokenizers.path(WORD_FILE))
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", without_toxic),
    ("n-gram Jaccard join", without_copies),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode),
]

#: SQL can express neither zstandard ratios nor a trained model.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
