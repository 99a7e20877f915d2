"""The corpus pipeline: ``documents`` are cleaned stage by stage and packed.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet into
the shared folder and read again as the next stage's docs.  All stages but the
last return the columns of ``documents``.  Once a stage's result is written, its
intermediates and its input's copy are removed, so one copy of the corpus lies
in the shared folder at a time, two while a stage runs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.llm import decontaminate, langid, packing, pii, simhash
from cardsentry.llm.common import read_table, scratch_path
from cardsentry.llm.queries import SURROGATE_KEY
from cardsentry.session import delete_path, scratch_scope


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a determined language."""
    model = langid.fit(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return langid.identified(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates."""
    return simhash.one_of_each(docs, ngram=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a benchmark item occurs."""
    return decontaminate.without_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts and sets n_chars to their new length."""
    replaced = pii.replace(docs, SURROGATE_KEY)
    return replaced.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.char_length("text").cast("long")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece with its sequence and offset."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), window=4096, end_id=2)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("surrogates", surrogates),
    ("packing", packed),
]

# The stages hash, tokenize and verify edit distances: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to ``documents`` and return the last one's rows."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        with scratch_scope(spark):
            result = stage(spark, docs, sf_dir)
            result.write.parquet(path)
        if before is not None:
            delete_path(spark, before)
        docs, before = spark.read.schema(result.schema).parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
