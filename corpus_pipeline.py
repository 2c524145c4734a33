"""Corpus pipeline: quality filter, SimHash near-dedup, decontamination, mixing, token ids.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and
returns a DataFrame, which is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from beatstream.llm import catalog, decontaminate, mixing, quality, simhash, tokens
from beatstream.llm.common import deleted, scratch, table
from beatstream.session import shared_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.keep_quality(docs, model, threshold=0.3)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_first(docs, shingle_words=4, max_bits=4)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), q=8, edit_rate=0.1)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mixture; the files written from it keep that order."""
    return mixing.mixed(docs, block_chars=100_000, power=0.5)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order of the rows of ``docs`` (of their files), digested per document."""
    import public_tokenizers
    rows, order = tokens.in_file_order(docs)
    path = shared_path(spark, "pipeline-tokens")
    # the workers serve all stages one after another, so this one keeps little
    tokens.write_tokens(rows, path, public_tokenizers.path(catalog.TOKENIZER), catalog.END_ID, order_by=order,
                        remember=50_000, slice_chars=1_500_000)
    return catalog.token_digest(spark, path)


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", simhash_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources to target weights", mixing_stage),
    ("token-ID / binary output", token_stage),
]

# The classifier, the fingerprints and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = shared_path(spark, "pipeline-" + name.split()[0].lower())
        with scratch(spark):  # a stage's own tables go once its rows are written
            out = stage(spark, docs, sf_dir)
            out.write.option("compression", "zstd").parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            deleted(spark, before)
        before = path
    return docs
