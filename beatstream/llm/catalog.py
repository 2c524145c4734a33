"""Registered queries of the training-data operators (thin: the work is in the operators)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatstream.llm import (
    decontaminate, language, lexical, lines, merkle, mixing, neighbours, quality, simhash, spotsigs, tokens, toxicity,
    urls,
)
from beatstream.llm.common import table
from beatstream.llm.oracle import ORACLE as ORACLE
from beatstream.session import shared_path

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
# fixed values: the rules that op8 applies (action, host, path)
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents by ascending id, read back and digested."""
    import public_tokenizers
    path = shared_path(spark, "op1-tokens")
    tokens.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER), END_ID)
    return token_digest(spark, path)


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the token files at ``path``."""
    return tokens.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model, threshold=0.5)


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document (4-word shingles, 4 bits)."""
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4, max_bits=4)
    return out.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model, threshold=0.3)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posterior language of every page; the text model is learned from ``documents``."""
    return language.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SpotSigs fingerprints of every document and its edited text, and their likeness."""
    return spotsigs.edited_fingerprints(table(spark, sf_dir, "documents"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every occurrence of a benchmark item in a document, with at most one edit in ten characters."""
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                                 q=8, edit_rate=0.1)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's url."""
    rules = spark.createDataFrame(URL_RULES, "action string, host string, path string")
    return (urls.judge(table(spark, sf_dir, "pages"), rules)
            .select("page_id", "host", "path", "rule", "verdict"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the later copies of runs of at least 50 words."""
    return (lines.dedup_lines(table(spark, sf_dir, "documents"), min_words=50)
            .select("doc_id", "text", "n_lines", F.size("removed").alias("n_removed"),
                    F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed_lines"),
                    F.array_join(F.col("first_ids").cast("array<string>"), ",").alias("first_ids")))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document in the mixture, with weights from the square roots of source sizes."""
    return mixing.positions(table(spark, sf_dir, "documents"), block_chars=100_000, power=0.5)


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every vector whose id is divisible by 20, by largest inner product."""
    found = neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)
    return found.withColumnRenamed("id", "vec_id")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle proof of every document, folded from a text without line ends where the id's crc32 is even."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    changed = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.manifest(table(spark, sf_dir, "documents"), changed, fanout=3).drop("proof")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 highest-scoring documents of every benchmark item."""
    return lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


QUERIES = {f.__name__: f for f in (
    op1_token_ids, op2_toxicity, op3_simhash_near_dedup, op4_quality_classifier, op5_language_id,
    op6_document_fingerprints, op7_benchmark_decontamination, op8_url_filter, op9_line_dedup, op10_source_mixing,
    op11_nearest_neighbours, op12_merkle_manifest, op13_lexical_search)}
