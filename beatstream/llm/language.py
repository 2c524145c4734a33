"""Language identification of web pages by Bayesian evidence fusion.

Four kinds of evidence are multiplied: the likelihood of the page's text under character
trigram models, the language that the markup declares, the address suffix, and a host
prior.  How far declarations and suffixes can be trusted is learned from the pages
themselves: grouped sums of the text posteriors give P(declared | language) and
P(suffix | language).  Host priors are smoothed along global -> domain -> host, each level
a grouped sum with the level above as its Dirichlet prior, and without the page's own vote.

Pages of any length are read whole.  Pages with null or empty text, markup or url lose only
that evidence: the missing value is a value of its own.  Repeated rows are judged once each,
ties go to the first language in alphabetical order.  Extra columns are ignored.  Without training texts, or without pages,
the result is empty.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatstream.llm.common import hash_sample, written
from beatstream.llm.urls import url_parts

BUCKETS = 1 << 15       # hashed trigrams
INVISIBLE = re.compile(r"(?is)<(script|style|noscript)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")
DECLARED = r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})\b"


def visible_text(page: str | None) -> str:
    return " ".join(entities.unescape(INVISIBLE.sub(" ", page or "")).split())


def trigrams(text: str) -> np.ndarray:
    """Hash buckets of the character trigrams of the lower-case text, padded with blanks."""
    c = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
    if len(c) < 3:
        return np.zeros(0, np.int64)
    h = (c[:-2] * np.uint64(0x9E3779B1) ^ c[1:-1] * np.uint64(0x85EBCA77) ^ c[2:] * np.uint64(0xC2B2AE3D))
    h *= np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(64 - 15)).astype(np.int64)


def fit_text_model(docs: DataFrame, per_language: int = 3_000, smoothing: float = 0.5) -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities) from at most ``per_language`` texts of each language.

    The bound is on the training rows only (those with the smallest hash of their id); counts are
    summed by Spark and one row per language and bucket is read.
    """
    ids = docs.where("lang is not null and doc_id is not null").select("doc_id", "lang").distinct()
    sample = hash_sample(ids, "lang", per_language)
    rows = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
            .join(F.broadcast(sample), "doc_id").select("lang", "text"))  # bounded above

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lang, part in b.groupby("lang"):
                total = np.zeros(BUCKETS, np.int64)
                for t in part["text"]:
                    total += np.bincount(trigrams(t), minlength=BUCKETS)
                at = np.nonzero(total)[0]
                yield pd.DataFrame({"lang": lang, "bucket": at, "n": total[at]})

    sums = (rows.mapInPandas(count, "lang string, bucket long, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    languages = sorted(sums["lang"].unique())
    counts = np.full((len(languages), BUCKETS), smoothing)
    for i, lang in enumerate(languages):
        part = sums[sums["lang"] == lang]
        counts[i, part["bucket"].to_numpy()] += part["n"].to_numpy()
    return languages, np.log(counts / counts.sum(1, keepdims=True)) if languages else counts


def _evidence(pages: DataFrame, languages: list[str], logp: np.ndarray, strength: int) -> DataFrame:
    """Narrow row of each page: address parts, declared language and text log likelihoods t0, t1, ...

    The likelihood is the mean per trigram times at most ``strength``: neighbouring trigrams
    are not independent, and a long text must not silence all other evidence by its length.
    """
    host, _ = url_parts(F.col("url"))
    declared = F.lower(F.regexp_extract(F.coalesce("html", F.lit("")), DECLARED, 1))
    labels = F.split(host, r"\.")
    rows = pages.select("page_id", host.alias("host"),
                        F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".").alias("domain"),
                        F.element_at(labels, -1).alias("suffix"), declared.alias("declared"), "html")
    names = [f"t{i}" for i in range(len(languages))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ll = np.zeros((b.num_rows, len(languages)))
            for i, page in enumerate(b.column(5)):
                at = trigrams(visible_text(page.as_py()))
                if len(at):
                    ll[i] = logp[:, at].mean(1) * min(len(at), strength)
            ll -= ll.max(1, initial=-1e300, keepdims=True) if len(languages) else 0
            yield pa.RecordBatch.from_arrays([*b.columns[:5], *(pa.array(ll[:, i]) for i in range(len(languages)))],
                                             [*b.schema.names[:5], *names])

    schema = "page_id long, host string, domain string, suffix string, declared string"
    rows = rows.withColumn("page_id", F.col("page_id").cast("long"))
    return written(rows.mapInArrow(run, ", ".join([schema, *(f"{n} double" for n in names)])), "language-evidence")


def identify(pages: DataFrame, docs: DataFrame, per_language: int = 3_000, strength: int = 60,
             weight: float = 5.0) -> DataFrame:
    """(page_id, lang, score, text_lang, declared, host): posterior language of every page.

    ``weight`` is the number of pages that the level above counts for in smoothing.
    """
    spark = pages.sparkSession
    languages, logp = fit_text_model(docs, per_language)
    schema = "page_id long, lang string, score double, text_lang string, declared string, host string"
    if not languages:
        return spark.createDataFrame([], schema)
    n = range(len(languages))
    rows = _evidence(pages, languages, logp, strength)
    total = sum((F.exp(F.col(f"t{i}")) for i in n), F.lit(0.0))
    rows = rows.withColumns({f"r{i}": F.exp(F.col(f"t{i}")) / total for i in n})

    def sums(level: str) -> DataFrame:
        return rows.groupBy(F.col(level).alias(f"{level}_key")).agg(
            *[F.sum(f"r{i}").alias(f"{level}_{i}") for i in n])

    host, domain = sums("host"), sums("domain")
    declared, suffix = sums("declared"), sums("suffix")
    everything = rows.agg(*[F.sum(f"r{i}").alias(f"all_{i}") for i in n], F.count(F.lit(1)).alias("pages")).first()
    of_all = [float(everything[f"all_{i}"] or 0.0) for i in n]
    pages_n = float(everything["pages"])
    # base rate of a value, for smoothing P(value | language)
    values = {level: weight / 10 for level in ("declared", "suffix")}

    def likelihood(level: str, i: int) -> Column:
        own = F.col(f"{level}_{i}") - F.col(f"r{i}")
        base = sum((F.col(f"{level}_{j}") for j in n), F.lit(0.0)) / max(pages_n, 1.0)
        return F.log((F.greatest(own, F.lit(0.0)) + values[level] * base + 1e-6) / (of_all[i] + values[level] + 1e-6))

    def smoothed(level: str, i: int, above: Column) -> Column:
        own = F.greatest(F.col(f"{level}_{i}") - F.col(f"r{i}"), F.lit(0.0))
        all_ = F.greatest(sum((F.col(f"{level}_{j}") for j in n), F.lit(0.0)) - 1.0, F.lit(0.0))
        return (own + weight * above) / (all_ + weight)

    joined = rows
    for level, part in (("host", host), ("domain", domain), ("declared", declared), ("suffix", suffix)):
        joined = joined.join(part, F.col(level) == F.col(f"{level}_key"))
    prior = [(x + 1.0) / (pages_n + len(languages)) for x in of_all]
    joined = joined.withColumns({f"p{i}": smoothed("domain", i, F.lit(prior[i])) for i in n})
    joined = joined.withColumns({
        f"s{i}": F.col(f"t{i}") + likelihood("declared", i) + likelihood("suffix", i)
        + F.log(smoothed("host", i, F.col(f"p{i}"))) for i in n})
    top = F.greatest(*[F.col(f"s{i}") for i in n]) if len(languages) > 1 else F.col("s0")
    text_top = F.greatest(*[F.col(f"t{i}") for i in n]) if len(languages) > 1 else F.col("t0")
    pick = F.coalesce(*[F.when(F.col(f"s{i}") == top, F.lit(languages[i])) for i in n])
    text_pick = F.coalesce(*[F.when(F.col(f"t{i}") == text_top, F.lit(languages[i])) for i in n])
    mass = sum((F.exp(F.col(f"s{i}") - top) for i in n), F.lit(0.0))
    return joined.select("page_id", pick.alias("lang"), (1.0 / mass).alias("score"), text_pick.alias("text_lang"),
                         "declared", "host")
