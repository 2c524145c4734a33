"""Line dedup by winnowing over line hashes, in DataFrame functions only.

A run of consecutive lines with at least ``min_words`` words that occurs again later (in a
later document, or further down the same one) is deleted there; its first occurrence stays.
Lines are compared without outer blanks; lines without words are skipped over and kept.

Every line starts a window: the shortest run from it that reaches ``min_words``; every line
also ends one.  The line with the smallest hash in a window is its fingerprint, so two
documents that share a long enough run always share a fingerprint.  Windows whose
fingerprint occurs at one place only are dropped; the others are joined to the first place
that holds the same lines.  A match is extended both ways by the matches next to it: the
windows that start in a run and the windows that end in it together cover the whole run.
Every step is a grouped minimum or a join to one first place, never pairs of places.

Null and empty texts have one empty line and stay; texts and lines may have any length.  Rows
that repeat both id and text are one document and get the same result; of one id's texts the
order is by hash; null ids come first.  Extra columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatstream.llm.common import written


def _keys() -> list[Column]:
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long")).alias("id"),
            F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash")]


def _lines() -> Column:
    return F.split(F.coalesce("text", F.lit("")), "\n")


def windows(docs: DataFrame, min_words: int) -> DataFrame:
    """(id, hash, places, k1, k2, mark, spot) of every shortest run with ``min_words`` words.

    ``places`` are the positions of the run's lines with words, ``k1, k2`` two hashes of those
    lines in order, ``mark`` is the smallest line hash and ``spot`` its first position.
    """
    lines = (docs.select(*_keys(), F.posexplode(F.transform(_lines(), lambda x: F.struct(
                F.xxhash64(F.trim(x)).alias("line"), F.regexp_count(x, F.lit(r"\S+")).alias("words")))))
             .select("id", "hash", "pos", "col.line", "col.words").where("words > 0").distinct())
    doc = Window.partitionBy("id", "hash")
    lines = lines.withColumn("through", F.sum("words").over(doc.orderBy("pos")))
    lines = lines.withColumn("before", F.col("through") - F.col("words"))
    found = []
    for w in (doc.orderBy("before").rangeBetween(0, min_words - 1),
              doc.orderBy("through").rangeBetween(-(min_words - 1), 0)):
        run = F.collect_list("line").over(w)
        found.append(lines.select("id", "hash", F.collect_list("pos").over(w).alias("places"),
                                  F.sum("words").over(w).alias("total"), run.alias("run"))
                     .where(F.col("total") >= min_words)
                     .select("id", "hash", "places", F.xxhash64("run").alias("k1"),
                             F.xxhash64(F.lit("second"), "run").alias("k2"), F.array_min("run").alias("mark"),
                             F.element_at("places", F.array_position("run", F.array_min("run")).cast("int")).alias("spot")))
    return found[0].unionByName(found[1])


def repeated_lines(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """(id, hash, removed, first_ids): positions of deleted lines, and where the runs occur first."""
    runs = written(windows(docs, min_words), "line-windows")
    first, last = F.element_at("places", 1), F.element_at("places", -1)
    place = F.struct("id", "hash", first.alias("first"), last.alias("last"))
    # the index: fingerprints that more than one place selects
    mark = F.struct("id", "hash", "spot")
    index = (runs.groupBy("mark").agg(F.min(mark).alias("low"), F.max(mark).alias("high"))
             .where("low != high").select("mark"))
    # tables of their own: a join with one shuffles both sides, and can split a frequent run
    candidates = written(runs.join(written(index, "line-marks"), "mark", "left_semi"), "line-candidates")
    firsts = (candidates.groupBy("k1", "k2").agg(F.min(place).alias("origin"), F.max(place).alias("latest"))
              .where("origin != latest").select(F.col("k1").alias("o1"), F.col("k2").alias("o2"), "origin"))
    firsts = written(firsts, "line-firsts")
    o = F.col("origin")
    same = (o["id"] == F.col("id")) & (o["hash"] == F.col("hash"))
    later = (candidates.join(firsts, (F.col("k1") == F.col("o1")) & (F.col("k2") == F.col("o2")))
             .where(~same | (first > o["last"])))
    return (later.select("id", "hash", F.explode("places").alias("pos"), o["id"].alias("origin_id"))
            .groupBy("id", "hash").agg(F.array_sort(F.collect_set("pos")).alias("removed"),
                                       F.array_sort(F.collect_set("origin_id")).alias("first_ids")))


def dedup_lines(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """(doc_id, text, n_lines, removed, first_ids) of every row; text is what is left of it.

    ``removed`` holds the positions (from 0) of deleted lines, ``first_ids`` the documents
    that keep them.
    """
    found = repeated_lines(docs, min_words).select(F.col("id").alias("i"), F.col("hash").alias("h"), "removed",
                                                   "first_ids")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *_keys())
    lines = _lines()
    at = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "removed")
    left = F.array_join(F.transform(at, lambda i: F.element_at(lines, i + 1)), "\n")
    none = F.array().cast("array<int>")
    return (rows.join(found, (F.col("id") == F.col("i")) & (F.col("hash") == F.col("h")), "left")
            .select("doc_id", F.when(F.col("removed").isNull(), F.col("text")).otherwise(left).alias("text"),
                    F.size(lines).alias("n_lines"), F.coalesce("removed", none).alias("removed"),
                    F.coalesce("first_ids", F.array().cast("array<bigint>")).alias("first_ids")))
