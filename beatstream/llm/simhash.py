"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint is the bitwise majority of the 64-bit hashes of a text's word shingles.
Two fingerprints that differ in at most ``max_bits`` bits are linked.  A fingerprint is
cut into ``max_bits // 2 + 1`` segments, so that of two linked ones at least one segment
differs by at most one bit.  Every segment is indexed as it is and once with each bit
masked (one wildcard); equal variants are joined and the whole distance is verified in
the join.  Exact repeats are folded first, so copies never meet in pairs.  Joins of
fingerprints are sort-merge joins at every size: Spark takes a written table for as large
as its compressed file, and an explode of one for no larger, and would broadcast it.

Segment values shared by more than ``crowded`` fingerprints would still give a square of
pairs.  Fingerprints holding or adjoining such a value are linked another exact way: two
of them are within ``max_bits`` bits if and only if some point lies within ``max_bits/2``
bits of both, so each is spread over those points and every point links its members to
the smallest one.  That work grows with the number of fingerprints, however they cluster.

Null and empty texts have fingerprint zero and are linked like any other; very long texts
count with all their shingles.  Repeated rows and equal texts share a fingerprint, hence a
component.  Rows with a null id keep their fingerprint but cannot name a component (a component
of null ids only has a null id).  Extra columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatstream.llm.common import connected_components, written

SEED = 42  # fixed value: seed of the shingle hash


def text_fingerprint(text: str | None, shingle_words: int = 4) -> int:
    """Unsigned fingerprint of one text (A-Z lowered, words split at ASCII white space)."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle_words, len(words))
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(joined[a:b], SEED) for a, b in
                       zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist(), strict=True)], "<u8")
    ones = np.zeros(64, np.uint64)
    for part in range(0, len(hashes), 4096):
        block = hashes[part:part + 4096]
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle_words: int = 4) -> Column:
    """Fingerprint as a signed long (the same 64 bits)."""

    @F.pandas_udf("long")
    def fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            out = np.array([text_fingerprint(t, shingle_words) for t in s], np.uint64)
            yield pd.Series(out.view(np.int64))

    return fingerprints(text)


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of the segments: max_bits // 2 + 1 nearly equal ones."""
    n = max_bits // 2 + 1
    cuts = [64 * i // n for i in range(n + 1)]
    return list(zip(cuts, (b - a for a, b in zip(cuts, cuts[1:], strict=False)), strict=False))


def _segment_value(fp: Column, lo: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << width) - 1))


def links(fps: DataFrame, max_bits: int = 4, crowded: int = 2048) -> DataFrame:
    """Edges (src, dst) between distinct fingerprints ``fp`` that join all linked ones.

    Every edge of uncrowded variants is a true link; crowded points give star edges
    whose ends are linked too.  Together they have the same components as all links.
    """
    if max_bits % 2 or not 0 < max_bits < 64:
        raise ValueError("max_bits must be even and between 2 and 62")
    segs = segments(max_bits)
    fp = F.col("fp")
    values = fps.select("fp", F.posexplode(F.array(*[_segment_value(fp, lo, w) for lo, w in segs])).alias("seg", "value"))

    # segment values held by many fingerprints, and the values one bit away from them
    hot = (values.groupBy("seg", "value").agg(F.count(F.lit(1)).alias("n"))
           .where(F.col("n") > crowded).select("seg", "value"))
    flips = F.element_at(F.array(*[F.array(F.lit(0).cast("long"), *[F.lit(1 << i) for i in range(w)])
                                   for _, w in segs]), F.col("seg") + 1)
    near_hot = (hot.select("seg", F.explode(flips).alias("flip"), "value")
                .select("seg", F.col("value").bitwiseXOR(F.col("flip")).alias("value")).distinct())
    crowd = values.join(near_hot, ["seg", "value"], "left_semi").select("fp").distinct()
    values = written(values.join(hot, ["seg", "value"], "left_anti").select("fp", "seg", "value"), "simhash-segments")

    # equal segments
    far = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    left, right = values.toDF("a", "seg", "value"), values.toDF("b", "seg2", "value2")
    equal = left.join(right.hint("merge"), (F.col("seg") == F.col("seg2")) & (F.col("value") == F.col("value2"))
                      & (F.col("a") < F.col("b")) & far).select("a", "b")
    # segments that differ in the masked bit: one side has it clear, the other set
    masks = F.element_at(F.array(*[F.array(*[F.lit(1 << i) for i in range(w)]) for _, w in segs]), F.col("seg") + 1)
    variant = values.select("fp", "value", "seg", F.explode(masks).alias("bit"))
    key = F.col("value").bitwiseAND(F.bitwise_not(F.col("bit")))
    # (segment, masked bit, masked value) in one number: the set bit's variants and the clear bit's meet
    variant = variant.select("fp", F.xxhash64("seg", "bit", key).alias("key"),
                             (F.col("value").bitwiseAND(F.col("bit")) != 0).alias("on"))
    off = variant.where(~F.col("on")).select(F.col("fp").alias("a"), F.col("key").alias("ka"))
    on = variant.where("on").select(F.col("fp").alias("b"), F.col("key").alias("kb"))
    one = off.join(on.hint("merge"), (F.col("ka") == F.col("kb")) & far).select("a", "b")

    return equal.union(one).union(_star_links(crowd, max_bits // 2)).toDF("src", "dst")


def _star_links(crowd: DataFrame, radius: int) -> DataFrame:
    """Edges from fingerprints to the smallest one with which they share a point.

    A point has at most as many members as the ball has points (2,081 at radius 2).
    """
    masks = sorted(sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(64), r))
    signed = np.array(masks, np.uint64).view(np.int64).tolist()
    ball = crowd.select("fp", F.explode(F.array(*[F.lit(m) for m in signed])).alias("mask"))
    points = ball.groupBy(F.col("fp").bitwiseXOR(F.col("mask")).alias("point")).agg(F.collect_set("fp").alias("fps"))
    return (points.where(F.size("fps") > 1).select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
            .where("a < b").distinct())


def _components(docs: DataFrame, shingle_words: int, max_bits: int, crowded: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id, fp) of every row, (fp, smallest id) of every fingerprint, (fp, root) of the linked ones."""
    rows = written(docs.select("doc_id", fingerprint_column(F.col("text"), shingle_words).alias("fp")), "simhash")
    fps = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    return rows, fps, connected_components(links(fps.select("fp"), max_bits, crowded)).toDF("fp", "root")


def near_duplicates(docs: DataFrame, shingle_words: int = 4, max_bits: int = 4, crowded: int = 2048) -> DataFrame:
    """(doc_id, fp, component_id) of every row; component_id is the smallest reachable doc_id."""
    rows, fps, comp = _components(docs, shingle_words, max_bits, crowded)
    linked = fps.join(comp.hint("merge"), "fp")
    smallest = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    moved = linked.join(smallest, "root").select(F.col("fp").alias("fp2"), F.col("component_id").alias("moved"))
    # a table of its own, so that the join below shuffles both sides and can split a frequent fingerprint
    ids = written(fps.join(moved.hint("merge"), F.col("fp") == F.col("fp2"), "left").select(
        F.col("fp").alias("fp3"), F.coalesce("moved", "first_id").alias("component_id")), "simhash-components")
    return rows.join(ids.hint("merge"), F.col("fp") == F.col("fp3")).select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, shingle_words: int = 4, max_bits: int = 4, crowded: int = 2048) -> DataFrame:
    """One row of each component: that of the smallest (doc_id, fp); of rows that repeat both, one text by its hash.

    An id may stand on rows with different texts: each component decides for its own rows.
    Rows without an id are decided among themselves, one row of each component by a hash of
    its text, as a row without an id can't stand for one with an id or the reverse.

    All is decided on a narrow table of ids, fingerprints and text hashes.  The texts are
    fingerprinted once and shuffled once, to meet the decisions.
    """
    texts = [F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2")]
    rows = written(docs.select("doc_id", fingerprint_column(F.col("text"), shingle_words).alias("fp"), *texts), "simhash")
    # rows that are equal in id and text, counted; then the first of each fingerprint, with and without an id
    rows = rows.groupBy("fp", "doc_id", "t1", "t2").agg(F.count(F.lit(1)).alias("copies"))
    row = F.struct("doc_id", "fp", "t1", "t2", "copies")
    named = F.min(F.when(F.col("doc_id").isNotNull(), row)).alias("named")
    lost = F.min(F.when(F.col("doc_id").isNull(), F.struct("t1", "t2", "fp", "copies"))).alias("lost")
    fps = written(rows.groupBy("fp").agg(named, lost), "simhash-distinct")
    comp = connected_components(links(fps.select("fp"), max_bits, crowded)).toDF("fp2", "root")
    firsts = (fps.join(comp.hint("merge"), F.col("fp") == F.col("fp2"), "left").groupBy(F.coalesce("root", "fp").alias("root"))
              .agg(F.min("named").alias("named"), F.min("lost").alias("lost")))
    decided = [F.col(f"{which}.{c}").alias(f"kept_{c}") for which in ("named", "lost") for c in ("t1", "t2", "copies")]
    firsts = written(
        firsts.where("named is not null").select(F.col("named.doc_id").alias("kept_id"), *decided[:3])
        .union(firsts.where("lost is not null").select(F.lit(None), *decided[3:])), "simhash-first")

    whole = docs.select(F.struct("*").alias("_row")).select(
        "_row", F.xxhash64("_row.text").alias("_t1"), F.xxhash64(F.lit(1), "_row.text").alias("_t2"))

    def meets(kept: DataFrame) -> DataFrame:
        return whole.join(kept, (F.col("_t1") == F.col("kept_t1")) & (F.col("_t2") == F.col("kept_t2"))
                          & F.col("_row.doc_id").eqNullSafe(F.col("kept_id")))

    # one strategy at every size: the narrow side is hashed, the texts aren't sorted
    out = meets(firsts.where("kept_copies = 1").hint("shuffle_hash")).select("_row.*")
    again = firsts.where("kept_copies > 1").hint("merge")
    if again.head(1):  # rows that repeat id and text
        out = out.unionByName(meets(again).groupBy("kept_id", "kept_t1", "kept_t2")
                              .agg(F.min_by("_row", F.xxhash64("_row")).alias("_row")).select("_row.*"))
    return out


def hex_digits(fp: Column) -> Column:
    """Sixteen lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
