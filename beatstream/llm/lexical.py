"""Ranked lexical search over norm buckets, as LEMP does for inner products.

A document is a vector of impacts over the terms of the items: for a term that occurs tf
times, (1000000000 tf) div (1000 tf + 20 m), where m = 50 + (50 n N) div L grows with the
document's share of all terms.  An item is a vector of its terms' weights
floor(1000 ln((2 N + 2) / (2 df + 1))); the score is the inner product, in whole numbers.

Documents are range-partitioned by the length of their impact vector, longest first, and cut
into buckets.  For an item with a lower bound on its last place, a bucket is skipped if the
item's length times the bucket's greatest length can't reach the bound (Cauchy-Schwarz).
Inside a bucket the item's heaviest coordinates are summed from inverted lists; a document
goes on only if that sum, plus a Cauchy-Schwarz or coordinate bound on the other ones, can
reach the bound.  Survivors are scored exactly in 64-bit integers.  The first bucket of
every partition is searched first and gives the bounds that the others start from.

Items are searched in blocks of about ``items_per_block``, chosen by a hash, so that what the
tasks are sent (a block's terms and weights) and what the driver holds is bounded by that;
every block is a pass over the documents.

Null and empty texts have no term: they count nowhere.  Texts of any length are read whole.
Rows that repeat an id are documents of their own; rows without an id count in the
statistics, but can't be returned.  Rows of ``items`` that share an id (or have none) are
one item with the terms of all.  Equal scores go by ascending id.  Extra columns are
ignored.  Empty tables give an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beatstream.llm.common import written

# separators become spaces, A-Z become a-z, all other bytes stay: bytes of 0x80 and above belong to terms
_FOLD = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 32
              for b in range(256))


def terms(text: str | bytes | None) -> list[bytes]:
    """All terms of a text in order, as UTF-8 bytes."""
    raw = text.encode("utf-8", "replace") if isinstance(text, str) else text or b""
    return raw.translate(_FOLD).split()


def _vectors(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document with a term: the terms that ``number`` numbers, as packed int32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = number.keys()
        for b in batches:
            texts = b.column(1).cast(pa.binary())
            for at in range(0, b.num_rows, 1024):
                ids, n, idx, tfs = [], [], [], []
                for d, x in zip(b.column(0)[at:at + 1024].to_pylist(), texts[at:at + 1024], strict=True):
                    words = terms(x.as_buffer().to_pybytes() if x.is_valid else None)
                    if not words:
                        continue
                    tf = Counter(words)
                    hit = sorted((number[t], tf[t]) for t in tf.keys() & known)
                    pairs = np.array(hit, np.int32).reshape(-1, 2)
                    ids.append(d)
                    n.append(len(words))
                    idx.append(pairs[:, 0].tobytes())
                    tfs.append(pairs[:, 1].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(idx, pa.binary()),
                     pa.array(tfs, pa.binary())], ["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return written(rows.mapInArrow(run, "doc_id long, n long, terms binary, tfs binary"), "lexical-vectors")


def _document_counts(vectors: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each of the ``size`` terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in batches:
            for x in b.column(0):
                total[np.frombuffer(x.as_buffer(), np.int32)] += 1
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["term", "n"])

    out = np.zeros(size, np.int64)
    for r in (vectors.select("terms").mapInArrow(run, "term long, n long")
              .groupBy("term").agg(F.sum("n").alias("n")).collect()):
        out[r.term] = r.n
    return out


def _by_length(vectors: DataFrame, documents: int, total: int, bucket_rows: int) -> DataFrame:
    """(doc_id, length, terms, impacts, bucket): ordered by length, longest first, cut into buckets per partition."""

    def impacts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths, packed = [], []
            for n, x in zip(b.column(1).to_pylist(), b.column(3), strict=True):
                tf = np.frombuffer(x.as_buffer(), np.int32).astype(np.int64)
                p = 1_000_000_000 * tf // (1000 * tf + 20 * (50 + 50 * n * documents // total))
                lengths.append(float(np.sqrt(np.square(p.astype(float)).sum())))
                packed.append(p.astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(lengths, pa.float64()), b.column(2), pa.array(packed, pa.binary())],
                ["doc_id", "length", "terms", "impacts"])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        for b in batches:
            at = (done + np.arange(b.num_rows)) // bucket_rows
            done += b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.int64())], [*b.schema.names, "bucket"])

    columns = "doc_id long, length double, terms binary, impacts binary"
    rows = vectors.where("doc_id is not null").mapInArrow(impacts, columns).where("length > 0")
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the hash splits runs of equal lengths
    order = [F.desc("length"), F.xxhash64("doc_id", "terms"), F.col("doc_id")]
    return written(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                   .mapInArrow(number, columns + ", bucket long"), "lexical-buckets")


def _search(buckets: DataFrame, items: list[tuple[np.ndarray, np.ndarray]], bounds: np.ndarray, k: int,
            bucket_rows: int, heavy: float) -> DataFrame:
    """(item, doc_id, score): the ``k`` best documents of each task for each item that reach the item's bound.

    ``items`` holds (term numbers, weights) by descending weight; ``bounds`` a lower bound on each last place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bound = np.maximum(bounds, 1)
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in items]
        size = 1 + max((int(t.max()) for t, _ in items if len(t)), default=0)
        lengths = [float(np.sqrt(np.square(w.astype(float)).sum())) for _, w in items]
        weight = np.zeros(size, np.int64)

        def search(ids: np.ndarray, length: np.ndarray, ptr: np.ndarray, idx: np.ndarray, imp: np.ndarray) -> None:
            # inverted lists of the bucket: rows and impacts by term
            row = np.repeat(np.arange(len(ids)), np.diff(ptr))
            by = np.argsort(idx, kind="stable")
            lists, rows, values = np.searchsorted(idx[by], np.arange(size + 1)), row[by], imp[by].astype(float)
            top = np.zeros(size)
            np.maximum.at(top, idx, imp)
            longest, squares = float(length.max()), np.square(length)
            for i, (t, w) in enumerate(items):
                slack = 1 - 1e-9  # for rounding in doubles
                if not len(t) or lengths[i] * longest < bound[i] * slack:
                    continue
                # the heaviest coordinates, until they hold a share of the item's squared length
                share = np.cumsum(np.square(w.astype(float)))
                cut = int(np.searchsorted(share, heavy * share[-1])) + 1
                part, seen = np.zeros(len(ids)), np.zeros(len(ids))
                for term, x in zip(t[:cut].tolist(), w[:cut].tolist(), strict=True):
                    a, b = lists[term], lists[term + 1]
                    v = values[a:b]
                    part[rows[a:b]] += x * v
                    seen[rows[a:b]] += v * v
                rest = float(np.sqrt(np.square(w[cut:].astype(float)).sum()))
                other = np.minimum(rest * np.sqrt(np.maximum(squares - seen, 0) + 1), float((w[cut:] * top[t[cut:]]).sum()))
                at = np.nonzero(part + other >= bound[i] * slack)[0]
                if not len(at):
                    continue
                weight[t] = w
                counts = ptr[at + 1] - ptr[at]
                starts = np.cumsum(counts) - counts
                flat = np.repeat(ptr[at] - starts, counts) + np.arange(counts.sum())
                score = np.add.reduceat(weight[idx[flat]] * imp[flat], starts)
                weight[t] = 0
                good = score >= bound[i]
                if not good.any():
                    continue
                s = np.concatenate([best[i][0], score[good]])
                d = np.concatenate([best[i][1], ids[at[good]]])
                if len(s) >= k:
                    o = np.lexsort((d, -s))[:k]
                    s, d = s[o], d[o]
                    bound[i] = max(bound[i], s[-1])
                best[i] = (s, d)

        def gathered() -> Iterator[tuple]:
            ids, length, idx, imp, held = [], [], [], [], 0
            for b in batches:
                for d, x, t, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3), strict=True):
                    ids.append(d)
                    length.append(x)
                    idx.append(np.frombuffer(t.as_buffer(), np.int32))
                    imp.append(np.frombuffer(p.as_buffer(), np.int32))
                    held += len(idx[-1])
                    if len(ids) == bucket_rows or held > 4_000_000:
                        yield ids, length, idx, imp
                        ids, length, idx, imp, held = [], [], [], [], 0
            if ids:
                yield ids, length, idx, imp

        for ids, length, idx, imp in gathered():
            ptr = np.concatenate([[0], np.cumsum([len(x) for x in idx])]).astype(np.int64)
            search(np.array(ids, np.int64), np.array(length), ptr, np.concatenate(idx),
                   np.concatenate(imp).astype(np.int64))
        for i, (s, d) in enumerate(best):
            if len(s):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), i, np.int32)), pa.array(d), pa.array(s)],
                                                 ["item", "doc_id", "score"])

    return buckets.select("doc_id", "length", "terms", "impacts").mapInArrow(run, "item int, doc_id long, score long")


def _ranked(hits: DataFrame, k: int, spread: int = 32) -> DataFrame:
    """The ``k`` best rows of each item with their rank; parts of an item are cut first."""
    best = [F.desc("score"), F.asc("doc_id")]
    part = F.pmod(F.xxhash64("doc_id"), F.lit(spread))
    inner = Window.partitionBy("item", "part").orderBy(*best)
    hits = (hits.withColumn("part", part).withColumn("place", F.row_number().over(inner))
            .where(F.col("place") <= k).drop("part", "place"))
    return hits.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*best))).where(F.col("rank") <= k)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 50, items_per_block: int = 4096,
                   bucket_rows: int = 1024, heavy: float = 0.8) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` highest-scoring documents with a score above zero."""
    spark = docs.sparkSession
    empty = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    blocks = -(-items.select("item_id").distinct().count() // items_per_block)
    out = empty
    for block in range(blocks):
        texts: dict[int | None, set[bytes]] = {}
        for r in items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).toLocalIterator():
            texts.setdefault(r.item_id, set()).update(terms(r.text))
        number = {t: j for j, t in enumerate(sorted(set().union(*texts.values())))}
        if not number:
            continue
        vectors = _vectors(docs, number)
        stats = vectors.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("total")).first()
        if not stats.n:
            return empty
        df = _document_counts(vectors, len(number))
        weights = np.array([floor(1000 * log((2 * stats.n + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        queries = []
        for words in texts.values():
            t = np.array(sorted(number[x] for x in words), np.int64)
            t = t[(df[t] > 0) & (weights[t] > 0)] if len(t) else t
            t = t[np.argsort(-weights[t], kind="stable")]
            queries.append((t, weights[t]))
        buckets = _by_length(vectors, stats.n, stats.total, bucket_rows)
        first = written(_search(buckets.where("bucket = 0"), queries, np.zeros(len(queries), np.int64), k,
                                bucket_rows, heavy), "lexical-first")
        bounds = np.zeros(len(queries), np.int64)
        for r in _ranked(first, k).where(F.col("rank") == k).select("item", "score").collect():
            bounds[r.item] = r.score
        rest = _search(buckets.where("bucket > 0"), queries, bounds, k, bucket_rows, heavy)
        names = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "item int, item_id long")
        hits = _ranked(first.union(rest), k)
        # at most ``k`` rows an item of a block
        out = out.union(hits.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return out
