"""Nearest neighbours by largest inner product: multiprobe p-stable hashing.

Inner products become distances by one more coordinate: a vector is divided by the greatest
length of all and completed to length one, a query is scaled to length one.  Each of
``tables`` hash tables cuts ``width``-wide intervals on some Gaussian projections; equal
interval numbers are a cell.  A query visits its own cell first and then cells reached by
moving some projections by one or two intervals, in order of the estimated chance of success:
the sum of squared distances from the query to the boundaries crossed.

Every vector is indexed.  The number of projections follows from the number of vectors, the
number of probes from a sample of ``sample`` queries whose true neighbours are found by
comparing them with all vectors: the fewest probes that find ``recall`` of these.  If
``max_probes`` don't, the cells are made larger by leaving out projections.

The queries that visit a cell and its vectors meet in one task, which multiplies blocks of
both and keeps the best of each query.  Cells with many vectors are cut into parts by a hash
and their queries visit all parts; the same holds for cells with many queries.  Home cells
come first and give each query a lower bound, so that later cells return only what beats it.
What the tables found is merged and ranked by the exact product in doubles.

Equal vectors are folded: a vector stands for its ids, of which the k + 1 smallest can matter.
Vectors that are null, empty or zero or hold null or non-finite components, rows without an
id, and vectors whose length is not the most frequent one (the larger one if two are) take
no part.  A row that repeats an id counts once with an equal vector; with another vector the
id is found by its best vector and, as a query, gets the best results of all its vectors.
Ties go to the smaller id.  Extra columns are ignored.  Empty tables give an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatstream.llm.common import written

KEY = ["h1", "h2"]
MOVES = (-2, -1, 1, 2)


@dataclass(frozen=True)
class Index:
    """Hash functions and the number of probes; ``found`` is the sample's recall."""

    longest: float
    projections: np.ndarray  # (dimension + 1, tables * per_table)
    offsets: np.ndarray
    width: float
    tables: int
    mixers: np.ndarray       # uint64, one per projection
    salts: np.ndarray        # uint64, one per table
    probes: int = 1
    found: float = 0.0

    def spots(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """Projections in units of intervals, as (rows, tables, per_table)."""
        norms = np.sqrt(np.square(vectors).sum(1))
        if query:
            full = np.c_[vectors / norms[:, None], np.zeros(len(vectors))]
        else:
            scaled = vectors / self.longest
            full = np.c_[scaled, np.sqrt(np.maximum(0, 1 - np.square(scaled).sum(1)))]
        return ((full @ self.projections + self.offsets) / self.width).reshape(len(vectors), self.tables, -1)

    def cells(self, numbers: np.ndarray) -> np.ndarray:
        """Cell keys of interval numbers (rows, tables, per_table), as signed longs (rows, tables)."""
        mixers = self.mixers.reshape(self.tables, -1)
        return ((numbers.astype(np.int64).view(np.uint64) * mixers).sum(2, dtype=np.uint64) + self.salts).view(np.int64)

    def probe_moves(self, spot: np.ndarray, probes: int) -> list[tuple[tuple[int, int], ...]]:
        """Sets of (projection, move) for one table in estimated success order, the empty set first."""
        inside = spot - np.floor(spot)
        steps = sorted((float(m - x if m > 0 else x - m - 1) ** 2, j, m) for j, x in enumerate(inside) for m in MOVES)
        out: list[tuple[tuple[int, int], ...]] = [()]
        heap = [(steps[0][0], (0,))]
        while heap and len(out) < probes:
            cost, chosen = heapq.heappop(heap)
            valid = len({steps[c][1] for c in chosen}) == len(chosen)  # a projection moves once
            if valid:
                out.append(tuple((steps[c][1], steps[c][2]) for c in chosen))
            last = chosen[-1] + 1
            if last < len(steps):
                more = cost + steps[last][0]
                if valid:
                    heapq.heappush(heap, (more, (*chosen, last)))
                heapq.heappush(heap, (more - steps[last - 1][0], (*chosen[:-1], last)))
        return out

    def probe_cells(self, vectors: np.ndarray, first: int, end: int) -> list[list[np.ndarray]]:
        """Cells that each query visits in each table as its probes ``first`` to ``end - 1``, in this order."""
        spots = self.spots(vectors, query=True)
        keys = self.cells(np.floor(spots)).view(np.uint64)
        if end == 1:
            return [[k.reshape(1).view(np.int64) for k in row] for row in keys]
        mixers = self.mixers.reshape(self.tables, -1)
        out = []
        for i, row in enumerate(keys):
            shifts = [[sum(int(mixers[t, j]) * m for j, m in moves) % (1 << 64)
                       for moves in self.probe_moves(spots[i, t], end)[first:]] for t in range(self.tables)]
            out.append([(np.array(x, np.uint64) + k).view(np.int64) for x, k in zip(shifts, row, strict=True)])
        return out


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _usable(vectors: DataFrame, id_column: str, vector_column: str) -> tuple[DataFrame, int]:
    """(id, h1, h2, vec) of the rows that take part, and the dimension; h1 and h2 name the vector."""
    rows = vectors.select(F.col(id_column).cast("long").alias("id"),
                          F.col(vector_column).cast("array<double>").alias("vec"))
    good = (F.exists("vec", lambda x: x != 0)
            & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    rows = rows.where(F.col("id").isNotNull() & F.coalesce(good, F.lit(False)))
    size = rows.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    dimension = size.size if size else 0
    return rows.where(F.size("vec") == dimension).select(
        "id", F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit(1), "vec").alias("h2"), "vec"), dimension


def _best_of(queries: np.ndarray, vectors: np.ndarray, firsts: np.ndarray, bounds: np.ndarray,
             keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, vector row, score) of the ``keep`` best vectors of each query that reach its bound."""
    s = queries @ vectors.T
    slack = 1e-9 * (1 + np.abs(s).max(initial=0))  # for the order of additions
    least = bounds - slack
    if s.shape[1] > keep:
        least = np.maximum(least, np.partition(s, -keep, axis=1)[:, -keep] - slack)
    q, v = np.nonzero(s >= least[:, None])
    # the same additions for a pair wherever it is met
    exact = np.concatenate([(queries[q[a:a + 65536]] * vectors[v[a:a + 65536]]).sum(1)
                            for a in range(0, len(q), 65536)]) if len(q) else np.empty(0)
    o = np.lexsort((firsts[v], -exact, q))
    q, v, exact = q[o], v[o], exact[o]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    at = (place < keep) & (exact >= bounds[q])
    return q[at], v[at], exact[at]


def _true_neighbours(distinct: DataFrame, sample: np.ndarray, names: list[tuple[int, int]],
                     k: int) -> list[tuple[int, list[float]]]:
    """(query number, vector) rows: the ``k`` best other vectors of a few queries among all vectors."""
    dimension = sample.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nowhere = np.full(len(sample), -np.inf)
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                vecs = _matrix(part.column(3), dimension)
                q, v, s = _best_of(sample, vecs, part.column(2).to_numpy(), nowhere, k + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q, pa.int32()), part.column(0).take(pa.array(v)), part.column(1).take(pa.array(v)),
                     pa.array(s), part.column(3).take(pa.array(v))], ["q", "h1", "h2", "score", "vec"])

    hits = distinct.select(*KEY, "first", "vec").mapInArrow(run, "q int, h1 long, h2 long, score double, vec array<double>")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), *KEY))
    rows = hits.withColumn("rank", rank).where(F.col("rank") <= k + 1).collect()
    return [(r.q, r.vec) for r in rows if (r.h1, r.h2) != names[r.q]]


def fit_index(distinct: DataFrame, queries: DataFrame, dimension: int, k: int = 20, tables: int = 4, width: float = 2.0,
              recall: float = 0.95, sample: int = 64, max_probes: int = 1024, cell_rows: int = 256, seed: int = 11) -> Index:
    """Hash functions for all vectors and the probes that find ``recall`` of a sample's true neighbours."""
    facts = distinct.agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("longest")).first()
    chosen = queries.orderBy(*KEY).limit(sample).select(*KEY, "vec").collect()
    sampled = np.array([r.vec for r in chosen])
    truth = _true_neighbours(distinct, sampled, [(r.h1, r.h2) for r in chosen], k)
    per_table = max(4, int(np.ceil(np.log2(max(facts.n / cell_rows, 1)) / 1.3)))
    while True:
        rng = np.random.default_rng(seed)
        index = Index(facts.longest, rng.normal(size=(dimension + 1, tables * per_table)),
                      rng.uniform(0, width, tables * per_table), width, tables,
                      rng.integers(0, 1 << 63, tables * per_table, np.uint64) * np.uint64(2) + np.uint64(1),
                      rng.integers(0, 1 << 63, tables, np.uint64))
        if not truth:
            return index
        cells = index.cells(np.floor(index.spots(np.array([v for _, v in truth]), query=False)))
        order = [[{c: j for j, c in enumerate(t.tolist())} for t in query]
                 for query in index.probe_cells(sampled, 0, max_probes)]
        # the probe that meets a true neighbour, in the table where it is met first
        met = np.sort([min(order[q][t].get(c, max_probes) for t, c in enumerate(cells[i].tolist()))
                       for i, (q, _) in enumerate(truth)])
        needed = int(met[int(np.ceil(recall * len(met))) - 1]) + 1
        if needed <= max_probes or per_table == 1:
            probes = min(needed, max_probes)
            return replace(index, probes=probes, found=float((met < probes).mean()))
        per_table -= 1


def _visits(queries: DataFrame, index: Index, dimension: int, first: int, end: int) -> DataFrame:
    """(cell, h1, h2, vec, bound) of the queries' probes ``first`` to ``end - 1``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                cells = index.probe_cells(_matrix(part.column(2), dimension), first, end)
                flat = [np.concatenate(c) for c in cells]
                row = pa.array(np.repeat(np.arange(len(flat)), [len(c) for c in flat]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(flat)), *[c.take(row) for c in part.columns]],
                                                 ["cell", *KEY, "vec", "bound"])

    return queries.select(*KEY, "vec", "bound").mapInArrow(run, "cell long, h1 long, h2 long, vec array<double>, bound double")


def _homes(distinct: DataFrame, index: Index, dimension: int) -> DataFrame:
    """(cell, h1, h2, first, vec): every vector in its cell of each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells = index.cells(np.floor(index.spots(_matrix(b.column(3), dimension), query=False)))
            row = pa.array(np.repeat(np.arange(b.num_rows), index.tables))
            yield pa.RecordBatch.from_arrays([pa.array(cells.reshape(-1)), *[c.take(row) for c in b.columns]],
                                             ["cell", *KEY, "first", "vec"])

    return distinct.select(*KEY, "first", "vec").mapInArrow(run, "cell long, h1 long, h2 long, first long, vec array<double>")


def _meet(visits: DataFrame, homes: DataFrame, dimension: int, keep: int, most_queries: int = 2048,
          most_vectors: int = 16384) -> DataFrame:
    """(q1, q2, h1, h2, first, score): best vectors of each query in each cell that it visits."""
    spark = visits.sparkSession
    # parts of a crowded cell: its vectors are dealt to ``vs`` parts, its queries to ``qs``
    n = (visits.groupBy("cell").agg(F.count(F.lit(1)).alias("q"))
         .join(homes.groupBy("cell").agg(F.count(F.lit(1)).alias("v")), "cell")
         .select(F.col("cell").alias("c"), F.ceil(F.col("q") / most_queries).cast("int").alias("qs"),
                 F.ceil(F.col("v") / most_vectors).cast("int").alias("vs")))
    crowded = written(n.where("qs > 1 or vs > 1"), "neighbours-crowded")
    spot = F.xxhash64(*KEY, F.lit(7))

    def dealt(rows: DataFrame, mine: str, other: str) -> DataFrame:
        rows = rows.join(crowded, F.col("cell") == F.col("c"), "left").drop("c")
        own = F.pmod(spot, F.coalesce(mine, F.lit(1))).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1))
        return rows.withColumn("own", own).withColumn("every", every)

    none = F.lit(None)
    left = dealt(visits, "qs", "vs").select(
        "cell", F.col("own").alias("qp"), F.col("every").alias("vp"), F.lit(0).alias("kind"), *KEY, "vec",
        none.cast("long").alias("first"), "bound")
    right = dealt(homes, "vs", "qs").select(
        "cell", F.col("every").alias("qp"), F.col("own").alias("vp"), F.lit(1).alias("kind"), *KEY, "vec", "first",
        none.cast("double").alias("bound"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    group = ["cell", "qp", "vp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, asked = None, []  # the group's queries: vectors, names, bounds
        for b in batches:
            if not b.num_rows:
                continue
            g = np.stack([b.column(i).to_numpy() for i in range(4)], 1)
            cuts = [0, *(np.nonzero((g[1:] != g[:-1]).any(1))[0] + 1).tolist(), len(g)]
            for a, z in zip(cuts, cuts[1:], strict=False):
                key, part = tuple(g[a, :3].tolist()), b.slice(a, z - a)
                if key != here:
                    here, asked = key, []
                names = np.stack([part.column(4).to_numpy(), part.column(5).to_numpy()], 1)
                if g[a, 3] == 0:
                    asked.append((_matrix(part.column(6), dimension), names, part.column(8).to_numpy()))
                    continue
                if not asked:
                    continue
                asked = [tuple(np.concatenate(x) for x in zip(*asked, strict=True))]
                firsts, vecs = part.column(7).to_numpy(), _matrix(part.column(6), dimension)
                for at in range(0, len(vecs), 1024):
                    for lo in range(0, len(asked[0][0]), 1024):
                        some = [x[lo:lo + 1024] for x in asked[0]]
                        q, v, s = _best_of(some[0], vecs[at:at + 1024], firsts[at:at + 1024], some[2], keep)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(x) for x in (some[1][q, 0], some[1][q, 1], names[at + v, 0], names[at + v, 1],
                                                   firsts[at + v], s)], ["q1", "q2", *KEY, "first", "score"])

    return (left.union(right).repartition(parts, *group).sortWithinPartitions(*group, "kind")
            .mapInArrow(run, "q1 long, q2 long, h1 long, h2 long, first long, score double"))


def _top(hits: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` best distinct vectors of each query, with their place."""
    found = hits.groupBy("q1", "q2", *KEY).agg(F.max("score").alias("score"), F.min("first").alias("first"))
    place = F.row_number().over(Window.partitionBy("q1", "q2").orderBy(F.desc("score"), F.asc("first")))
    return found.withColumn("place", place).where(F.col("place") <= keep)


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id",
            vector_column: str = "embedding", **fit) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` nearest found of every row that ``is_query`` selects by its ``id``.

    ``fit`` goes to ``fit_index``.
    """
    rows, dimension = _usable(vectors, id_column, vector_column)
    keep = k + 1  # the query itself may be among them
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    distinct = (rows.groupBy(*KEY).agg(F.min("id").alias("first"), F.first("vec").alias("vec"), F.max(is_query).alias("asks"))
                .withColumn("norm", norm))
    distinct = written(distinct, "neighbours-vectors")
    queries = distinct.where("asks")
    if not queries.head(1):
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, id long, score double")
    index = fit_index(distinct, queries, dimension, k, **fit)
    homes = written(_homes(distinct, index, dimension), "neighbours-index")
    free = F.lit(float("-inf"))
    visits = written(_visits(queries.withColumn("bound", free), index, dimension, 0, 1), "neighbours-visits")
    hits = written(_top(_meet(visits, homes, dimension, keep), keep), "neighbours-home")
    if index.probes > 1:
        bounds = hits.where(F.col("place") == keep).select("q1", "q2", F.col("score").alias("least"))
        bounded = (queries.join(bounds, (F.col("h1") == F.col("q1")) & (F.col("h2") == F.col("q2")), "left")
                   .withColumn("bound", F.coalesce("least", free)))
        visits = written(_visits(bounded, index, dimension, 1, index.probes), "neighbours-visits")
        hits = _top(hits.drop("place").unionByName(_meet(visits, homes, dimension, keep)), keep)

    # the ids of the vectors found: the k + 1 smallest of each, as one may be the query's own
    ids = rows.select(*KEY, "id").distinct()
    place = F.row_number().over(Window.partitionBy(*KEY).orderBy("id"))
    ids = ids.withColumn("n", place).where(F.col("n") <= keep).select(*KEY, "id")
    each = F.struct((-F.col("score")).alias("minus"), "id")
    lists = (hits.join(ids, KEY).groupBy("q1", "q2").agg(F.slice(F.sort_array(F.collect_list(each)), 1, keep).alias("hits")))
    lists = written(lists, "neighbours-lists")
    asked = rows.where(is_query).select(F.col("id").alias("query_id"), *KEY).distinct()
    pairs = (asked.join(lists, (F.col("h1") == F.col("q1")) & (F.col("h2") == F.col("q2")))
             .select("query_id", F.explode("hits").alias("hit")).where(F.col("hit.id") != F.col("query_id"))
             .groupBy("query_id", F.col("hit.id").alias("id")).agg((-F.min("hit.minus")).alias("score")))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("id")))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
