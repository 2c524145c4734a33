"""Mixing sources to target weights as a proportionate-fair (Pfair) schedule.

The documents of each source are put in a fixed pseudo-random order and cut into blocks
of ``block_chars`` characters.  A source of weight w out of W gets, for its j-th block, a
release time floor(j W / w) and a deadline ceil((j + 1) W / w); one block is served per
time slot, the released one with the earliest deadline first.  With these windows no
source is ever a whole block ahead of or behind its share w/W.  The schedule repeats
after W slots, so one period is computed and every block's slot follows from its number
by arithmetic: the rows are placed by Spark, however many there are.

When a source runs out, the others go on with their weights among themselves from that
slot (a new phase with the same bound), so that every document is placed.  Sources
without a positive weight follow after all others, in proportion to their sizes.

The order within a source is by (hash bucket of the key, key), where the key is the id, or
a hash of the text where the id is null.  Rows that repeat a key within a source share one
place.  A null source is a source of its own; empty and null texts have size one.  Extra
columns are ignored by ``schedule`` and kept by ``mixed``.  An empty table gives an empty
result.  A document longer than a block spans several block numbers.  The schedule has a
row per document and meets them in a sort-merge join at every size: a small one would be
broadcast, and its hashed relation takes three times the size of its rows on the driver.
"""

from __future__ import annotations

import heapq
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatstream.llm.common import written

BUCKETS = 4096      # parts of a source that are ordered independently
MAX_SOURCES = 1000  # a mixture is a configuration, not a data-sized list


def period(weights: dict[str, int]) -> dict[str, list[int]]:
    """Slots of each source's blocks within one period of sum(weights) slots."""
    total = sum(weights.values())
    slots: dict[str, list[int]] = {s: [] for s in weights}
    waiting = [(0, s, 0) for s in sorted(weights)]  # (release, source, block)
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []          # (deadline, source, block)
    for t in range(total):
        while waiting and waiting[0][0] <= t:
            _, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * total // weights[s]), s, j))
        _, s, j = heapq.heappop(ready)
        slots[s].append(t)
        if j + 1 < weights[s]:
            heapq.heappush(waiting, ((j + 1) * total // weights[s], s, j + 1))
    return slots


def phases(blocks: dict[str, int], weights: dict[str, int]) -> list[tuple[str, int, int, int, int, list[int]]]:
    """(source, first block, end block, first slot, period, slots in the period) until all blocks are placed."""
    out, start = [], 0
    done = dict.fromkeys(blocks, 0)
    left = {s for s, n in blocks.items() if n > 0}
    while left:
        active = {s: weights[s] for s in left if weights.get(s, 0) > 0}
        if not active:  # only unweighted sources are left: by size
            scale = max(1, sum(blocks[s] for s in left) // 1000)
            active = {s: max(1, blocks[s] // scale) for s in left}
        common = gcd(*active.values())
        active = {s: w // common for s, w in active.items()}
        total, slots = sum(active.values()), period(active)

        def slot(s: str, j: int) -> int:
            return j // active[s] * total + slots[s][j % active[s]]  # noqa: B023

        end = min(slot(s, blocks[s] - done[s] - 1) for s in active) + 1
        for s in sorted(active):
            served = end // total * active[s] + sum(x < end % total for x in slots[s])
            out.append((s, done[s], done[s] + served, start, total, slots[s]))
            done[s] += served
        start += end
        left = {s for s in left if done[s] < blocks[s]}
    return out


def tempered_weights(sizes: dict[str, int], power: float = 0.5, parts: int = 1000) -> dict[str, int]:
    """Whole-number weights of about ``parts`` in all, in proportion to size ** power."""
    total = sum(n ** power for n in sizes.values()) or 1.0
    return {s: max(1, round(parts * n ** power / total)) for s, n in sizes.items()}


def _key() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit(""))))


def schedule(docs: DataFrame, weights: dict[str, int] | None = None, block_chars: int = 100_000,
             power: float = 0.5) -> DataFrame:
    """(source, key, block, slot, place) of every distinct (source, key).

    ``place`` is the character offset within the source, so (slot, source, place) is the
    whole order.  Without ``weights`` they are ``tempered_weights`` of the sources' sizes.
    """
    spark = docs.sparkSession
    units = (docs.select("source", _key().alias("key"), (F.length(F.coalesce("text", F.lit(""))) + 1).alias("size"))
             .groupBy("source", "key").agg(F.sum("size").alias("size"))
             .withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).cast("int")))
    units = written(units, "mixing-units")  # one scan of the documents for all that follows
    # two-level running sum: buckets of a source, then rows of a bucket
    parts = units.groupBy("source", "bucket").agg(F.sum("size").alias("total"))
    before = F.coalesce(F.sum("total").over(Window.partitionBy("source").orderBy("bucket")
                                            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select(F.col("source").alias("s"), F.col("bucket").alias("b"), "total", before.alias("before"))
    sizes = {r.s: r.n for r in parts.groupBy("s").agg(F.sum("total").alias("n")).limit(MAX_SOURCES + 1).collect()}
    if len(sizes) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources to mix")
    names = {s: "" if s is None else "=" + s for s in sizes}  # a sortable name for the null source
    if weights is None:
        weights = tempered_weights(sizes, power)
    plan = phases({names[s]: -(-n // block_chars) for s, n in sizes.items()},
                  {names[s]: weights.get(s, 0) for s in sizes})
    # bounded by the sources and the period of the weights, whatever the number of documents
    plan = F.broadcast(spark.createDataFrame(
        plan, "name string, first long, finish long, start long, period long, slots array<int>"))
    inside = F.coalesce(F.sum("size").over(Window.partitionBy("source", "bucket").orderBy("key")
                                           .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = (units.withColumn("inside", inside)
            .join(parts, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
            .withColumn("place", F.col("before") + F.col("inside"))
            .withColumn("block", F.floor(F.col("place") / block_chars).cast("long"))
            .withColumn("name", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))))
    per = F.size("slots")
    turn = F.col("block") - F.col("first")
    slot = (F.col("start") + F.floor(turn / per) * F.col("period")
            + F.element_at("slots", (F.pmod(turn, per) + 1).cast("int")))
    return (rows.join(plan, "name").where("block >= first and block < finish")
            .select("source", "key", "block", slot.cast("long").alias("slot"), "place"))


def positions(docs: DataFrame, weights: dict[str, int] | None = None, block_chars: int = 100_000,
              power: float = 0.5) -> DataFrame:
    """(doc_id, source, block, slot, place) of every row."""
    plan = schedule(docs, weights, block_chars, power)
    rows = docs.select("doc_id", "source", _key().alias("key")).alias("d")
    p = plan.select(F.col("source").alias("s"), F.col("key").alias("k"), "block", "slot", "place")
    return (rows.join(p.hint("merge"), (F.col("key") == F.col("k")) & F.col("source").eqNullSafe(F.col("s")))
            .select("doc_id", "source", "block", "slot", "place"))


def mixed(docs: DataFrame, weights: dict[str, int] | None = None, block_chars: int = 100_000,
          power: float = 0.5) -> DataFrame:
    """All rows of ``docs`` in schedule order: range-partitioned and sorted, so written files follow it."""
    plan = schedule(docs, weights, block_chars, power)
    p = plan.select(F.col("source").alias("_s"), F.col("key").alias("_k"), F.col("slot").alias("_slot"),
                    F.col("place").alias("_place"))
    rows = docs.select(F.struct("*").alias("_row"), F.col("source").alias("_source"), _key().alias("_key"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.join(p.hint("merge"), (F.col("_key") == F.col("_k")) & F.col("_source").eqNullSafe(F.col("_s")))
            .select("_row", "_slot", "_source", "_place")
            .repartitionByRange(parts, "_slot", "_source", "_place")
            .sortWithinPartitions("_slot", "_source", "_place")
            .select("_row.*"))
