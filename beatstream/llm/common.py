"""Helpers shared by the operators: tables, shared folders, hold-out rule, components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from beatstream.session import checkpoint_root, shared_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_tables: list[str] = []  # paths of the tables that ``written`` made, in order


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs only the tasks that read the files.  The table stays
    until the cluster clears the folder, or until the end of a ``scratch`` block around the call.
    """
    path = shared_path(df.sparkSession, name)
    _tables.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the tables written inside the block at its end, when its results are saved elsewhere."""
    first = len(_tables)
    try:
        yield
    finally:
        for path in _tables[first:]:
            deleted(spark, path)
        del _tables[first:]


def deleted(spark: SparkSession, path: str) -> None:
    """Delete a folder through its own file system."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def held_out(doc_id: str = "doc_id") -> Column:
    """True for rows whose crc32 of the id's text is divisible by five (null id: false)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def hash_sample(rows: DataFrame, group: str, max_rows: int, parts: int = 64) -> DataFrame:
    """At most ``max_rows`` rows (doc_id, group) of every group, those with the smallest hashes of the id.

    ``rows`` has distinct (doc_id, group) without nulls and few groups.  A threshold on the hash
    from the group's count leaves little more than ``max_rows`` rows; those are ranked within
    ``parts`` parts of the group, which share the bound equally.  A group of at most ``max_rows``
    rows is taken whole.
    """
    parts = min(parts, max_rows)
    each = max_rows // parts
    sizes = {r[0]: r.n for r in rows.groupBy(group).agg(F.count(F.lit(1)).alias("n")).collect()}
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share, whole = F.lit(0.0), F.lit(False)
    for g, n in sizes.items():
        # three deviations more than wanted in each part, so that a part is hardly ever short
        wanted = parts * (each + 3 * each ** 0.5 + 10)
        share = F.when(F.col(group) == g, min(1.0, wanted / n)).otherwise(share)
        whole = F.when(F.col(group) == g, n <= max_rows).otherwise(whole)
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(parts))
    rank = F.row_number().over(Window.partitionBy(group, "part").orderBy("spot", "doc_id"))
    near = rows.select("doc_id", group, spot.alias("spot"), part.alias("part")).where(F.col("spot") <= share)
    return near.withColumn("rank", rank).where(whole | (F.col("rank") <= each)).select("doc_id", group)


def labelled_rows(labels: DataFrame, label: str) -> DataFrame:
    """All training rows of both classes as (doc_id, label), never held-out ones.

    Repeated ids count once (their largest label).
    """
    rows = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
            .groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label")))
    return rows.where("label in (0, 1)")


def labelled_sample(labels: DataFrame, label: str, max_rows_per_class: int) -> DataFrame:
    """At most ``max_rows_per_class`` rows of each class of ``labelled_rows``."""
    return hash_sample(labelled_rows(labels, label), "label", max_rows_per_class)


def training_sizes(docs: DataFrame, labels: DataFrame, label: str) -> tuple[int, int]:
    """Rows of ``docs`` with a training label of class 0 and 1: all of them, not those of a sample."""
    copies = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    sizes = {r.label: r.n for r in copies.join(labelled_rows(labels, label), "doc_id")
             .groupBy("label").agg(F.sum("n").alias("n")).collect()}
    return sizes.get(0, 0), sizes.get(1, 0)


def training_texts(docs: DataFrame, labels: DataFrame, label: str, max_rows_per_class: int) -> DataFrame:
    """(doc_id, text, label) of the bounded training sample.

    The sample holds at most ``2 * max_rows_per_class`` narrow rows by construction,
    so it is broadcast and the texts are not shuffled.
    """
    sample = labelled_sample(labels, label, max_rows_per_class)
    return (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
            .join(F.broadcast(sample), "doc_id"))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Components of an undirected graph as (node, component = smallest node).

    ``edges`` has long columns ``src`` and ``dst``; loops and repeats are allowed,
    nulls are ignored.  Nodes without an edge to another node do not appear.
    Alternates large-star and small-star steps: each is a grouped minimum (combined
    before the shuffle) joined back to the edges, so no task ever holds a whole hub,
    and every round is cut by a reliable checkpoint.
    """
    spark = edges.sparkSession
    checkpoint_root(spark)

    def fixed(df: DataFrame) -> tuple[DataFrame, tuple]:
        df = df.where(F.col("src") != F.col("dst")).distinct().checkpoint(eager=True)
        row = df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("src", "dst"))).first()
        return df, tuple(row)

    # every edge points from its larger to its smaller node
    cur, mark = fixed(edges.where("src is not null and dst is not null")
                      .select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")))
    for _ in range(max_rounds):
        if mark[0] == 0:
            break
        both = cur.union(cur.select(F.col("dst"), F.col("src"))).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("src"), F.col("m").alias("dst"))).distinct()
        low = large.groupBy("src").agg(F.min("dst").alias("m"))
        small = large.join(low, "src")
        small = small.select("dst", "m").union(small.select("src", "m")).toDF("src", "dst")
        cur, new = fixed(small)
        if new == mark:
            break
        mark = new
    else:
        raise RuntimeError("components did not settle")
    pairs = cur.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    return pairs.union(pairs.select("component", "component").distinct())
