"""Merkle manifest of a data set, and proofs climbed by a recursive query.

H is the lowercase hexadecimal sha256 of its inputs, concatenated (digests as hexadecimal
text).  A row's leaf is H of doc_id, source, lang, n_chars and text, each written as its
UTF-8 byte count, a colon and the value, or as ``-`` if null.  Within a source the leaves
ascend by doc_id; every ``fanout`` consecutive nodes become their H until one is left, the
source's subroot.  The subroots, by source (null first, then bytewise), form the top tree.

Places come from one range shuffle: the sorted rows are written, and a row's place is its
number within its file plus the rows of its source in earlier files, so that a source with
most of the rows is spread over many tasks.  A tree is built ``hop`` levels at a time: a task
hashes up blocks of fanout ** hop consecutive nodes.  Each round's nodes are stored as rows
linked to their ancestor ``hop`` levels up (the tree's root if that comes first), with the
siblings on the way.  A Spark recursive query starts from all leaves; each step joins the
row of the node reached, appends its siblings to the proof and folds the hash.

Null and empty texts differ (``-`` and ``0:``).  Texts of any length are hashed whole.  Rows
with a null doc_id come first in their source; rows that repeat an id are ordered by their
leaf, and equal rows are leaves of their own, whose order makes no difference.  Extra
columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatstream.llm.common import written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = "T"  # name of the top tree; those of the sources start with a digit


def leaf_digest(text: Column, fields: tuple[str, ...] = FIELDS) -> Column:
    """sha256 of a row's fields as 32 bytes, with ``text`` in the place of the text."""
    parts = []
    for name in fields:
        value = text if name == "text" else F.col(name).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def hexed(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _tree_name(source: Column) -> Column:
    """Name of a source's tree; names sort like the sources."""
    return F.coalesce(F.concat(F.lit("1"), source), F.lit("0"))


def _placed(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` (tree, key, digest, ...) with ``pos`` by (key, digest) within the tree and the tree's size ``n``."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the last key only splits runs of equal rows
    order = ["tree", "key", "digest", "tie"]
    rows = (rows.withColumn("tie", F.monotonically_increasing_id())
            .repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("tie"))
    rows = written(rows, name).select("*", F.col("_metadata.file_path").alias("file"),
                                      F.col("_metadata.row_index").alias("row"))
    end = F.struct("key", "digest")
    files = rows.groupBy("tree", "file").agg(F.count(F.lit(1)).alias("rows"), F.min("row").alias("first_row"),
                                             F.min(end).alias("low"), F.max(end).alias("high"))
    # one row per (tree, file): as many as files and trees together
    by_tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("rows").over(by_tree.orderBy("low", "high", "file")
                                           .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = files.select(F.col("tree").alias("t"), F.col("file").alias("f"), "first_row", before.alias("before"),
                         F.sum("rows").over(by_tree).alias("n"))
    return (rows.join(files, (F.col("tree") == F.col("t")) & (F.col("file") == F.col("f")))
            .withColumn("pos", F.col("before") + F.col("row") - F.col("first_row"))
            .drop("t", "f", "file", "row", "first_row", "before"))


def _levels(n: str, fanout: int) -> Column:
    """Levels above ``n`` nodes: the least h with fanout ** h >= n."""
    powers, p = [], 1
    while p < 1 << 62:
        powers.append(F.lit(p).cast("long"))
        p *= fanout
    return F.size(F.filter(F.array(*powers), lambda x: x < F.col(n)))


def _round(nodes: DataFrame, fanout: int, hop: int, name: str) -> DataFrame:
    """One row per block of fanout ** hop nodes: tree, block, n, lv (levels climbed), items, up (its hash).

    ``nodes`` has tree, pos, n, digest and a struct ``item``; items keep the siblings as
    ``steps`` (array of left and right bytes, one per level).
    """
    width = fanout ** hop
    blocks = (nodes.groupBy("tree", F.floor(F.col("pos") / width).cast("long").alias("block"))
              .agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", "digest", "item"))).alias("members"))
              .withColumn("lv", F.least(_levels("n", fanout), F.lit(hop)))
              .withColumn("d0", F.transform("members", lambda m: m["digest"])))
    joined = "transform({a}, x -> lower(hex(x)))"
    for j in range(hop):
        run = joined.format(a=f"slice(d{j}, i * {fanout} + 1, {fanout})")
        blocks = blocks.withColumn(f"d{j + 1}", F.expr(
            f"transform(sequence(0, int((size(d{j}) + {fanout - 1}) div {fanout}) - 1), "
            f"i -> unhex(sha2(array_join({run}, ''), 256)))"))
    levels = "array(" + ", ".join(f"d{j}" for j in range(hop)) + ")"
    # siblings of the ancestor a = i div fanout ** j among the nodes of level j
    steps = (f"transform(slice(sequence(0, {hop - 1}), 1, lv), j -> transform(array(int(i div powers[j])), a -> struct("
             f"unhex(array_join({joined.format(a=f'slice(levels[j], a - a % {fanout} + 1, a % {fanout})')}, '')) AS left, "
             f"unhex(array_join({joined.format(a=f'slice(levels[j], a + 2, {fanout - 1} - a % {fanout})')}, '')) AS right))[0])")
    powers = F.array(*[F.lit(fanout ** j) for j in range(hop)])
    up = F.element_at(F.array(*[F.col(f"d{j}")[0] for j in range(hop + 1)]), F.col("lv") + 1)
    items = F.expr(f"transform(members, (m, i) -> struct(m.pos, m.digest, m.item, {steps} AS steps))")
    out = (blocks.withColumn("levels", F.expr(levels)).withColumn("powers", powers)
           .select("tree", "block", "n", "lv", items.alias("items"), up.alias("up")))
    return written(out, name)


def _climb_up(nodes: DataFrame, fanout: int, hop: int, first: str, name: str) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """Build all trees of ``nodes``: the first round's blocks, the later rounds' node rows, the roots.

    Node rows: tree, hop, pos, digest, steps, up_tree, up_hop, up_pos.  Roots: tree, hop, digest.
    """
    largest = nodes.agg(F.max("n")).first()[0] or 0
    rounds, left = 1, largest
    while left > fanout ** hop:
        left, rounds = -(-left // fanout ** hop), rounds + 1
    base, stored, roots = None, [], []
    for r in range(rounds):
        blocks = _round(nodes, fanout, hop, f"{name}-{r}" if r else first)
        base = blocks if base is None else base
        if r:
            stored.append(blocks.select("tree", "block", F.explode("items").alias("i")).select(
                "tree", F.lit(r).alias("hop"), "i.pos", "i.digest", "i.steps", F.col("tree").alias("up_tree"),
                F.lit(r + 1).alias("up_hop"), F.col("block").alias("up_pos")))
        # a tree of at most fanout ** hop nodes ends in this round
        done = F.col("n") <= fanout ** hop
        roots.append(blocks.where(done).select("tree", F.lit(r + 1).alias("hop"), F.col("up").alias("digest")))
        nodes = blocks.where(~done).select(
            "tree", F.col("block").alias("pos"), F.ceil(F.col("n") / fanout ** hop).cast("long").alias("n"),
            F.col("up").alias("digest"), F.struct(F.lit(r).alias("r")).alias("item"))
    together = roots[0]
    for more in roots[1:]:
        together = together.union(more)
    return base, stored, together


def manifest(docs: DataFrame, changed: Column | None = None, fanout: int = 3, hop: int = 6) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof, proof_sha256, folded_root, verified) of every row.

    ``changed`` is the text that a leaf's hash is folded from (default: the text itself), while
    leaf, proof and root come from the text.  ``proof`` holds the siblings' digests (32 bytes
    each) level by level from the leaf to the root, left to right.
    """
    spark = docs.sparkSession
    changed = F.col("text") if changed is None else changed
    rows = written(docs.select(_tree_name(F.col("source")).alias("tree"), F.col("doc_id").alias("key"),
                               leaf_digest(F.col("text")).alias("digest"), leaf_digest(changed).alias("changed")),
                   "merkle-leaves")
    leaves = _placed(rows, "merkle-sorted")
    leaves = leaves.select("tree", "pos", "n", "digest", F.struct(F.col("key").alias("doc_id"), "changed").alias("item"))
    base, stored, subroots = _climb_up(leaves, fanout, hop, "merkle-leaf-blocks", "merkle-blocks")

    # the top tree: its leaves keep the names that the source trees know them by
    subroots = subroots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("key"), "digest", "hop")
    top = _placed(subroots, "merkle-subroots").select(
        "tree", "pos", "n", "digest", F.struct(F.col("key").alias("name"), "hop").alias("item"))
    top_base, top_stored, root = _climb_up(top, fanout, hop, "merkle-top-blocks", "merkle-top")
    ends = root.first()
    if ends is None:
        return spark.createDataFrame([], "doc_id long, leaf string, subroot string, root string, proof binary, "
                                         "proof_sha256 string, folded_root string, verified boolean")
    linked = top_base.select("block", F.explode("items").alias("i")).select(
        F.col("i.item.name").alias("tree"), F.col("i.item.hop").alias("hop"), F.lit(0).cast("long").alias("pos"),
        "i.digest", "i.steps", F.lit(TOP).alias("up_tree"), F.lit(1).alias("up_hop"), F.col("block").alias("up_pos"))
    nodes = linked
    for more in (*stored, *top_stored):
        nodes = nodes.union(more)
    nodes = written(nodes, "merkle-nodes")
    start = base.select("tree", "block", F.explode("items").alias("i")).select(
        F.col("i.item.doc_id").alias("doc_id"), F.col("i.digest").alias("leaf"), F.col("i.item.changed").alias("changed"),
        "i.steps", F.col("tree").alias("up_tree"), F.lit(1).alias("up_hop"), F.col("block").alias("up_pos"))

    folded = ("unhex(aggregate({steps}, lower(hex({start})), (h, s) -> "
              "sha2(concat(lower(hex(s.left)), h, lower(hex(s.right))), 256)))")
    siblings = "transform({steps}, s -> concat(s.left, s.right))"
    glued = "aggregate(" + siblings + ", {start}, (p, s) -> concat(p, s))"
    # every step appends a hop's siblings and folds its levels; no row is left out, so no row limit applies
    setting = "spark.sql.cteRecursionRowLimit"
    old = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        climbed = spark.sql(f"""
            WITH RECURSIVE climb(doc_id, leaf, subroot, up_tree, up_hop, up_pos, folded, proof) AS (
              SELECT doc_id, leaf, CAST(NULL AS BINARY), up_tree, up_hop, up_pos,
                     {folded.format(steps='steps', start='changed')},
                     {glued.format(steps='steps', start="unhex('')")}
              FROM {{start}}
              UNION ALL
              SELECT c.doc_id, c.leaf, CASE WHEN p.up_tree <> p.tree THEN p.digest ELSE c.subroot END,
                     p.up_tree, p.up_hop, p.up_pos,
                     {folded.format(steps='p.steps', start='c.folded')},
                     {glued.format(steps='p.steps', start='c.proof')}
              FROM climb c JOIN {{nodes}} p ON p.tree = c.up_tree AND p.hop = c.up_hop AND p.pos = c.up_pos)
            SELECT doc_id, leaf, subroot, proof, sha2(lower(hex(proof)), 256) AS proof_sha256, folded
            FROM climb WHERE up_tree = '{TOP}' AND up_hop = {ends.hop}
            """, start=start, nodes=nodes)
        climbed = written(climbed, "merkle-proofs")
    finally:
        spark.conf.set(setting, old)
    top_digest = F.lit(bytes(ends.digest).hex())
    return climbed.select("doc_id", hexed(F.col("leaf")).alias("leaf"), hexed(F.col("subroot")).alias("subroot"),
                          top_digest.alias("root"), "proof", "proof_sha256", hexed(F.col("folded")).alias("folded_root"),
                          (hexed(F.col("folded")) == top_digest).alias("verified"))
