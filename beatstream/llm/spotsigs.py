"""SpotSigs document fingerprints, in DataFrame functions only.

A signature is a common word (an anchor) and the chain of the next content words, other
anchors between them left out.  A text's fingerprint is the set of its signatures' hashes;
its text form is the set's size and a 128-bit digest of the sorted set.  Two fingerprints
are as alike as the Jaccard coefficient of their sets.  Sets whose lengths differ too much
for a wanted likeness are never compared: the set length bounds the coefficient.

A text without any whole chain has its pairs of neighbouring words as signatures (one word:
that word); texts of any length are read whole; null and empty texts and texts without words have the empty set.  Two empty sets are alike (1.0), an
empty and another set are not (0.0).  Equal texts have equal fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatstream.llm.common import connected_components, written

# fixed values: common words of four languages
ANCHORS = {
    "en": "the of and to in is that for was on are with as be this by an at from it not or have a he she they we",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an",
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il avec",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más",
}
MARK = "\u0001"


def _trie(words: list[str]) -> str:
    """A regular expression for the words, factored by first letters."""
    tails: dict[str, list[str]] = {}
    for w in sorted(set(words)):
        if w:
            tails.setdefault(w[0], []).append(w[1:])
    parts = [c + (_trie(t) if any(t) else "") for c, t in tails.items()]
    whole = f"(?:{'|'.join(parts)})"
    return whole + "?" if "" in words else whole


def _anchors() -> str:
    return _trie([w for ws in ANCHORS.values() for w in ws.split()])


def with_signatures(df: DataFrame, text: str, name: str, chain: int = 2) -> DataFrame:
    """Adds column ``name``: the sorted distinct hashes of the anchored chains of ``chain`` content words.

    The steps are columns of their own, so that each is evaluated once for a row.
    """
    spaced, chains = f"{name}_spaced", f"{name}_chains"
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")
    # anchors are glued to the word after them: "the of cat " -> "the<MARK>of<MARK>cat "
    glued = F.regexp_replace(spaced, f"(?<= )({_anchors()}) ", f"$1{MARK}")
    # possessive throughout: long rows of anchors must not be matched by recursion
    word, glue = f"[^ {MARK}]++", f"(?:[^ {MARK}]++{MARK})"
    found = F.regexp_extract_all(glued, F.lit(f"(?= ({glue}++{word}(?: {glue}*+{word}){{{chain - 1}}}) )"), 1)
    hashes = F.transform(chains, lambda c: F.xxhash64(F.regexp_replace(c, f" {glue}++", " ")))
    pairs = F.transform(F.regexp_extract_all(spaced, F.lit("(?= ([^ ]++ [^ ]++) )"), 1), lambda c: F.xxhash64(c))
    sigs = (F.when(F.size(chains) > 0, hashes)
            .when(F.trim(spaced) == "", F.array().cast("array<bigint>"))
            .when(F.instr(F.trim(spaced), " ") > 0, pairs).otherwise(F.array(F.xxhash64(spaced))))
    return (df.withColumn(spaced, F.concat(F.lit(" "), F.trim(plain), F.lit(" "))).withColumn(chains, found)
            .withColumn(name, F.array_sort(F.array_distinct(sigs))).drop(spaced, chains))


def fingerprint_text(sigs: Column) -> Column:
    """Set size and a 128-bit digest of the sorted set."""
    return F.concat_ws("-", F.size(sigs).cast("string"), F.lower(F.concat(
        F.lpad(F.hex(F.xxhash64(sigs)), 16, "0"), F.lpad(F.hex(F.xxhash64(F.lit("second"), sigs)), 16, "0"))))


def jaccard(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard coefficient of two sets; zero without comparing them if their lengths rule out ``least``."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    common = F.size(F.array_intersect(a, b))
    return (F.when(large == 0, 1.0).when((small == 0) | (small < least * large), 0.0)
            .otherwise(common / (F.size(a) + F.size(b) - common)))


def ordered_neighbours(docs: DataFrame) -> DataFrame:
    """(id, hash, size, prev_id, prev_hash, prev_size) of every distinct (doc_id, text), by ascending id.

    ``prev`` is the document before it (of the first: the last).  Positions are counted in
    ranges of the order and shifted by the ranges' totals, so nothing is sorted in one task.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(*_keys()).distinct()
    parts = written(ids.repartitionByRange(n, "id", "hash").withColumn("part", F.spark_partition_id()), "doc-order")
    totals = parts.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    all_rows = int(totals.agg(F.sum("rows")).first()[0] or 0)
    before = F.coalesce(F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = totals.select(F.col("part").alias("p"), before.alias("before"))  # one row for each range
    rank = F.row_number().over(Window.partitionBy("part").orderBy("id", "hash")) - 1
    at = written(parts.withColumn("rank", rank).join(totals, F.col("part") == F.col("p"))
                 .select("id", "hash", "size", (F.col("before") + F.col("rank")).alias("at")), "doc-positions")
    prev = at.select(F.col("id").alias("prev_id"), F.col("hash").alias("prev_hash"), F.col("size").alias("prev_size"),
                     F.pmod(F.col("at") + 1, F.lit(max(all_rows, 1))).alias("then"))
    return at.join(prev, F.col("at") == F.col("then")).select("id", "hash", "size", "prev_id", "prev_hash", "prev_size")


def _keys() -> list[Column]:
    """Order key (null ids first), hash and number of code points of a row's text."""
    text = F.coalesce("text", F.lit(""))
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long")).alias("id"),
            F.xxhash64(text).alias("hash"), F.length(text).alias("size")]


def edited_fingerprints(docs: DataFrame, chain: int = 2, part: int = 4) -> DataFrame:
    """Fingerprints of every text and of its edited text.

    The edit replaces the last floor(n / ``part``) code points by the first as many (or all)
    of the next document in ascending doc_id (after the last: the first).  Rows that repeat
    both id and text are one document in that order and keep their number of rows; of one
    id's texts the order is by hash.
    """
    around = ordered_neighbours(docs).select("id", "hash", "prev_id", "prev_hash", "prev_size")
    # both uses need the same three columns, so the texts are shuffled once
    rows = docs.select(*_keys()[:2], F.coalesce("text", F.lit("")).alias("text"))
    heads = (with_signatures(rows.join(around, ["id", "hash"]), "text", "next_sigs", chain)
             .select(F.col("prev_id").alias("id"), F.col("prev_hash").alias("hash"),
                     F.substring("text", F.lit(1), F.floor(F.col("prev_size") / part).cast("int")).alias("head"),
                     "next_sigs")
             .groupBy("id", "hash").agg(F.min(F.struct("head", "next_sigs")).alias("next")))
    n = F.length("text")
    edited = F.concat(F.substring("text", F.lit(1), n - F.floor(n / part).cast("int")), F.col("next.head"))
    doc_id = F.when(F.col("id") != -(1 << 63), F.col("id"))
    out = (rows.join(heads, ["id", "hash"])
           .select(doc_id.alias("doc_id"), n.cast("long").alias("n_chars"), "text", edited.alias("edited"),
                   F.col("next.next_sigs").alias("next_sigs")))
    out = with_signatures(with_signatures(out, "text", "sigs", chain), "edited", "edited_sigs", chain)
    return out.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                      fingerprint_text(F.col("sigs")).alias("fingerprint"),
                      fingerprint_text(F.col("edited_sigs")).alias("edited_fingerprint"),
                      jaccard(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
                      jaccard(F.col("sigs"), F.col("next_sigs")).alias("near_next"))


def near_classes(docs: DataFrame, least: float = 0.8, chain: int = 2) -> DataFrame:
    """(doc_id, class_id) of every row: classes of texts linked by a likeness of at least ``least``.

    Equal sets are folded first.  Sets meet in buckets of a rare signature and a length
    class: two sets that are alike enough share one of their ``n - ceil(least n) + 1`` rarest
    signatures and lie in the same or neighbouring length classes.  In each bucket all sets
    are compared with one of them; what that leaves in different components of the links
    found is compared in a second pass, without the pairs inside a bucket's largest
    component.  So a large group of near copies is linked without forming its pairs, and no
    link between components is lost.  A class is named by its smallest doc_id.
    """
    rows = with_signatures(docs.select("doc_id", "text"), "text", "sigs", chain)
    rows = written(rows.select("doc_id", F.xxhash64("sigs", F.lit("set")).alias("sid"), "sigs"), "spot-rows")
    sets = written(rows.groupBy("sid").agg(F.min("sigs").alias("sigs"), F.min("doc_id").alias("first_id"))
                   .withColumn("n", F.size("sigs")), "spot-sets")

    # prefix of the rarest signatures, in buckets of (signature, length class)
    spots = sets.select("sid", "n", F.explode("sigs").alias("sig"))
    often = spots.groupBy("sig").agg(F.count(F.lit(1)).alias("often"))
    rank = F.row_number().over(Window.partitionBy("sid").orderBy("often", "sig"))
    length_class = F.floor(F.log(F.col("n")) / F.log(F.lit(1 / least)) + 1e-9)
    prefix = (spots.join(often, "sig").withColumn("place", rank)
              .where(F.col("place") <= F.col("n") - F.ceil(F.lit(least) * F.col("n") - 1e-9) + 1)
              .select("sid", "n", F.explode(F.array(length_class, length_class + 1)).alias("class"), "sig"))
    prefix = written(prefix, "spot-buckets")
    bucket = ["sig", "class"]

    def alike(pairs: DataFrame) -> DataFrame:
        """The pairs (src, dst) whose sets are alike enough."""
        a = sets.select(F.col("sid").alias("src"), F.col("sigs").alias("a"))
        b = sets.select(F.col("sid").alias("dst"), F.col("sigs").alias("b"))
        both = pairs.distinct().join(a, "src").join(b, "dst")
        return both.where(jaccard(F.col("a"), F.col("b"), least) >= least - 1e-12).select("src", "dst")

    def bounded(small: Column, large: Column) -> Column:
        return F.least(small, large) >= F.lit(least) * F.greatest(small, large) - 1e-9

    leaders = prefix.groupBy(*bucket).agg(F.min(F.struct("sid", "n")).alias("leader"), F.count(F.lit(1)).alias("sets"))
    first = (prefix.join(leaders.where("sets > 1"), bucket)
             .where((F.col("sid") != F.col("leader.sid")) & bounded(F.col("n"), F.col("leader.n")))
             .select(F.col("leader.sid").alias("src"), F.col("sid").alias("dst")))
    links = written(alike(first), "spot-links")
    found = connected_components(links).toDF("node", "root")
    members = (prefix.join(found, F.col("sid") == F.col("node"), "left")
               .select("sid", "n", *bucket, F.coalesce("root", "sid").alias("root")))
    members = written(members, "spot-members")
    largest = (members.groupBy(*bucket, "root").agg(F.count(F.lit(1)).alias("k"))
               .groupBy(*bucket).agg(F.max(F.struct("k", "root")).alias("top"), F.count(F.lit(1)).alias("roots"))
               .where("roots > 1").select(*bucket, F.col("top.root").alias("top")))
    others = (members.join(largest, bucket).where("root != top")
              .select(*bucket, F.col("sid").alias("src"), F.col("n").alias("m"), F.col("root").alias("r")))
    second = (others.join(members, bucket).where((F.col("r") != F.col("root")) & bounded(F.col("m"), F.col("n")))
              .select(F.least("src", "sid").alias("src"), F.greatest("src", "sid").alias("dst")))
    comp = connected_components(links.union(alike(second))).toDF("node", "root")
    named = sets.join(comp, F.col("sid") == F.col("node"), "left").select(
        "sid", "first_id", F.coalesce("root", "sid").alias("root"))
    smallest = named.groupBy("root").agg(F.min("first_id").alias("class_id"))
    ids = written(named.join(smallest, "root").select(F.col("sid").alias("s"), "class_id"), "spot-classes")
    return rows.join(ids, F.col("sid") == F.col("s")).select("doc_id", "class_id")
