"""Sinks: append tables, keyed upserts, sums and sets, nested window results, text lines.

The keyed sinks replace a key-value store with parquet tables.  A keyed table is cut into
buckets by a hash of its key, and a bucket is a short list of folders.  A write adds its rows
as one more folder to the buckets it touches; a bucket's latest folders that are at most twice
as large are merged into it on this occasion.  So folders grow geometrically, a bucket has few
of them, and what a write rewrites follows its own size, not the table's.  A write commits by
one small file that names every bucket's folders.  Readers follow the newest commit and merge
the folders by key, so a write that failed half-way is never seen.  A repeated call (a
micro-batch replayed after a failure) gives the same table.  A table has one writer at a time.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatstream.session import checkpoint_root, shared_path


def append_table(df: DataFrame, path: str, checkpoint: str | None = None, trigger: dict | None = None,
                 partition_by: list[str] | None = None, query_name: str | None = None):
    """Append every record of each micro-batch to a parquet table (created if missing).

    The file sink records committed batches in its own log, so replays do not
    duplicate rows.  Returns the started ``StreamingQuery``.
    """
    spark = df.sparkSession
    w = (df.writeStream.format("parquet").outputMode("append")
           .option("checkpointLocation", checkpoint or shared_path(spark, "ck-append")))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"processingTime": "2 seconds"}))
    return w.start(path)


def publish_lines(df: DataFrame, path: str | None = None, checkpoint: str | None = None,
                  trigger: dict | None = None, value_col: str = "value",
                  kafka_servers: str | None = None, topic: str | None = None):
    """Forward raw messages unchanged, one line each: to a Kafka topic when
    ``kafka_servers`` and ``topic`` are given (needs the Kafka connector), else to a
    text sink at ``path``."""
    spark = df.sparkSession
    w = (df.select(F.col(value_col).cast("string").alias("value")).writeStream
           .option("checkpointLocation", checkpoint or shared_path(spark, "ck-lines"))
           .trigger(**(trigger or {"processingTime": "2 seconds"})))
    if topic:
        return (w.format("kafka").option("kafka.bootstrap.servers", kafka_servers)
                 .option("topic", topic).start())
    return w.format("text").start(path)


def console_debug(df: DataFrame, num_rows: int, trigger: dict | None = None):
    """Echo at most ``num_rows`` records of each micro-batch to the driver's console (debugging only)."""
    return (df.writeStream.format("console").option("truncate", False).option("numRows", num_rows)
              .trigger(**(trigger or {"processingTime": "2 seconds"})).start())


# --- keyed tables ---------------------------------------------------------------------------

COMMITS = "_commits"


def _file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and a function that makes its path objects."""
    jvm = spark.sparkContext._jvm
    new = jvm.org.apache.hadoop.fs.Path
    return new(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), new


def write_text_file(spark: SparkSession, path: str, text: str) -> None:
    """Write one small file so that it appears whole or not at all, in place of an older one (rename over it)."""
    fs, new = _file_system(spark, path)
    folder, _, name = path.rpartition("/")
    temporary = new(f"{folder}/.{name}.tmp")
    out = fs.create(temporary, True)
    out.write(bytearray(text.encode()))
    out.close()
    context = spark.sparkContext
    rename = context._jvm.org.apache.hadoop.fs.Options.Rename
    options = context._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    target = fs.makeQualified(new(path))
    files = context._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), context._jsc.hadoopConfiguration())
    files.rename(fs.makeQualified(temporary), target, options)


def _commits(spark: SparkSession, path: str) -> list[tuple[int, dict]]:
    """(version, commit) of a keyed table, oldest first; a few small files."""
    fs, new = _file_system(spark, path)
    folder = new(f"{path}/{COMMITS}")
    if not fs.exists(folder):
        return []
    names = sorted(st.getPath().getName() for st in fs.listStatus(folder))
    found = [n for n in names if n.endswith(".json") and not n.startswith(".")]
    texts = spark.read.text([f"{path}/{COMMITS}/{n}" for n in found], wholetext=True).collect() if found else []
    return sorted((c["version"], c) for c in (json.loads(r.value) for r in texts))


def latest_version(spark: SparkSession, path: str) -> int | None:
    """Number of the newest commit of a keyed table (None when there is none)."""
    commits = _commits(spark, path)
    return commits[-1][0] if commits else None


def _bucket_folders(path: str, commit: dict, buckets: list[int] | None = None) -> list[str]:
    return [f"{path}/write={w}/bucket={b}" for b, parts in sorted((int(b), x) for b, x in commit["buckets"].items())
            for w, _ in parts if buckets is None or b in buckets]


def _merged(rows: DataFrame, keys: list[str], how: str) -> DataFrame:
    """One row per key; ``how`` is ``last`` (by the sequence in each field), ``sum`` or ``set`` (keys only)."""
    step = {"last": F.max, "sum": F.sum}
    fields = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(*[step[how](c).alias(c) for c in fields]) if fields else rows.distinct()


def _stored(spark: SparkSession, path: str, commit: dict, buckets: list[int] | None = None) -> DataFrame | None:
    """The rows of a commit, one per key."""
    folders = _bucket_folders(path, commit, buckets)
    if not folders:
        return None
    rows = spark.read.option("mergeSchema", "true").parquet(*folders)
    if all(len(x) == 1 for b, x in commit["buckets"].items() if buckets is None or int(b) in buckets):
        return rows  # merged already
    return _merged(rows, commit["keys"], commit["how"])


def _add(rows: DataFrame, path: str, keys: list[str], how: str, buckets: int = 64, keep: int = 2, keep_seconds: float = 0,
         applied: tuple[str, int] | None = None) -> dict:
    """Merge ``rows`` into a keyed table and commit; a (writer, batch) that was applied before changes nothing."""
    spark = rows.sparkSession
    commits = _commits(spark, path)
    version, commit = commits[-1] if commits else (-1, {"buckets": {}, "count": buckets, "keys": keys, "how": how,
                                                        "applied": {}})
    if applied and commit["applied"].get(applied[0], -1) >= applied[1]:
        return commit
    bucket = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(commit["count"])).cast("int")
    rows = _merged(rows, keys, how)
    sizes = {r.bucket: r.n for r in rows.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")).collect()}
    after, old = dict(commit["buckets"]), []
    new = version + 1
    for b, n in sizes.items():  # at most ``buckets`` of them
        parts = list(after.get(str(b), []))
        while parts and parts[-1][1] <= 2 * n:
            w, m = parts.pop()
            old.append(f"{path}/write={w}/bucket={b}")
            n += m
        after[str(b)] = [*parts, [new, n]]
    if old:
        rows = _merged(spark.read.option("mergeSchema", "true").parquet(*old).unionByName(rows, allowMissingColumns=True),
                       keys, how)
    if sizes:
        # small buckets share tasks, a large one is spread over several
        (rows.withColumn("bucket", bucket).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket")
             .parquet(f"{path}/write={new}"))
    elif not commits:  # an empty first write: one empty bucket keeps the schema
        rows.write.mode("overwrite").parquet(f"{path}/write={new}/bucket=0")
        after["0"] = [[new, 0]]
    done = commit["applied"] | ({applied[0]: applied[1]} if applied else {})
    commit = commit | {"version": new, "buckets": after, "applied": done, "time": time.time()}
    write_text_file(spark, f"{path}/{COMMITS}/{new:09d}.json", json.dumps(commit))
    drop_old_snapshots(spark, path, keep, keep_seconds)
    return commit


def drop_old_snapshots(spark: SparkSession, path: str, keep: int = 2, keep_seconds: float = 0) -> list[int]:
    """Delete commits that are neither among the ``keep`` newest nor younger than ``keep_seconds``, and the
    bucket folders that only they use.

    Returns the commits removed.  A reader of an older commit must have finished by then: a
    table that long micro-batches look up wants ``keep_seconds`` beyond their duration.
    """
    commits = _commits(spark, path)
    # a commit is in use until the next one is written
    ended = [nxt.get("time", 0) for _, nxt in commits[1:]] + [float("inf")]
    young = [i for i, t in enumerate(ended) if t > time.time() - keep_seconds]
    cut = max(min([len(commits) - keep, *young[:1]]), 0)
    old, kept = commits[:cut], commits[cut:]
    fs, new = _file_system(spark, path)
    used = {f for _, c in kept for f in _bucket_folders(path, c)}
    for _, c in old:
        for f in _bucket_folders(path, c):
            if f not in used:
                fs.delete(new(f), True)
    for v, _ in old:
        fs.delete(new(f"{path}/{COMMITS}/{v:09d}.json"), False)
    return [v for v, _ in old]


def read_keyed_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The current content of a keyed table: keys and fields, one row per key."""
    commits = _commits(spark, path)
    if not commits:
        return None
    commit = commits[-1][1]
    stored = _stored(spark, path, commit)
    fields = [c for c in stored.columns if c not in commit["keys"]]
    value = (lambda c: F.col(f"`{c}`.value").alias(c)) if commit["how"] == "last" else F.col
    return stored.select(*commit["keys"], *[value(c) for c in fields])


def upsert_by_key(updates: DataFrame, path: str, key: str | list[str], seq_col: str, buckets: int = 64, keep: int = 2,
                  keep_seconds: float = 0, null_keys: bool = False) -> DataFrame:
    """Merge field groups into one record per key; the last write wins per field.

    ``updates`` carries the key (or keys), a sequence column (larger = later) and any subset
    of fields, null where a write did not touch the field.  Every stored field keeps the
    sequence of its own last write, so the result does not depend on how the writes are
    batched; of two writes with the same sequence the larger value wins.  Rows without a
    key are ignored, unless ``null_keys`` makes null a key.  Folders that neither the newest ``keep`` commits use nor those of the
    last ``keep_seconds`` are deleted.  Returns the current table.
    """
    keys = [key] if isinstance(key, str) else list(key)
    fields = [c for c in updates.columns if c not in (*keys, seq_col)]
    rows = updates if null_keys else updates.dropna(subset=keys)
    rows = rows.select(*keys, *[
        F.when(F.col(c).isNotNull(), F.struct(F.col(seq_col).cast("long").alias("seq"), F.col(c).alias("value"))).alias(c)
        for c in fields])
    _add(rows, path, keys, "last", buckets, keep, keep_seconds)
    return read_keyed_table(updates.sparkSession, path)


def add_by_key(deltas: DataFrame, path: str, key: str | list[str], writer: str, batch_id: int, buckets: int = 64,
               keep: int = 2, keep_seconds: float = 0) -> None:
    """Add the deltas of a micro-batch to the counters of each key, once per (writer, batch).

    Several writers may feed different counters of one table; a counter that a write doesn't
    carry stays.  Rows without a key are ignored.  Nothing of the table is read but the
    folders that are merged on this occasion.
    """
    keys = [key] if isinstance(key, str) else list(key)
    _add(deltas.dropna(subset=keys), path, keys, "sum", buckets, keep, keep_seconds, (writer, batch_id))


def set_value(updates: DataFrame, path: str, key: str, value_col: str, seq_col: str, keep_seconds: float = 3600) -> DataFrame:
    """Set each key to a scalar value; the last write wins.  Streams look such tables up: old commits stay an hour."""
    return upsert_by_key(updates.select(key, value_col, seq_col), path, key, seq_col, keep_seconds=keep_seconds)


def set_add(members: DataFrame, path: str, key: str | list[str] = "customer_id", return_new: bool = False,
            buckets: int = 64) -> DataFrame | None:
    """Add each key once; keys already present are ignored (replays add nothing).

    The set is a keyed table without fields: adding reads nothing of it beyond the folders
    that are merged on the occasion.  With ``return_new`` the buckets of the candidates are
    read for an anti join, and the new keys are checkpointed first (so they can be returned
    after the set has changed) and returned.
    """
    spark = members.sparkSession
    keys = [key] if isinstance(key, str) else list(key)
    cand = members.select(*keys).dropna().distinct()
    if not return_new:
        _add(cand, path, keys, "set", buckets)
        return None
    commits = _commits(spark, path)
    if commits:
        commit = commits[-1][1]
        bucket = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(commit["count"])).cast("int")
        touched = [r[0] for r in cand.select(bucket).distinct().collect()]  # at most ``buckets`` numbers
        old = _stored(spark, path, commit, touched)
        if old is not None:
            cand = cand.join(old, keys, "left_anti")
    checkpoint_root(spark)
    cand = cand.checkpoint(eager=True)
    _add(cand, path, keys, "set", buckets)
    return cand


def read_set(spark: SparkSession, path: str) -> DataFrame:
    """The members of a set written by ``set_add``."""
    return read_keyed_table(spark, path)


def nested_window_result(ranked: DataFrame, window_cols=("window_start", "window_end"),
                         rank_col: str = "rank", name_col: str = "tag",
                         count_col: str = "amount") -> DataFrame:
    """One row per window holding its ranked list: ``datetime`` (window end) and
    ``hashtags`` = array<struct<name, occurrences>> in rank order."""
    start, end = window_cols
    item = F.struct(F.col(rank_col).alias("rank"), F.col(name_col).alias("name"),
                    F.col(count_col).alias("occurrences"))
    return (ranked.groupBy(start, end)
                  .agg(F.sort_array(F.collect_list(item)).alias("_items"))
                  .select(F.col(start).alias("window_start"), F.col(end).alias("datetime"),
                          F.transform("_items", lambda x: F.struct(x["name"].alias("name"),
                                                                   x["occurrences"].alias("occurrences")))
                          .alias("hashtags")))


def write_batch_output(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one micro-batch's rows to ``path/batch_id=<id>``, replacing a previous
    attempt of the same batch: an idempotent append for ``foreachBatch``."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def _batch_folders(spark: SparkSession, path: str) -> dict[int, str]:
    """The finished ``batch_id=<n>`` folders below ``path``."""
    fs, new = _file_system(spark, path)
    found = {}
    for st in fs.listStatus(new(path)):
        name = st.getPath().getName()
        if name.startswith("batch_id=") and fs.exists(new(f"{path}/{name}/_SUCCESS")):
            found[int(name[len("batch_id="):])] = f"{path}/{name}"
    return found


def compact_table(spark: SparkSession, src: str, dst: str, ts_col: str = "datetime",
                  date_col: str = "play_date", drop: tuple[str, ...] = ("batch_id",),
                  max_records_per_file: int = 5_000_000) -> DataFrame:
    """Rewrite a table of many small per-batch files into date partitions.

    Only batches that earlier calls didn't take are read, and only their dates get new files:
    each call writes one folder and commits it with the batches it holds, so a re-run after a
    failure gives the same table.  A rebalance by date brings the rows of a date together: AQE
    joins small dates' shuffle blocks into one task and splits a busy date over several, each
    of about the advisory partition size, so a date has as few files as its size needs.
    Returns the compacted table.
    """
    commits = _commits(spark, dst)
    version, commit = commits[-1] if commits else (-1, {"batches": [], "runs": []})
    folders = _batch_folders(spark, src)
    fresh = sorted(set(folders) - set(commit["batches"]))
    if fresh or not commits:
        new = version + 1
        df = spark.read.parquet(*[folders[b] for b in fresh])
        df = df.drop(*[c for c in drop if c in df.columns]).withColumn(date_col, F.to_date(F.col(ts_col)))
        (df.hint("rebalance", date_col).write.mode("overwrite").partitionBy(date_col)
           .option("maxRecordsPerFile", max_records_per_file).parquet(f"{dst}/run={new}"))
        commit = {"version": new, "batches": sorted([*commit["batches"], *fresh]), "runs": [*commit["runs"], new]}
        write_text_file(spark, f"{dst}/{COMMITS}/{new:09d}.json", json.dumps(commit))
        fs, path = _file_system(spark, dst)
        if commits:
            fs.delete(path(f"{dst}/{COMMITS}/{version:09d}.json"), False)
    return spark.read.option("basePath", dst).parquet(*[f"{dst}/run={r}" for r in commit["runs"]]).drop("run")
