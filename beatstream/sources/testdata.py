"""Adapter from the generated test tables to the listening data model.

The test folders hold a TPC-H-like star schema plus an ``events`` table.  These
functions derive the reference's inputs from them with plain column expressions,
so every query's work grows with the tables:

* plays      <- events (customer = user, track = ``k`` from ``props``)
* customers  <- customer + nation
* clicks     <- events of type ``click``
* music      <- part
* messages   <- events (tag text built from the event)
* retail     <- lineitem join orders
* play lines <- plays printed as raw CSV log lines, with broken lines for errors

The same definitions exist as DuckDB SQL in ``beatstream.plans.oracle``.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def events_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The events table as a file stream (the folder is watched for new files)."""
    schema = table(spark, sf_dir, "events").schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # A file stream needs a directory or a glob, not a single file path.
    return reader.parquet(os.path.join(sf_dir, "events*.parquet"))


def _track_key(props: str = "props") -> Column:
    return F.get_json_object(F.col(props), "$.k").cast("bigint")


def plays_from_events(events: DataFrame) -> DataFrame:
    """Works for batch and streaming events."""
    return events.select(
        F.col("event_id"),
        F.col("user_id").alias("customer_id"),
        _track_key().alias("track_id"),
        F.col("ts").alias("datetime"),
        F.when(F.col("event_type").isin("view", "click"), F.lit(1)).otherwise(F.lit(0))
         .cast("int").alias("ismobile"),
        (F.lit(10000) + F.col("event_id") % 40).cast("string").alias("listening_zip_code"),
    )


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plays_from_events(table(spark, sf_dir, "events"))


def coarse_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays with a coarse track id (``k % 5``) so that repeats are frequent."""
    return plays(spark, sf_dir).withColumn("track_id", F.col("track_id") % 5)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    # nation has 25 rows by definition of the schema: a proven-small side.
    n = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    key = F.col("c_custkey")
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .select(
                key.alias("customer_id"),
                F.col("c_name").alias("name"),
                (F.lit(10) + key % 60).cast("int").alias("age"),
                (key % 2).cast("string").alias("gender"),
                F.col("c_nationkey").cast("string").alias("zip"),
                F.col("n_name").alias("Address"),
                F.date_format(F.date_add(F.lit("2013-01-01").cast("date"), (key % 1000).cast("int")),
                              "MM/dd/yyyy").alias("SignDate"),
                F.when(F.col("c_acctbal") >= 0, F.lit("1")).otherwise(F.lit("0")).alias("Status"),
                (key % 3).cast("string").alias("Level"),
                F.col("c_mktsegment").alias("Campaign"),
                (key % 5 % 2).cast("string").alias("LinkedWithApps"),
            ))


def active_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with an open account (Status 1); plays of others miss a lookup."""
    return customers(spark, sf_dir).filter(F.col("Status") == "1")


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clicks_from_events(table(spark, sf_dir, "events"))


def clicks_from_events(events: DataFrame) -> DataFrame:
    """Works for batch and streaming events."""
    return events.filter(F.col("event_type") == "click").select(
        F.col("event_id").alias("EventID"),
        F.col("user_id").alias("CustID"),
        F.when(_track_key() % 5 == 0, F.lit("ADV_REDUCED_1DAY"))
         .otherwise(F.lit("ADV_FREE_REFERRAL")).alias("AdClicked"),
        F.col("ts").alias("Localtime"),
    )


def music(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("TrackId"),
        F.col("p_name").alias("Title"),
        F.col("p_brand").alias("Artist"),
        F.col("p_size").cast("int").alias("Length"),
    )


def messages_from_events(events: DataFrame) -> DataFrame:
    k = _track_key()
    text = F.concat(
        F.lit("Now #"), F.col("event_type"),
        F.lit(", #K"), (k % 10).cast("string"),
        F.lit("! a#b ##"), (F.col("user_id") % 3).cast("string"),
        F.lit(" #?"),
    )
    return events.select(F.col("event_id").alias("msg_id"), F.col("ts"), text.alias("text"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_from_events(table(spark, sf_dir, "events"))


def retail(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("CustomerId"),
        F.col("l_extendedprice").alias("UnitPrice"),
        F.lit(1).alias("Quantity"),
        F.col("o_orderdate").alias("InvoiceDate"),
    )


def play_lines_from_events(events: DataFrame, *keep: str) -> DataFrame:
    """Print plays as raw log lines (``value`` column, behind the columns to keep), the way the log file holds them.

    Error events become broken lines: cut short before the flag when the event value is
    below 5, with a text track id when it is above 90, an unreadable time when it is
    above 80, and else with a non-integer mobile flag.
    """
    k = _track_key().cast("string")
    stamp = F.substring(F.col("ts").cast("string"), 1, 19)  # the wall clock, whatever the session's zone
    mobile = F.when(F.col("event_type").isin("view", "click"), F.lit("1")).otherwise(F.lit("0"))
    zip_code = (F.lit(10000) + F.col("event_id") % 40).cast("string")
    head = F.concat(F.col("event_id").cast("string"), F.lit(","), F.col("user_id").cast("string"),
                    F.lit(","), k, F.lit(',"'), stamp, F.lit('",'))
    good = F.concat(head, mobile, F.lit(',"'), zip_code, F.lit('"'))
    bad_flag = F.concat(head, F.lit("E,\""), zip_code, F.lit('"'))
    ids = F.concat(F.col("event_id").cast("string"), F.lit(","), F.col("user_id").cast("string"), F.lit(","))
    tail = F.concat(F.lit('",0,"'), zip_code, F.lit('"'))
    bad_track = F.concat(ids, F.lit("T"), k, F.lit(',"'), stamp, tail)
    bad_time = F.concat(ids, k, F.lit(',"'), F.substring(stamp, 1, 10), tail)
    line = (F.when(F.col("event_type") != "error", good).when(F.col("value") < 5, head)
             .when(F.col("value") > 90, bad_track).when(F.col("value") > 80, bad_time).otherwise(bad_flag))
    return events.select(*keep, line.alias("value"))


def play_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return play_lines_from_events(table(spark, sf_dir, "events"))


def play_log_folder(spark: SparkSession, sf_dir: str) -> str:
    """Write the play log as text files to a fresh shared folder (what the log
    collector tails) and return the folder: one file for each partition of the table."""
    from beatstream.session import shared_path
    path = shared_path(spark, "play-log")
    play_lines(spark, sf_dir).write.text(path)
    return path


LOG_HOSTS = 8  # collectors that write a log file each


def _by_host(events: DataFrame) -> DataFrame:
    """The log's lines as (host, line), each host sorted by time in a partition of its own."""
    host = F.pmod(F.col("user_id"), F.lit(LOG_HOSTS)).cast("int")
    line = play_lines_from_events(events.select("*", host.alias("host")), "host", "ts", "event_id")
    # so many partitions that Spark's hash puts no two hosts into one
    return (line.repartition(5 * LOG_HOSTS, "host").sortWithinPartitions("host", "ts", "event_id")
            .select("host", F.concat("value", F.lit("\n")).alias("line")))


def _write_logs(batches, folder: str, cut: int):
    """Write each host's lines, which come one host after another, to its file; one row when done."""
    import numpy as np
    import pyarrow as pa
    from pyarrow import fs as pafs
    fs, base = pafs.FileSystem.from_uri(folder)
    fs.create_dir(base)
    here, out, kept = None, None, b""

    def close():
        if out is not None:
            out.close()
            fs.move(f"{base}/.host-{here}.part", f"{base}/host-{here}.log")

    for b in batches:
        hosts, lines = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_pylist()
        begins = [0, *(np.flatnonzero(hosts[1:] != hosts[:-1]) + 1).tolist(), len(lines)]
        for i, j in zip(begins, begins[1:], strict=False):
            if i == j:
                continue
            if hosts[i] != here:
                close()
                here, kept = hosts[i], b""
                out = fs.open_output_stream(f"{base}/.host-{here}.part")
            kept += "".join(lines[i:j]).encode()  # a batch's lines at once: only the last bytes are held back
            ready = max(len(kept) - cut, 0)
            out.write(kept[:ready])
            kept = kept[ready:]
    close()
    yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32())], ["done"])


def grow_play_log(events: DataFrame, folder: str, cut: int = 0) -> None:
    """Bring the log files of ``folder`` (one per host, ascending by time) to what ``events`` holds.

    A file whose events are a later state of the same log keeps its old bytes and grows behind
    them.  ``cut`` leaves that many bytes off each file's end: a line half written.  A file is
    replaced as a whole, so a repeated task gives the same file.
    """
    from pyspark import cloudpickle
    import sys
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    rows = _by_host(events).mapInArrow(lambda batches: _write_logs(batches, folder, cut), "done int")
    rows.write.format("noop").mode("overwrite").save()
