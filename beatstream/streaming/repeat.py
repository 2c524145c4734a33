"""Repeat listens on a stream: the one custom stateful operator.

Keys, that is (customer, track), are grouped into ``SHARDS`` groups by their hash.  A call to
the operator, a read or write of state and a timer each cost a round trip to the JVM, far more
than the work on one key, so each serves a whole group.  What is held of a group's keys:

- ``plays``, the times of plays that may be part of a run still to be found.
- ``found``, the end of the earliest run so far, and the latest play, of keys with a run.
- ``reported``, the time of the latest play of keys whose report is out.

One event-time timer a group, at the moment when something of it is due first, does the rest.
A run is reported when the watermark has passed its last play: until then an earlier play may
still arrive and complete an earlier run, so the report does not depend on the order in which
plays arrive.  Plays lie in time buckets one horizon wide; those of a bucket are dropped when no
play that is still to come can join it.  A key's report is forgotten ``retain`` after its
last play (a key that starts anew after that is reported again; the interest list, a keyed set,
registers it once).  A state's time to live is no substitute: it counts processing time, which
Spark doesn't offer next to event-time timers, and a replay would forget at other moments.

State size per key is bounded even for a hot key, whatever its age.  Plays from a run's end on
aren't held, as they can't end an earlier one; those before hold no run, so a horizon has less
than ``k`` of them, and they span the watermark delay plus two horizons.  The rows one call
receives are bounded by the micro-batch size (``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``).
Plays without a customer, track or time are left out.  ``read_state`` reads the state of a
checkpoint back.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from beatstream.functions.timeutil import duration_seconds, micros_to_ntz, ntz_micros, ntz_to_instant
from beatstream.session import rocksdb_state
from beatstream.streaming.flows import start
from beatstream.streaming.sinks import set_add

# the processor is shipped by value: workers need not have this package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OUTPUT_SCHEMA = "customer_id long, track_id long, first_detected_us long"

SHARDS = 8192  # groups of keys; the state of a checkpoint lies by them, so a stream keeps its number
KEY = ["customer_id", "track_id"]
HELD = {"plays": [*KEY, "us"], "found": [*KEY, "us", "newest"], "reported": [*KEY, "us"]}
STATE_SCHEMA = "due long, within long, " + ", ".join(f"{v}_{c} array<long>" for v, names in HELD.items() for c in names)
LATER, EARLIER = np.iinfo(np.int64).max, np.iinfo(np.int64).min


def _numbered(*tables: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The number of each column's key, by table, and the distinct keys.  Rows 0 and 1 are the key."""
    keys = np.concatenate([t[:2] for t in tables], axis=1)
    order = np.lexsort((keys[1], keys[0]))
    keys = keys[:, order]
    first = np.ones(keys.shape[1], bool)
    first[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(first) - 1
    return np.split(number, np.cumsum([t.shape[1] for t in tables])[:-1]), keys[:, first]


class RepeatProcessor(StatefulProcessor):
    """Reports a key once ``k`` of its plays lie within ``within_us`` microseconds.

    Works on a group of keys at once; a table of ``HELD`` is an array with a row per name."""

    def __init__(self, k: int, within_us: int, retain_us: int):
        self.k, self.within, self.retain = k, within_us, retain_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", STATE_SCHEMA)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = np.concatenate([b[HELD["plays"]].to_numpy(dtype=np.int64) for b in rows]).T
        due, plays, found, reported = self._load()
        (at_new, at_plays, at_found, at_reported), keys = _numbered(new, plays, found, reported)
        done = np.zeros(keys.shape[1], bool)
        done[at_reported] = True
        newest = np.full(keys.shape[1], EARLIER)
        newest[at_reported], newest[at_found] = reported[2], found[3]
        best = np.full(keys.shape[1], LATER)
        best[at_found] = found[2]
        at, us = np.concatenate([at_plays, at_new]), np.concatenate([plays[2], new[2]])
        np.maximum.at(newest, at, us)
        use = ~done[at] & (us < best[at])  # behind the run found a play can't end an earlier one
        at, us = at[use], us[use]
        order = np.lexsort((us, at))
        at, us = at[order], us[order]
        begins = max(0, len(us) - self.k + 1)
        ends = slice(self.k - 1, None)
        runs = (at[ends] == at[:begins]) & (us[ends] - us[:begins] <= self.within)
        np.minimum.at(best, at[ends][runs], us[ends][runs])
        use, run = us < best[at], best < LATER
        self._keep(due, np.vstack([keys[:, at[use]], us[use]]), np.vstack([keys[:, run], best[run], newest[run]]),
                   np.vstack([keys[:, done], newest[done]]))
        return
        yield  # reports come from timers only

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        expiry = expiredTimerInfo.getExpiryTimeInMs()
        now = max(expiry, timerValues.getCurrentWatermarkInMs())
        due, plays, found, reported = self._load()
        ready = self._report_at(found[2]) <= now
        out = found[:, ready]
        (at_plays, at_out), _ = _numbered(plays, out)
        plays = plays[:, (self._drop_at(plays[2]) > now) & ~np.isin(at_plays, at_out)]
        reported = np.hstack([reported, out[[0, 1, 3]]])
        reported = reported[:, self._forget_at(reported[2]) > now]
        self._keep(None if due == expiry else due, plays, found[:, ~ready], reported)
        if out.shape[1]:
            yield pd.DataFrame({"customer_id": out[0], "track_id": out[1], "first_detected_us": out[2]})

    def close(self) -> None:
        pass

    def _load(self) -> tuple[int | None, np.ndarray, np.ndarray, np.ndarray]:
        """When the group's timer is due, and its tables."""
        got = self.held.get()
        due, _, *columns = got or (None, None, *[[]] * sum(map(len, HELD.values())))
        columns = iter(columns)
        return due, *(np.array([next(columns) for _ in names], np.int64).reshape(len(names), -1) for names in HELD.values())

    def _keep(self, due: int | None, plays: np.ndarray, found: np.ndarray, reported: np.ndarray) -> None:
        """Write the tables back.  ``due``: when the timer is, if there is one; a timer that is too early stays."""
        first = min((int(t.min()) for t in (self._drop_at(plays[2]), self._report_at(found[2]),
                                            self._forget_at(reported[2])) if len(t)), default=None)
        if first is None:
            self.held.clear()
            return
        if due is None or first < due:
            if due is not None:
                self.handle.deleteTimer(due)
            self.handle.registerTimer(first)
            due = first
        self.held.update((due, self.within, *(c.tolist() for table in (plays, found, reported) for c in table)))

    def _drop_at(self, us: np.ndarray) -> np.ndarray:
        """When plays of the play's bucket can't meet a coming one: a horizon behind the bucket's end, in ms."""
        return -(-(us // self.within + 2) * self.within // 1000)

    def _report_at(self, us: np.ndarray) -> np.ndarray:
        return us // 1000 + 1

    def _forget_at(self, us: np.ndarray) -> np.ndarray:
        return (us + self.retain) // 1000 + 1


def repeat_listens_stream(plays: DataFrame, min_plays: int = 3, within_seconds: int = 30 * 60,
                          delay: str = "30 minutes", ts_col: str = "datetime", retain: str = "30 days") -> DataFrame:
    """Streaming (customer, track, first_detected) reports, each key once.

    Play times travel as epoch microseconds of the wall clock (no time zone), and
    ``first_detected`` comes back as ``timestamp_ntz`` like the batch form.  In a session that
    doesn't have its streams' state in RocksDB, start the query inside ``rocksdb_state(spark)``."""
    p = (plays.select(*[F.col(c).cast("long").alias(c) for c in KEY], ntz_to_instant(F.col(ts_col)).alias("ts"),
                      ntz_micros(F.col(ts_col)).alias("us"))
              .filter(F.col("customer_id").isNotNull() & F.col("track_id").isNotNull() & F.col("us").isNotNull())
              .withColumn("shard", F.pmod(F.xxhash64(*KEY), F.lit(SHARDS)).cast("int"))
              .withWatermark("ts", delay))
    processor = RepeatProcessor(min_plays, within_seconds * 1_000_000, duration_seconds(retain) * 1_000_000)
    out = p.groupBy("shard").transformWithStateInPandas(
        processor, OUTPUT_SCHEMA, outputMode="Append", timeMode="EventTime")
    return out.select("customer_id", "track_id", micros_to_ntz(F.col("first_detected_us")).alias("first_detected"))


def read_state(spark: SparkSession, checkpoint: str, variable: str) -> DataFrame:
    """What a checkpoint of the stream holds in ``plays``, ``found`` or ``reported``: (customer_id, track_id, ...).

    Plays come by their bucket, as (customer_id, track_id, bucket, times)."""
    names = HELD[variable]
    state = spark.read.format("statestore").option("stateVarName", "held").load(checkpoint)
    held = (state.select("value.within", *[F.col(f"value.{variable}_{c}").alias(c) for c in names])
            .select("within", F.explode(F.arrays_zip(*names)).alias("row")).select("within", "row.*"))
    if variable == "plays":
        return (held.groupBy(*KEY, F.expr("(us - pmod(us, within)) div within").alias("bucket"))
                .agg(F.sort_array(F.collect_list("us")).alias("times")))
    return held.select(*names)


def register_repeats(reports: DataFrame, interests_path: str, checkpoint: str | None = None,
                     trigger: dict | None = None):
    """Start a query that registers each reported (customer, track) in the interest list,
    a keyed set: a key reported again, or a batch replayed, adds nothing."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        set_add(batch, interests_path, ["customer_id", "track_id"])

    with rocksdb_state(reports.sparkSession):
        return start(reports, handle, checkpoint, trigger)
