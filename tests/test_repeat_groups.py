"""The repeat-listen processor on a group of keys, against a stand-in for Spark's state and timers."""

import random

import numpy as np
import pandas as pd
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from beatstream.streaming.repeat import HELD, RepeatProcessor

HOUR = 3600 * 1_000_000
FIELDS = [(v, c) for v, names in HELD.items() for c in names]


class Group:
    """State and timers of one group, with a count of the calls that cross to the JVM."""

    def __init__(self, processor):
        self.value, self.timers, self.calls = None, set(), 0
        self.processor = processor
        processor.init(self)

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def clear(self):
        self.calls += 1
        self.value = None

    def registerTimer(self, ms):
        self.calls += 1
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.calls += 1
        self.timers.remove(ms)

    def batch(self, rows, watermark):
        """Reports of a micro-batch of (customer, track, us)."""
        now, out = TimerValues(0, watermark), []
        if rows:
            frame = pd.DataFrame(rows, columns=HELD["plays"])
            out += self.processor.handleInputRows((0,), iter([frame[:7], frame[7:]]), now)
        for ms in sorted(t for t in self.timers if t < watermark):
            out += self.processor.handleExpiredTimer((0,), now, ExpiredTimerInfo(ms))
            self.timers.remove(ms)
        return [tuple(r) for f in out for r in f.itertuples(index=False)]

    def held(self, variable):
        if self.value is None:
            return []
        columns = {c: v for (name, c), v in zip(FIELDS, self.value[2:], strict=True) if name == variable}
        return list(zip(*columns.values(), strict=True))


def first_runs(plays, k, within):
    times, out = {}, {}
    for c, t, us in plays:
        times.setdefault((c, t), []).append(us)
    for key, v in times.items():
        v.sort()
        ends = [b for a, b in zip(v, v[k - 1:]) if b - a <= within]
        if ends:
            out[key] = ends[0]
    return out


def test_a_group_costs_the_same_calls_whatever_its_keys():
    calls = []
    for keys in (1, 500):
        group = Group(RepeatProcessor(3, HOUR, 720 * HOUR))
        rows = [(c, c % 5, (10 * i + c % 3) * 60_000_000) for c in range(keys) for i in range(12)]
        assert group.batch(rows, 0) == []
        assert dict(((c, t), us) for c, t, us in group.batch([], 10**9)) == first_runs(rows, 3, HOUR)
        calls.append(group.calls)
    assert max(calls) <= 8


def test_reports_do_not_depend_on_batches_and_order():
    for seed in range(30):
        rnd = random.Random(seed)
        k, delay = rnd.choice([1, 2, 3, 4]), 5 * HOUR
        plays = [(rnd.randint(-2, 6), rnd.randint(0, 2), rnd.randrange(-20 * HOUR, 80 * HOUR, 60_000_000)) for _ in range(400)]
        plays.sort(key=lambda p: p[2] + rnd.randrange(delay))  # none comes later than the delay
        group, got, seen, high = Group(RepeatProcessor(k, HOUR, 10_000 * HOUR)), [], 0, -10**18
        while seen < len(plays):
            n = rnd.randint(1, 60)
            got += group.batch(plays[seen:seen + n], (high - delay) // 1000)
            seen, high = seen + n, max([high, *(p[2] for p in plays[seen:seen + n])])
            assert len(group.timers) <= 1
        got += group.batch([], 10**8 * 3)
        assert len(got) == len({g[:2] for g in got})
        assert {g[:2]: g[2] for g in got} == first_runs(plays, k, HOUR)
        newest = {}
        for c, t, us in plays:
            newest[c, t] = max(us, newest.get((c, t), us))
        assert sorted(group.held("reported")) == sorted((*key, newest[key]) for key in first_runs(plays, k, HOUR))
        assert group.held("plays") == [] and group.held("found") == []


def test_a_hot_key_holds_few_plays():
    group = Group(RepeatProcessor(3, HOUR, 720 * HOUR))
    rnd = random.Random(1)
    for _ in range(5):
        group.batch([(1, 1, rnd.randrange(48 * HOUR)) for _ in range(5000)], 0)
    us = np.sort([u for _, _, u in group.held("plays")])
    (_, _, end, newest), = group.held("found")
    assert len(us) <= 2 * 48 and (us < end).all() and newest > end
    assert not any(b - a <= HOUR for a, b in zip(us, us[2:]))


def test_a_report_is_forgotten_after_the_last_play():
    group = Group(RepeatProcessor(2, HOUR, 10 * HOUR))
    ms = HOUR // 1000
    assert group.batch([(1, 1, 0), (1, 1, 5), (2, 2, 0), (2, 2, 5)], 0) == []
    assert sorted(group.batch([], ms)) == [(1, 1, 5), (2, 2, 5)]
    assert group.batch([(2, 2, 6 * HOUR)], 2 * ms) == []
    group.batch([], 11 * ms)
    assert group.held("reported") == [(2, 2, 6 * HOUR)]
    assert group.batch([(1, 1, 12 * HOUR), (1, 1, 12 * HOUR + 1), (2, 2, 12 * HOUR)], 11 * ms) == []
    assert group.batch([], 13 * ms) == [(1, 1, 12 * HOUR + 1)]
    assert sorted(group.held("reported")) == [(1, 1, 12 * HOUR + 1), (2, 2, 12 * HOUR)]
    group.batch([], 30 * ms)
    assert group.value is None and not group.timers
