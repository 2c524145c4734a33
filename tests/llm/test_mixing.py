import random
import re

import pytest

from beatstream.llm import mixing
from tests.llm.helpers import ODD, docs


def slots_of(plan):
    out = {}
    for s, a, b, start, period, slots in plan:
        for j in range(a, b):
            k = j - a
            x = start + k // len(slots) * period + slots[k % len(slots)]
            assert x not in out
            out[x] = (s, j)
    return out


def simulate(weights, n):
    """Earliest deadline first over ``n`` slots, block by block."""
    total, done, out = sum(weights.values()), dict.fromkeys(weights, 0), []
    for t in range(n):
        ready = [s for s in weights if done[s] * total // weights[s] <= t]
        s = min(ready, key=lambda s: (-(-(done[s] + 1) * total // weights[s]), s))
        out.append(s)
        done[s] += 1
    return out


@pytest.mark.parametrize("seed", range(40))
def test_schedule_serves_all_within_one_block(seed):
    rnd = random.Random(seed)
    weights = {f"s{i}": rnd.randint(1, 12) for i in range(rnd.randint(1, 6))}
    blocks = {s: rnd.randint(0, 60) for s in weights}
    if seed % 4 == 0:
        weights["s0"] = 0
    plan = mixing.phases(blocks, weights)
    slots = slots_of(plan)
    n = sum(blocks.values())
    assert sorted(slots) == list(range(n))
    for s in blocks:
        assert [slots[t][1] for t in range(n) if slots[t][0] == s] == list(range(blocks[s]))
    starts = sorted({p[3] for p in plan})
    for start, end in zip(starts, [*starts[1:], n]):
        share = {p[0]: len(p[5]) / p[4] for p in plan if p[3] == start}
        count = dict.fromkeys(share, 0)
        for t in range(start, end):
            count[slots[t][0]] += 1
            assert all(abs(count[s] - (t - start + 1) * share[s]) < 1 for s in share)


def test_period_equals_simulation():
    for weights in ({"a": 3, "b": 1}, {"a": 5, "b": 7, "c": 2}, {"a": 1}, {f"s{i}": i + 1 for i in range(9)}):
        total = sum(weights.values())
        by_slot = {t: s for s, ts in mixing.period(weights).items() for t in ts}
        assert [by_slot[t % total] for t in range(3 * total)] == simulate(weights, 3 * total)


def test_rows_are_placed_once_and_follow_the_weights(spark):
    rnd = random.Random(1)
    rows = [(i, "x" * rnd.randint(0, 40), rnd.choice(["a", "a", "a", "b", None])) for i in range(600)]
    out = mixing.positions(docs(spark, rows), weights={"a": 1, "b": 1, None: 2}, block_chars=100).collect()
    assert sorted(r.doc_id for r in out) == list(range(600))
    by_slot = {}
    for r in out:
        by_slot.setdefault(r.slot, set()).add((r.source, r.block))
    assert all(len(v) == 1 for v in by_slot.values())  # one block in a slot
    n_null = max(r.block for r in out if r.source is None) + 1
    first = [next(iter(by_slot[t]))[0] for t in range(2 * n_null - 4) if t in by_slot]
    assert abs(first.count(None) - len(first) / 2) <= 2
    for s in ("a", "b", None):  # places within a source are running sums of sizes
        size = {i: len(t) + 1 for i, t, x in rows if x == s}
        own = sorted((r for r in out if r.source == s), key=lambda r: r.place)
        at = 0
        for r in own:
            assert (r.place, r.block) == (at, at // 100)
            at += size[r.doc_id]


def test_mixed_keeps_rows_columns_and_order(spark):
    rows = [*ODD, *[(100 + i, f"text {i} " * 5, f"s{i % 3}") for i in range(60)]]
    d = docs(spark, rows)
    out = mixing.mixed(d, block_chars=50)
    assert out.columns == d.columns
    got = [r.doc_id for r in out.collect()]
    assert sorted(got, key=str) == sorted([r[0] for r in rows], key=str)
    place = {r.doc_id: (r.slot, r.place) for r in mixing.positions(d, block_chars=50).collect()}
    assert [place[i] for i in got] == sorted(place[i] for i in got)


@pytest.mark.parametrize("rows_of", [mixing.mixed, mixing.positions])
def test_the_schedule_is_not_broadcast_to_the_documents(spark, rows_of):
    # it has a row per document, and a hashed relation takes several times the size of its rows
    out = rows_of(docs(spark, [(i, "word " * (i % 7), f"s{i % 3}") for i in range(200)]))
    assert len(out.collect()) == 200
    joins = re.findall(r"\w+Join\w*", out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0])
    assert joins[0] == "SortMergeJoin", joins  # the outermost: documents and their places


def test_empty_and_too_many(spark, monkeypatch):
    assert mixing.positions(docs(spark, [])).count() == 0 and mixing.mixed(docs(spark, [])).count() == 0
    monkeypatch.setattr(mixing, "MAX_SOURCES", 2)
    with pytest.raises(ValueError):
        mixing.positions(docs(spark, [(i, "t", f"s{i}") for i in range(4)]))
