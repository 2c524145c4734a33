import random

import numpy as np

from beatstream.llm import decontaminate
from beatstream.llm.decontaminate import Index, plain
from tests.llm.helpers import ODD, docs

BENCH = [(1, "The quick brown fox jumps over the lazy dog near the old river bank today"),
         (2, "Seven different ships sailed slowly across the northern sea before the winter storm"),
         (3, "short"), (4, None), (5, ""), (None, "Seven different ships"), (6, "The QUICK brown fox  jumps over the lazy dog\nnear the old river bank today")]


def bench(spark, rows=BENCH):
    return spark.createDataFrame(rows, "item_id long, text string")


def sellers(item, text):
    """Least edits of ``item`` against any part of ``text``."""
    row = np.zeros(len(text) + 1, int)
    at = np.arange(len(text) + 1)
    codes = np.array([ord(c) for c in text])
    for j, c in enumerate(item, 1):
        new = np.empty_like(row)
        new[0] = j
        new[1:] = np.minimum(row[:-1] + (codes != ord(c)), row[1:] + 1)
        row = np.minimum.accumulate(new - at) + at
    return int(row.min())


def edited(text, n, rnd):
    t = list(text)
    for _ in range(n):
        k, op = rnd.randrange(len(t)), rnd.random()
        if op < 0.4:
            t[k] = rnd.choice("abcxyz ")
        elif op < 0.7:
            t.insert(k, rnd.choice("abcxyz"))
        else:
            t.pop(k)
    return "".join(t)


def test_finds_every_occurrence_within_the_budget():
    rnd = random.Random(7)
    words = [w for _, t in BENCH if t for w in plain(t).split()]
    index = Index([(1, BENCH[0][1]), (2, BENCH[1][1])])
    for _ in range(250):
        k = rnd.randrange(2)
        item = index.items[k][1]
        around = " ".join(rnd.choice(words) for _ in range(60))
        at = rnd.randrange(len(around))
        text = plain(around[:at] + " " + edited(item, rnd.randint(0, 11), rnd) + " " + around[at:])
        cost = sellers(item, text)
        got = [m for m in index.find(text) if m[0] == k + 1]
        assert bool(got) == (cost <= index.edits[k]), (text, cost)
        for _, a, b, edits in got:
            assert sellers(item, text[a:b]) <= edits <= index.edits[k]
        if got:
            assert min(m[3] for m in got) == cost


def test_matches_and_filter(spark):
    rows = [*ODD, (10, f"before {BENCH[0][1].upper()} after"), (10, f"before {BENCH[0][1].upper()} after"),
            (11, BENCH[1][1].replace("northern", "northen")), (12, "Seven ships"), (13, "short"),
            (14, f"{BENCH[1][1]} and {BENCH[1][1]}"), (None, BENCH[0][1])]
    got = sorted(((r.doc_id, r.item_id, r.edits) for r in decontaminate.matches(docs(spark, rows), bench(spark)).collect()), key=str)
    assert got == sorted([(10, 1, 0), (10, 6, 0)] * 2 + [(11, 2, 1), (14, 2, 0), (14, 2, 0), (None, 1, 0), (None, 6, 0)], key=str)
    left = decontaminate.drop_contaminated(docs(spark, rows), bench(spark))
    assert left.columns == docs(spark, rows).columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted([i for i, *_ in ODD] + [12, 13], key=str)


def test_slices_give_the_same(spark):
    d = docs(spark, [(1, BENCH[0][1]), (2, BENCH[1][1]), (3, "clean words")])
    whole = decontaminate.matches(d, bench(spark)).collect()
    parts = decontaminate.matches(d, bench(spark), slice_chars=10).collect()
    assert sorted(map(str, whole)) == sorted(map(str, parts))
    assert [r.doc_id for r in decontaminate.drop_contaminated(d, bench(spark), slice_chars=10).collect()] == [3]


def test_empty_tables(spark):
    assert decontaminate.matches(docs(spark, []), bench(spark)).count() == 0
    assert decontaminate.matches(docs(spark, ODD), bench(spark, [])).count() == 0
    assert decontaminate.drop_contaminated(docs(spark, ODD), bench(spark, [])).count() == len(ODD)


def test_repeated_words_are_not_an_occurrence():
    index = Index([(1, BENCH[0][1])])
    assert index.find("the lazy dog " * 4000) == []


def test_short_items_have_the_whole_budget():
    """A tenth of the length, rounded down, against Sellers' algorithm; the rate 0.3 leaves some without a q-gram bound."""
    rnd = random.Random(17)
    for rate in (0.1, 0.3):
        missed = set()
        for m in range(8, 41):
            for _ in range(12):
                item = "".join(rnd.choice("abcdefgh ijklmnop") for _ in range(m + 4)).strip()[:m].replace("  ", "xy")
                item = plain(item).ljust(m, "q")
                index = Index([(1, item)], edit_rate=rate)
                budget = int(m * rate + 1e-9)
                around = ["".join(rnd.choice("abcxyz") for _ in range(rnd.randint(0, 50))) for _ in range(2)]
                text = plain(around[0] + edited(item, rnd.randint(0, budget + 1), rnd) + around[1])
                cost = sellers(item, text)
                got = index.find(text)
                assert bool(got) == (cost <= budget), (m, rate, item, text, cost)
                for _, a, b, edits in got:
                    assert sellers(item, text[a:b]) <= edits <= budget
                missed.add(cost > budget)
        assert missed == {True, False}


def test_a_short_item_is_found_at_every_place():
    assert [m[1:] for m in Index([(1, "abcdefghij")]).find("abcdefghij .. abcdefghij")] == [(0, 10, 0), (14, 24, 0)]
    twice = Index([(1, "abcdefghij")], edit_rate=0.3).find("abcdefghij ..... abcxefghij")
    assert [m[3] for m in twice] == [0, 1]
