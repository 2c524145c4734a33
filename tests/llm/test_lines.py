import random
import re

import pytest

from beatstream.llm import lines
from tests.llm.helpers import ODD, docs


def brute(rows, least):
    """Positions to delete: all runs of at least ``least`` words, compared with their first place."""
    kept = []
    for i, text in rows:
        parts = [x.strip(" ") for x in (text or "").split("\n")]
        kept.append([(p, x, len(x.split())) for p, x in enumerate(parts) if x.split()])
    runs, first = [], {}
    for d, own in enumerate(kept):
        for a in range(len(own)):
            words = 0
            for b in range(a, len(own)):
                words += own[b][2]
                if words >= least:
                    key = tuple(x for _, x, _ in own[a:b + 1])
                    runs.append((d, own[a][0], [p for p, _, _ in own[a:b + 1]], key))
                    first.setdefault(key, (d, own[b][0]))
    out = [set() for _ in rows]
    for d, start, places, key in runs:
        if first[key][0] != d or start > first[key][1]:
            out[d].update(places)
    return [sorted(x) for x in out]


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    some = [" ".join(rnd.choice("abc") for _ in range(n)) for n in (1, 1, 2, 3, 5, 8)] + ["", "  ", " a b "]
    rows = [(i, "\n".join(rnd.choice(some) for _ in range(rnd.randint(0, 14)))) for i in range(60)]
    got = {r.doc_id: r for r in lines.dedup_lines(docs(spark, rows), min_words=6).collect()}
    want = brute(rows, 6)
    assert sum(map(len, want)) > 50
    for (i, text), gone in zip(rows, want):
        parts = text.split("\n")
        assert got[i].removed == gone and got[i].n_lines == len(parts)
        assert got[i].text == "\n".join(x for p, x in enumerate(parts) if p not in gone)


def test_odd_rows(spark):
    long = "w " * 60
    rows = [*ODD, (20, long), (21, f"intro\n{long}\nend"), (None, long), (22, f"{long}\n{long}")]
    got = sorted(((r.doc_id, r.removed) for r in lines.dedup_lines(docs(spark, rows)).collect()), key=str)
    want = [(i, []) for i, _ in ODD] + [(20, [0]), (21, [1]), (None, []), (22, [0, 1])]
    assert got == sorted(want, key=str)  # null ids come first, repeated rows are one document


def test_empty_table_and_plan(spark):
    assert lines.dedup_lines(docs(spark, [])).count() == 0
    plan = lines.dedup_lines(docs(spark, ODD))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|MapIn", plan)
