import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from beatstream.llm import lexical
from beatstream.llm.catalog import op13_lexical_search
from beatstream.llm.common import table
from tests.llm.helpers import ODD, docs

SF = "/root/testdata/sf0.001"
ITEM = "item_id long, text string, score string, rank string, doc_id string"


def items(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], ITEM)


def words(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)


def brute(rows, queries, k=50):
    bags = [(r[0], Counter(words(r[1]))) for r in rows]
    bags = [(i, c, sum(c.values())) for i, c in bags if c]
    n_docs, total = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, c, _ in bags for t in c)
    asked = {}
    for q in queries:
        asked.setdefault(q[0], set()).update(words(q[1]))
    out = []
    for q, ts in asked.items():
        w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in ts}
        scores = []
        for i, c, n in bags:
            m = 50 + 50 * n * n_docs // total
            s = sum(w[t] * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in ts if t in c)
            if s > 0 and i is not None:
                scores.append((-s, i))
        out += [(q, j + 1, i, -s) for j, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark):
    d = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    b = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    assert got(op13_lexical_search(spark, SF)) == brute(d, b)


def corpus(n, seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ünï", "日本", "A1"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    return [(i, " ".join(rnd.choices(vocabulary, weights, k=rnd.choice([1, 3, 20, 200])))) for i in range(n)], rnd


@pytest.mark.parametrize("heavy,bucket_rows,per_block", [(0.8, 16, 4096), (0.3, 7, 3), (1.0, 1000, 2)])
def test_pruning_loses_nothing(spark, heavy, bucket_rows, per_block):
    rows, rnd = corpus(300, 5)
    rows += [(1000 + i, "w3 w3 w7 w9") for i in range(80)]  # equal scores beyond the last place
    queries = [(q, " ".join(f"w{rnd.randrange(60)}" for _ in range(rnd.choice([1, 4, 30])))) for q in range(9)]
    out = lexical.rank_documents(docs(spark, rows), items(spark, queries), 20, per_block, bucket_rows, heavy)
    assert got(out) == brute(rows, queries, 20)


def test_odd_rows(spark):
    rows = [*ODD, (8, "One, two;THREE-four\x7ffive"), (8, "One, two;THREE-four\x7ffive"), (None, "one two"), (9, "a\x00b İ K ퟿")]
    queries = [(1, "one FIVE word"), (1, "日本"), (None, "x lost ünïcode"), (2, None), (3, ""), (4, "nothing known"),
               (5, "word " * 5000 + "x" * 20000), (6, "İ b")]
    assert got(lexical.rank_documents(docs(spark, rows), items(spark, queries))) == brute(rows, queries)


def test_empty_tables(spark):
    assert got(lexical.rank_documents(docs(spark, []), items(spark, [(1, "one")]))) == []
    assert got(lexical.rank_documents(docs(spark, ODD), items(spark, []))) == []
    assert got(lexical.rank_documents(docs(spark, [(1, "..."), (2, None)]), items(spark, [(1, "one")]))) == []
    # a term of all documents weighs nothing
    assert got(lexical.rank_documents(docs(spark, [(i, "all") for i in range(2000)]), items(spark, [(1, "all")]))) == []


def test_terms_are_the_pattern():
    rnd = random.Random(1)
    for _ in range(300):
        text = "".join(chr(rnd.choice([rnd.randrange(1, 300), rnd.randrange(0x20, 0x7f), 0x1F600, 0x130])) for _ in range(40))
        assert [t.decode() for t in lexical.terms(text)] == words(text)
    assert lexical.terms(None) == [] and np.array(lexical.terms("A b")).tolist() == [b"a", b"b"]
