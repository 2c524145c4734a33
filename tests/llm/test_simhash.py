import random
import re

import pytest
import xxhash

from beatstream.llm import simhash
from tests.llm.helpers import ODD, docs


def brute_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, bits=4):
    fps = [brute_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    first = {}
    for (d, _), x in zip(rows, label):
        if d is not None:
            first[x] = min(first.get(x, d), d)
    return [(d, f, first.get(x)) for (d, _), f, x in zip(rows, fps, label)]


def near_rows(n, seed):
    rnd = random.Random(seed)
    base = [[rnd.choice("abcdefghij") * rnd.randint(1, 4) for _ in range(60)] for _ in range(6)]
    rows = []
    for i in range(n):
        words = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 3)):
            words[rnd.randrange(len(words))] = f"w{rnd.randint(0, 40)}"
        rows.append((i, " ".join(words)))
    return rows


def got(spark, rows, **kw):
    out = simhash.near_duplicates(docs(spark, rows), **kw).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    return sorted([(r.doc_id, r.fp % 2**64, r.component_id) for r in out], key=key)


def test_odd_rows(spark):
    rows = [*ODD, (8, "A B\x0bC\x1fd"), (9, "a b\x0bc\x1fD")]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert got(spark, rows) == sorted(brute_components(rows), key=key)


@pytest.mark.parametrize("crowded", [2048, 2])
def test_components_equal_brute_force(spark, crowded):
    rows = near_rows(150, 4)
    want = brute_components(rows)
    assert len({c for _, _, c in want}) < 150  # some are linked
    assert got(spark, rows, crowded=crowded) == sorted(want)


@pytest.mark.parametrize("crowded", [2048, 1])
def test_links_at_every_distance(spark, crowded):
    rnd = random.Random(9)
    fps = set()
    for _ in range(60):
        f = rnd.getrandbits(64)
        fps.add(f)
        for d in range(1, 7):
            g = f
            for b in rnd.sample(range(64), d):
                g ^= 1 << b
            fps.add(g)
    fps = sorted(fps)
    df = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f,) for f in fps], "fp long")
    from beatstream.llm.common import connected_components
    comp = {r.node % 2**64: r.component for r in connected_components(simhash.links(df, 4, crowded)).collect()}
    label = {f: f for f in fps}
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 4 and label[a] != label[b]:
                old, new = label[a], label[b]
                label = {k: new if v == old else v for k, v in label.items()}
    groups = lambda of: sorted(sorted(f for f in fps if of(f) == x) for x in {of(f) for f in fps})
    assert groups(lambda f: comp.get(f, f"own{f}")) == groups(lambda f: label[f])


def test_fingerprints_are_not_broadcast_by_the_size_of_their_file(spark):
    # the file of a written table says little of its rows, and nothing of those of an explode
    fps = simhash.written(spark.range(300).selectExpr("xxhash64(id) AS fp"), "simhash-test")
    some = docs(spark, [(i, f"w{i} x{i} y{i} z{i} {'same' if i % 2 else i}") for i in range(40)] * 2)
    for df in (simhash.links(fps), simhash.near_duplicates(some), simhash.keep_first(some)):
        joins = re.findall(r"\w*Join\w* .*", df._jdf.queryExecution().sparkPlan().toString())
        # those against the few crowded segment values (semi, anti) may be broadcast
        wide = [j for j in joins if not re.search(r"LeftSemi|LeftAnti", j)]
        assert wide and not [j for j in wide if j.startswith("Broadcast")], joins


def test_segments_allow_one_bit():
    assert simhash.segments(4) == [(0, 21), (21, 21), (42, 22)]
    with pytest.raises(ValueError):
        simhash.links(None, 3)


def test_keep_first_keeps_columns_and_null_ids(spark):
    rows = [(3, "same text of words"), (1, "same text of words"), (1, "same text of words"), (2, "other words are here"),
            (None, "same text of words"), (7, None)]
    out = simhash.keep_first(docs(spark, rows))
    assert out.columns == docs(spark, rows).columns
    assert sorted([r.doc_id for r in out.collect()], key=str) == [1, 2, 7, None]


def test_keep_first_tells_texts_of_one_id_apart(spark):
    a, b, c = ("alpha beta gamma delta epsilon", "one two three four five six", "red green blue white black")
    for rows, want in (
            ([(7, a), (7, b)], [(7, a), (7, b)]),                        # unrelated texts of one id
            ([(3, b), (7, a), (7, b)], [(3, b), (7, a)]),                # one of them a copy of another row
            ([(7, a), (7, a), (7, b), (8, a), (9, c)], [(7, a), (7, b), (9, c)]),
            ([(None, a), (None, a), (None, b), (4, c)], [(None, a), (None, b), (4, c)])):
        out = [(r.doc_id, r.text) for r in simhash.keep_first(docs(spark, rows)).collect()]
        assert sorted(out, key=str) == sorted(want, key=str)


def test_empty_table(spark):
    assert got(spark, []) == []
    assert simhash.keep_first(docs(spark, [])).count() == 0
