import hashlib
import re

from pyspark.sql import functions as F

from beatstream.llm import spotsigs
from tests.llm.helpers import ODD, docs

STOP = {w for ws in spotsigs.ANCHORS.values() for w in ws.split()}


def brute(text, chain=2):
    """Signatures as tuples: the anchors before a content word, and the chain from it."""
    words = re.findall(r"[^\W_]+", (text or "").lower())
    tokens, anchors = [], []
    for w in words:
        if w in STOP:
            anchors.append(w)
        else:
            tokens.append((tuple(anchors), w))
            anchors = []
    if anchors and tokens or anchors:
        tokens.append((tuple(anchors[:-1]), anchors[-1]))  # closing common words stand as a word
    out = set()
    for i, (a, _) in enumerate(tokens):
        if a and i + chain <= len(tokens):
            out.add((a, tuple(w for _, w in tokens[i:i + chain])))
    if out:
        return out
    if len(words) > 1:
        return {(None, p) for p in zip(words, words[1:])}
    return {(None, tuple(words))} if words else set()


TEXTS = ["the cat of the dog and bird sat on a mat in the sun", "plain words only here", "the", "the of and", "", None,
         "Der Hund und die Katze, das Haus!", "one", "El perro de la casa. Y el gato", "cat the", "a a a a cat dog",
         "the cat sat the cat sat the cat sat"]


def test_signatures_equal_brute_force(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, text string")
    got = {r.i: set(r.s) for r in spotsigs.with_signatures(df, "text", "s").collect()}
    want = {i: brute(t) for i, t in enumerate(TEXTS)}
    for i in want:
        assert len(got[i]) == len(want[i]), TEXTS[i]
        for j in want:  # the same overlaps, so the same hashes for the same signatures
            assert len(got[i] & got[j]) == len(want[i] & want[j]), (TEXTS[i], TEXTS[j])


def test_edits_and_neighbours(spark):
    rows = [(5, "the cat sat on the mat and the dog ran to the old house by the river" * 3), (9, "tiny"),
            (2, "Ünïcode \U0001f600 text of the sea and the sky with the birds"), (7, None), (8, "the x"), (30, "q" * 5000)]
    got = {r.doc_id: r for r in spotsigs.edited_fingerprints(docs(spark, rows)).collect()}
    order = sorted(rows)
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        t, nxt = t or "", nxt or ""
        m = len(t) // 4
        edited = t[:len(t) - m] + nxt[:m]
        assert got[i].n_chars == len(t)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = brute(t), brute(edited), brute(nxt)
        like = lambda x, y: 1.0 if not x | y else len(x & y) / len(x | y)
        assert abs(got[i].near_edited - like(a, b)) < 1e-9 and abs(got[i].near_next - like(a, c)) < 1e-9
        assert (got[i].fingerprint == got[i].edited_fingerprint) == (a == b)


def test_odd_rows_single_row_and_empty(spark):
    out = spotsigs.edited_fingerprints(docs(spark, ODD)).collect()
    assert sorted((r.doc_id for r in out), key=str) == sorted((i for i, _ in ODD), key=str)
    by_text = {}
    for r in out:
        by_text.setdefault(dict(ODD)[r.doc_id], set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    one = spotsigs.edited_fingerprints(docs(spark, [(4, "the cat sat on the mat")])).first()
    assert one.near_next == 1.0  # its own next
    assert spotsigs.edited_fingerprints(docs(spark, [])).count() == 0


def test_pruned_jaccard(spark):
    df = spark.createDataFrame([([1, 2, 3], [2, 3, 4]), ([1], [1, 2, 3, 4]), ([], []), ([], [1])],
                               "a array<long>, b array<long>")
    a, b = F.col("a"), F.col("b")
    assert [r[0] for r in df.select(spotsigs.jaccard(a, b)).collect()] == [0.5, 0.25, 1.0, 0.0]
    assert [r[0] for r in df.select(spotsigs.jaccard(a, b, 0.4)).collect()] == [0.5, 0.0, 1.0, 0.0]


def test_no_python_in_the_plan(spark):
    plan = spotsigs.edited_fingerprints(docs(spark, ODD))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|MapIn", plan)


def test_near_classes_equal_brute_force(spark):
    import random
    rnd = random.Random(6)
    words = [f"w{i}" for i in range(400)]
    base = [[rnd.choice(["the", "of", "and"]) if i % 2 == 0 else rnd.choice(words) for i in range(90)] for _ in range(5)]
    rows = []
    for i in range(160):
        text = list(base[i % 5])
        for _ in range(rnd.randint(0, 6)):
            text[rnd.randrange(len(text))] = rnd.choice(words)
        if i % 11 == 0:
            text = text[:rnd.randint(1, 90)]
        rows.append((i, " ".join(text)))
    rows += [(1000, rows[0][1]), (1001, None), (1002, ""), (None, rows[0][1])]
    sigs = [brute(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            union = len(sigs[i] | sigs[j])
            like = len(sigs[i] & sigs[j]) / union if union else 1.0
            if like >= 0.8 and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    first = {}
    for (d, _), x in zip(rows, label):
        if d is not None:
            first[x] = min(first.get(x, d), d)
    want = sorted([(d, first[x]) for (d, _), x in zip(rows, label)], key=str)
    got = sorted([tuple(r) for r in spotsigs.near_classes(docs(spark, rows)).collect()], key=str)
    assert got == want
    assert 5 < len({c for _, c in want}) < 120
    assert spotsigs.near_classes(docs(spark, [])).count() == 0
