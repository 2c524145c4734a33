import random

import numpy as np

from beatstream.llm import quality
from beatstream.llm.common import held_out, labelled_sample
from tests.llm.helpers import ODD, docs


def corpus(n):
    rnd = random.Random(5)
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        words = ["".join(rnd.choice("abcdehilnorstu") for _ in range(rnd.randint(2, 8))) for _ in range(rnd.randint(20, 90))]
        text = " ".join(f"{w.upper()}!!" for w in words) if bad else " ".join(words).capitalize() + "."
        rows.append((i, text))
        labels.append((i, int(not bad), 0))
    return rows, labels


def test_separates_held_out_rows(spark):
    rows, labels = corpus(400)
    d, lab = docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = quality.score_quality(d, quality.fit_quality(d, lab)).collect()
    want = {i: q for i, q, _ in labels}
    held = [r for r in out if r.held_out]
    assert len(out) == 400 and len(held) > 40
    assert np.mean([r.predicted == want[r.doc_id] for r in held]) > 0.95
    assert all(r.predicted == int(r.score >= 0.3) for r in out)


def test_log_odds_equal_the_direct_density(spark):
    rows, labels = corpus(200)
    d, lab = docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    m = quality.fit_quality(d, lab, temper=1.0)
    train = {r.doc_id for r in d.where(~held_out()).select("doc_id").collect()}
    x = {c: np.array([quality.statistics(t) for i, t in rows if i in train and labels[i][1] == c]) for c in (0, 1)}
    cov = {c: np.cov(x[c].T, bias=True) for c in x}
    pooled = sum(len(x[c]) * cov[c] for c in x) / sum(map(len, x.values()))
    probe = np.array(quality.statistics(rows[3][1]))
    dens = {}
    for c in x:
        s = 0.9 * cov[c] + 0.1 * pooled
        s = 0.95 * s + 0.05 * np.diag(np.diag(s)) + 1e-3 * np.eye(quality.SIZE)
        diff = probe - x[c].mean(0)
        dens[c] = -0.5 * diff @ np.linalg.solve(s, diff) - 0.5 * np.linalg.slogdet(s)[1]
    want = dens[1] - dens[0] + np.log((len(x[1]) + 1) / (len(x[0]) + 1))
    assert np.isclose(m.log_odds(probe[None])[0], want, rtol=1e-6)


def test_the_bound_of_the_sample_leaves_the_class_ratio(spark):
    rows, labels = corpus(400)
    d, lab = docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    whole = quality.fit_quality(d, lab)
    m = quality.fit_quality(d, lab, max_rows_per_class=20, to_pooled=1.0, to_diagonal=0.0)
    assert whole.log_prior > 0.8 and m.log_prior == whole.log_prior
    train = {r.doc_id for r in d.where(~held_out()).select("doc_id").collect()}
    size = [sum(i in train and q == c for i, q, _ in labels) for c in (0, 1)]
    assert min(size) > 40
    drawn = {r.doc_id for r in labelled_sample(lab, "quality", 20).collect()}
    cov = [np.cov(np.array([quality.statistics(t) for i, t in rows if i in drawn and labels[i][1] == c]).T, bias=True)
           for c in (0, 1)]
    pooled = (size[0] * cov[0] + size[1] * cov[1]) / sum(size) + 1e-3 * np.eye(quality.SIZE)
    assert np.allclose(m.inverse[0] @ pooled @ m.inverse[0].T, np.eye(quality.SIZE), atol=1e-6)


def test_odd_rows_and_missing_labels(spark):
    d = docs(spark, ODD)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = quality.score_quality(d, quality.fit_quality(d, none)).collect()
    assert len(out) == len(ODD) and {r.score for r in out} == {0.5}
    one = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in quality.score_quality(d, quality.fit_quality(d, one)).collect()} == {1}
    rows, labels = corpus(100)
    m = quality.fit_quality(docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    scores = {(r.doc_id, r.score) for r in quality.score_quality(d, m).collect()}
    assert all(0 <= s <= 1 for _, s in scores)
    assert {s for i, s in scores if i == 2} == {s for i, s in scores if i == 3}  # null text like empty text
    assert quality.keep_quality(d, m, 0.0).columns == d.columns and quality.keep_quality(d, m, 0.0).count() == len(ODD)


def test_empty_tables(spark):
    d = docs(spark, [])
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    m = quality.fit_quality(d, labels)
    assert quality.score_quality(d, m).count() == 0 and quality.keep_quality(d, m).count() == 0
