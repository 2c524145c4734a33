import random

import numpy as np

from beatstream.llm import toxicity
from tests.llm.helpers import ODD, docs

LABEL = "doc_id long, quality int, toxic int"


def corpus(n, seed=3):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abdeilnorstu") for _ in range(rnd.randint(3, 9))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        text = [rnd.choice(words) for _ in range(rnd.randint(10, 60))]
        for _ in range(rnd.randint(1, 3) if toxic else 0):
            text.insert(rnd.randrange(len(text)), rnd.choice(["idiot", "Scum", "zqxv" + rnd.choice(words), "zqxv" + rnd.choice(words)]))
        rows.append((i, " ".join(text) + "."))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_learns_from_voters(spark):
    rows, labels = corpus(900)
    d, lab = docs(spark, rows), spark.createDataFrame(labels, LABEL)
    model = toxicity.fit_toxicity(d, lab)
    assert any(t.startswith("zqx") for t in model.number)  # a word beginning found by itself
    out = toxicity.score_toxicity(d, model).collect()
    want = {i: t for i, _, t in labels}
    held = [r for r in out if r.held_out]
    assert len(held) > 100
    assert np.mean([r.predicted == want[r.doc_id] for r in held]) > 0.97
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in out)


def test_label_model_recovers_accuracies_and_correlation():
    rng = np.random.default_rng(1)
    n, y = 6000, rng.random(6000) < 0.3
    right = np.array([0.9, 0.8, 0.7, 0.85])
    votes = np.where(rng.random((n, 4)) < right, y[:, None], ~y[:, None]) * 2.0 - 1
    votes = np.concatenate([votes, votes[:, [2]]], 1)  # a voter that copies the third
    model = toxicity.fit_label_model(votes, prior=0.3)
    assert np.allclose(model.accuracy[:4], right, atol=0.1)
    assert model.correlation[2, 4] > 0.95
    # the copied pair together says about as much as the voter alone
    alone = toxicity.fit_label_model(votes[:, :4], prior=0.3)
    assert abs(model.weights[2] + model.weights[4] - alone.weights[2]) < 0.3 * alone.weights[2] + 0.1
    assert np.mean((model.posterior(votes) > 0.5) == y) > 0.9


def test_logistic_on_soft_labels():
    x = np.array([[0.0], [0.0], [1.0], [1.0]])
    w = toxicity.fit_logistic(x, np.array([0.1, 0.1, 0.8, 0.8]), l2=1e-6)
    assert np.allclose(1 / (1 + np.exp(-(x @ w[:1] + w[1]))), [0.1, 0.1, 0.8, 0.8], atol=1e-3)


def test_the_bound_of_the_sample_leaves_terms_and_intercept(spark):
    rnd = random.Random(8)
    rows, labels = corpus(1500, seed=4)
    rows = [(i, t + (" mild" if rnd.random() < (0.9 if i % 5 == 0 else 0.25) else "")) for i, t in rows]
    d, lab = docs(spark, rows), spark.createDataFrame(labels, LABEL)
    whole, m = toxicity.fit_toxicity(d, lab), toxicity.fit_toxicity(d, lab, max_rows_per_class=180)
    for model in (whole, m):  # most rows with "mild" are clean, though it is commoner among toxic ones
        assert "zqx*" in model.number and not {"mild", "mil*"} & set(model.number)
    assert abs(m.weights[-1] - whole.weights[-1]) < 0.5
    scores = [{r.doc_id: r.score for r in toxicity.score_toxicity(d, model).collect()} for model in (whole, m)]
    clean = [i for i, _, toxic in labels if not toxic]
    assert abs(np.mean([scores[0][i] - scores[1][i] for i in clean])) < 0.01


def test_weighted_rows_count_like_repeated_ones():
    rng = np.random.default_rng(2)
    y = rng.random(400) < 0.4
    votes = np.where(rng.random((400, 3)) < 0.8, y[:, None], ~y[:, None]) * 2.0 - 1
    counts = np.where(y, 1, 4)
    one, many = (toxicity.fit_label_model(votes, 0.2, weight=counts.astype(float)),
                 toxicity.fit_label_model(votes.repeat(counts, 0), 0.2))
    assert np.allclose(one.weights, many.weights) and np.isclose(one.bias, many.bias)
    assert np.allclose(one.accuracy, many.accuracy)
    p = one.posterior(votes)
    assert np.allclose(toxicity.fit_logistic(votes > 0, p, weight=counts),
                       toxicity.fit_logistic((votes > 0).repeat(counts, 0), p.repeat(counts)))


def test_odd_rows_and_missing_labels(spark):
    d = docs(spark, [*ODD, (50, "You IDIOT, you moron"), (51, "a kind word")])
    for labels in ([], [(1, 1, 0), (None, 1, 1), (2, 1, None)]):
        model = toxicity.fit_toxicity(d, spark.createDataFrame(labels, LABEL))
        got = [(r.doc_id, r.score, r.predicted) for r in toxicity.score_toxicity(d, model).collect()]
        assert len(got) == len(ODD) + 2
        assert {p for i, _, p in got if i == 50} == {1} and {p for i, _, p in got if i != 50} == {0}
        assert {s for i, s, _ in got if i == 2} == {s for i, s, _ in got if i == 3}


def test_empty_table(spark):
    d = docs(spark, [])
    model = toxicity.fit_toxicity(d, spark.createDataFrame([(1, 1, 1)], LABEL))
    assert toxicity.score_toxicity(d, model).count() == 0


def test_held_out_recall_and_precision(spark):
    from beatstream.llm.common import table
    sf = "/root/testdata/sf0.1"
    d, lab = table(spark, sf, "documents"), table(spark, sf, "labels")
    rows = (toxicity.score_toxicity(d, toxicity.fit_toxicity(d, lab)).where("held_out").join(lab, "doc_id")
            .select("predicted", "toxic").collect())
    hits = sum(r.predicted and r.toxic for r in rows)
    assert hits >= 0.9 * sum(r.toxic for r in rows) and hits >= 0.95 * sum(r.predicted for r in rows)


def test_patterns():
    terms = toxicity.Terms({"idiot": 0, "zqa*": 1, "zqa*+": 2})
    hold = lambda text: {toxicity.PATTERNS[i - 3] for i in terms.features(text) if i >= 3}
    assert terms.features("zqab x " + "w " * 200) == [1] and terms.features("zqab zqac " + "w " * 300)[:2] == [1, 2]
    assert "disguised" in hold("an 1d1ot here " + "w " * 200) and "disguised" in hold("an i.d.i.o.t " + "w " * 200)
    assert "disguised" not in hold("an idiot of 1980 with $5 " + "w " * 200)
    assert "addressed" in hold("you are an idiot") and "addressed" not in hold("an idiot, they said to you")
    assert "shouted" in hold("what an IDIOT") and "shouted" not in hold("what an idiot, SAID he")
    assert hold(None) == hold("") == set()


def test_voters_without_a_vote_are_dropped(spark):
    rows, labels = corpus(400)
    model = toxicity.fit_toxicity(docs(spark, rows), spark.createDataFrame(labels, LABEL))
    assert (model.label_model.accuracy >= 0.45).all()
