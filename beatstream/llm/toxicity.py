"""Toxicity by weak supervision.

Voters of four kinds: fixed lexicons of insults in several languages, by kind of insult; words
and word beginnings found by their share of toxic rows among the labelled training rows, once
and twice in a text (``beginning*`` and ``beginning*+``); patterns over hits (several, dense,
disguised by look-alike characters or separators, addressed to the reader, shouted); and
the absence of any hit.  A generative label model (expectation-maximisation over the votes,
without labels) estimates each voter's accuracy and the correlations between voters, so that
voters which say the same thing don't count twice; voters that never vote, or that it finds
wrong more often than right, are dropped and the model is fitted again.  Its posteriors are the
labels of a regularised logistic regression over the terms of a text, which scores every
document.

Null and empty texts have no terms and get the score of a text without hits.  Texts of any
length are read whole.  Repeated rows are scored once each.  Columns other than ``doc_id`` and
``text`` are ignored.  With no labelled row, or none of one class, only the fixed lexicon
votes.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatstream.llm.common import held_out, training_sizes, training_texts

# fixed values: common insults in English, Spanish, French and German, by kind of insult
LEXICON = {
    "stupidity": ["idiot", "idiots", "moron", "morons", "stupid", "imbecile", "dumb", "fool", "idiota", "imbécil", "estúpido",
                  "tonto", "idiote", "imbécile", "débile", "crétin", "dummkopf", "blödmann", "trottel"],
    "contempt": ["pathetic", "worthless", "loser", "losers", "clown", "useless", "patético", "inútil", "payaso", "minable",
                 "pitoyable", "versager", "erbärmlich", "wertlos"],
    "disgust": ["disgusting", "trash", "garbage", "filth", "filthy", "scum", "vermin", "asqueroso", "basura", "escoria",
                "ordure", "dégoûtant", "raclure", "abschaum", "dreckig", "ekelhaft"],
    "hostility": ["hate", "kill", "bastard", "bitch", "damn", "hell", "jerk", "cabrón", "bastardo", "salaud", "connard",
                  "arschloch", "mistkerl"],
}
INSULTS = frozenset(w for ws in LEXICON.values() for w in ws)
# fixed values: words that address the reader, and characters that stand in for letters
ADDRESS = frozenset(["you", "your", "youre", "u", "ur", "tú", "eres", "usted", "vous", "tu", "du", "bist", "ihr"])
LOOK_ALIKE = str.maketrans("@4831!0$57", "aabeiiosst")
WORD = re.compile(r"[^\W\d_]+")
# what a disguised insult must hold somewhere: cheap to look for
INSIDE = re.compile(r"[@4831!0$57][^\W\d_]")
BETWEEN = re.compile(r"[.*_-][^\W\d_][.*_-]")
SPACED = re.compile(r"(?<![^\W_])(?:[^\W\d_][.*_-]){2,}[^\W\d_](?![^\W_])")
BEGINNINGS = range(3, 8)
PATTERNS = ["two_terms", "three_hits", "hit_every_hundred_words", "disguised", "addressed", "shouted"]


def word_terms(word: str) -> list[str]:
    """The terms of a lower-case word: itself and its beginnings (marked by a star)."""
    return [word, *(word[:n] + "*" for n in BEGINNINGS if n <= len(word))]


def disguised(text: str) -> bool:
    """True if a lower-case text holds an insult written with look-alike characters or separated letters."""
    if BETWEEN.search(text) and any(re.sub(r"[.*_-]", "", m) in INSULTS for m in SPACED.findall(text)):
        return True
    if not INSIDE.search(text):
        return False
    plain = Counter(WORD.findall(text))
    return any(n > plain[w] for w, n in Counter(WORD.findall(text.translate(LOOK_ALIKE))).items() if w in INSULTS)


@dataclass
class Terms:
    """Term -> number, and what a text says in those terms."""

    number: dict[str, int]
    known: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.base = {t.rstrip("+") for t in self.number}
        self.starts = {t.rstrip("*")[:3] for t in self.base}  # most words start like no term

    def of(self, words: list[str]) -> tuple[set[int], int]:
        """(terms of the words, how many words have one)."""
        counts: Counter = Counter()
        hits = 0
        if len(self.known) > 100_000:
            self.known.clear()
        for w, n in Counter(words).items():
            if w[:3] not in self.starts:
                continue
            t = self.known.get(w)
            if t is None:
                t = self.known[w] = tuple(x for x in word_terms(w) if x in self.base)
            for x in t:
                counts[x] += n
            if t:
                hits += n
        found = {self.number[x] for x in counts if x in self.number}
        found.update(self.number[x + "+"] for x, n in counts.items() if n >= 2 and x + "+" in self.number)
        return found, hits

    def features(self, text: str | None) -> list[int]:
        """Numbers of the terms, then those of the patterns that hold."""
        raw = text or ""
        lower = raw.lower()
        words = WORD.findall(lower)
        found, hits = self.of(words)
        m = len(self.number)
        addressed = shouted = False
        if not INSULTS.isdisjoint(words):
            at = [i for i, w in enumerate(words) if w in INSULTS]
            addressed = any(not ADDRESS.isdisjoint(words[max(i - 4, 0):i]) for i in at)
            cased = WORD.findall(raw)
            shouted = len(cased) == len(words) and any(cased[i].isupper() for i in at)
        holds = [len(found) >= 2, hits >= 3, hits * 100 >= len(words) > 0, disguised(lower), addressed, shouted]
        return sorted(found) + [m + i for i, h in enumerate(holds) if h]


def _count_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents of each class that hold a term, or hold it twice: one row for a term and part of a batch."""
    for b in batches:
        for k in range(0, len(b), 250):  # few at a time: a batch has millions of terms
            part = b.iloc[k:k + 250]
            count: tuple[Counter, Counter] = (Counter(), Counter())
            for text, label in zip(part["text"], part["label"], strict=True):
                once: set[str] = set()
                twice: set[str] = set()
                for w, n in Counter(WORD.findall(text.lower())).items():
                    own = word_terms(w)
                    twice.update(own if n > 1 else once.intersection(own))
                    once.update(own)
                count[label].update(once)
                count[label].update([t + "+" for t in twice])
            terms = list(count[0].keys() | count[1].keys())
            yield pd.DataFrame({"term": terms, "toxic": [count[1][t] for t in terms],
                                "clean": [count[0][t] for t in terms]})


def mine_terms(train: DataFrame, sizes: tuple[int, int], max_terms: int, min_ratio: float = 30.0,
               weight: tuple[float, float] = (1.0, 1.0)) -> list[tuple[str, float]]:
    """At most ``max_terms`` (term, share of toxic rows among its rows), most frequent first.

    A term counts if more of its rows are toxic than not and the likelihood ratio against the
    base rate is beyond what the best of millions of unrelated terms would reach by chance.
    ``weight`` is how many rows one of ``train`` stands for in each class.  The share is that of
    the rows stood for; chance is judged by the rows seen.
    """
    base = sizes[1] / sum(sizes)
    toxic, clean = F.col("toxic") + 0.1, F.col("clean") + 0.1
    share = toxic * weight[1] / (toxic * weight[1] + clean * weight[0])
    seen = toxic / (toxic + clean)
    ratio = 2 * (F.col("toxic") * F.log(seen / base) + F.col("clean") * F.log((1 - seen) / (1 - base)))
    rows = (train.mapInPandas(_count_terms, "term string, toxic long, clean long")
            .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
            .withColumn("share", share)
            .where((F.col("share") > 0.6) & (ratio > min_ratio))
            .orderBy(F.desc("toxic"), F.length("term"), "term").limit(8 * max_terms).collect())
    chosen: dict[str, tuple[int, float]] = {}
    for r in rows:
        stem, twice = r.term.rstrip("*+"), r.term.endswith("+")
        # a term that a chosen beginning already covers, or almost, says nothing new
        wider = [stem[:n] + "*" for n in BEGINNINGS] + [r.term[:-1]]
        if any(x in chosen and r.share <= chosen[x][1] + 0.02 for x in (wider + [w + "+" for w in wider] if twice else wider)):
            continue
        chosen[r.term] = (r.toxic, r.share)
        if len(chosen) == max_terms:
            break
    return [(t, s) for t, (_, s) in chosen.items()]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class LabelModel:
    """Posterior of the hidden label from correlated votes (1 toxic, -1 clean, 0 none)."""

    weights: np.ndarray
    bias: float
    accuracy: np.ndarray
    correlation: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return _sigmoid(votes @ self.weights + self.bias)


def fit_label_model(votes: np.ndarray, prior: float, rounds: int = 20, ridge: float = 0.02,
                    weight: np.ndarray | None = None) -> LabelModel:
    """Expectation-maximisation without labels.

    Given the label, votes have class means and a common covariance, whose off-diagonal
    part holds the correlations; the posterior's log odds are linear in the votes.  The
    share of toxic rows is held at ``prior``.  A row counts ``weight`` times (once without).
    """
    v = votes.astype(np.float64)
    n, m = v.shape
    c = np.ones(n) if weight is None else weight * (n / weight.sum())
    p = _sigmoid(2 * v.sum(1))
    weights, bias = np.ones(m), 0.0
    cov = np.eye(m)
    square = (v * c[:, None]).T @ v  # both classes' second moments together never change
    for _ in range(rounds):
        p1, p0 = c * p, c * (1 - p)
        mean1, mean0 = p1 @ v / (p1.sum() + 1e-9), p0 @ v / (p0.sum() + 1e-9)
        cov = (square - p1.sum() * np.outer(mean1, mean1) - p0.sum() * np.outer(mean0, mean0)) / n
        weights = np.linalg.solve(cov + ridge * np.eye(m), mean1 - mean0)
        raw = v @ weights
        low, high = -60.0 - raw.max(initial=0), 60.0 - raw.min(initial=0)
        for _ in range(60):  # the bias that keeps the prior
            bias = (low + high) / 2
            low, high = (bias, high) if c @ _sigmoid(raw + bias) / n < prior else (low, bias)
        p = _sigmoid(raw + bias)
    right = ((c * p) @ (v > 0) + (c * (1 - p)) @ (v < 0)) / np.maximum(c @ np.abs(v), 1e-9)
    scale = np.sqrt(np.maximum(np.diag(cov), 1e-9))
    return LabelModel(weights, bias, right, cov / scale[:, None] / scale[None])


def fit_logistic(x: np.ndarray, p: np.ndarray, l2: float = 1.0, rounds: int = 25,
                 weight: np.ndarray | None = None) -> np.ndarray:
    """Weights (the last one the intercept) of a logistic regression on soft labels.

    A row counts ``weight`` times (once without).
    """
    c = np.ones(len(x)) if weight is None else weight
    z = np.concatenate([x, np.ones((len(x), 1))], 1)
    w = np.zeros(z.shape[1])
    penalty = np.full(z.shape[1], l2)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        s = _sigmoid(z @ w)
        h = (z * (c * s * (1 - s))[:, None]).T @ z + np.diag(penalty) + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(h, z.T @ (c * (s - p)) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class ToxicityModel:
    number: dict[str, int]
    weights: np.ndarray
    label_model: LabelModel | None

    def score(self, texts: pd.Series, terms: Terms) -> np.ndarray:
        return _sigmoid(np.array([self.weights[terms.features(t)].sum() + self.weights[-1] for t in texts]))


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows_per_class: int = 20_000,
                 max_terms: int = 400) -> ToxicityModel:
    """Fit on at most ``max_rows_per_class`` labelled rows of each class (documented bound).

    Each row of the sample stands for as many as its class has for one drawn, so that base
    rate, shares of terms and intercept are those of all labelled rows, whatever the bound.
    The driver gets counts of at most ``8 * max_terms`` terms and the term numbers of the
    sample's rows.  Terms that pass the test of chance beyond ``max_terms`` (the documented
    bound of the model, the most frequent first) have no say.
    """
    lexicon = {w: kind for kind, ws in LEXICON.items() for w in ws}
    train = training_texts(docs, labels, label, max_rows_per_class).select("text", "label")
    count = {r.label: r.n for r in train.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = (count.get(0, 0), count.get(1, 0))
    full = training_sizes(docs, labels, label)
    weight = (full[0] / max(sizes[0], 1), full[1] / max(sizes[1], 1))
    mined = mine_terms(train, sizes, max_terms, weight=weight) if min(sizes) else []
    number = {t: i for i, t in enumerate([t for t, _ in mined] + [w for w in lexicon if w not in dict(mined)])}
    m = len(number)
    fallback = np.array([2.0] * m + [0.0] * len(PATTERNS) + [-2.0])
    if not min(sizes):
        return ToxicityModel(number, fallback, None)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms = Terms(number)
        for b in batches:
            yield pd.DataFrame({"found": [terms.features(t) for t in b["text"]], "label": b["label"].to_numpy()})

    # rows that say the same are one: most clean rows hold no term at all
    said: dict[tuple[int, ...], float] = {}
    for r in train.mapInPandas(features, "found array<int>, label int").groupBy("found", "label").count().collect():
        key = tuple(r.found)
        said[key] = said.get(key, 0.0) + weight[r.label] * r["count"]
    x = np.zeros((len(said), m + len(PATTERNS)), np.float32)
    for i, found in enumerate(said):
        x[i, list(found)] = 1
    counts = np.array(list(said.values()))
    # voters: all mined terms, kinds of the lexicon, patterns, and the absence of hits
    kinds = [[number[w] for w in ws] for ws in LEXICON.values()]
    any_mined = x[:, :len(mined)].any(1)
    any_lexicon = x[:, [number[w] for w in lexicon]].any(1)
    votes = np.stack([*(x[:, i] for i in range(len(mined))), *(x[:, k].max(1) for k in kinds),
                      *(x[:, m + i] for i in range(len(PATTERNS))),
                      any_mined.astype(np.float32),
                      np.where(any_mined, 0, -1), np.where(any_lexicon, 0, -1),
                      np.where(any_mined | any_lexicon, 0, -1)], 1).astype(np.float32)
    prior = full[1] / sum(full)
    # voters without a vote, or wrong more often than right, have no say
    votes = votes[:, np.abs(votes).any(0)]
    votes = votes[:, fit_label_model(votes, prior, weight=counts).accuracy >= 0.5]
    model = fit_label_model(votes, prior, weight=counts)
    return ToxicityModel(number, fit_logistic(x, model.posterior(votes), weight=counts), model)


def toxicity_score(text: Column, model: ToxicityModel) -> Column:
    """Score column in 0..1; the model (a few hundred terms) travels with the function."""

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        terms = Terms(model.number)
        for s in texts:
            yield pd.Series(model.score(s, terms), dtype="float64")

    return score(text)


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    return (docs.select("doc_id", held_out().alias("held_out"), toxicity_score(F.col("text"), model).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
