import math

import numpy as np

from beatstream.llm import language
from tests.llm.helpers import CLASH, docs

WORDS = {"en": "the and that with this from have".split(), "de": "der und nicht auch eine werden".split()}
PAGE = "page_id long, url string, html string, " + ", ".join(f"`{c}` string" for c in [*CLASH, "host", "domain", "declared"])


def training(spark):
    rows = []
    for k, (lang, ws) in enumerate(sorted(WORDS.items())):
        rows += [(100 * k + i, " ".join(ws[(i + j) % len(ws)] for j in range(12)), lang) for i in range(30)]
    d = docs(spark, [(i, t) for i, t, _ in rows]).drop("lang")
    return d.join(spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id long, lang string"), "doc_id")


def pages(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * (len(CLASH) + 3)) for r in rows], PAGE)


def html(lang, words, n=12):
    return f'<html lang="{lang}"><script>der und</script><body><p>{" ".join(words[j % len(words)] for j in range(n))}</p></body></html>'


ROWS = ([(i, f"http://www.a.com/{i}", html("en", WORDS["en"])) for i in range(20)]
        + [(100 + i, f"http://b.de/{i}", html("de", WORDS["de"])) for i in range(20)]
        + [(200, "http://b.de/x", html("en", WORDS["de"])),        # a wrong declaration
           (201, "http://b.de/y", ""), (202, "http://www.a.com/z", None), (203, None, None),
           (204, "http://b.de/q", "<html lang='de-AT'></html>"), (1, "http://www.a.com/1", html("en", WORDS["en"])), (None, "x", "")])


def test_evidence_is_fused(spark):
    got = {r.page_id: r for r in language.identify(pages(spark, ROWS), training(spark)).collect()}
    assert all(got[i].lang == "en" for i in range(20)) and all(got[100 + i].lang == "de" for i in range(20))
    assert got[200].lang == "de" and got[200].declared == "en"
    assert got[201].lang == "de" and got[202].lang == "en"  # by host and suffix alone
    assert got[204].lang == "de" and got[204].declared == "de"
    assert 0 < got[203].score <= 1 and got[203].host == ""
    assert language.identify(pages(spark, ROWS), training(spark)).count() == len(ROWS)


def test_equals_direct_computation(spark):
    train = training(spark)
    languages, logp = language.fit_text_model(train)
    assert languages == ["de", "en"]
    ll, key = [], []
    for _, url, page in ROWS:
        at = language.trigrams(language.visible_text(page))
        v = logp[:, at].mean(1) * min(len(at), 60) if len(at) else np.zeros(2)
        ll.append(v - v.max())
        host = url.split("://")[1].split("/")[0] if url and "://" in url else ""
        declared = "de" if page and "de-AT" in page else page[12:14] if page and page.startswith('<html lang="') else ""
        key.append({"host": host, "domain": ".".join(host.split(".")[-2:]), "suffix": host.split(".")[-1], "declared": declared})
    ll = np.array(ll)
    r = np.exp(ll) / np.exp(ll).sum(1, keepdims=True)
    total, n, weight = r.sum(0), len(ROWS), 5.0
    got = {}
    for x in language.identify(pages(spark, ROWS), train).collect():
        got.setdefault(x.page_id, x)
    for i, (page_id, _, _) in enumerate(ROWS):
        sums = {f: sum(r[j] for j in range(n) if key[j][f] == key[i][f]) for f in key[i]}
        s = ll[i].copy()
        for f in ("declared", "suffix"):
            s += np.log((np.maximum(sums[f] - r[i], 0) + 0.5 * sums[f].sum() / n + 1e-6) / (total + 0.5 + 1e-6))
        prior = (total + 1) / (n + 2)
        for f in ("domain", "host"):
            prior = (np.maximum(sums[f] - r[i], 0) + weight * prior) / (max(sums[f].sum() - 1, 0) + weight)
        s += np.log(prior)
        assert got[page_id].lang == languages[int(np.argmax(s))]
        assert math.isclose(got[page_id].score, np.exp(s.max()) / np.exp(s).sum(), rel_tol=1e-6)


def test_empty_tables(spark):
    assert language.identify(pages(spark, []), training(spark)).count() == 0
    none = language.identify(pages(spark, ROWS[:2]), training(spark).limit(0))
    assert none.count() == 0 and none.columns == ["page_id", "lang", "score", "text_lang", "declared", "host"]
