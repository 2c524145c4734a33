import zlib

import numpy as np
import pytest

import corpus_pipeline
from beatstream.llm import decontaminate, mixing, quality, simhash
from beatstream.llm.common import table
from tests.llm.helpers import docs

SF = "/root/testdata/sf0.001"
public_tokenizers = pytest.importorskip("public_tokenizers")


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "SimHash near-dedup", "benchmark decontamination", "mixing sources to target weights",
        "token-ID / binary output"]


def test_run_equals_brute_force(spark):
    """The operators' own tests compare them with brute force; here their decisions are put together on the driver."""
    from tokenizers import Tokenizer
    d, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = {r.doc_id: r for r in d.collect()}
    model = quality.fit_quality(d, labels)
    kept = {i for i, r in rows.items() if 1 / (1 + np.exp(-model.log_odds(np.array([quality.statistics(r.text)]))[0])) >= 0.3}
    fps = {i: simhash.text_fingerprint(rows[i].text) for i in kept}
    label = {i: i for i in kept}
    for a in sorted(kept):
        for b in sorted(kept):
            if b < a and (fps[a] ^ fps[b]).bit_count() <= 4 and label[a] != label[b]:
                x, y = label[a], label[b]
                label = {i: min(x, y) if v in (x, y) else v for i, v in label.items()}
    kept = {i for i in kept if label[i] == i}
    index = decontaminate.Index([(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()])
    kept = {i for i in kept if not index.find(rows[i].text)}
    assert 0 < len(kept) < len(rows)
    left = d.where(d.doc_id.isin(sorted(kept)))
    order = [r.doc_id for r in mixing.mixed(left, block_chars=100_000, power=0.5).collect()]
    assert sorted(order) == sorted(kept)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, at = [], 0
    for i in order:
        ids = tokenizer.encode(rows[i].text, add_special_tokens=False).ids + [2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = corpus_pipeline.run(spark, SF).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got] == want


def test_stages_keep_columns_and_take_odd_tables(spark):
    rows = [(1, None), (2, ""), (None, "x"), (3, "some words of text"), (3, "some words of text")]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for d in (docs(spark, rows), docs(spark, [])):
            out = stage(spark, d, SF)
            assert out.columns == d.columns, name
            assert out.count() <= d.count()
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, docs(spark, rows), SF).count() == 5 and last(spark, docs(spark, []), SF).count() == 0
