import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from beatstream.llm import tokens
from beatstream.session import shared_path
from tests.llm.helpers import ODD, docs

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_ids(text):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=70))
@settings(max_examples=200, deadline=None)
def test_pack_round_trip(values):
    v = np.array(values, np.uint32)
    control, data = tokens.pack(v)
    assert len(control) == -(-len(values) // 4)
    assert tokens.unpack(control, data, len(values)).tolist() == values


@given(st.lists(st.text(alphabet="aB'é.,)|&3 \n5sTİÉßñ-(́<>x ᄀ", max_size=50), max_size=6))
@settings(max_examples=150, deadline=None)
def test_pieces_give_the_tokenizers_ids(texts):
    got = tokens.Encoder.of(PATH, "<u2").texts(texts)
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == [plain_ids(t) for t in texts]


def test_generations_forget_without_harm(monkeypatch):
    monkeypatch.setattr(tokens.Encoder, "limit", 3)
    enc = tokens.Encoder(PATH, "<u2")
    for text in ["a bb ccc dd", "ee ff, gg. <|endoftext|> a", "a bb <|startoftext|>x", "ccc dd ee it's"] * 2:
        assert np.frombuffer(enc.texts([text])[0], "<u2").tolist() == plain_ids(text)


def read(spark, rows, **kw):
    path = shared_path(spark, "t-tokens")
    tokens.write_tokens(docs(spark, rows), path, PATH, end_id=2, **kw)
    return path, [(r.doc_id, r.start, r.n_tokens, r.ids) for r in tokens.read_tokens(spark, path).collect()]


def test_files_hold_all_ids_in_order(spark):
    _, got = read(spark, ODD, block_tokens=50)
    got.sort(key=lambda r: r[1])
    assert [r[0] for r in got] == [None, 1, 1, 2, 3, 4, 5, 6, 7]  # null id first, repeated rows both there
    at = 0
    text_of = dict(ODD)
    for doc_id, start, n, ids in got:
        want = plain_ids(text_of[doc_id]) + [2]
        assert (start, n) == (at, len(want))
        assert zlib.crc32(ids) == zlib.crc32(np.array(want, "<u4").tobytes())
        at += n


def test_ranks_follow_frequency(spark):
    path, _ = read(spark, [(1, "the the the cat"), (2, "the cat sat")])
    ranks = spark.read.parquet(f"{path}/ranks").orderBy("rank").limit(5).collect()
    assert [r.n for r in ranks] == [4, 2, 2, 1, 0]
    assert [ranks[1].id, ranks[2].id] == sorted([ranks[1].id, ranks[2].id])  # ties by id


def test_empty_table(spark):
    assert read(spark, [])[1] == []


def test_other_order(spark):
    path = shared_path(spark, "t-tokens")
    rows = docs(spark, [(1, "a"), (2, "b"), (3, "c")]).selectExpr("*", "-doc_id AS down")
    tokens.write_tokens(rows, path, PATH, order_by=["down"])
    assert [r.doc_id for r in tokens.read_tokens(spark, path).orderBy("start").collect()] == [3, 2, 1]
