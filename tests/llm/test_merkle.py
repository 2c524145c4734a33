import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from beatstream.llm import merkle
from beatstream.llm.catalog import op12_merkle_manifest
from beatstream.llm.common import table
from beatstream.llm.oracle import ORACLE
from tests.llm.helpers import DOC, ODD, docs

SF = "/root/testdata/sf0.001"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(r, text):
    values = (r.doc_id, r.source, r.lang, r.n_chars, text)
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels(nodes, fanout):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + fanout]) for i in range(0, len(out[-1]), fanout)])
    return out


def path_of(tree, i, fanout):
    for nodes in tree[:-1]:
        a = i - i % fanout
        yield nodes[a:i], nodes[i + 1:a + fanout]
        i //= fanout


def changed_text(r):
    even = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0
    return r.text.replace("\n", "") if even and r.text is not None else r.text


def brute(rows, fanout=3):
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        by[s].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text)))
    trees = [levels([leaf_of(r, r.text) for r in by[s]], fanout) for s in names]
    top = levels([t[-1][0] for t in trees], fanout)
    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(by[s]):
            steps = [*path_of(trees[k], i, fanout), *path_of(top, k, fanout)]
            folded = leaf_of(r, changed_text(r))
            for a, b in steps:
                folded = h(*a, folded, *b)
            out.append((r.doc_id, trees[k][0][i], trees[k][-1][0], top[-1][0], h(*[x for a, b in steps for x in (*a, *b)]),
                        folded, folded == top[-1][0]))
    return sorted(out, key=str)


def got(df, **kw):
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    changed = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return sorted((tuple(r) for r in merkle.manifest(df, changed, **kw).drop("proof").collect()), key=str)


def test_query_equals_brute_force(spark):
    rows = table(spark, SF, "documents").collect()
    out = sorted((tuple(r) for r in op12_merkle_manifest(spark, SF).collect()), key=str)
    assert out == brute(rows) and {r[-1] for r in out} == {True, False}


@pytest.mark.parametrize("hop,fanout", [(1, 3), (2, 3), (6, 3), (2, 2)])
def test_sources_of_every_size(spark, hop, fanout):
    rnd = random.Random(hop)
    rows = []
    for s, n in ((None, 4), ("", 1), ("é", 9), ("a", 10), ("b", 27), ("c", 28), ("d", 2)):
        rows += [(rnd.randint(0, 10**6), rnd.choice(["x\ny", "", None, "日本\n"]), s) for _ in range(n)]
    rnd.shuffle(rows)
    df = docs(spark, rows)
    assert got(df, hop=hop, fanout=fanout) == brute(df.collect(), fanout)


def test_odd_rows_and_empty_table(spark):
    df = docs(spark, [*ODD, (None, "lost words here"), (None, "other")]).union(
        spark.createDataFrame([(8, None, None, None, None, *["x"] * (len(DOC.split(",")) - 5))], DOC))
    assert got(df) == brute(df.collect())
    assert got(docs(spark, [])) == []
    assert got(docs(spark, [(1, "a\nb")])) == brute(docs(spark, [(1, "a\nb")]).collect())


def test_proof_verifies_the_leaf(spark):
    df = docs(spark, [(i, f"text {i}", f"s{i % 4}") for i in range(30)])
    for r in merkle.manifest(df).collect():
        assert r.verified and r.folded_root == r.root
        assert hashlib.sha256(r.proof.hex().encode()).hexdigest() == r.proof_sha256 and len(r.proof) % 32 == 0


def test_a_table_is_one_recursive_query(spark):
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") != "-1"  # put back behind every call


def test_sql_gives_the_same(spark):
    import duckdb
    if "op12_merkle_manifest" not in ORACLE:
        pytest.skip("no SQL form")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    rows = con.execute(ORACLE["op12_merkle_manifest"]).fetchall()
    assert sorted(rows, key=str) == brute(table(spark, SF, "documents").collect())
