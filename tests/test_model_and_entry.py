import os
import random

import duckdb

import __spark_entry__ as entry
from beatstream.operators import model as M
from beatstream.sources import files as FS
from conftest import SF_SMALL

FEATURES = ["morn", "aft", "eve", "night", "mobile", "unique"]


def separable(spark, n=400, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        label = i % 2
        base = [rnd.random() * 0.5 for _ in FEATURES]
        base[4] = 0.9 if label else -0.9
        rows.append((i, float(label), *base))
    return spark.createDataFrame(rows, "customer_id long, label double, " +
                                 ", ".join(f"{f} double" for f in FEATURES))


def test_split_is_reproducible(spark):
    df = separable(spark)
    a1, b1 = M.split(df)
    a2, b2 = M.split(df)
    assert a1.exceptAll(a2).count() == 0 and a1.count() + b1.count() == df.count()
    assert 0.6 < a1.count() / df.count() < 0.8


def test_train_score_and_gate(spark):
    preds, report = M.train_and_score(separable(spark))
    assert report.error <= M.ACCEPT_ERROR and report.accepted
    assert preds.count() == 400 and set(r.pred for r in preds.select("pred").distinct().collect()) == {0, 1}
    assert not M.accept_model(0.2)


def test_compare_models(spark):
    data = M.assemble(separable(spark))
    reps = M.compare_models(data)
    train, test = M.split(data)
    assert all((r.train_rows, r.test_rows) == (train.count(), test.count()) for r in reps)
    assert [r.setting for r in reps] == ["lbfgs", "l2"] and all(0 <= r.error <= 0.5 for r in reps)


def test_rejected_model_is_not_published(spark, tmp_dir):
    from beatstream.streaming.sinks import read_keyed_table, set_value
    path = os.path.join(tmp_dir, "pred")
    old = spark.createDataFrame([(i, 7, 1) for i in range(400)], "customer_id long, pred int, _seq int")
    set_value(old, path, "customer_id", "pred", "_seq")
    report = M.publish_if_accepted(separable(spark), path, seq=2, threshold=-1.0)
    assert report.error >= 0 and {r.pred for r in read_keyed_table(spark, path).collect()} == {7}
    M.publish_if_accepted(separable(spark), path, seq=3, threshold=0.5)
    assert {r.pred for r in read_keyed_table(spark, path).collect()} == {0, 1}


def test_ad_audience_below_gold(spark):
    cust = spark.createDataFrame([(1, "0"), (2, "2"), (3, "1")], "customer_id long, Level string")
    preds = spark.createDataFrame([(1, 1), (2, 1), (3, 0)], "customer_id long, pred int")
    assert [r.customer_id for r in M.ad_audience(cust, preds).collect()] == [1]


def test_libsvm_round_trip(spark, tmp_dir):
    feats = separable(spark, 20)
    path = os.path.join(tmp_dir, "f")
    FS.write_libsvm(feats, path)
    back = FS.read_libsvm(spark, path, 6)
    assert back.count() == 20 and back.first().features.size == 6


def test_kafka_options_split_topics():
    o = FS.kafka_options("h:9092", "realtime, other ,")
    assert o["subscribe"] == "realtime,other" and o["startingOffsets"] == "latest"


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert [f.name for f in df.schema.fields] == ["bucket_start", "mobile_connections", "unique_customers"]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 70


def test_fast_oracles_at_smallest_scale(spark):
    """A sample of batch queries against DuckDB at sf0.001 (the full run is scripts/check_oracle.py)."""
    con = duckdb.connect()
    for t in ["nation", "customer", "part", "orders", "lineitem", "events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    names = ["mobile_trend", "top_regions_and_users", "level_by_age", "build_features",
             "repeat_listens_coarse", "trending_tags", "daily_spend", "quarantine_lines"]
    for n in names:
        got = entry.queries()[n](spark, SF_SMALL)
        exp = con.execute(entry.oracle_sql()[n]).fetchall()
        cols = [c[0] for c in con.description]
        got_rows = sorted(tuple(str(r[c]) for c in cols) for r in got.collect())
        exp_rows = sorted(tuple(str(v) for v in row) for row in exp)
        assert got_rows == exp_rows, n


def test_command_line_list_and_run(spark, capsys):
    from beatstream.__main__ import main
    assert main(["list"]) == 0
    listed = capsys.readouterr().out.split()
    from beatstream.plans.catalog import QUERIES
    assert "mobile_trend" in listed and set(listed) == set(QUERIES) <= set(entry.queries())
    assert main(["run", "terms_zip", "--sf", SF_SMALL, "--show", "3"]) == 0
    assert "listening_zip_code" in capsys.readouterr().out
    assert main(["run", "no_such_query", "--sf", SF_SMALL]) == 2
