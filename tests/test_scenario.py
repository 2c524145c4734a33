"""End to end on the small test tables: features -> model -> keyed predictions ->
real-time ad flags -> audience set, checked against the pieces computed in batch."""

import os

from pyspark.sql import functions as F

from beatstream.functions.parse import parse_plays
from beatstream.operators import model as M
from beatstream.operators import profile as PR
from beatstream.sources import files as FS
from beatstream.sources import testdata as T
from beatstream.streaming import flows as FL
from beatstream.streaming.sinks import read_keyed_table, read_set, set_value
from conftest import SF_SMALL


def test_listening_to_audience(spark, tmp_dir):
    feats = PR.build_features(T.plays(spark, SF_SMALL), T.clicks(spark, SF_SMALL))
    preds, report = M.train_and_score(feats)
    assert report.test_rows > 0 and 0.0 <= report.error <= 1.0

    store = os.path.join(tmp_dir, "pred")
    set_value(preds.withColumn("_seq", F.lit(1)), store, "customer_id", "pred", "_seq")
    stored = read_keyed_table(spark, store)
    assert stored.count() == feats.count()

    log = os.path.join(tmp_dir, "log")
    T.play_lines(spark, SF_SMALL).repartition(3).write.text(log)
    out, aud = os.path.join(tmp_dir, "flags"), os.path.join(tmp_dir, "audience")
    lines = FS.read_play_lines_stream(spark, log, max_files_per_trigger=1)
    FL.ad_flag_stream(lines, T.customers(spark, SF_SMALL), FL.keyed_table(spark, store), out, aud,
                      checkpoint=os.path.join(tmp_dir, "ck"), trigger={"availableNow": True}).awaitTermination()

    flagged = spark.read.parquet(out)
    good = parse_plays(spark.read.text(log))
    assert flagged.count() == good.count()
    exp_aud = {r[0] for r in good.join(stored.filter("pred = 1"), "customer_id").select("customer_id").distinct().collect()}
    got_aud = [r[0] for r in read_set(spark, aud).collect()]
    assert sorted(got_aud) == sorted(exp_aud) and len(got_aud) == len(set(got_aud))
    audience = M.ad_audience(T.customers(spark, SF_SMALL), stored)
    assert audience.filter(F.col("Level") == "2").count() == 0
