import random

from beatstream.llm.common import connected_components, held_out, labelled_sample


def test_components_of_chains_stars_and_loops(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(1000, k) for k in range(1001, 1100)] + [(5000, 5000), (None, 3)]
    edges += [(rnd.randint(2000, 2200), rnd.randint(2000, 2200)) for _ in range(150)]
    rnd.shuffle(edges)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    label = {}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = label.setdefault(a, a), label.setdefault(b, b)
            label = {k: min(x, y) if v in (x, y) else v for k, v in label.items()}
    assert got == label


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_sample_is_bounded_and_leaves_held_out_rows(spark):
    rows = [(i, i % 2) for i in range(5000)] + [(None, 1), (7, None), (7, 1)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    got = labelled_sample(labels, "quality", 640).withColumn("h", held_out()).collect()
    assert not any(r.h for r in got)
    for c in (0, 1):
        assert 600 <= sum(r.label == c for r in got) <= 640
    whole = labelled_sample(labels, "quality", 5000)
    assert whole.count() == labels.where("doc_id is not null and quality is not null").where(~held_out()) \
        .select("doc_id").distinct().count()
    assert labelled_sample(labels.limit(0), "quality", 10).count() == 0


def test_scratch_deletes_its_own_tables_only(spark):
    from beatstream.llm import common
    kept = common.written(spark.range(3), "kept")
    with common.scratch(spark):
        inner = common.written(spark.range(5), "inner")
        assert inner.count() == 5
        path = common._tables[-1]
    from pathlib import Path
    assert not Path(path).exists() and kept.count() == 3
