"""Following growing log files: appended, half-written, rotated, cut-off and lost files; start positions."""

import os
import random

import pytest

from beatstream.sources.tail import GrowingLogReader, LogFolder, follow_lines, ranges

NOW = {"availableNow": True}


def put(folder, name, text, mode="a"):
    with open(os.path.join(folder, name), mode + "b") as f:
        f.write(text if isinstance(text, bytes) else text.encode())


@pytest.fixture()
def log(spark, tmp_dir):
    """A folder, and a run of the same query over what it holds; returns all lines so far."""
    folder, out = os.path.join(tmp_dir, "log"), os.path.join(tmp_dir, "out")
    os.makedirs(folder)

    def run(starting="earliest", **options):
        query = (follow_lines(spark, folder, starting, **options).writeStream.format("parquet")
                 .option("checkpointLocation", os.path.join(tmp_dir, "ck")).trigger(**NOW).start(out))
        query.awaitTermination()
        return sorted(r.value for r in spark.read.parquet(out).collect())

    return folder, run


def test_appended_lines_arrive_once_and_half_lines_wait(log):
    folder, run = log
    put(folder, "a.log", "l1\nl2\nhal")
    assert run() == ["l1", "l2"]
    assert run() == ["l1", "l2"]
    put(folder, "a.log", "f\r\n\nl4\n")
    put(folder, "b.log", "other\n")
    put(folder, ".hidden", "no\n")
    assert run() == ["", "half", "l1", "l2", "l4", "other"]


def test_rotated_and_cut_off_files(log):
    folder, run = log
    put(folder, "a.log", "l1\nl2\n")
    run()
    # written to after the last batch, then renamed; a new file takes the name
    put(folder, "a.log", "l3\n")
    os.rename(os.path.join(folder, "a.log"), os.path.join(folder, "a.log.1"))
    put(folder, "a.log", "m1\n")
    assert run() == ["l1", "l2", "l3", "m1"]
    # copied and cut off: the copy holds what was read, the file starts anew
    put(folder, "a.log.2", "m1\nm2\n")
    put(folder, "a.log", "n1 with a longer line than all before\n", "w")
    assert run() == ["l1", "l2", "l3", "m1", "m2", "n1 with a longer line than all before"]
    # deleted files leave the offset
    os.remove(os.path.join(folder, "a.log.1"))
    put(folder, "a.log", "n2\n")
    assert run()[-1] == "n2"


def test_pieces_give_every_line_once(log):
    folder, run = log
    rnd = random.Random(3)
    lines = [f"{i}:" + "é" * rnd.choice([0, 1, 5, 40, 300]) for i in range(400)]
    put(folder, "a.log", "".join(x + "\n" for x in lines[:300]))
    run(partitionBytes="97")
    put(folder, "a.log", "".join(x + "\n" for x in lines[300:]))
    assert run(partitionBytes="31") == sorted(lines)


def test_reader_pieces_for_every_size(tmp_dir):
    data = b"a\n\nbcd\nefghij\n" + "日本語\n".encode() + b"\xff\xfe\nlast\n"
    put(tmp_dir, "x.log", data + b"open")
    want = data.decode("utf-8", "replace").split("\n")[:-1]
    for size in range(1, 40):
        reader = GrowingLogReader({"path": tmp_dir, "partitionBytes": str(size)})
        rows = [r for p in reader.partitions(reader.initialOffset(), reader.latestOffset())
                for b in reader.read(p) for r in b.to_pylist()]
        assert [r["value"] for r in rows] == want
        assert [data[r["position"]:].split(b"\n")[0].decode("utf-8", "replace") for r in rows] == want


def test_repeated_batch_finds_a_renamed_file_and_reports_a_lost_one(tmp_dir):
    put(tmp_dir, "x.log", "one\ntwo\n")
    reader = GrowingLogReader({"path": tmp_dir})
    start, end = reader.initialOffset(), reader.latestOffset()
    os.rename(os.path.join(tmp_dir, "x.log"), os.path.join(tmp_dir, "y.log"))
    again = GrowingLogReader({"path": tmp_dir})
    assert [v for p in again.partitions(start, end) for b in again.read(p) for v in b.column(0).to_pylist()] == ["one", "two"]
    os.remove(os.path.join(tmp_dir, "y.log"))
    with pytest.raises(RuntimeError):
        [list(again.read(p)) for p in again.partitions(start, end)]
    loose = GrowingLogReader({"path": tmp_dir, "failOnDataLoss": "false"})
    assert [b for p in loose.partitions(start, end) for b in loose.read(p)] == []


def test_ranges_between_snapshots():
    old = {"a": ["h1", 10], "b": ["h2", 5], "c": ["h3", 7]}
    assert ranges({}, {"a": ["h1", 10]}) == [("a", "h1", 0, 10)]
    assert ranges(old, old) == []
    # a grew, b was renamed and grew, c was replaced by another file
    new = {"a": ["h1", 12], "b.1": ["h2", 9], "c": ["h4", 3]}
    assert ranges(old, new) == [("a", "h1", 10, 12), ("b.1", "h2", 5, 9), ("c", "h4", 0, 3)]
    # the same first line, but shorter than what was read: filled anew
    assert ranges(old, {"a": ["h1", 4]}) == [("a", "h1", 0, 4)]
    # files with one header keep apart by name
    assert ranges({"a": ["h", 10], "b": ["h", 20]}, {"a": ["h", 15], "b": ["h", 21]}) == [("a", "h", 10, 15), ("b", "h", 20, 21)]


def test_a_rename_during_the_listing_repeats_nothing(tmp_dir, monkeypatch):
    put(tmp_dir, "a.log", "one\ntwo\n")
    reader = GrowingLogReader({"path": tmp_dir})
    offsets = [reader.initialOffset(), reader.latestOffset()]
    names = LogFolder.names
    os.rename(os.path.join(tmp_dir, "a.log"), os.path.join(tmp_dir, "a.log.1"))
    put(tmp_dir, "a.log", "new\n")
    monkeypatch.setattr(LogFolder, "names", lambda self: [i for i in names(self) if i.base_name == "a.log"])
    offsets.append(reader.latestOffset())  # sees the new file, misses the renamed one
    monkeypatch.setattr(LogFolder, "names", names)
    put(tmp_dir, "a.log.1", "three\n")
    offsets.append(reader.latestOffset())
    got = [[v for p in reader.partitions(a, b) for r in reader.read(p) for v in r.column(0).to_pylist()]
           for a, b in zip(offsets, offsets[1:], strict=False)]
    assert got == [["one", "two"], ["new"], ["three"]]
    os.remove(os.path.join(tmp_dir, "a.log.1"))
    for _ in range(30):
        last = reader.latestOffset()
    assert list(last["files"]) == ["a.log"]


def test_start_positions(log):
    folder, run = log
    times = [f"2024-01-01 00:00:{s:02d}" for s in (1, 3, 3, 5, 8)]
    text = "".join(f'{i},7,9,"{t}",1,"x"\n' + ("no time here\n" if i == 2 else "") for i, t in enumerate(times))
    put(folder, "a.log", text)
    for moment, first in (("2024-01-01 00:00:00", 0), ("2024-01-01 00:00:03", 1), ("2024-01-01 00:00:04", 3),
                          ("2024-01-01 00:00:08", 4), ("2024-01-01 00:00:09", 5)):
        reader = GrowingLogReader({"path": folder, "startingPosition": moment})
        got = [v.split(",")[0] for p in reader.partitions(reader.initialOffset(), reader.latestOffset())
               for b in reader.read(p) for v in b.column(0).to_pylist() if "," in v]
        assert got == [str(i) for i in range(first, 5)]
    with pytest.raises(ValueError):
        GrowingLogReader({"path": folder, "startingPosition": "noon"}).initialOffset()
    # a checkpoint wins over the option
    assert len(run("2024-01-01 00:00:04")) == 2
    put(folder, "a.log", "9,appended\n")
    assert len(run("earliest")) == 3


def test_one_file_and_the_names_it_is_rotated_to(tmp_dir):
    put(tmp_dir, "plays.csv", "a\n")
    put(tmp_dir, "plays.csv.1", "b\n")
    put(tmp_dir, "other.csv", "c\n")
    assert sorted(LogFolder(os.path.join(tmp_dir, "plays.csv")).snapshot()) == ["plays.csv", "plays.csv.1"]
    assert LogFolder(os.path.join(tmp_dir, "nowhere")).snapshot() == {}


def test_play_log_is_written_by_the_batch_and_a_host_a_task(spark, tmp_dir):
    import time

    import pyarrow as pa
    from pyspark.sql import functions as F

    from beatstream.sources.testdata import LOG_HOSTS, _by_host, _write_logs, grow_play_log, play_lines_from_events
    # the bytes of many lines aren't copied again for each line
    lines = [f"{i},1,{i % 97},\"2024-01-01 00:00:00\",1,\"10000\"\n" for i in range(300_000)]
    batches = [pa.record_batch([pa.array([0] * 10_000, pa.int32()), pa.array(lines[i:i + 10_000])], ["host", "line"])
               for i in range(0, len(lines), 10_000)]
    began = time.process_time()
    list(_write_logs(batches, tmp_dir + "/long", 7))
    assert time.process_time() - began < 4
    with open(tmp_dir + "/long/host-0.log") as f:
        assert f.read() == "".join(lines)[:-7]
    # each host has a task of its own; cut files hold the beginning of the whole ones
    events = spark.range(3000).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(1_700_000_000 + F.col("id") * 7919 % 3000).cast("timestamp_ntz").alias("ts"),
        (F.col("id") * 31 % 101).alias("user_id"), F.element_at(F.array(F.lit("view"), F.lit("error")), (F.col("id") % 2 + 1).cast("int"))
        .alias("event_type"), (F.col("id") % 100).cast("double").alias("value"), F.lit('{"k": 5}').alias("props"))
    tasks = _by_host(events).select("host", F.spark_partition_id().alias("task")).distinct().collect()
    assert len({r.host for r in tasks}) == len({r.task for r in tasks}) == len(tasks) == LOG_HOSTS
    want = {h: [] for h in range(LOG_HOSTS)}
    for r in play_lines_from_events(events, "ts", "event_id", "user_id").orderBy("ts", "event_id").collect():
        want[r.user_id % LOG_HOSTS].append(r.value + "\n")
    for cut in (9, 0, 10**6):
        folder = f"{tmp_dir}/grown-{cut}"
        grow_play_log(events, folder, cut)
        for h, rows in want.items():
            with open(f"{folder}/host-{h}.log") as f:
                whole = "".join(rows)
                assert f.read() == whole[:max(len(whole) - cut, 0)]
