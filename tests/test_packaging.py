"""The library works from a driver in another folder: workers need not find it on their path."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import datetime as dt, sys
sys.path.insert(0, {repo!r})  # the driver's path only
from beatstream.session import build_session
from beatstream.streaming import flows as FL
from beatstream.streaming.repeat import repeat_listens_stream
from beatstream.streaming.sinks import append_table
spark = build_session("local[2]", shuffle_partitions=2, extra={{"spark.checkpoint.dir": {tmp!r} + "/ck"}})
t0 = dt.datetime(2024, 1, 1)
plays = spark.createDataFrame([(i, 1, 1, t0 + dt.timedelta(minutes=i)) for i in range(5)],
                              "event_id long, customer_id long, track_id long, datetime timestamp_ntz")
plays.write.parquet({tmp!r} + "/plays")
stream = spark.readStream.schema(plays.schema).parquet({tmp!r} + "/plays")
FL.run_closed(stream, plays, "datetime", lambda s, ck: append_table(
    repeat_listens_stream(s), {tmp!r} + "/out", ck, {{"availableNow": True}}))
print("FOUND", spark.read.parquet({tmp!r} + "/out").count())
"""


def test_stateful_stream_from_another_folder(tmp_dir):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    env["PYSPARK_PYTHON"] = sys.executable
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=REPO, tmp=tmp_dir)], cwd=tmp_dir, env=env,
                         capture_output=True, text=True, timeout=300)
    assert "FOUND 1" in out.stdout, out.stderr[-2000:]
