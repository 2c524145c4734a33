"""Property test: Spark's line parser against a plain-Python reading of the same rules."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from beatstream.functions import parse as P

FIELD = st.one_of(
    st.integers(min_value=-5, max_value=10**6).map(str),
    st.sampled_from(["", " ", "x", "E", '"7"', ' 12', '"10117', "1.5", "2015-02-01 18:00:14",
                     '"2015-03-29 02:30:00"', '"not a time"', " 2015-02-30 10:00:00"]),
)
LINE = st.lists(FIELD, min_size=0, max_size=8).map(lambda fs: ",".join(fs))


def py_int(text):
    t = text.strip()
    if t[:1] in "+-":
        sign, digits = t[:1], t[1:]
    else:
        sign, digits = "", t
    return int(sign + digits) if digits.isdigit() else None


def py_time(text):
    t = text.replace('"', "").strip()
    try:
        return dt.datetime.strptime(t, "%Y-%m-%d %H:%M:%S") if t else None
    except ValueError:
        return None


def py_parse(line):
    f = line.split(",")
    get = lambda i: f[i].strip() if i < len(f) else None
    cust = py_int(get(1).replace('"', "")) if get(1) is not None else None
    mobile = py_int(get(4)) if get(4) is not None else None
    if len(f) < 6:
        reason = "too_few_fields"
    elif cust is None:
        reason = "bad_customer_id"
    elif mobile is None:
        reason = "bad_ismobile"
    elif py_int(get(2).replace('"', "")) is None:
        reason = "bad_track_id"
    elif py_time(get(3)) is None:
        reason = "bad_event_time"
    else:
        reason = None
    if reason:
        return (line, reason)
    return (line, None, py_int(get(0).replace('"', "")), cust, py_int(get(2).replace('"', "")),
            py_time(get(3)), mobile, get(5).replace('"', ""))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(LINE, min_size=1, max_size=60))
def test_parser_matches_python_rules(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = []
    for r in P.parse_lines(df).collect():
        if r.reject_reason:
            got.append((r.raw, r.reject_reason))
        else:
            got.append((r.raw, None, r.event_id, r.customer_id, r.track_id, r.datetime, r.ismobile,
                        r.listening_zip_code))
    assert sorted(got, key=repr) == sorted((py_parse(x) for x in lines), key=repr)
