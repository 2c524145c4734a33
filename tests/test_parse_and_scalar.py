from pyspark.sql import functions as F

from beatstream.functions import parse as P
from beatstream.functions import scalar as S

# Invented lines: good, without a closing quote, padded, and broken in every way.
LINES = [
    '10,7,31,"2015-02-01 08:00:05",0,"10115"',
    '11,8,32,"2015-02-01 23:59:59",1,"10117',
    '12, 9,33, 2015-02-02 00:00:00,1, 10119',
    '',
    'bad',
    '13,1,2,"2015-02-02 00:00:00",x,"1"',
    '14,abc,2,"2015-02-02 00:00:00",1,"1"',
    '15,7,2,"not a time",1,"1"',
    '16,7,T2,"2015-02-02 00:00:00",1,"1"',
    '17,7,2,"2015-02-30 00:00:00",1,"1"',
]
BAD = {'': "too_few_fields", 'bad': "too_few_fields", LINES[5]: "bad_ismobile", LINES[6]: "bad_customer_id",
       LINES[7]: "bad_event_time", LINES[8]: "bad_track_id", LINES[9]: "bad_event_time"}


def lines_df(spark):
    return spark.createDataFrame([(x,) for x in LINES], "value string")


def test_parse_plays_good_lines(spark):
    rows = {r.event_id: r for r in P.parse_plays(lines_df(spark)).collect()}
    assert set(rows) == {10, 11, 12}
    assert (rows[10].customer_id, rows[10].track_id, rows[10].ismobile) == (7, 31, 0)
    assert str(rows[10].datetime) == "2015-02-01 08:00:05"
    # the quote without a partner is removed, and so are the blanks around fields
    assert [rows[i].listening_zip_code for i in (10, 11, 12)] == ["10115", "10117", "10119"]


def test_every_bad_line_is_reported_with_its_reason(spark):
    got = {r.raw: r.reject_reason for r in P.quarantine_bad_lines(lines_df(spark)).collect()}
    assert got == BAD


def test_safe_timestamp(spark):
    df = spark.createDataFrame([("2015-02-03 18:32:14",), ("",), (None,), ("garbage",), ("2015-2-3 1:2:3",)], "t string")
    out = [r[0] for r in df.select(P.safe_timestamp(F.col("t"))).collect()]
    assert str(out[0]) == "2015-02-03 18:32:14" and out[1:] == [None, None, None, None]


def test_bytes_to_lines(spark):
    df = spark.createDataFrame([(bytearray("héllo,1".encode()),)], "value binary")
    assert P.bytes_to_lines(df).first().value == "héllo,1"


def test_daypart_boundaries(spark):
    df = spark.range(24).select(F.col("id").cast("int").alias("h"))
    got = {r.h: r.d for r in df.select("h", S.daypart(F.col("h")).alias("d")).collect()}
    for h in range(24):
        exp = "night" if h < 5 else "morn" if h < 12 else "aft" if h < 17 else "eve" if h < 22 else "night"
        assert got[h] == exp


def test_ad_match_is_substring(spark):
    df = spark.createDataFrame([("ADV_REDUCED_1DAY",), ("X_ADV_REDUCED_1DAY_Y",), ("ADV_FREE_REFERRAL",)], "a string")
    assert [r[0] for r in df.select(S.ad_match(F.col("a"))).collect()] == [1, 1, 0]
    assert S.ad_match_exact(df, "a").count() == 1


def test_hashtag_edge_cases(spark):
    msgs = spark.createDataFrame([("Hello #Spark, #spark! a#no ##x #, #A.b",)], "text string")
    tags = sorted(r.tag for r in S.hashtags(msgs, keep=[]).collect())
    assert tags == ["#x", "ab", "spark", "spark"]


def test_synth_age_is_deterministic_and_in_range(spark):
    df = spark.range(2000).select(S.synth_age(F.col("id")).alias("a"))
    stats = df.agg(F.min("a"), F.max("a")).first()
    assert stats[0] >= 10 and stats[1] <= 69
    again = spark.range(2000).select(S.synth_age(F.col("id")).alias("a"))
    assert df.exceptAll(again).count() == 0
    # decade weights: 20s are the most common decade
    by_decade = {r.d: r["count"] for r in df.groupBy((F.floor(F.col("a") / 10) * 10).alias("d")).count().collect()}
    assert max(by_decade, key=by_decade.get) == 20


def test_time_conversions_ignore_the_session_zone(spark):
    from beatstream.functions.timeutil import instant_to_ntz, ntz_micros, ntz_to_instant
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ["Asia/Kolkata", "America/New_York", "UTC"]:
            spark.conf.set("spark.sql.session.timeZone", tz)
            df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 12:34:56.123456' AS t "
                           "UNION ALL SELECT TIMESTAMP_NTZ'1969-12-31 23:59:59.5'")
            rows = df.select("t", ntz_micros(F.col("t")).alias("us"),
                             instant_to_ntz(ntz_to_instant(F.col("t"))).alias("back"),
                             instant_to_ntz(F.window(ntz_to_instant(F.col("t")), "20 minutes").start).alias("w")
                             ).orderBy("t").collect()
            assert [r.us for r in rows] == [-500000, 1704112496123456], tz
            assert all(r.back == r.t for r in rows), tz
            assert str(rows[1].w) == "2024-01-01 12:20:00", tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
