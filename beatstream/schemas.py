"""Canonical schemas of the listening-behaviour data model."""

from pyspark.sql import types as T

# Raw play log line, parsed: event_id, customer_id, track_id, datetime, ismobile, zip.
PLAYS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("track_id", T.LongType()),
    T.StructField("datetime", T.TimestampNTZType()),
    T.StructField("ismobile", T.IntegerType()),
    T.StructField("listening_zip_code", T.StringType()),
])

# Customer attributes.  Coded categories are strings of digits, as in the key-value
# store the attributes came from.
CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("gender", T.StringType()),
    T.StructField("zip", T.StringType()),
    T.StructField("Address", T.StringType()),
    T.StructField("SignDate", T.StringType()),
    T.StructField("Status", T.StringType()),
    T.StructField("Level", T.StringType()),
    T.StructField("Campaign", T.StringType()),
    T.StructField("LinkedWithApps", T.StringType()),
])

CUSTOMER_ATTRIBUTES = ["name", "age", "gender", "zip", "Address", "SignDate", "Status",
                       "Level", "Campaign", "LinkedWithApps"]

CLICKS = T.StructType([
    T.StructField("EventID", T.LongType()),
    T.StructField("CustID", T.LongType()),
    T.StructField("AdClicked", T.StringType()),
    T.StructField("Localtime", T.TimestampNTZType()),
])

MUSIC = T.StructType([
    T.StructField("TrackId", T.LongType()),
    T.StructField("Title", T.StringType()),
    T.StructField("Artist", T.StringType()),
    T.StructField("Length", T.IntegerType()),
])

# Output column order of an enriched play (the reference's index document), plus
# event_id and event time which it dropped and we keep.
ENRICHED_COLUMNS = ["@timestamp", "customer_id", "track_id", "ismobile", "listening_zip_code",
                    *CUSTOMER_ATTRIBUTES]

FEATURE_NAMES = ["morn", "aft", "eve", "night", "mobile", "unique"]

# Timestamp text format of the play log.
PLAY_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
