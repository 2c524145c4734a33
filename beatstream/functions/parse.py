"""Parsing of raw play log lines into typed columns (JVM-side expressions only).

A line is ``event_id,customer_id,track_id,"yyyy-MM-dd HH:mm:ss",ismobile,"zip"``.
Fields may carry spaces after the comma and quotes may be unbalanced; every field is
trimmed and quotes are removed, as the reference's record mapper does.  Lines the
reference would crash on (too few fields, a customer id or mobile flag that is not
an integer) get a ``reject_reason`` instead of failing the batch, and so do lines whose
track id or event time cannot be read: such a play would be null in every later group
or window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatstream.functions.timeutil import instant_to_ntz
from beatstream.schemas import PLAY_TIME_FORMAT

PLAY_FIELDS = 6


def _field(parts: Column, i: int) -> Column:
    # get() is 0-based and yields null past the end instead of failing under ANSI.
    return F.trim(F.get(parts, i))


def unquote(c: Column) -> Column:
    """Remove every double quote (zip code, quoted time)."""
    return F.replace(c, F.lit('"'), F.lit(""))


def safe_timestamp(text: Column, fmt: str = PLAY_TIME_FORMAT) -> Column:
    """Text -> timestamp_ntz; empty or malformed text gives null, never an error.

    The text is read with an explicit zero offset and taken back as that offset's wall
    clock: hours that the session's zone skips or repeats parse like any others.
    """
    t = F.concat(F.nullif(F.trim(text), F.lit("")), F.lit(" +00:00"))
    return instant_to_ntz(F.try_to_timestamp(t, F.lit(f"{fmt} XXX")))


def to_int(c: Column, type_: str = "int") -> Column:
    """``toInt`` without the exception: null when the text is not an integer."""
    return c.try_cast(type_)


def parse_play_columns(value: Column, parts: Column | None = None) -> list[Column]:
    """Typed play columns and ``reject_reason`` from a raw line (and its split fields)."""
    parts = F.split(value, ",", -1) if parts is None else parts
    n = F.size(parts)
    event_id = to_int(unquote(_field(parts, 0)), "bigint")
    customer_id = to_int(unquote(_field(parts, 1)), "bigint")
    track_id = to_int(unquote(_field(parts, 2)), "bigint")
    dt = safe_timestamp(unquote(_field(parts, 3)))
    ismobile = to_int(_field(parts, 4), "int")
    zip_code = unquote(_field(parts, 5))
    reason = (F.when(value.isNull() | (n < PLAY_FIELDS), F.lit("too_few_fields"))
               .when(customer_id.isNull(), F.lit("bad_customer_id"))
               .when(ismobile.isNull(), F.lit("bad_ismobile"))
               .when(track_id.isNull(), F.lit("bad_track_id"))
               .when(dt.isNull(), F.lit("bad_event_time")))
    return [event_id.alias("event_id"), customer_id.alias("customer_id"),
            track_id.alias("track_id"), dt.alias("datetime"), ismobile.alias("ismobile"),
            zip_code.alias("listening_zip_code"), reason.alias("reject_reason")]


def parse_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """All lines with parsed columns plus ``reject_reason`` (null for good lines).

    The line is split once into an array column; the field expressions read that
    array (the optimizer keeps the two projections apart because the split is
    used by every field), so each line is split a single time.
    """
    split = lines.select(F.col(value_col).alias("raw"), F.split(F.col(value_col), ",", -1).alias("_parts"))
    return split.select("raw", *parse_play_columns(F.col("raw"), F.col("_parts")))


def parse_plays(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Good lines as typed plays (batch or stream)."""
    parsed = parse_lines(lines, value_col)
    return (parsed.filter(F.col("reject_reason").isNull())
            .drop("raw", "reject_reason"))


def quarantine_bad_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Lines the reference would fail on, with the reason."""
    parsed = parse_lines(lines, value_col)
    return parsed.filter(F.col("reject_reason").isNotNull()).select("raw", "reject_reason")


def bytes_to_lines(df: DataFrame, col: str = "value") -> DataFrame:
    """Decode a binary message payload as UTF-8 text (Pub/Sub or Kafka value)."""
    return df.withColumn(col, F.decode(F.col(col), "UTF-8"))


def parse_libsvm_line(line: Column, num_features: int = 6) -> Column:
    """``label i:v i:v ...`` (1-based indices) -> struct(label double, values array<double>).

    Missing indices are 0.0; the values array is dense and 0-based, ready for
    ``pyspark.ml.functions.array_to_vector``.
    """
    tokens = F.split(F.trim(line), r"\s+")
    pairs = F.slice(tokens, 2, F.greatest(F.size(tokens) - 1, F.lit(0)))
    kv = F.map_from_entries(F.transform(pairs, lambda t: F.struct(
        F.split(t, ":").getItem(0).try_cast("int").alias("i"),
        F.split(t, ":").getItem(1).try_cast("double").alias("v"))))
    dense = F.transform(F.sequence(F.lit(1), F.lit(num_features)),
                        lambda i: F.coalesce(F.element_at(kv, i), F.lit(0.0)))
    return F.struct(F.get(tokens, 0).try_cast("double").alias("label"), dense.alias("values"))
