"""Scalar column functions of the listening model: time of day, ad matching, tags, ages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values (must equal the reference): daypart boundaries by hour of day,
# hour < 5 night, < 12 morn, < 17 aft, < 22 eve, otherwise night.
DAYPART_BOUNDS = [(5, "night"), (12, "morn"), (17, "aft"), (22, "eve")]
DAYPART_LATE = "night"

# Fixed values (must equal the reference): the one-day Gold upgrade ad.
AD_REDUCED_1DAY = "ADV_REDUCED_1DAY"

# Fixed values (must equal the reference): punctuation removed from hashtags.
TAG_PUNCTUATION = ",.!?:;"

# Fixed values (must equal the reference): weighted decades for a synthetic age,
# 10, 20, 20, 20, 20, 30, 30, 30, 40, 40, 50, 60, plus a uniform year 0-9.
AGE_DECADES = [10, 20, 20, 20, 20, 30, 30, 30, 40, 40, 50, 60]


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def daypart(hour: Column) -> Column:
    expr = None
    for bound, name in DAYPART_BOUNDS:
        expr = F.when(hour < bound, F.lit(name)) if expr is None else expr.when(hour < bound, F.lit(name))
    return expr.otherwise(F.lit(DAYPART_LATE))


def ad_match(ad: Column, which: str = AD_REDUCED_1DAY) -> Column:
    """1 when the clicked ad text contains ``which`` (substring test), else 0."""
    return F.contains(ad, F.lit(which)).cast("int")


def ad_match_exact(df: DataFrame, ad_col: str = "AdClicked", which: str = AD_REDUCED_1DAY) -> DataFrame:
    """Only the clicks on exactly ``which``; other clicks give no row."""
    return df.filter(F.col(ad_col) == F.lit(which))


def total_cost(price: Column, quantity: Column) -> Column:
    return price * quantity


def tokens(text: Column) -> Column:
    """Array of whitespace-separated tokens."""
    return F.split(text, r"\s+")


def normalise_tag(token: Column) -> Column:
    """Drop punctuation, lower-case, drop one leading '#'.

    ``translate`` deletes the punctuation characters without a regex engine, and
    the leading '#' is cut with a substring; both are cheap per token.
    """
    cleaned = F.lower(F.translate(token, TAG_PUNCTUATION, ""))
    return F.when(F.startswith(cleaned, F.lit("#")), F.substring(cleaned, 2, 1 << 30)).otherwise(cleaned)


def hashtags(messages: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per hashtag occurrence: tokens starting with '#', normalised, non-empty."""
    keep = keep if keep is not None else [c for c in messages.columns if c != text_col]
    tok = messages.select(*keep, F.explode(tokens(F.col(text_col))).alias("token"))
    return (tok.filter(F.startswith(F.col("token"), F.lit("#")))
            .select(*keep, normalise_tag(F.col("token")).alias("tag"))
            .filter(F.col("tag") != ""))


def synth_age(key: Column) -> Column:
    """Deterministic age from a key: a weighted decade plus a year, hashed per key."""
    decades = F.array(*[F.lit(a) for a in AGE_DECADES])
    digest = F.md5(key.cast("string"))
    number = [F.conv(F.substring(digest, i, 8), 16, 10).cast("long") for i in (1, 9)]
    return (F.element_at(decades, (number[0] % len(AGE_DECADES) + 1).cast("int")) + number[1] % 10).cast("int")
