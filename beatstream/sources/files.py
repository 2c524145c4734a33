"""File and message-bus sources of the listening model (batch and stream)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatstream.functions.parse import parse_plays
from beatstream.schemas import CLICKS, CUSTOMERS, MUSIC

# Timestamp text in CSV files we write and read back (keeps microseconds).
CSV_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def _csv(spark: SparkSession, schema, header: bool):
    return (spark.read.schema(schema)
            .option("header", header)
            .option("ignoreLeadingWhiteSpace", True)
            .option("ignoreTrailingWhiteSpace", True)
            .option("timestampNTZFormat", CSV_TIME_FORMAT)
            .option("mode", "PERMISSIVE"))


def read_play_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw play log lines (``value``) from text files."""
    return spark.read.text(path)


def read_plays_batch(spark: SparkSession, path: str) -> DataFrame:
    """The play log as a typed table, with the same line rules as the stream
    (quotes removed, fields trimmed, bad lines left out; see ``quarantine_bad_lines``)."""
    return parse_plays(read_play_lines(spark, path))


def read_play_lines_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Follow new log files appearing in a folder (the tailing log collector)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def read_clicks(spark: SparkSession, path: str) -> DataFrame:
    """Ad clicks: ``EventID, CustID, AdClicked, Localtime``, no header."""
    return _csv(spark, CLICKS, header=False).csv(path)


def read_customers(spark: SparkSession, path: str) -> DataFrame:
    """Customer attributes from a CSV with a header; columns are taken by name
    (the file's column order does not matter) and cast to the model's types."""
    raw = (spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True)
           .option("ignoreTrailingWhiteSpace", True).csv(path))
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in CUSTOMERS.fields])


def read_music(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, MUSIC, header=False).csv(path)


def read_csv_infer(spark: SparkSession, path: str, view: str | None = None) -> DataFrame:
    """CSV with a header and an inferred schema over a file glob, optionally as a temp view.

    Inference reads the data an extra time; prefer an explicit schema at scale.
    """
    df = spark.read.option("header", True).option("inferSchema", True).csv(path)
    if view:
        df.createOrReplaceTempView(view)
    return df


def read_libsvm(spark: SparkSession, path: str, num_features: int = 6) -> DataFrame:
    """Sparse labelled vectors (1-based indices in the text, 0-based in the vector)."""
    return spark.read.format("libsvm").option("numFeatures", num_features).load(path)


def write_libsvm(features: DataFrame, path: str, cols=("morn", "aft", "eve", "night", "mobile", "unique"),
                 label_col: str = "label", digits: int = 2) -> None:
    """``label 1:x 2:y ...`` text with values rounded to ``digits`` (the training file)."""
    from pyspark.ml.feature import VectorAssembler
    rounded = features.select(F.col(label_col).cast("double").alias("label"),
                              *[F.round(F.coalesce(F.col(c), F.lit(0.0)), digits).alias(c) for c in cols])
    vec = VectorAssembler(inputCols=list(cols), outputCol="features").transform(rounded)
    vec.select("label", "features").write.format("libsvm").save(path)


def kafka_options(servers: str, topics: str, starting: str = "latest", **extra: str) -> dict[str, str]:
    """Options of a Kafka subscription; ``topics`` is a comma-separated list."""
    names = ",".join(t.strip() for t in topics.split(",") if t.strip())
    opts = {"kafka.bootstrap.servers": servers, "subscribe": names, "startingOffsets": starting}
    opts.update(extra)
    return opts


def kafka_lines(spark: SparkSession, servers: str, topics: str, starting: str = "latest") -> DataFrame:
    """Messages of the topics as ``value`` text.  Offsets live in the query
    checkpoint, so a restart resumes exactly where the last batch committed.
    Needs the Kafka connector on the classpath."""
    r = spark.readStream.format("kafka")
    for k, v in kafka_options(servers, topics, starting).items():
        r = r.option(k, v)
    return r.load().selectExpr("CAST(value AS STRING) AS value")
