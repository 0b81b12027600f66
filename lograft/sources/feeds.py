"""Change-feed readers and writers: text / JSON-lines / parquet files or Kafka,
as batch or as stream. Every reader returns a ``value`` string column holding
one envelope per row, so the same transforms apply to all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FORMATS = ("text", "json", "parquet")


def read_feed(
    spark: SparkSession,
    path: str,
    fmt: str = "text",
    streaming: bool = False,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Envelope text from files. ``text``/``json``: one envelope per line
    (JSON lines are not parsed here). ``parquet``: a ``value`` string column.
    """
    if fmt not in _FORMATS:
        raise ValueError(f"unknown feed format {fmt!r}; expected one of {_FORMATS}")
    reader = spark.readStream if streaming else spark.read
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if fmt == "parquet":
        if streaming:
            reader = reader.schema("value string")
        return reader.parquet(path).select(F.col("value").cast("string"))
    return reader.format("text").load(path).select("value")


def read_kafka_feed(
    spark: SparkSession,
    bootstrap_servers: str,
    topics: str,
    starting_offsets: str = "earliest",
    streaming: bool = True,
    extra_options: dict[str, str] | None = None,
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Envelopes from Kafka topics (needs the spark-sql-kafka package).
    Keeps the log coordinates for ordering and replay checks.
    ``max_offsets_per_trigger`` bounds each micro-batch.
    """
    reader = spark.readStream if streaming else spark.read
    r = (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topics)
        .option("startingOffsets", starting_offsets)
    )
    if streaming and max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for k, v in (extra_options or {}).items():
        r = r.option(k, v)
    return r.load().select(
        F.col("value").cast("string").alias("value"),
        F.col("topic").alias("log_topic"),
        F.col("partition").alias("log_partition"),
        F.col("offset").alias("log_offset"),
    )


def write_feed(df: DataFrame, path: str, fmt: str = "text", mode: str = "overwrite") -> None:
    """Land envelope text as files (``value`` column only)."""
    if fmt not in _FORMATS:
        raise ValueError(f"unknown feed format {fmt!r}")
    w = df.select("value").write.mode(mode)
    if fmt == "parquet":
        w.parquet(path)
    else:
        w.text(path)
