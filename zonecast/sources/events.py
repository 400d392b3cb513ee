"""Event sources (S1, S2): broker or file stream -> JSON text -> typed flat columns.

The same decode step serves a Kafka source (``value`` is binary) and a text
file source (``value`` is one JSON document per line), batch or streaming.
A document with some malformed fields is kept with nulls in their place; a document that gives no field at all is
undecodable and goes to the rejects instead of becoming an all-null row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _decoded(df: DataFrame, schema: StructType, value_col: str) -> DataFrame:
    """Parse once per row. The parsed struct is expanded by a generator (``inline`` of a
    one-element array): filters on its fields cannot be pushed below a generator, so the
    optimizer does not substitute (and re-run, field by field) the JSON parse into them."""
    text = F.col(value_col).cast("string")
    parsed = F.from_json(text, schema, {"mode": "PERMISSIVE"})
    return df.select(F.inline(F.array(parsed)), text.alias("json_str"))


def _valid(schema: StructType):
    """At least one field was read."""
    return F.coalesce(*[F.col(f.name).cast("string") for f in schema.fields]).isNotNull()


def decode_events(df: DataFrame, schema: StructType, value_col: str = "value") -> DataFrame:
    """JSON text (or bytes) -> flat typed columns, without the undecodable rows (see ``decode_rejects``)."""
    return _decoded(df, schema, value_col).filter(_valid(schema)).select(*[f.name for f in schema.fields])


def decode_rejects(df: DataFrame, schema: StructType, value_col: str = "value") -> DataFrame:
    """The rows ``decode_events`` drops, with their raw text."""
    return _decoded(df, schema, value_col).filter(~_valid(schema)).select("json_str")


def decode_both(df: DataFrame, schema: StructType, value_col: str = "value") -> DataFrame:
    """One parse for both sides: the typed columns, the raw text (``json_str``) and whether the document was decoded (``decoded``)."""
    taken = {f.name for f in schema.fields}
    if taken & {"json_str", "decoded"}:
        raise ValueError("an event schema cannot have columns json_str or decoded")
    return _decoded(df, schema, value_col).withColumn("decoded", _valid(schema))


def read_raw_stream(spark: SparkSession, *, kafka_servers: str | None = None, topic: str | None = None, path: str | None = None,
                    max_files_per_trigger: int | None = None, starting_offsets: str = "latest", min_partitions: int | None = None) -> DataFrame:
    """Streaming source with a ``value`` column. With ``kafka_servers`` it subscribes to ``topic`` (needs the
    Kafka connector on the classpath; ``failOnDataLoss`` off); otherwise it tails a folder of JSON-lines files."""
    if kafka_servers:
        reader = (spark.readStream.format("kafka")
                  .option("kafka.bootstrap.servers", kafka_servers).option("subscribe", topic)
                  .option("startingOffsets", starting_offsets).option("failOnDataLoss", "false"))
        if min_partitions:
            # split large topic partitions into more Spark tasks than the topic has partitions
            reader = reader.option("minPartitions", min_partitions)
        return reader.load()
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def read_event_stream(spark: SparkSession, schema: StructType, **source) -> DataFrame:
    """The streaming source (``read_raw_stream``), decoded with ``decode_events``."""
    return decode_events(read_raw_stream(spark, **source), schema, "value")
