"""A topic kept as files: the same key/value columns as Kafka, with replayable offsets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MESSAGES = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType())])

ROW_GROUP = 8 << 20


def publish(messages: DataFrame, path: str, max_records_per_file: int = 0) -> None:
    """Append messages to the topic; the cap on file size bounds what one trigger must take.

    Packed by zstd: digests in messages are hexadecimal text, which only an
    entropy coder makes smaller; its lowest level packs them as well as higher
    ones. No dictionary is tried, since no message comes twice. Row groups are
    small, so that the tasks of a micro-batch can share a large file.
    """
    packing = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1", "parquet.enable.dictionary": "false"}
    options = {"maxRecordsPerFile": max_records_per_file, "parquet.block.size": ROW_GROUP}
    messages.write.mode("append").options(**packing, **options).parquet(path)


def subscribe(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream the topic, at most so many files in a micro-batch."""
    reader = spark.readStream.schema(MESSAGES)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
