"""The event topic the streaming queries read: published once per session and source folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesflow.functions.codecs import encode_json, encode_json_with_id
from salesflow.schema import FIELDS
from salesflow.session import scratch_dir
from salesflow.sources import topic
from salesflow.sources.tables import sales

#: Messages in a file and files in a micro-batch, at most: what one micro-batch
#: takes (3.2 million messages, about 1 GB) does not depend on how many there are.
MESSAGES_PER_FILE, FILES_PER_TRIGGER = 50_000, 64
#: The same for queries that carry no state, or that of a few groups, from one micro-batch to the next.
FILES_PER_LIGHT_TRIGGER = 128
#: All that a sale says of itself; its id is a digest of it.
UNKEYED = tuple(f for f in FIELDS if f != "id")
#: Files taken one at a time, or a few: about so many at most, however many messages there are.
FILES_ONE_BY_ONE = 128
_TOPICS: dict[tuple[str, str, int], str] = {}


def files_for(messages: int, batches: int, messages_per_file: int = MESSAGES_PER_FILE) -> int:
    """Files per trigger that give at least so many micro-batches, and no more than ``FILES_PER_TRIGGER`` makes needful."""
    return max(min(FILES_PER_TRIGGER, messages // messages_per_file // batches), 1)


def publish_sales(records: DataFrame, path: str, messages_per_file: int = MESSAGES_PER_FILE) -> None:
    """Encode records as JSON messages and append them to the topic at ``path``; records without an id get theirs here.

    The joins behind the records run here, in a batch job that can split hot
    keys. Files are capped, also when a hot key made one partition much larger
    than the others.
    """
    messages = encode_json(records, key="id") if "id" in records.columns else encode_json_with_id(records)
    topic.publish(messages, path, messages_per_file)


def sales_topic(spark: SparkSession, sf_dir: str, messages_per_file: int = MESSAGES_PER_FILE) -> str:
    """Path of the topic with all sales of ``sf_dir``; the streaming queries share it."""
    where = (spark.sparkContext.applicationId, sf_dir, messages_per_file)
    if where not in _TOPICS:
        path = scratch_dir(spark, "topic")
        publish_sales(sales(spark, sf_dir, *UNKEYED), path, messages_per_file)
        _TOPICS[where] = path
    return _TOPICS[where]


def sales_messages(
    spark: SparkSession,
    sf_dir: str,
    reader: SparkSession | None = None,
    files_per_trigger: int = FILES_PER_LIGHT_TRIGGER,
    messages_per_file: int = MESSAGES_PER_FILE,
) -> DataFrame:
    """Stream the topic; publishing runs in ``spark``, the stream in ``reader`` if given."""
    return topic.subscribe(reader or spark, sales_topic(spark, sf_dir, messages_per_file), files_per_trigger)
