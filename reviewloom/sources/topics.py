"""Message streams: Kafka topics, or folders of files where there is no broker."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Broker and topic names.
BROKER = "localhost:9092"
RAW_TOPIC = "rawData"
RESULT_TOPIC = "resultData"


def kafka_read_options(
    topic: str = RAW_TOPIC,
    broker: str = BROKER,
    starting: str = "latest",
    fail_on_loss: bool = False,
    max_per_batch: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of a topic source. ``max_per_batch`` bounds a micro-batch, so that a
    backlog is worked off in pieces; offsets live in the query's checkpoint.
    ``min_partitions`` cuts the offset ranges of a topic with few partitions into more
    tasks."""
    options = {
        "kafka.bootstrap.servers": broker,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_loss).lower(),
    }
    if max_per_batch is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_batch)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_write_options(topic: str = RESULT_TOPIC, broker: str = BROKER) -> dict[str, str]:
    """Options of a topic sink: every replica confirms, three retries, one request in
    flight, which keeps the order within a partition. Delivery is at least once."""
    return {
        "kafka.bootstrap.servers": broker,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": "3",
        "kafka.max.in.flight.requests.per.connection": "1",
    }


def read_topic(spark: SparkSession, **options) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_read_options(**options)).load()


def read_landing(
    spark: SparkSession,
    path: str,
    schema,
    fmt: str = "parquet",
    max_files: int | None = None,
) -> DataFrame:
    """A landing folder (or glob) as a stream. ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def keyed(messages: DataFrame, key: str, value: str = "value") -> DataFrame:
    """Rows for a topic, keyed so that the messages of one order keep their order."""
    return messages.select(F.col(key).cast("string").alias("key"), F.col(value))


def write_topic(messages: DataFrame, **options) -> None:
    """A batch of messages to a topic."""
    messages.write.format("kafka").options(**kafka_write_options(**options)).save()
