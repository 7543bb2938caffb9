"""The event log: Kafka, or files in the shape of Kafka records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from penstock.model import RAW_FRAME
from penstock.settings import Settings


def kafka_options(
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_offsets: int | None = None,
    fail_on_data_loss: bool = True,
) -> dict[str, str]:
    """All new records per trigger, and an error when records are lost, unless told otherwise."""
    limit = {} if max_offsets is None else {"maxOffsetsPerTrigger": str(max_offsets)}
    return limit | {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }


def kafka_source(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Needs the spark-sql-kafka package of the running Spark version on the class path."""
    reader = spark.readStream.format("kafka")
    return reader.options(**kafka_options(servers, topic, **options)).load()


def settings_options(settings: Settings) -> dict[str, str]:
    """Servers, topic and intake of the job settings as options of the reader."""
    limit = settings.max_offsets_per_trigger or None
    return kafka_options(settings.bootstrap_servers, settings.topic, max_offsets=limit)


def settings_source(spark: SparkSession, settings: Settings) -> DataFrame:
    """The log that the job settings name."""
    return spark.readStream.format("kafka").options(**settings_options(settings)).load()


def frame_source(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Log records from Parquet files, as a stream."""
    reader = spark.readStream.schema(RAW_FRAME)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all"}


def publish(records: DataFrame, servers: str, topic: str) -> None:
    """Write key and value (see operators.raw.keyed_json) to the log."""
    records.write.format("kafka").options(**sink_options(servers, topic)).save()


def publish_stream(records: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    writer = records.writeStream.format("kafka").options(**sink_options(servers, topic))
    return writer.option("checkpointLocation", checkpoint)
