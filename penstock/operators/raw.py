"""Raw layer: the log frame kept as it came, with its place in the log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penstock.model import CURATED_WIRE


def raw_project(frame: DataFrame) -> DataFrame:
    return frame.select(
        F.col("value").cast("string").alias("raw_json"),
        F.col("key").cast("string").alias("kafka_key"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.to_date("timestamp").alias("ingest_date"),
    )


def raw_as_frame(raw: DataFrame) -> DataFrame:
    """A stored raw table in the shape of the log, so curation can start from either."""
    return raw.select(
        F.col("kafka_key").cast("binary").alias("key"),
        F.col("raw_json").cast("binary").alias("value"),
        F.col("kafka_topic").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("kafka_timestamp").alias("timestamp"),
    )


def keyed_json(events: DataFrame, key: str = "plant_id", keep: list[str] = ()) -> DataFrame:
    """Rows as log records: the key, and the row as JSON under its wire names.

    `keep` names columns to carry beside the record instead of inside it.
    """
    fields = [
        F.col(name).alias(CURATED_WIRE.get(name, name))
        for name in events.columns
        if name not in keep
    ]
    return events.select(
        F.col(key).cast("binary").alias("key"),
        F.to_json(F.struct(*fields)).cast("binary").alias("value"),
        *keep,
    )
