"""Is each layer being written?"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from penstock.settings import Settings
from penstock.sources.tables import data_files
from penstock.upkeep.files import Folder


def watched_layers(
    curated_path: str, kpi_path: str, settings: Settings = Settings()
) -> dict[str, tuple[str, int]]:
    """The two layers a deployment watches, with the bounds of the job settings."""
    return {
        "curated": (curated_path, settings.curated_fresh_seconds),
        "kpis": (kpi_path, settings.kpi_fresh_seconds),
    }


def layer_freshness(
    spark: SparkSession, layers: dict[str, tuple[str, int]], now: datetime | Column | None = None
) -> DataFrame:
    """Per layer the newest file, its age in seconds, and whether that is below the bound.

    `layers` gives path and bound. A layer without files is not healthy. Works on file listings;
    no data file is opened.
    """
    clock = F.current_timestamp() if now is None else F.lit(now)
    answers = None
    for layer, (path, bound) in layers.items():
        if Folder(spark, path).exists():
            files = data_files(spark, path)
        else:
            files = spark.sql(
                "SELECT '' AS path, CAST(NULL AS TIMESTAMP) AS modificationTime, 0L AS length"
            ).filter("false")
        age = F.unix_timestamp(clock) - F.unix_timestamp(F.max("modificationTime"))
        one = files.agg(
            F.lit(layer).alias("layer"),
            F.max("modificationTime").alias("newest"),
            F.count(F.lit(1)).alias("files"),
            age.alias("age_seconds"),
            F.coalesce(age < bound, F.lit(False)).alias("healthy"),
        )
        answers = one if answers is None else answers.union(one)
    return answers
