"""Removal of old partitions."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import SparkSession

from penstock.settings import Settings
from penstock.upkeep.files import Folder


def partition_dates(spark: SparkSession, path: str, column: str) -> list[date]:
    """Dates of the partitions; a folder whose value is no date is left alone."""
    dates = []
    for name in Folder(spark, path).folders():
        key, _, value = name.partition("=")
        if key != column:
            continue
        try:
            dates.append(date.fromisoformat(value))
        except ValueError:
            continue
    return dates


def drop_dates(spark: SparkSession, path: str, column: str, dates: list[date]) -> list[date]:
    for day in dates:
        Folder(spark, path).below(f"{column}={day.isoformat()}").delete()
    return dates


def raw_retention(
    spark: SparkSession, path: str, now: datetime, settings: Settings = Settings()
) -> list[date]:
    """Days whose midnight is older than the retention."""
    cutoff = now - timedelta(days=settings.raw_retention_days)
    dates = partition_dates(spark, path, "ingest_date")
    old = [day for day in dates if datetime.combine(day, time.min, now.tzinfo) < cutoff]
    return drop_dates(spark, path, "ingest_date", old)


def curated_retention(
    spark: SparkSession, path: str, now: datetime, settings: Settings = Settings()
) -> list[date]:
    """Whole days before the day that the retention in hours reaches back to."""
    cutoff = (now - timedelta(hours=settings.curated_retention_hours)).date()
    old = [day for day in partition_dates(spark, path, "event_date") if day < cutoff]
    return drop_dates(spark, path, "event_date", old)


def kpi_retention(
    spark: SparkSession, path: str, now: datetime, settings: Settings = Settings()
) -> list[date]:
    """By the date of the window, not by the age of the file, which a rewrite would renew."""
    cutoff = (now - timedelta(days=settings.kpi_retention_days)).date()
    old = [day for day in partition_dates(spark, path, "window_date") if day < cutoff]
    return drop_dates(spark, path, "window_date", old)
