"""What is newest in a table partitioned by date, found from its dates instead of its rows.

Dates come from the folder names, newest first; rows are counted only in as many dates as it takes.
The answers are dates for filters that prune the scan proper.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from penstock.sources.tables import table_scan
from penstock.upkeep.retention import partition_dates

DATE = "event_date"


def newest_date(spark: SparkSession, path: str, column: str = DATE) -> date | None:
    """The last date of the table; a listing, no file is opened."""
    return max(partition_dates(spark, path, column), default=None)


def date_holding(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    n: int,
    where: Column | str | None = None,
    column: str = DATE,
) -> date | None:
    """The latest date from which on at least `n` rows (that satisfy `where`) exist; None if the
    dated part of the table has fewer.

    One date is counted, then two, four and so on, each count under a filter on its dates, so what is
    read is at most a small multiple of what holds the n rows. Without `where` a count comes from the
    files' footers."""
    dates = sorted(partition_dates(spark, path, column), reverse=True)
    table = table_scan(spark, path, schema)
    if where is not None:
        table = table.filter(where)
    taken, missing, width = 0, n, 1
    while taken < len(dates) and missing > 0:
        part = dates[taken : taken + width]
        day = F.col(column)
        counted = table.filter((day >= part[-1]) & (day <= part[0])).groupBy(column).count()
        counts = {row[column]: row["count"] for row in counted.collect()}
        for one in part:
            missing -= counts.get(one, 0)
            if missing <= 0:
                return one
        taken, width = taken + width, width * 2
    return None


def since(readings: DataFrame, first: date | None, column: str = DATE) -> DataFrame:
    """Rows from a date on; all of them, those without a date included, if there is none."""
    return readings if first is None else readings.filter(F.col(column) >= first)


def newest_rows(
    spark: SparkSession, path: str, schema: T.StructType, n: int, where: Column | str | None = None
) -> DataFrame:
    """The part of the table that holds its n newest rows, for `last_n_by_time` and its like.

    Equal times are of one date, so ties are in that part as a whole. The table's date is that of the
    time the rows are ordered by."""
    return since(table_scan(spark, path, schema), date_holding(spark, path, schema, n, where))


def recent_days(
    spark: SparkSession, path: str, schema: T.StructType, minutes: int, column: str = DATE
) -> DataFrame:
    """The part of the table that holds the last `minutes` before its newest time."""
    table, last = table_scan(spark, path, schema), newest_date(spark, path, column)
    if last is None:
        return table
    days = timedelta(days=-(-minutes // 1440))
    # The upper bound is no restriction on the rows; it lets a subquery for the newest time see that
    # its dates are known as well.
    return table.filter(F.col(column).between(last - days, last))


def newest_time(
    spark: SparkSession, path: str, schema: T.StructType, time: str = "event_ts", column: str = DATE
) -> Column:
    """The newest time as a scalar subquery over the newest date that holds rows."""
    last = date_holding(spark, path, schema, 1, F.col(time).isNotNull(), column)
    table = table_scan(spark, path, schema)
    part = table if last is None else table.filter(F.col(column) == last)
    return part.agg(F.max(time)).scalar()
