"""Running totals on sums of fixed time buckets.

A window over `partitionBy(plant)` puts the whole history of a plant into one task. Here time is cut
into buckets of `seconds`, the same for all data: the sums of a bucket depend on its own rows alone.
A running total starts in each bucket from the sums of the buckets before it: those of its day, and
those of the days before. So a plant with most of the rows is worked on in as many tasks as it has
buckets, nothing is sampled or checkpointed, and the sums can be stored: a day that is appended, or
changed by late rows, costs its own rows and the stored sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from penstock.streaming.sinks import BATCH, write_batch

SECONDS = 300
DAY = "day"
BUCKET = "bucket"


def bucketed(df: DataFrame, time: str = "event_ts", seconds: int = SECONDS) -> DataFrame:
    """With `day` (date) and `bucket` (buckets since 1970). `seconds` divides a day. Rows without a
    time have neither and come first, as nulls do in an ascending order."""
    return df.withColumns(
        {DAY: F.to_date(time), BUCKET: F.expr(f"cast(floor(unix_seconds({time}) / {seconds}) as long)")}
    )


def bucket_sums(
    df: DataFrame, keys: list[str], totals: dict[str, Column], time: str = "event_ts", seconds: int = SECONDS
) -> DataFrame:
    """keys, day, bucket and the sum of each total; combined before the shuffle."""
    named = df.select(*keys, time, *[c.alias(n) for n, c in totals.items()])
    sums = [F.sum(n).alias(n) for n in totals]
    return bucketed(named, time, seconds).groupBy(*keys, DAY, BUCKET).agg(*sums)


def starts(sums: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """The totals before each bucket. No window holds more than the buckets of a day or the days of a
    key."""
    rows = Window.unboundedPreceding
    in_day = Window.partitionBy(*keys, DAY).orderBy(BUCKET).rowsBetween(rows, -1)
    by_day = Window.partitionBy(*keys).orderBy(DAY).rowsBetween(rows, -1)
    days = sums.groupBy(*keys, DAY).agg(*[F.sum(n).alias(n) for n in names])
    days = days.select(
        *[F.col(k).alias(f"_{k}") for k in [*keys, DAY]],
        *[F.coalesce(F.sum(n).over(by_day), F.lit(0)).alias(f"_{n}") for n in names],
    )
    within = sums.select(
        *keys, DAY, BUCKET, *[F.coalesce(F.sum(n).over(in_day), F.lit(0)).alias(n) for n in names]
    )
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in [*keys, DAY]]
    both = within.join(days, same)
    return both.select(*keys, DAY, BUCKET, *[(F.col(n) + F.col(f"_{n}")).alias(n) for n in names])


def running_totals(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    totals: dict[str, Column],
    sums: DataFrame | None = None,
    seconds: int = SECONDS,
) -> DataFrame:
    """Running sums per key along `order`, whose first column is the time, as new columns.

    `sums` are those of `bucket_sums`, stored or not; they have to cover the rows of `df` and all
    earlier ones. Without them they are worked out from `df`."""
    names, time = list(totals), order[0]
    if sums is None:
        sums = bucket_sums(df, keys, totals, time, seconds)
    rows = bucketed(df.withColumns(totals), time, seconds).withColumn("_start", F.lit(False))
    first = starts(sums, keys, names).withColumn("_start", F.lit(True))
    inside = (
        Window.partitionBy(*keys, DAY, BUCKET)
        .orderBy(F.col("_start").desc(), *order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    both = rows.unionByName(first, allowMissingColumns=True)
    summed = both.withColumns({n: F.sum(n).over(inside) for n in names})
    return summed.filter(~F.col("_start")).select(*df.columns, *[n for n in names if n not in df.columns])


# A stored table of sums


def refresh_sums(
    df: DataFrame,
    path: str,
    keys: list[str],
    totals: dict[str, Column],
    time: str = "event_ts",
    seconds: int = SECONDS,
) -> None:
    """Put the sums of the days in `df` into the table at `path`, in place of what those days had.

    `df` holds all rows of its days. Doing it again changes nothing; other days are not read."""
    write_batch(bucket_sums(df, keys, totals, time, seconds), 0, path, [DAY], BUCKET)


def stored_sums(spark: SparkSession, path: str, keys: T.StructType, totals: T.StructType, until: Column | None = None) -> DataFrame:
    """The table of sums, up to a day if one is given."""
    fields = [*keys.fields, T.StructField(BUCKET, T.LongType()), *totals.fields, T.StructField(DAY, T.DateType())]
    table = spark.read.schema(T.StructType([*fields, T.StructField(BATCH, T.LongType())])).parquet(path).drop(BATCH)
    return table if until is None else table.filter(F.col(DAY) <= until)
