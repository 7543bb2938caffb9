"""What a plant has accumulated: energy, availability, maintenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from penstock.functions import machine
from penstock.model import MAINTENANCE
from penstock.operators import prefix

TIME_ORDER = ["event_ts", "event_id"]
STATUS_COLUMNS = ["plant_id", *TIME_ORDER, "status"]
RUN_START = ["start_ts", "start_id"]
# Border runs of so many days are joined in one task and passed on as one unit.
FAN = 64
PLANT = T.StructType([T.StructField("plant_id", T.StringType())])
SUMS = T.StructType(
    [
        T.StructField("cumulative_energy_mwh", T.DoubleType()),
        T.StructField("available_readings", T.LongType()),
        T.StructField("total_readings", T.LongType()),
    ]
)


# Running totals ---------------------------------------------------------------------------------


def energy_total() -> dict[str, Column]:
    return {"cumulative_energy_mwh": F.col("energy_mwh")}


def status_totals() -> dict[str, Column]:
    return {
        "available_readings": F.when(F.col("status") != MAINTENANCE, 1).otherwise(0),
        "total_readings": F.lit(1),
    }


def store_history(day: DataFrame, path: str, seconds: int = prefix.SECONDS) -> None:
    """Sums of energy and readings of whole days, for the running totals of later days.

    The job that closes a day calls it with that day's readings, each event once; a repair after
    late readings calls it again."""
    prefix.refresh_sums(day, path, ["plant_id"], energy_total() | status_totals(), seconds=seconds)


def stored_history(spark: SparkSession, path: str, until: Column | None = None) -> DataFrame:
    """What `store_history` wrote, up to a day if one is given."""
    return prefix.stored_sums(spark, path, PLANT, SUMS, until)


def running_energy(
    readings: DataFrame, sums: DataFrame | None = None, seconds: int = prefix.SECONDS
) -> DataFrame:
    """Cumulative energy of each plant after each reading.

    With `sums` (of `stored_history`, of the same `seconds`) the readings may be those of some days
    only; without, they are the whole history."""
    slim = readings.select("plant_id", *TIME_ORDER, "energy_mwh")
    return prefix.running_totals(slim, ["plant_id"], TIME_ORDER, energy_total(), sums, seconds)


def running_availability(
    readings: DataFrame,
    carry: list[str] = (),
    sums: DataFrame | None = None,
    seconds: int = prefix.SECONDS,
) -> DataFrame:
    """Share of the readings so far in which the plant was not in maintenance; `sums` as above."""
    slim = readings.select(*STATUS_COLUMNS, *carry)
    counted = prefix.running_totals(slim, ["plant_id"], TIME_ORDER, status_totals(), sums, seconds)
    return counted.withColumn(
        "availability", F.col("available_readings") / F.col("total_readings")
    )


def running_oee(
    readings: DataFrame, sums: DataFrame | None = None, seconds: int = prefix.SECONDS
) -> DataFrame:
    """OEE of each reading with the availability up to it; `sums` as above."""
    measured = running_availability(readings, ["power_mw", "installed_mw"], sums, seconds)
    return measured.withColumn(
        "oee", machine.oee(F.col("availability"), F.col("power_mw"), F.col("installed_mw"))
    )


# Maintenance ------------------------------------------------------------------------------------


def bucket_runs(readings: DataFrame, seconds: int = prefix.SECONDS) -> DataFrame:
    """Runs of consecutive readings in or out of maintenance, cut at the borders of time buckets.

    `unit` is the bucket; `start_ts` and `start_id` name a run by its first reading; `next_ts` is the
    first reading after it inside the bucket, null at its end; `first` and `last` mark the runs at
    the bucket's borders. Readings without a time take no part."""
    placed = prefix.bucketed(readings.select(*STATUS_COLUMNS), seconds=seconds).dropna(subset=["event_ts"])
    placed = placed.withColumnsRenamed({prefix.BUCKET: "unit"})
    place = ["plant_id", "unit"]
    line = Window.partitionBy(*place).orderBy(*TIME_ORDER)
    flagged = placed.withColumn(
        "maintenance", F.coalesce(F.col("status") == MAINTENANCE, F.lit(False))
    )
    same = F.col("maintenance") == F.lag("maintenance").over(line)
    numbered = flagged.withColumn("_new", F.when(same, 0).otherwise(1)).withColumn(
        "run", F.sum("_new").over(line)
    )
    runs = numbered.groupBy(*place, "run").agg(
        F.any_value("maintenance").alias("maintenance"),
        F.min("event_ts").alias("start_ts"),
        F.min_by("event_id", F.struct(*TIME_ORDER)).alias("start_id"),
        F.max("event_ts").alias("end_ts"),
        F.count(F.lit(1)).alias("readings"),
    )
    by_run = Window.partitionBy(*place).orderBy("run")
    return runs.withColumns(
        {
            "next_ts": F.lead("start_ts").over(by_run),
            "first": F.lag("run").over(by_run).isNull(),
            "last": F.lead("run").over(by_run).isNull(),
        }
    ).drop("run")


def merge_runs(runs: DataFrame, fan: int | None) -> DataFrame:
    """The same for units `fan` times as wide, or for all time: runs that touch at the borders of the
    units put together become one.

    The summary of a unit is its first and last run; what lies between them is closed and only passed
    on. Summaries can be joined in any grouping, so a task holds at most 2 * `fan` rows of a plant."""
    wider = F.lit(0).cast("long") if fan is None else F.expr(f"cast(floor(unit / {fan}) as long)")
    border = F.col("first") | F.col("last")
    # A closed run stays in a place of its own, so that one pass over the runs does for both.
    own = F.when(~border, F.struct(*RUN_START))
    placed = runs.filter(border | F.col("maintenance")).withColumns(
        {"_wide": wider, "_border": border, "_own": own}
    )
    place = ["plant_id", "_wide", "_own"]
    line = Window.partitionBy(*place).orderBy("unit", *RUN_START)
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    goes_on = (F.col("maintenance") == F.lag("maintenance").over(line)) & (
        F.lag("unit").over(line) != F.col("unit")
    )
    numbered = placed.withColumns(
        {
            "_new": F.when(goes_on, 0).otherwise(1),
            # At a unit's end the next reading is the first of the next unit.
            "_next": F.coalesce(F.col("next_ts"), F.lead("start_ts").over(line)),
            "_first": F.col("_border") & (F.row_number().over(line) == 1),
            "_last": F.col("_border") & (F.row_number().over(line) == F.count(F.lit(1)).over(whole)),
        }
    ).withColumn("_episode", F.sum("_new").over(line))
    merged = numbered.groupBy(*place, "_episode").agg(
        F.any_value("maintenance").alias("maintenance"),
        F.min("start_ts").alias("start_ts"),
        F.min_by("start_id", F.struct("unit", *RUN_START)).alias("start_id"),
        F.max("end_ts").alias("end_ts"),
        F.sum("readings").alias("readings"),
        F.max_by("_next", F.struct("unit", *RUN_START)).alias("next_ts"),
        F.max("_first").alias("first"),
        F.max("_last").alias("last"),
    )
    return merged.withColumnRenamed("_wide", "unit").drop("_own", "_episode")


def day_runs(readings: DataFrame, seconds: int = prefix.SECONDS) -> DataFrame:
    """Runs cut at midnight (UTC) only: those of one day do not depend on another day's readings."""
    return merge_runs(bucket_runs(readings, seconds), 86_400 // seconds)


def join_runs(runs: DataFrame) -> DataFrame:
    """Maintenance episodes out of `day_runs`, joined level by level: 64 days, then all of those (at
    most two rows for each 64 days of a plant's life)."""
    for fan in (FAN, None):
        runs = merge_runs(runs, fan)
    return runs.filter("maintenance").select(
        "plant_id", "start_ts", "end_ts", F.col("next_ts").alias("resumed_ts"), "readings"
    )


def maintenance_episodes(readings: DataFrame, seconds: int = prefix.SECONDS) -> DataFrame:
    """Unbroken runs of maintenance per plant.

    `end_ts` is the last reading of the run, `resumed_ts` the first one after it, null while the
    plant is still in maintenance.
    """
    return join_runs(day_runs(readings, seconds))


def maintenance_seconds(episodes: DataFrame, minutes: int = 60) -> DataFrame:
    """Seconds in maintenance per plant and window.

    A plant is in maintenance from the first such reading until the next reading of another
    status, or until its last reading. Time is cut at window borders.
    """
    width = F.expr(f"INTERVAL {minutes} MINUTES")
    until = F.coalesce(F.col("resumed_ts"), F.col("end_ts"))
    spans = episodes.select("plant_id", "start_ts", until.alias("until_ts"))
    starts = F.sequence(
        F.window("start_ts", f"{minutes} minutes")["start"], F.col("until_ts"), width
    )
    parts = spans.withColumn("window_start", F.explode(starts))
    upper = F.least(F.col("until_ts"), F.col("window_start") + width)
    lower = F.greatest(F.col("start_ts"), F.col("window_start"))
    micros = F.unix_micros(upper) - F.unix_micros(lower)
    summed = parts.withColumn("_micros", micros).groupBy("plant_id", "window_start")
    return summed.agg((F.sum("_micros") / 1e6).alias("maintenance_seconds")).filter(
        "maintenance_seconds > 0"
    )
