"""Curated layer: typed, checked, timed and flagged readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from penstock.functions import alerts, performance
from penstock.model import CURATED_TABLE, EVENT_JSON, curated_from_wire
from penstock.settings import LIMITS, Limits


def parse_json(frame: DataFrame, schema: T.StructType, keep: list[str] = ()) -> DataFrame:
    """Fields of the JSON in `value` as columns, next to the log columns to keep.

    Text that is no JSON gives a row of nulls, a field of the wrong type is null by itself,
    unknown fields are dropped, and fields the text lacks are null.

    The fields come out of inline() and not out of a struct column: a later filter on them would
    be pushed below the struct's projection and parse the text again for each field it names.
    """
    event = F.from_json(F.col("value").cast("string"), schema)
    return frame.select(F.inline(F.array(event)), *keep)


def parse_events(frame: DataFrame, keep_raw: bool = False) -> DataFrame:
    """Log records as typed event columns; with the text itself if asked for."""
    kept = frame.withColumn("kafka_offset", F.col("offset"))
    if keep_raw:
        kept = kept.withColumn("raw_json", F.col("value").cast("string"))
    keep = ["kafka_offset", "raw_json"] if keep_raw else ["kafka_offset"]
    return curated_from_wire(parse_json(kept, EVENT_JSON, keep))


def parse_variant(frame: DataFrame) -> DataFrame:
    """Log records as typed event columns, with what the schema has no place for.

    `json_error` says why a record gave no event (see `json_error`), and `unknown_fields` maps the
    fields that the schema does not name to their JSON text, so that a later generation of events
    loses nothing. A field of the wrong type is null by itself. The text is parsed once, to VARIANT."""
    text = F.col("value").cast("string")
    once = F.inline(F.array(F.struct(text.alias("_text"), F.try_parse_json(text).alias("_json"))))
    parsed = frame.select(F.col("offset").alias("kafka_offset"), once)
    fields = [
        F.try_variant_get("_json", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in EVENT_JSON
    ]
    known = F.array(*[F.lit(name) for name in EVENT_JSON.names])
    others = F.map_filter(
        F.try_variant_get("_json", "$", "map<string,variant>"), lambda k, _: ~F.array_contains(known, k)
    )
    events = parsed.select(
        *fields,
        "kafka_offset",
        json_error(F.col("_text"), F.col("_json")).alias("json_error"),
        F.transform_values(others, lambda _, v: F.to_json(v)).alias("unknown_fields"),
    )
    return curated_from_wire(events)


def json_error(text: Column, parsed: Column | None = None) -> Column:
    """Why a text gives no event at all; null where it holds a JSON object."""
    value = F.try_parse_json(text) if parsed is None else parsed
    return (
        F.when(text.isNull() | (F.trim(text) == ""), "empty record")
        .when(value.isNull(), "not JSON")
        .when(F.try_variant_get(value, "$", "map<string,variant>").isNull(), "no JSON object")
    )


def event_time(df: DataFrame) -> DataFrame:
    return df.withColumn("event_ts", F.try_to_timestamp(F.col("timestamp_utc")))


def reject_reason(check_time: bool = False) -> Column:
    """Why a reading is not fit for use; null for a good one."""
    power = F.col("power_mw")
    reason = (
        F.when(F.col("event_id").isNull(), "missing event id")
        .when(F.col("plant_id").isNull(), "missing plant")
        .when(power.isNull(), "missing power")
        .when(power < 0, "negative power")
        .when(F.col("efficiency").isNull(), "missing efficiency")
    )
    if check_time:
        reason = reason.when(F.col("event_ts").isNull(), "no event time")
    return reason


def quality_filter(df: DataFrame) -> DataFrame:
    """The usable readings. Written as plain predicates, so a table scan can use them."""
    return df.filter(
        F.col("event_id").isNotNull()
        & F.col("plant_id").isNotNull()
        & F.col("power_mw").isNotNull()
        & (F.col("power_mw") >= 0)
        & F.col("efficiency").isNotNull()
    )


def quality_rejects(df: DataFrame, check_time: bool = False) -> DataFrame:
    return df.withColumn("reason", reject_reason(check_time)).filter(F.col("reason").isNotNull())


def quality_split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable readings with a known time, and the rest with the reason."""
    usable = quality_filter(df).filter(F.col("event_ts").isNotNull())
    return usable, quality_rejects(df, check_time=True)


def calendar_columns(df: DataFrame) -> DataFrame:
    return df.withColumns({"event_date": F.to_date("event_ts"), "event_hour": F.hour("event_ts")})


def performance_columns(df: DataFrame) -> DataFrame:
    c = F.col
    sized = df.withColumns(
        {
            "relative_efficiency": performance.relative_efficiency(c("efficiency")),
            "apparent_power_mva": performance.apparent_power(
                c("power_mw"), c("reactive_power_mvar")
            ),
            "power_loss_mw": performance.power_loss(
                c("water_density_kg_m3"),
                c("gravity_m_s2"),
                c("flow_m3_s"),
                c("head_m"),
                c("efficiency"),
            ),
        }
    )
    return sized.withColumn(
        "power_factor", performance.power_factor(c("power_mw"), c("apparent_power_mva"))
    )


def alert_flags(df: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    c = F.col
    return df.withColumns(
        {
            "is_anomaly_critical": alerts.is_anomaly_critical(c("is_anomaly"), c("alert_level")),
            "efficiency_band": alerts.efficiency_band(c("efficiency")),
            "power_pct_capacity": alerts.power_pct_capacity(c("capacity_factor")),
            "temperature_alert": alerts.temperature_alert(c("turbine_temp_c"), limits),
            "vibration_alert": alerts.vibration_alert(c("vibration_mm_s"), limits),
            "wear_alert": alerts.wear_alert(c("wear_index"), limits),
        }
    )


def derive_columns(usable: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Calendar, performance and alert columns, in the order of the curated table."""
    flagged = alert_flags(performance_columns(calendar_columns(usable)), limits)
    return flagged.select(*CURATED_TABLE.names)


def curate(frame: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Log frame to curated rows. Narrow: one stage, no shuffle, for tables and streams."""
    usable, _ = quality_split(event_time(parse_events(frame)))
    return derive_columns(usable, limits)


def quarantine(frame: DataFrame) -> DataFrame:
    """The records curation leaves out, with their text and the reason."""
    _, rejected = quality_split(event_time(parse_events(frame, keep_raw=True)))
    # Only the rejected texts are looked at again; a record without text misses its id.
    text = F.col("raw_json")
    reason = F.coalesce(F.when(text.isNotNull(), json_error(text)), F.col("reason"))
    return rejected.select("kafka_offset", "raw_json", reason.alias("reason"))


def dedup_events(df: DataFrame, key: str = "event_id", first_by: str = "kafka_offset") -> DataFrame:
    """One row per key, the one that came first. Repeats of one offset, as two partitions of the log
    can have, are settled by event time and plant where the rows have them.

    The rank limit runs before the shuffle too, so copies of one event are dropped where they
    are read and a key with very many copies does not fill one task.
    """
    ties = [c for c in ("event_ts", "plant_id") if c in df.columns]
    order = Window.partitionBy(key).orderBy(F.col(first_by).asc_nulls_last(), *ties)
    return df.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def dedup_stream(df: DataFrame, watermark: str, key: str = "event_id") -> DataFrame:
    return df.withWatermark("event_ts", watermark).dropDuplicatesWithinWatermark([key])
