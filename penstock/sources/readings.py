"""Plant readings out of a generic `events` table (event_id, ts, user_id, event_type, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from penstock.model import ADDED_IN_V3, EVENT_FIELDS
from penstock.operators.curated import derive_columns, quality_filter
from penstock.operators.enrich import derived_metrics
from penstock.operators.raw import keyed_json
from penstock.settings import LIMITS, Limits

# Made-up plants for the adapter; not those of the plant dimension. The SQL check formats the same list.
ADAPTER_PLANTS = [
    ("plant_0", "North", "River A", "AA", 900.0, 90.0, 1100.0, 0.94, 48.0, 1.1, 6),
    ("plant_1", "South", "River B", "BB", 600.0, 64.0, 1000.0, 0.93, 51.0, 1.3, 5),
    ("plant_2", "East", "River C", "CC", 420.0, 130.0, 350.0, 0.92, 53.0, 1.2, 4),
    ("plant_3", "West", "River D", "DD", 280.0, 22.0, 1400.0, 0.91, 50.0, 1.7, 8),
    ("plant_4", "Delta", "River D", "DD", 120.0, 14.0, 900.0, 0.9, 49.0, 1.9, 3),
]


def adapter_plants(spark: SparkSession) -> DataFrame:
    names = (
        "plant_id, plant_name, river, state, installed_mw, head_m, max_flow_m3_s,"
        " base_efficiency, base_temp_c, base_vibration_mm_s, unit_count"
    )
    rows = ", ".join(
        "({})".format(", ".join(f"{x}D" if isinstance(x, float) else repr(x) for x in plant))
        for plant in ADAPTER_PLANTS
    )
    return spark.sql(f"SELECT * FROM VALUES {rows} AS p({names})")


def measured(events: DataFrame) -> DataFrame:
    """What the machine reports, before anything about the plant is known."""
    seq = F.col("event_id")
    status = (
        F.when(F.col("event_type") == "signup", "MANUTENCAO")
        .when(F.col("event_type") == "error", "OPERANDO_COM_DESVIO")
        .otherwise("OPERANDO")
    )
    return events.select(
        seq.cast("string").alias("event_id"),
        seq.alias("seq"),
        F.col("ts").cast("timestamp").alias("event_ts"),
        F.concat(F.lit("plant_"), (F.col("user_id") % 5).cast("string")).alias("plant_id"),
        status.alias("status"),
        (F.col("event_type") == "error").alias("is_anomaly"),
        F.col("value"),
    )


def readings_from(events: DataFrame, plants: DataFrame) -> DataFrame:
    """Readings with plant attributes. Some have no temperature, some an invalid power."""
    seq = F.col("seq")
    resting = F.col("status") == "MANUTENCAO"
    load = (seq % 50).cast("double") / 100.0 + 0.40
    shown = measured(events).join(plants, "plant_id").withColumns(
        {
            "flow_m3_s": F.when(resting, 0.0).otherwise(F.col("max_flow_m3_s") * load),
            "efficiency": F.when(resting, 0.0).otherwise((seq % 28 + 70).cast("double") / 100.0),
            "turbine_temp_c": F.when(seq % 97 != 0, F.col("value") * 0.1 + 50.0),
            "vibration_mm_s": (seq % 50 + 10).cast("double") / 10.0,
            "rain_mm_h": (seq % 300).cast("double") / 10.0,
        }
    )
    power = F.col("efficiency") * 1000.0 * 9.81 * F.col("flow_m3_s") * F.col("head_m") / 1000000.0
    return shown.withColumn("power_mw", F.when(seq % 211 == 0, -1.0).otherwise(power))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_from(spark.read.parquet(f"{sf_dir}/events.parquet"), adapter_plants(spark))


def with_metrics(source: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Readings with all per-reading metrics and the remaining event fields."""
    return derived_metrics(source, limits).withColumns(
        {
            "timestamp_utc": F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"),
            "sim_step": F.col("seq").cast("int"),
            "gross_flow_m3_s": F.col("flow_m3_s"),
            "anomaly_kind": F.when(F.col("is_anomaly"), "VIBRACAO_ALTA"),
            "cumulative_energy_mwh": F.lit(None).cast("double"),
            "metadata": event_metadata("3.0"),
            "kafka_offset": F.col("seq"),
        }
    )


def metered(source: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    return with_metrics(quality_filter(source), limits)


def curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_columns(metered(readings(spark, sf_dir)))


def event_metadata(version: str) -> Column:
    return F.struct(
        F.lit("events").alias("fonte"),
        F.lit(version).alias("versao"),
        F.lit("readings").alias("topico"),
    )


def event_frame(source: DataFrame, version: str = "3.0") -> DataFrame:
    """Readings as log records: JSON of the given event generation, in the log's columns."""
    events = with_metrics(source).withColumn("metadata", event_metadata(version))
    left_out = ADDED_IN_V3 if version == "2.0" else []
    fields = [name for wire, name, _ in EVENT_FIELDS if wire not in left_out]
    records = keyed_json(events.select(*fields, "seq", "event_ts"), keep=["seq", "event_ts"])
    return records.select(
        "key",
        "value",
        F.lit("readings").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("seq").alias("offset"),
        F.col("event_ts").alias("timestamp"),
    )
