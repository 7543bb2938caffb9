"""Schemas of the layers and the names they have on the wire."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# --- Fixed values: event fields as they travel in JSON (generation 3.0) -------------------------
# wire name, column name, Spark type
EVENT_FIELDS = [
    ("event_id", "event_id", "string"),
    ("timestamp_utc", "timestamp_utc", "string"),
    ("simulacao_t", "sim_step", "int"),
    ("usina_id", "plant_id", "string"),
    ("usina_nome", "plant_name", "string"),
    ("rio", "river", "string"),
    ("uf", "state", "string"),
    ("num_unidades", "unit_count", "int"),
    ("potencia_instalada_mw", "installed_mw", "double"),
    ("status_operacional", "status", "string"),
    ("nivel_alerta", "alert_level", "string"),
    ("anomalia", "is_anomaly", "boolean"),
    ("tipo_anomalia", "anomaly_kind", "string"),
    ("vazao_m3_s", "flow_m3_s", "double"),
    ("vazao_bruta_m3_s", "gross_flow_m3_s", "double"),
    ("queda_bruta_m", "head_m", "double"),
    ("pressao_carcaca_kpa", "casing_pressure_kpa", "double"),
    ("eficiencia", "efficiency", "double"),
    ("potencia_mw", "power_mw", "double"),
    ("potencia_reativa_mvar", "reactive_power_mvar", "double"),
    ("fator_capacidade", "capacity_factor", "double"),
    ("rendimento_hidraulico", "hydraulic_yield", "double"),
    ("energia_incremental_mwh", "energy_mwh", "double"),
    ("energia_acumulada_mwh", "cumulative_energy_mwh", "double"),
    ("chuva_mm_h", "rain_mm_h", "double"),
    ("temperatura_turbina_c", "turbine_temp_c", "double"),
    ("vibracao_mm_s", "vibration_mm_s", "double"),
    ("oee", "oee", "double"),
    ("heat_rate_kj_kwh", "heat_rate_kj_kwh", "double"),
    ("indice_desgaste", "wear_index", "double"),
    ("densidade_agua_kg_m3", "water_density_kg_m3", "double"),
    ("gravidade_m_s2", "gravity_m_s2", "double"),
    ("metadata", "metadata", "metadata"),
]

# Fields that generation 2.0 events do not carry.
ADDED_IN_V3 = [
    "uf",
    "num_unidades",
    "potencia_instalada_mw",
    "pressao_carcaca_kpa",
    "potencia_reativa_mvar",
    "rendimento_hidraulico",
    "oee",
    "heat_rate_kj_kwh",
    "indice_desgaste",
]

# Columns that curation adds: wire name, column name, Spark type
CURATED_FIELDS = [
    ("kafka_offset", "kafka_offset", "bigint"),
    ("event_ts", "event_ts", "timestamp"),
    ("event_date", "event_date", "date"),
    ("event_hour", "event_hour", "int"),
    ("eficiencia_relativa", "relative_efficiency", "double"),
    ("potencia_aparente_mva", "apparent_power_mva", "double"),
    ("fator_potencia_calculado", "power_factor", "double"),
    ("potencia_perdida_estimada_mw", "power_loss_mw", "double"),
    ("is_anomaly_critical", "is_anomaly_critical", "boolean"),
    ("eficiencia_cat", "efficiency_band", "string"),
    ("potencia_pct_cap", "power_pct_capacity", "double"),
    ("alerta_temperatura", "temperature_alert", "string"),
    ("alerta_vibracao", "vibration_alert", "string"),
    ("alerta_desgaste", "wear_alert", "string"),
]

# Window KPIs: wire name, column name, aggregate, source column
KPI_AGGREGATES = [
    ("total_eventos", "event_count", "rows", None),
    ("potencia_media_mw", "power_avg_mw", "avg", "power_mw"),
    ("potencia_max_mw", "power_max_mw", "max", "power_mw"),
    ("potencia_min_mw", "power_min_mw", "min", "power_mw"),
    ("potencia_stddev_mw", "power_stddev_mw", "stddev", "power_mw"),
    ("eficiencia_media", "efficiency_avg", "avg", "efficiency"),
    ("eficiencia_minima", "efficiency_min", "min", "efficiency"),
    ("eficiencia_relativa_media", "relative_efficiency_avg", "avg", "relative_efficiency"),
    ("oee_medio", "oee_avg", "avg", "oee"),
    ("oee_minimo", "oee_min", "min", "oee"),
    ("heat_rate_medio", "heat_rate_avg", "avg", "heat_rate_kj_kwh"),
    ("heat_rate_max", "heat_rate_max", "max", "heat_rate_kj_kwh"),
    ("desgaste_medio", "wear_avg", "avg", "wear_index"),
    ("desgaste_maximo", "wear_max", "max", "wear_index"),
    ("energia_gerada_mwh", "energy_mwh", "sum", "energy_mwh"),
    ("perda_media_mw", "power_loss_avg_mw", "avg", "power_loss_mw"),
    ("total_anomalias", "anomaly_count", "count_if", "is_anomaly"),
    ("total_manutencao", "maintenance_count", "count_if", "status = 'MANUTENCAO'"),
    ("total_criticos", "critical_count", "count_if", "alert_level = 'CRITICO'"),
    ("temperatura_max_c", "temperature_max_c", "max", "turbine_temp_c"),
    ("temperatura_media_c", "temperature_avg_c", "avg", "turbine_temp_c"),
    ("vibracao_max_mm_s", "vibration_max_mm_s", "max", "vibration_mm_s"),
    ("vibracao_media_mm_s", "vibration_avg_mm_s", "avg", "vibration_mm_s"),
    ("pressao_media_kpa", "casing_pressure_avg_kpa", "avg", "casing_pressure_kpa"),
    ("vazao_media_m3_s", "flow_avg_m3_s", "avg", "flow_m3_s"),
    ("vazao_max_m3_s", "flow_max_m3_s", "max", "flow_m3_s"),
    ("chuva_media_mm_h", "rain_avg_mm_h", "avg", "rain_mm_h"),
    ("chuva_max_mm_h", "rain_max_mm_h", "max", "rain_mm_h"),
    ("fator_capacidade_medio", "capacity_factor_avg", "avg", "capacity_factor"),
    ("potencia_pct_cap_media", "power_pct_capacity_avg", "avg", "power_pct_capacity"),
    ("fator_potencia_medio", "power_factor_avg", "avg", "power_factor"),
    ("potencia_reativa_media_mvar", "reactive_power_avg_mvar", "avg", "reactive_power_mvar"),
    ("primeiro_evento_ts", "first_event_ts", "min", "event_ts"),
    ("ultimo_evento_ts", "last_event_ts", "max", "event_ts"),
]

# KPI columns worked out after the aggregation: wire name, column name, Spark type
KPI_DERIVED = [
    ("taxa_criticos_pct", "critical_rate_pct", "double"),
    ("score_saude", "health_score", "double"),
    ("janela_minutos", "window_minutes", "int"),
    ("window_start", "window_start", "timestamp"),
    ("window_end", "window_end", "timestamp"),
]

MAINTENANCE, DEVIATION, RUNNING = "MANUTENCAO", "OPERANDO_COM_DESVIO", "OPERANDO"
CRITICAL, ATTENTION, NORMAL, INFO = "CRITICO", "ATENCAO", "NORMAL", "INFO"
# --- end of fixed values ------------------------------------------------------------------------


_TYPES = {
    "string": T.StringType(),
    "binary": T.BinaryType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "metadata": T.StructType(
        [T.StructField(name, T.StringType()) for name in ("fonte", "versao", "topico")]
    ),
}


def _schema(rows: list[tuple[str, str]]) -> T.StructType:
    """Built without a session; parsing a DDL text would need one."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in rows])


def _kpi_type(kind: str, source: str | None) -> str:
    if kind in ("rows", "count_if"):
        return "bigint"
    return "timestamp" if source == "event_ts" else "double"


RAW_FRAME = _schema(
    [
        ("key", "binary"),
        ("value", "binary"),
        ("topic", "string"),
        ("partition", "int"),
        ("offset", "bigint"),
        ("timestamp", "timestamp"),
    ]
)
RAW_TABLE = _schema(
    [
        ("raw_json", "string"),
        ("kafka_key", "string"),
        ("kafka_topic", "string"),
        ("kafka_partition", "int"),
        ("kafka_offset", "bigint"),
        ("kafka_timestamp", "timestamp"),
        ("ingest_date", "date"),
    ]
)
EVENT_JSON = _schema([(wire, kind) for wire, _, kind in EVENT_FIELDS])
CURATED_TABLE = _schema([(name, kind) for _, name, kind in EVENT_FIELDS + CURATED_FIELDS])
KPI_TABLE = _schema(
    [("plant_id", "string"), ("plant_name", "string")]
    + [(name, _kpi_type(kind, source)) for _, name, kind, source in KPI_AGGREGATES]
    + [(name, kind) for _, name, kind in KPI_DERIVED]
)
PLANT_TABLE = _schema(
    [
        ("plant_id", "string"),
        ("plant_name", "string"),
        ("river", "string"),
        ("state", "string"),
        ("installed_mw", "double"),
        ("head_m", "double"),
        ("max_flow_m3_s", "double"),
        ("base_efficiency", "double"),
        ("base_temp_c", "double"),
        ("base_vibration_mm_s", "double"),
        ("unit_count", "int"),
    ]
)

CURATED_WIRE = {name: wire for wire, name, _ in EVENT_FIELDS + CURATED_FIELDS}
KPI_WIRE = {"plant_id": "usina_id", "plant_name": "usina_nome"} | {
    row[1]: row[0] for row in KPI_AGGREGATES + KPI_DERIVED
}


def curated_to_wire(df: DataFrame) -> DataFrame:
    """Curated columns under the field names the events carry."""
    return df.withColumnsRenamed(CURATED_WIRE)


def curated_from_wire(df: DataFrame) -> DataFrame:
    """An existing curated table with wire names, under this package's column names."""
    return df.withColumnsRenamed({wire: name for name, wire in CURATED_WIRE.items()})


def kpis_to_wire(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(KPI_WIRE)


def kpis_from_wire(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({wire: name for name, wire in KPI_WIRE.items()})
