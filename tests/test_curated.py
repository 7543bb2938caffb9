"""Hand-made records, one per edge case."""

import json
import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from penstock.model import (
    ADDED_IN_V3,
    CURATED_TABLE,
    EVENT_FIELDS,
    EVENT_JSON,
    KPI_TABLE,
    RAW_TABLE,
    curated_from_wire,
    curated_to_wire,
    kpis_from_wire,
    kpis_to_wire,
)
from penstock.operators import curated, enrich, insight, raw
from penstock.sources.plants import PLANTS, PLANTS_V2, plant_dimension

GOOD = {
    "event_id": "itaipu-1-1",
    "timestamp_utc": "2024-05-01T10:00:00.250000+00:00",
    "simulacao_t": 1,
    "usina_id": "itaipu",
    "usina_nome": "Itaipu Binacional",
    "rio": "Rio Paraná",
    "uf": "PR",
    "num_unidades": 20,
    "potencia_instalada_mw": 14000,
    "status_operacional": "OPERANDO",
    "nivel_alerta": "NORMAL",
    "anomalia": False,
    "tipo_anomalia": None,
    "vazao_m3_s": 9000.0,
    "vazao_bruta_m3_s": 9000.0,
    "queda_bruta_m": 118.4,
    "pressao_carcaca_kpa": 829.64,
    "eficiencia": 0.93,
    "potencia_mw": 9721.9,
    "potencia_reativa_mvar": 3195.4,
    "fator_capacidade": 0.71,
    "rendimento_hidraulico": 0.93,
    "energia_incremental_mwh": 2.700528,
    "energia_acumulada_mwh": 2.7005,
    "chuva_mm_h": 4.2,
    "temperatura_turbina_c": 55.0,
    "vibracao_mm_s": 1.4,
    "oee": 0.69442,
    "heat_rate_kj_kwh": 3870.97,
    "indice_desgaste": 0.23,
    "densidade_agua_kg_m3": 1000.0,
    "gravidade_m_s2": 9.81,
    "metadata": {"fonte": "test", "versao": "3.0", "topico": "t"},
}


def frame(spark, values, keys=None):
    rows = [
        (b"itaipu", v.encode() if isinstance(v, str) else v, "t", 0, i, datetime(2024, 5, 1, 10))
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(
        rows, "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
    )


def event(**changes):
    return json.dumps({**GOOD, **changes}, ensure_ascii=False)


def one(df):
    (row,) = df.collect()
    return row


def test_good_record(spark):
    row = one(curated.curate(frame(spark, [event()])))
    assert row.plant_id == "itaipu" and row.river == "Rio Paraná"
    assert row.installed_mw == 14000.0
    assert row.event_ts == datetime(2024, 5, 1, 10, 0, 0, 250000)
    assert str(row.event_date) == "2024-05-01" and row.event_hour == 10
    assert row.relative_efficiency == 0.95876
    assert row.apparent_power_mva == round(math.sqrt(9721.9**2 + 3195.4**2), 4)
    assert row.power_factor == 0.95
    assert row.power_pct_capacity == 71.0
    assert row.efficiency_band == "ALTA"
    assert row.metadata.versao == "3.0"
    assert len(row) == 47


def test_timestamp_without_fraction(spark):
    row = one(curated.curate(frame(spark, [event(timestamp_utc="2024-05-01T10:00:00+00:00")])))
    assert row.event_ts == datetime(2024, 5, 1, 10)


@pytest.mark.parametrize(
    ("value", "reason"),
    [
        ("this is not json", "not JSON"),
        ("{}", "missing event id"),
        (None, "missing event id"),
        (event(usina_id=None), "missing plant"),
        (event(potencia_mw="oops"), "missing power"),
        (event(potencia_mw=-1.0), "negative power"),
        (event(eficiencia=None), "missing efficiency"),
        (event(timestamp_utc="soon"), "no event time"),
        (event(timestamp_utc=None), "no event time"),
    ],
)
def test_rejected(spark, value, reason):
    records = frame(spark, [value])
    assert curated.curate(records).count() == 0
    row = one(curated.quarantine(records))
    assert row.reason == reason
    assert row.raw_json == value


def test_every_record_is_kept_or_quarantined(spark):
    values = [event(), "x", event(potencia_mw=-3.0), event(extra=1), event(timestamp_utc="no")]
    records = frame(spark, values)
    kept = curated.curate(records).select("kafka_offset")
    left = curated.quarantine(records).select("kafka_offset")
    assert sorted(r[0] for r in kept.union(left).collect()) == list(range(len(values)))


def test_unknown_field_is_ignored_and_idle_plant_has_no_power_factor(spark):
    row = one(
        curated.curate(frame(spark, [event(new_field=1, potencia_mw=0, potencia_reativa_mvar=0)]))
    )
    assert row.power_mw == 0.0 and row.apparent_power_mva == 0.0 and row.power_factor is None


def test_wrong_type_is_null_only_there(spark):
    row = one(curated.curate(frame(spark, [event(oee="high", vazao_m3_s=7.0)])))
    assert row.oee is None and row.flow_m3_s == 7.0


def test_missing_measurements_are_normal(spark):
    row = one(
        curated.curate(
            frame(
                spark,
                [event(indice_desgaste=None, temperatura_turbina_c=None, vibracao_mm_s=None)],
            )
        )
    )
    assert (row.temperature_alert, row.vibration_alert, row.wear_alert) == ("NORMAL",) * 3


@pytest.mark.parametrize(
    ("field", "value", "column", "label"),
    [
        ("temperatura_turbina_c", 80.0, "temperature_alert", "CRITICO"),
        ("temperatura_turbina_c", 79.99, "temperature_alert", "ATENCAO"),
        ("temperatura_turbina_c", 72.0, "temperature_alert", "ATENCAO"),
        ("temperatura_turbina_c", 71.99, "temperature_alert", "NORMAL"),
        ("vibracao_mm_s", 4.5, "vibration_alert", "CRITICO"),
        ("vibracao_mm_s", 3.0, "vibration_alert", "ATENCAO"),
        ("indice_desgaste", 0.65, "wear_alert", "CRITICO"),
        ("indice_desgaste", 0.64, "wear_alert", "NORMAL"),
        ("eficiencia", 0.88, "efficiency_band", "ALTA"),
        ("eficiencia", 0.80, "efficiency_band", "MEDIA"),
        ("eficiencia", 0.79, "efficiency_band", "BAIXA"),
    ],
)
def test_thresholds_belong_to_the_higher_band(spark, field, value, column, label):
    assert one(curated.curate(frame(spark, [event(**{field: value})])))[column] == label


def test_anomaly_critical_is_three_valued(spark):
    values = [
        event(anomalia=a, nivel_alerta=n)
        for a, n in [(True, "CRITICO"), (True, "ATENCAO"), (False, None), (True, None)]
    ]
    rows = curated.curate(frame(spark, values)).orderBy("kafka_offset").collect()
    assert [r.is_anomaly_critical for r in rows] == [True, False, False, None]


def test_older_event_is_completed(spark):
    old = {k: v for k, v in GOOD.items() if k not in ADDED_IN_V3}
    parsed = curated.parse_events(frame(spark, [json.dumps(old)]))
    assert one(parsed).installed_mw is None
    full = one(
        enrich.derived_metrics(enrich.enrich_with_plant(parsed, plant_dimension(spark)))
    )
    assert full.installed_mw == 14000.0 and full.state == "PR" and full.unit_count == 20
    assert full.heat_rate_kj_kwh == 3870.97
    assert full.capacity_factor == 0.71  # given, not worked out again


def test_row_constants_win_over_settings(spark):
    parsed = curated.parse_events(frame(spark, [event(gravidade_m_s2=10.81, rendimento_hidraulico=None)]))
    joined = enrich.enrich_with_plant(parsed, plant_dimension(spark))
    row = one(enrich.derived_metrics(joined))
    assert row.hydraulic_yield == pytest.approx(9721.9 / (1000 * 10.81 * 9000 * 118.4 / 1e6), abs=1e-5)


def test_dedup_keeps_the_lowest_offset(spark):
    records = frame(spark, [event(potencia_mw=float(p)) for p in (5, 6, 7)])
    row = one(curated.dedup_events(curated.curate(records)))
    assert (row.kafka_offset, row.power_mw) == (0, 5.0)


def test_dedup_limits_before_the_shuffle(spark):
    unique = curated.dedup_events(curated.curate(frame(spark, [event()])))
    text = unique._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2


def test_text_is_parsed_once(spark):
    plan = curated.curate(frame(spark, [event()]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_raw_keeps_the_text_and_can_be_replayed(spark):
    records = frame(spark, [event(), "junk"])
    stored = raw.raw_project(records)
    assert stored.schema.names == RAW_TABLE.names
    assert [f.dataType for f in stored.schema] == [f.dataType for f in RAW_TABLE]
    again = curated.curate(raw.raw_as_frame(stored))
    assert again.exceptAll(curated.curate(records)).count() == 0


def test_keyed_json_round_trip(spark):
    parsed = curated.parse_events(frame(spark, [event()])).drop("kafka_offset")
    record = one(raw.keyed_json(parsed))
    assert bytes(record.key) == b"itaipu"
    assert json.loads(bytes(record.value)) == {
        k: (float(v) if k == "potencia_instalada_mw" else v) for k, v in GOOD.items() if v is not None
    }


def test_layer_schemas(spark):
    assert len(EVENT_FIELDS) == 33 and len(EVENT_JSON) == 33
    assert len(CURATED_TABLE) == 47 and len(KPI_TABLE) == 41
    built = curated.curate(frame(spark, [event()]))
    assert [(f.name, f.dataType) for f in built.schema] == [
        (f.name, f.dataType) for f in CURATED_TABLE
    ]


def test_wire_names_go_both_ways(spark):
    built = curated.curate(frame(spark, [event()]))
    wire = curated_to_wire(built)
    assert {"usina_id", "potencia_mw", "alerta_desgaste", "eficiencia_cat"} <= set(wire.columns)
    assert curated_from_wire(wire).columns == built.columns
    kpi = spark.createDataFrame([], KPI_TABLE)
    assert {"taxa_criticos_pct", "score_saude", "usina_nome"} <= set(kpis_to_wire(kpi).columns)
    assert kpis_from_wire(kpis_to_wire(kpi)).columns == kpi.columns


def test_plants(spark):
    assert plant_dimension(spark).count() == len(PLANTS) == 5
    old = plant_dimension(spark, PLANTS_V2)
    assert old.filter(F.col("installed_mw").isNull()).count() == len(PLANTS_V2) == 4


def test_anomaly_flag_as_text(spark):
    rows = spark.createDataFrame(
        [("a", "TRUE"), ("b", "true"), ("c", "1"), ("d", "0"), ("e", None), ("f", "no")],
        "event_id string, is_anomaly string",
    )
    kept = insight.anomaly_filter(rows).collect()
    assert sorted(r.event_id for r in kept) == ["a", "b", "c"]
