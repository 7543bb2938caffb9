"""The registered queries once more, in plain SQL for another engine.

Written out by hand from the definitions, not generated from the operators, so that the two can
be held against each other.
"""

from __future__ import annotations

from penstock.model import ADDED_IN_V3, CURATED_TABLE, EVENT_FIELDS
from penstock.sources.readings import ADAPTER_PLANTS


def rounded(expression: str, digits: int) -> str:
    """Half-up rounding of a double's shortest decimal form."""
    return f"CAST(CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38,{digits})) AS DOUBLE)"


def settled(expression: str, digits: int = 6) -> str:
    """Rounding to 10 digits, which removes summation noise, and then to `digits`."""
    return (
        f"CAST(CAST(CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38,10))"
        f" AS DECIMAL(38,{digits})) AS DOUBLE)"
    )


def settled_list(*names: str, digits: int = 6) -> str:
    return ", ".join(f"{settled(name, digits)} AS {name}" for name in names)


PLANT_VALUES = ", ".join(
    "({})".format(", ".join(f"{x}e0" if isinstance(x, float) else repr(x) for x in plant[:8] + plant[10:]))
    for plant in ADAPTER_PLANTS
)

PLANTS = f"""
plants AS (SELECT * FROM (VALUES {PLANT_VALUES})
  AS p(plant_id, plant_name, river, state, installed_mw, head_m, max_flow_m3_s, base_efficiency, unit_count))
"""

MEASURED = f"""
WITH {PLANTS},
measured AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, event_id AS seq, ts AS event_ts,
    concat('plant_', CAST(user_id % 5 AS VARCHAR)) AS plant_id,
    CASE event_type WHEN 'signup' THEN 'MANUTENCAO' WHEN 'error' THEN 'OPERANDO_COM_DESVIO'
      ELSE 'OPERANDO' END AS status,
    event_type = 'error' AS is_anomaly, value
  FROM events)
"""

READINGS = f"""{MEASURED},
sized AS (
  SELECT m.*, plant_name, river, state, unit_count, installed_mw, head_m,
    max_flow_m3_s, base_efficiency,
    CASE WHEN status = 'MANUTENCAO' THEN 0e0
      ELSE max_flow_m3_s * (0.40e0 + CAST(seq % 50 AS DOUBLE) / 100e0) END AS flow_m3_s,
    CASE WHEN status = 'MANUTENCAO' THEN 0e0
      ELSE CAST(70 + seq % 28 AS DOUBLE) / 100e0 END AS efficiency,
    CASE WHEN seq % 97 = 0 THEN NULL ELSE 50e0 + value * 0.1e0 END AS turbine_temp_c,
    CAST(10 + seq % 50 AS DOUBLE) / 10e0 AS vibration_mm_s,
    CAST(seq % 300 AS DOUBLE) / 10e0 AS rain_mm_h
  FROM measured m JOIN plants ON m.plant_id = plants.plant_id),
readings AS (
  SELECT *, CASE WHEN seq % 211 = 0 THEN -1e0
    ELSE efficiency * 1000e0 * 9.81e0 * flow_m3_s * head_m / 1000000e0 END AS power_mw
  FROM sized),
usable AS (
  SELECT * FROM readings
  WHERE event_id IS NOT NULL AND plant_id IS NOT NULL AND power_mw >= 0
    AND efficiency IS NOT NULL)
"""

# tan(acos(0.95)) as a double
REACTIVE_FACTOR = "0.3286841051788632e0"


def alert_level(temp_critical: str, temp_attention: str, efficiency_attention: str) -> str:
    return f"""CASE WHEN status = 'MANUTENCAO' THEN 'INFO'
    WHEN is_anomaly OR turbine_temp_c >= {temp_critical} OR vibration_mm_s >= 4.5e0
      OR efficiency < 0.75e0 THEN 'CRITICO'
    WHEN turbine_temp_c >= {temp_attention} OR vibration_mm_s >= 3e0
      OR efficiency < {efficiency_attention} THEN 'ATENCAO'
    ELSE 'NORMAL' END"""


METERED = f"""{READINGS},
water AS (
  SELECT *, 1000e0 * 9.81e0 * flow_m3_s * head_m / 1000000e0 AS water_mw,
    {rounded("base_efficiency * 1000e0 * 9.81e0 * max_flow_m3_s * head_m / 1000000e0", 4)}
      AS full_load_mw
  FROM usable),
metered AS (
  SELECT *,
    {rounded("power_mw / full_load_mw", 5)} AS capacity_factor,
    {rounded("power_mw * (1e0 / 3600e0)", 6)} AS energy_mwh,
    {rounded(f"power_mw * {REACTIVE_FACTOR}", 4)} AS reactive_power_mvar,
    CASE WHEN water_mw <= 0 THEN 0e0
      ELSE {rounded("least(1e0, power_mw / nullif(water_mw, 0e0))", 5)} END AS hydraulic_yield,
    CASE WHEN efficiency <= 0 THEN 0e0
      ELSE {rounded("3600e0 / nullif(efficiency, 0e0)", 2)} END AS heat_rate_kj_kwh,
    CASE WHEN turbine_temp_c IS NULL OR vibration_mm_s IS NULL THEN NULL ELSE
      {rounded('''least(1e0, 0.60e0 * least(1e0, vibration_mm_s / 4.5e0)
        + 0.40e0 * least(1e0, greatest(0e0, (turbine_temp_c - 50e0) / 40e0))
        + CASE WHEN is_anomaly THEN 0.15e0 ELSE 0e0 END)''', 5)} END AS wear_index,
    {rounded("1000e0 * 9.81e0 * head_m * (flow_m3_s / max_flow_m3_s) / 1000e0", 2)}
      AS casing_pressure_kpa,
    {rounded("1e0 * least(1e0, power_mw / installed_mw)", 5)} AS oee,
    {alert_level("80e0", "72e0", "0.83e0")} AS alert_level,
    strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS timestamp_utc,
    CAST(seq AS INTEGER) AS sim_step, seq AS kafka_offset, flow_m3_s AS gross_flow_m3_s,
    CASE WHEN is_anomaly THEN 'VIBRACAO_ALTA' END AS anomaly_kind,
    CAST(NULL AS DOUBLE) AS cumulative_energy_mwh, 1000e0 AS water_density_kg_m3,
    9.81e0 AS gravity_m_s2, 'events/3.0/readings' AS metadata
  FROM water)
"""

CURATED = f"""{METERED},
powered AS (
  SELECT *,
    {rounded("efficiency / 0.97e0", 5)} AS relative_efficiency,
    {rounded("sqrt(power_mw * power_mw + reactive_power_mvar * reactive_power_mvar)", 4)}
      AS apparent_power_mva,
    {rounded("water_mw * (1e0 - efficiency)", 4)} AS power_loss_mw,
    CAST(CAST(event_ts AS DATE) AS VARCHAR) AS event_date,
    CAST(hour(event_ts) AS INTEGER) AS event_hour
  FROM metered),
curated AS (
  SELECT *,
    CASE WHEN apparent_power_mva > 0
      THEN {rounded("power_mw / nullif(apparent_power_mva, 0e0)", 5)} END AS power_factor,
    is_anomaly AND alert_level = 'CRITICO' AS is_anomaly_critical,
    CASE WHEN efficiency >= 0.88e0 THEN 'ALTA' WHEN efficiency >= 0.80e0 THEN 'MEDIA'
      ELSE 'BAIXA' END AS efficiency_band,
    {rounded("capacity_factor * 100e0", 2)} AS power_pct_capacity,
    CASE WHEN turbine_temp_c >= 80 THEN 'CRITICO' WHEN turbine_temp_c >= 72 THEN 'ATENCAO'
      ELSE 'NORMAL' END AS temperature_alert,
    CASE WHEN vibration_mm_s >= 4.5e0 THEN 'CRITICO' WHEN vibration_mm_s >= 3 THEN 'ATENCAO'
      ELSE 'NORMAL' END AS vibration_alert,
    CASE WHEN wear_index >= 0.65e0 THEN 'CRITICO' ELSE 'NORMAL' END AS wear_alert
  FROM powered)
"""

PERFORMANCE = ["relative_efficiency", "apparent_power_mva", "power_factor", "power_loss_mw"]
FLAGS = [
    "is_anomaly_critical",
    "efficiency_band",
    "power_pct_capacity",
    "temperature_alert",
    "vibration_alert",
    "wear_alert",
]
METRICS = [
    "capacity_factor",
    "energy_mwh",
    "reactive_power_mvar",
    "hydraulic_yield",
    "heat_rate_kj_kwh",
    "wear_index",
    "casing_pressure_kpa",
    "oee",
    "alert_level",
]


def with_kpis(minutes: int, name: str = "kpis", base: str = CURATED) -> str:
    """CTEs ending in a table of window KPIs with unrounded averages."""
    return f"""{base},
{name}_sums AS (
  SELECT time_bucket(INTERVAL '{minutes} minutes', event_ts) AS window_start, plant_id, plant_name,
    count(*) AS event_count,
    avg(power_mw) AS power_avg_mw, max(power_mw) AS power_max_mw, min(power_mw) AS power_min_mw,
    stddev_samp(power_mw) AS power_stddev_mw,
    avg(efficiency) AS efficiency_avg, min(efficiency) AS efficiency_min,
    avg(relative_efficiency) AS relative_efficiency_avg,
    avg(oee) AS oee_avg, min(oee) AS oee_min,
    avg(heat_rate_kj_kwh) AS heat_rate_avg, max(heat_rate_kj_kwh) AS heat_rate_max,
    avg(wear_index) AS wear_avg, max(wear_index) AS wear_max,
    sum(energy_mwh) AS energy_mwh, avg(power_loss_mw) AS power_loss_avg_mw,
    count(*) FILTER (WHERE is_anomaly) AS anomaly_count,
    count(*) FILTER (WHERE status = 'MANUTENCAO') AS maintenance_count,
    count(*) FILTER (WHERE alert_level = 'CRITICO') AS critical_count,
    max(turbine_temp_c) AS temperature_max_c, avg(turbine_temp_c) AS temperature_avg_c,
    max(vibration_mm_s) AS vibration_max_mm_s, avg(vibration_mm_s) AS vibration_avg_mm_s,
    avg(casing_pressure_kpa) AS casing_pressure_avg_kpa,
    avg(flow_m3_s) AS flow_avg_m3_s, max(flow_m3_s) AS flow_max_m3_s,
    avg(rain_mm_h) AS rain_avg_mm_h, max(rain_mm_h) AS rain_max_mm_h,
    avg(capacity_factor) AS capacity_factor_avg,
    avg(power_pct_capacity) AS power_pct_capacity_avg, avg(power_factor) AS power_factor_avg,
    avg(reactive_power_mvar) AS reactive_power_avg_mvar,
    min(event_ts) AS first_event_ts, max(event_ts) AS last_event_ts
  FROM curated GROUP BY 1, 2, 3),
{name}_rated AS (
  SELECT *, {rounded("critical_count * 100e0 / event_count", 2)} AS critical_rate_pct
  FROM {name}_sums),
{name} AS (
  SELECT *, {settled('''oee_avg * 0.40e0 + relative_efficiency_avg * 0.30e0
      + (1e0 - wear_avg) * 0.20e0 + (1e0 - least(1e0, critical_rate_pct / 100e0)) * 0.10e0''', 5)}
      AS health_score,
    CAST({minutes} AS INTEGER) AS window_minutes,
    window_start + INTERVAL '{minutes} minutes' AS window_end
  FROM {name}_rated)
"""


KPI_DOUBLES = """power_avg_mw power_max_mw power_min_mw power_stddev_mw efficiency_avg
efficiency_min relative_efficiency_avg oee_avg oee_min heat_rate_avg heat_rate_max wear_avg
wear_max energy_mwh power_loss_avg_mw temperature_max_c temperature_avg_c vibration_max_mm_s
vibration_avg_mm_s casing_pressure_avg_kpa flow_avg_m3_s flow_max_m3_s rain_avg_mm_h
rain_max_mm_h capacity_factor_avg power_pct_capacity_avg power_factor_avg
reactive_power_avg_mvar critical_rate_pct health_score""".split()
KPI_OTHERS = """plant_id, plant_name, event_count, anomaly_count, maintenance_count,
critical_count, first_event_ts, last_event_ts, window_minutes, window_start, window_end"""


def kpi_rows(minutes: int, where: str = "") -> str:
    return (
        f"{with_kpis(minutes)} SELECT {KPI_OTHERS}, {settled_list(*KPI_DOUBLES)} FROM kpis {where}"
    )


def latest(column: str) -> str:
    return f"arg_max({column}, window_start) FILTER (WHERE {column} IS NOT NULL) AS {column}"


def latest_cte(minutes: int, *columns: str) -> str:
    picked = ", ".join(latest(c) for c in columns)
    return f"""{with_kpis(minutes)},
newest AS (SELECT plant_id, {picked} FROM kpis GROUP BY plant_id)"""


TIME_LINE = "PARTITION BY plant_id ORDER BY event_ts, event_id"
SO_FAR = f"({TIME_LINE} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"

EPISODES = f"""{METERED},
flagged AS (
  SELECT plant_id, event_ts, event_id, status = 'MANUTENCAO' AS m,
    lag(status = 'MANUTENCAO') OVER ({TIME_LINE}) AS before,
    lead(event_ts) OVER ({TIME_LINE}) AS next_ts
  FROM metered),
numbered AS (
  SELECT *, sum(CASE WHEN m = before THEN 0 ELSE 1 END) OVER {SO_FAR} AS run FROM flagged)
"""

SECONDS = f"""{EPISODES},
spans AS (
  SELECT plant_id, event_ts, next_ts,
    unnest(generate_series(time_bucket(INTERVAL '1 hour', event_ts), next_ts, INTERVAL '1 hour'))
      AS window_start
  FROM flagged WHERE m AND next_ts IS NOT NULL),
seconds AS (
  SELECT plant_id, window_start,
    CAST(sum(epoch_us(least(next_ts, window_start + INTERVAL '1 hour'))
      - epoch_us(greatest(event_ts, window_start))) AS BIGINT) / 1e6 AS maintenance_seconds
  FROM spans GROUP BY 1, 2)
"""


def boxes(quartiles: str) -> str:
    """Box plot of power per plant, given CTEs that end in quartiles(plant_id, n, q1, median, q3)."""
    return f"""{quartiles},
limits AS (
  SELECT *, q1 - (q3 - q1) * 1.5e0 AS lower_fence, q3 + (q3 - q1) * 1.5e0 AS upper_fence
  FROM quartiles),
marked AS (
  SELECT l.*, power_mw, power_mw BETWEEN lower_fence AND upper_fence AS inside
  FROM usable u JOIN limits l ON u.plant_id = l.plant_id)
"""


LINEAR = f"""{READINGS},
quartiles AS (
  SELECT plant_id, count(power_mw) AS n, quantile_cont(power_mw, 0.25) AS q1,
    quantile_cont(power_mw, 0.5) AS median, quantile_cont(power_mw, 0.75) AS q3
  FROM usable GROUP BY plant_id)"""

MIDPOINT = f"""{READINGS},
ranked AS (
  SELECT plant_id, power_mw, row_number() OVER (PARTITION BY plant_id ORDER BY power_mw) - 1 AS i,
    count(*) OVER (PARTITION BY plant_id) AS n
  FROM usable),
shares AS (SELECT * FROM (VALUES (0.25e0), (0.5e0), (0.75e0)) AS s(share)),
wanted AS (
  SELECT DISTINCT plant_id, n, share,
    greatest(0e0, least(n * share - 0.5e0, CAST(n - 1 AS DOUBLE))) AS place
  FROM ranked CROSS JOIN shares),
picked AS (
  SELECT w.plant_id, w.n, share, max(place) - floor(max(place)) AS weight,
    max(CASE WHEN i = floor(place) THEN power_mw END) AS low,
    max(CASE WHEN i = ceil(place) THEN power_mw END) AS high
  FROM wanted w JOIN ranked r ON w.plant_id = r.plant_id GROUP BY 1, 2, 3),
quartiles AS (
  SELECT plant_id, n,
    max(CASE WHEN share = 0.25e0 THEN low + (high - low) * weight END) AS q1,
    max(CASE WHEN share = 0.5e0 THEN low + (high - low) * weight END) AS median,
    max(CASE WHEN share = 0.75e0 THEN low + (high - low) * weight END) AS q3
  FROM picked GROUP BY 1, 2)"""

BOX_SELECT = f"""
SELECT plant_id, n, {settled_list("q1", "median", "q3", "lower_fence", "upper_fence")},
  {settled("min(power_mw) FILTER (WHERE inside)")} AS whisker_low,
  {settled("max(power_mw) FILTER (WHERE inside)")} AS whisker_high,
  count(*) FILTER (WHERE NOT inside) AS outliers
FROM marked GROUP BY plant_id, n, q1, median, q3, lower_fence, upper_fence"""


def snapshot(recent: str, now: str, compat: bool) -> str:
    peak, total = ("avg", "avg") if compat else ("max", "sum")
    critical = "0" if compat else "count(*) FILTER (WHERE alert_level = 'CRITICO')"
    resting = "0" if compat else "count(*) FILTER (WHERE status = 'MANUTENCAO')"
    rate = "0e0" if compat else rounded("critical_count * 100e0 / event_count", 2)
    doubles = """power_avg_mw power_max_mw efficiency_avg oee_avg wear_avg heat_rate_avg
      temperature_max_c vibration_max_mm_s flow_avg_m3_s rain_avg_mm_h capacity_factor_avg
      energy_mwh relative_efficiency_avg""".split()
    return f"""{CURATED},
clock AS (SELECT {now} AS now FROM curated),
recent AS ({recent}),
grouped AS (
  SELECT plant_id, avg(power_mw) AS power_avg_mw, max(power_mw) AS power_max_mw,
    avg(efficiency) AS efficiency_avg, count(power_mw) AS event_count, avg(oee) AS oee_avg,
    avg(wear_index) AS wear_avg, avg(heat_rate_kj_kwh) AS heat_rate_avg,
    {peak}(turbine_temp_c) AS temperature_max_c, {peak}(vibration_mm_s) AS vibration_max_mm_s,
    avg(flow_m3_s) AS flow_avg_m3_s, avg(rain_mm_h) AS rain_avg_mm_h,
    avg(capacity_factor) AS capacity_factor_avg, {total}(energy_mwh) AS energy_mwh,
    avg(relative_efficiency) AS relative_efficiency_avg,
    count(*) FILTER (WHERE is_anomaly) AS anomaly_count,
    CAST({critical} AS BIGINT) AS critical_count,
    CAST({resting} AS BIGINT) AS maintenance_count
  FROM recent GROUP BY plant_id)
SELECT plant_id, event_count, anomaly_count, critical_count, maintenance_count,
  {settled_list(*doubles)}, {rate} AS critical_rate_pct,
  {settled('''least(1e0, greatest(0e0, oee_avg)) * 0.5e0
    + least(1e0, greatest(0e0, efficiency_avg)) * 0.5e0''', 4)} AS health_score,
  (SELECT now FROM clock) - INTERVAL '5 minutes' AS window_start,
  (SELECT now FROM clock) AS window_end, CAST(5 AS INTEGER) AS window_minutes
FROM grouped"""


RECENT_15 = """SELECT * FROM curated
  WHERE event_ts >= (SELECT now FROM clock) - INTERVAL '15 minutes'"""
LAST_5000 = "SELECT * FROM curated ORDER BY event_ts DESC, event_id LIMIT 5000"

RECENT_60 = """recent AS (
  SELECT * FROM curated
  WHERE event_ts >= (SELECT max(event_ts) FROM curated) - INTERVAL '60 minutes')"""

TOP_30 = """top AS (
  SELECT * FROM curated WHERE is_anomaly ORDER BY event_ts DESC, event_id LIMIT 30)"""


def expected(drop: str, gain: str, optimum: str, width: str, low: str, high: str, digits: int) -> str:
    load = "flow_m3_s / max_flow_m3_s"
    bell = f"exp(-(({load} - {optimum}) * ({load} - {optimum})) / {width})"
    curve = f"(base_efficiency - {drop}) + {gain} * {bell}"
    value = f"least({high}, greatest({low}, {rounded(curve, 5) if digits == 5 else curve}))"
    return f"""{READINGS},
e AS (SELECT event_id, efficiency, {value} AS expected_efficiency FROM usable)
SELECT event_id, {settled("expected_efficiency", 9)} AS expected_efficiency,
  {settled("efficiency - expected_efficiency", 9)} AS efficiency_residual FROM e"""


def view(minutes: int) -> str:
    plain = """power_avg_mw power_max_mw efficiency_avg heat_rate_avg wear_avg energy_mwh
      temperature_max_c vibration_max_mm_s flow_avg_m3_s rain_avg_mm_h""".split()
    rate = settled("critical_rate_pct", 4)
    return f"""{with_kpis(minutes)},
newest AS (SELECT * FROM kpis ORDER BY window_start DESC, plant_id LIMIT 200)
SELECT strftime(window_start, '%H:%M %d/%m') AS window_start, plant_id, event_count,
  anomaly_count, {settled_list(*plain, digits=4)}, coalesce({rate}, 0e0) AS critical_rate_pct,
  least(1e0, greatest(0e0, coalesce({settled("oee_avg", 4)}, 0e0))) AS oee_avg,
  least(1e0, greatest(0e0, coalesce({settled("health_score", 4)}, 0e0))) AS health_score
FROM newest"""


REGRESSION = f"""{with_kpis(60)},
fit AS (
  SELECT count(*) AS windows, regr_slope(power_avg_mw, rain_avg_mm_h) AS slope,
    regr_intercept(power_avg_mw, rain_avg_mm_h) AS intercept,
    min(rain_avg_mm_h) AS rain_min, max(rain_avg_mm_h) AS rain_max
  FROM kpis WHERE rain_avg_mm_h IS NOT NULL AND power_avg_mw IS NOT NULL)"""
FIT_COLUMNS = settled_list("slope", "intercept", "rain_min", "rain_max")


def board() -> str:
    metrics = [
        ("capacity_pct", "capacity_factor_avg", "100e0", "80e0"),
        ("oee_pct", "oee_avg", "100e0", "70e0"),
        ("efficiency_pct", "efficiency_avg", "100e0", "88e0"),
        ("wear", "wear_avg", "1e0", "0.65e0"),
        ("temperature_c", "temperature_max_c", "1e0", "80e0"),
        ("heat_rate_kj_kwh", "heat_rate_avg", "1e0", "3871e0"),
        ("vibration_mm_s", "vibration_max_mm_s", "1e0", "5e0"),
        ("flow_m3_s", "flow_avg_m3_s", "1e0", "CAST(NULL AS DOUBLE)"),
        ("rain_mm_h", "rain_avg_mm_h", "1e0", "CAST(NULL AS DOUBLE)"),
    ]
    long = " UNION ALL ".join(
        f"SELECT plant_id, '{metric}' AS metric, coalesce({column}, 0e0) * {factor} AS value,"
        f" {reference} AS reference FROM newest"
        for metric, column, factor, reference in metrics
    )
    return f"""{latest_cte(60, *[m[1] for m in metrics])},
long AS ({long})
SELECT plant_id, metric, {settled("value")} AS value, reference,
  {settled("value - reference")} AS distance,
  CASE WHEN metric = 'capacity_pct' THEN
      CASE WHEN value < 50 THEN 'CRITICO' WHEN value < 75 THEN 'ATENCAO' ELSE 'NORMAL' END
    WHEN metric = 'wear' THEN
      CASE WHEN value >= 0.65e0 THEN 'CRITICO' WHEN value >= 0.35e0 THEN 'ATENCAO'
        ELSE 'NORMAL' END
    WHEN metric = 'temperature_c' THEN
      CASE WHEN value >= 80 THEN 'CRITICO' WHEN value >= 72 THEN 'ATENCAO' ELSE 'NORMAL' END
    END AS band
FROM long"""


# What a stream with a watermark of 10 minutes has given out at the end of the data.
CLOSED = "WHERE window_end <= (SELECT max(event_ts) FROM curated) - INTERVAL '10 minutes'"

EVENT_COLUMNS = ", ".join(name for _, name, _ in EVENT_FIELDS)
CURATED_COLUMNS = ", ".join(CURATED_TABLE.names)


def parsed_events() -> str:
    """Fields of both generations; where seq % 13 is 0, 1 or 3 the text holds no event."""
    added = [name for wire, name, _ in EVENT_FIELDS if wire in ADDED_IN_V3]
    columns = []
    for _, name, _ in EVENT_FIELDS:
        value = "'events/' || v.version || '/readings'" if name == "metadata" else name
        there = "seq % 13 NOT IN (0, 1, 3)" + (" AND v.version = '3.0'" if name in added else "")
        columns.append(f"CASE WHEN {there} THEN {value} END AS {name}")
    return f"""{METERED}
SELECT {", ".join(columns)}, seq AS kafka_offset,
  CASE seq % 13 WHEN 0 THEN 'not JSON' WHEN 1 THEN 'no JSON object' WHEN 3 THEN 'empty record' END
    AS json_error,
  CASE WHEN seq % 13 = 2 THEN 'novo={{"a":1}}' ELSE '' END AS unknown_fields
FROM metered CROSS JOIN (VALUES ('2.0'), ('3.0')) AS v(version)"""


def oracle_sql() -> dict[str, str]:
    last = "plant_id, event_ts, event_id"
    curated_rows = f"{CURATED} SELECT {CURATED_COLUMNS} FROM curated"
    raw_rows = f"""{READINGS}
SELECT plant_id AS kafka_key, 'readings' AS kafka_topic, CAST(0 AS INTEGER) AS kafka_partition,
  seq AS kafka_offset, event_ts AS kafka_timestamp, CAST(CAST(event_ts AS DATE) AS VARCHAR)
    AS ingest_date, event_id, plant_id, plant_name, status, is_anomaly, installed_mw, head_m,
  flow_m3_s, efficiency, power_mw, turbine_temp_c, vibration_mm_s, rain_mm_h
FROM readings"""
    rejected_rows = f"""{READINGS}
SELECT seq AS kafka_offset, 'negative power' AS reason FROM readings WHERE power_mw < 0"""
    episodes = f"""{EPISODES}
SELECT plant_id, min(event_ts) AS start_ts, max(event_ts) AS end_ts,
  CASE WHEN count(next_ts) = count(*) THEN max(next_ts) END AS resumed_ts, count(*) AS readings
FROM numbered WHERE m GROUP BY plant_id, run"""
    return {
        "window_kpis_1m": kpi_rows(1),
        "window_kpis_5m": kpi_rows(5),
        "window_kpis_1h": kpi_rows(60),
        "merge_kpis": kpi_rows(60),
        "rebuild_windows": kpi_rows(60),
        "repair_late_windows": kpi_rows(60),
        "stream_window_kpis_5m": kpi_rows(5, CLOSED),
        "stream_window_kpis_1h": kpi_rows(60, CLOSED),
        "quality_filter": f"{READINGS} SELECT event_id, plant_id, power_mw, efficiency FROM usable",
        "quality_rejects": f"""{READINGS}
SELECT event_id, plant_id, power_mw,
  CASE WHEN power_mw IS NULL THEN 'missing power' ELSE 'negative power' END AS reason
FROM readings WHERE power_mw IS NULL OR power_mw < 0""",
        "calendar_columns": f"{CURATED} SELECT event_id, event_ts, event_date, event_hour FROM curated",
        "performance_columns": f"{CURATED} SELECT event_id, {', '.join(PERFORMANCE)} FROM curated",
        "alert_flags": f"{CURATED} SELECT event_id, {', '.join(FLAGS)} FROM curated",
        "derived_metrics": f"{METERED} SELECT event_id, {', '.join(METRICS)} FROM metered",
        "alert_level": f"{METERED} SELECT event_id, alert_level FROM metered",
        "alert_level_v2": f"""{METERED}
SELECT event_id, {alert_level("78e0", "70e0", "0.82e0")} AS alert_level FROM metered""",
        "expected_efficiency": expected(
            "0.04e0",
            "0.05e0",
            "CASE WHEN head_m < 25 THEN 0.78e0 ELSE 0.72e0 END",
            "CASE WHEN head_m < 25 THEN 0.030e0 ELSE 0.025e0 END",
            "0.75e0",
            "0.97e0",
            5,
        ),
        "expected_efficiency_v2": expected(
            "0.05e0", "0.06e0", "0.72e0", "0.025e0", "0.72e0", "0.96e0", 0
        ),
        "enrich_with_plant": f"""{MEASURED}
SELECT event_id, m.plant_id, plant_name, river, state, installed_mw, head_m, max_flow_m3_s,
  base_efficiency FROM measured m LEFT JOIN plants p ON m.plant_id = p.plant_id""",
        "flag_unknown_plants": f"""{MEASURED}
SELECT event_id, plant_id, plant_id <> 'plant_4' AS plant_known FROM measured""",
        "unknown_plants": f"""{MEASURED}
SELECT event_id, m.plant_id, status FROM measured m
WHERE NOT EXISTS (
  SELECT 1 FROM plants p WHERE p.plant_id = m.plant_id AND p.plant_id <> 'plant_4')""",
        "dedup_events": f"""{MEASURED},
doubled AS (
  SELECT event_id, plant_id, event_ts, seq * 2 + 1 AS kafka_offset FROM measured
  UNION ALL SELECT event_id, plant_id, event_ts, seq * 2 FROM measured)
SELECT event_id, plant_id, event_ts, min(kafka_offset) AS kafka_offset
FROM doubled GROUP BY 1, 2, 3""",
        "anomaly_filter": f"{CURATED} SELECT event_id, plant_id, event_ts FROM curated WHERE is_anomaly",
        "anomaly_filter_text": f"{CURATED} SELECT event_id, plant_id FROM curated WHERE is_anomaly",
        "active_plants_filter": f"""{CURATED}
SELECT event_id, plant_id, power_mw FROM curated WHERE plant_id IN ('plant_1', 'plant_3')""",
        "drop_missing": f"""{CURATED}
SELECT event_id, turbine_temp_c, wear_index FROM curated WHERE turbine_temp_c IS NOT NULL""",
        "project_existing": f"""{CURATED} SELECT event_id AS id, power_mw AS "MW" FROM curated""",
        "recent_window_data_anchored": f"""{CURATED}, {RECENT_60}
SELECT event_id, plant_id, event_ts, power_mw FROM recent""",
        "recent_window_summary": f"""{CURATED}, {RECENT_60}
SELECT count(*) AS event_count, count(DISTINCT plant_id) AS plant_count,
  max(event_ts) - INTERVAL '60 minutes' AS window_start, max(event_ts) AS anchor_ts FROM recent""",
        "recent_window_or_last_n": f"""{CURATED}
SELECT event_id, plant_id, event_ts FROM curated ORDER BY event_ts DESC, event_id LIMIT 5000""",
        "last_n_by_time": f"""{CURATED}
SELECT event_id, plant_id, event_ts FROM curated ORDER BY event_ts DESC, event_id LIMIT 5000""",
        "minute_series": f"""{CURATED}, {RECENT_60}
SELECT date_trunc('minute', event_ts) AS minute, plant_id,
  {settled("avg(power_mw)")} AS power_avg_mw, {settled("max(power_mw)")} AS power_max_mw,
  count(power_mw) AS event_count FROM recent GROUP BY 1, 2""",
        "latest_per_plant": f"""{latest_cte(60, *[c for c in KPI_DOUBLES + ["plant_name"]])}
SELECT plant_id, plant_name, {settled_list(*KPI_DOUBLES)} FROM newest""",
        "fleet_kpis": f"""{latest_cte(5, "power_avg_mw", "oee_avg", "health_score",
            "flow_avg_m3_s", "anomaly_count", "critical_count")}
SELECT {settled("sum(power_avg_mw)")} AS power_mw,
  (SELECT {settled("sum(energy_mwh)")} FROM kpis) AS energy_mwh,
  {settled("avg(oee_avg)")} AS oee, {settled("avg(health_score)")} AS health_score,
  {settled("avg(flow_avg_m3_s)")} AS flow_m3_s,
  CAST(sum(anomaly_count) AS BIGINT) AS anomaly_count,
  CAST(sum(critical_count) AS BIGINT) AS critical_count FROM newest""",
        "alert_totals_per_plant": f"""{latest_cte(5, "anomaly_count", "critical_count",
            "maintenance_count")}
SELECT plant_id, kind, readings FROM newest
UNPIVOT (readings FOR kind IN (anomaly_count, critical_count, maintenance_count))""",
        "health_board": board(),
        "silver_snapshot": snapshot(RECENT_15, "max(event_ts)", compat=False),
        "silver_snapshot_compat": snapshot(RECENT_15, "max(event_ts)", compat=True),
        "silver_snapshot_fallback": snapshot(
            LAST_5000, "max(event_ts) + INTERVAL '1 day'", compat=False
        ),
        "source_fallback": f"""{with_kpis(5)}
SELECT plant_id, window_start, window_start + INTERVAL '5 minutes' AS window_end,
  CAST(5 AS INTEGER) AS window_minutes, event_count, {settled_list("power_avg_mw", "power_max_mw")},
  'kpis' AS source FROM kpis""",
        "source_fallback_snapshot": f"""
SELECT plant_id, window_start, window_end, window_minutes, event_count, power_avg_mw, power_max_mw,
  'curated' AS source FROM ({snapshot(RECENT_15, "max(event_ts)", compat=False)})""",
        "top_recent_anomalies": f"""{CURATED}, {TOP_30}
SELECT strftime(event_ts, '%H:%M:%S') AS event_time, plant_id,
  'VIBRACAO_ALTA' AS anomaly_kind, alert_level, {rounded("power_mw", 3)} AS power_mw,
  {rounded("efficiency", 3)} AS efficiency, {rounded("turbine_temp_c", 3)} AS turbine_temp_c,
  {rounded("vibration_mm_s", 3)} AS vibration_mm_s FROM top""",
        "anomaly_level_counts": f"""{CURATED}, {TOP_30}
SELECT count(*) FILTER (WHERE alert_level = 'CRITICO') AS critical,
  count(*) FILTER (WHERE alert_level = 'ATENCAO') AS attention FROM top""",
        "anomaly_scan_coverage": "SELECT count(*) AS rows, CAST(1 AS BIGINT) AS files FROM events",
        "file_census": """
SELECT 'events' AS layer, CAST(1 AS BIGINT) AS files, count(*) AS rows FROM events
UNION ALL SELECT 'lineitem', CAST(1 AS BIGINT), count(*) FROM lineitem""",
        "recent_files_scan": "SELECT * FROM events WHERE event_id % 5 >= 2",
        "kpi_table_view_5m": view(5),
        "kpi_table_view_1h": view(60),
        "newest_first": kpi_rows(60),
        "distinct_plants": f"{READINGS} SELECT DISTINCT plant_id FROM usable",
        "plant_palette_index": f"""{READINGS}, p AS (SELECT DISTINCT plant_id FROM usable)
SELECT plant_id, CAST((dense_rank() OVER (ORDER BY plant_id) - 1) % 5 AS INTEGER)
  AS palette_index FROM p""",
        "rain_power_regression": f"{REGRESSION} SELECT windows, {FIT_COLUMNS} FROM fit",
        "rain_power_regression_per_plant": f"""{REGRESSION.replace(
            "SELECT count(*) AS windows", "SELECT plant_id, count(*) AS windows").replace(
            "power_avg_mw IS NOT NULL)", "power_avg_mw IS NOT NULL GROUP BY plant_id)")}
SELECT plant_id, windows, {FIT_COLUMNS} FROM fit""",
        "rain_power_trend_line": f"""{REGRESSION},
points AS (
  SELECT CAST(unnest(range(50)) AS INTEGER) AS point),
placed AS (
  SELECT point, slope, intercept, rain_min + point * ((rain_max - rain_min) / 49) AS rain_mm_h
  FROM fit CROSS JOIN points)
SELECT point, {settled("rain_mm_h")} AS rain_mm_h,
  {settled("slope * rain_mm_h + intercept")} AS power_mw FROM placed""",
        "power_distribution": boxes(LINEAR) + BOX_SELECT,
        "power_distribution_midpoint": boxes(MIDPOINT) + BOX_SELECT,
        "power_outliers": f"""{boxes(LINEAR)}
SELECT plant_id, power_mw FROM marked WHERE NOT inside""",
        "value_outliers": f"""{READINGS},
quartiles AS (
  SELECT plant_id, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
  FROM usable GROUP BY plant_id)
SELECT event_id, u.plant_id, value FROM usable u JOIN quartiles q ON u.plant_id = q.plant_id
WHERE value NOT BETWEEN q1 - (q3 - q1) * 1.5e0 AND q3 + (q3 - q1) * 1.5e0""",
        "running_energy": f"""{METERED}
SELECT {last}, {settled(f"sum(energy_mwh) OVER {SO_FAR}")} AS cumulative_energy_mwh
FROM metered""",
        "energy_balance_per_window": f"""{METERED},
running AS (
  SELECT plant_id, event_ts, sum(energy_mwh) OVER {SO_FAR} AS total FROM metered)
SELECT plant_id, time_bucket(INTERVAL '1 hour', event_ts) AS window_start,
  time_bucket(INTERVAL '1 hour', event_ts) + INTERVAL '1 hour' AS window_end,
  {settled("max(total) - min(total)")} AS energy_balance_mwh FROM running GROUP BY 1, 2, 3""",
        "running_availability": f"""{METERED},
counted AS (
  SELECT {last}, CAST(count(*) FILTER (WHERE status <> 'MANUTENCAO') OVER {SO_FAR} AS BIGINT)
      AS available_readings, count(*) OVER {SO_FAR} AS total_readings
  FROM metered)
SELECT *, CAST(available_readings AS DOUBLE) / total_readings AS availability FROM counted""",
        "running_oee": f"""{METERED},
counted AS (
  SELECT {last}, power_mw, installed_mw,
    CAST(count(*) FILTER (WHERE status <> 'MANUTENCAO') OVER {SO_FAR} AS DOUBLE)
      / count(*) OVER {SO_FAR} AS availability
  FROM metered)
SELECT {last}, {rounded("availability * least(1e0, power_mw / installed_mw)", 5)} AS oee
FROM counted""",
        "maintenance_episodes": episodes,
        "stream_maintenance_episodes": episodes,
        "maintenance_seconds": f"""{SECONDS}
SELECT * FROM seconds WHERE maintenance_seconds > 0""",
        "alert_breaches": kpi_rows(
            60, "WHERE critical_rate_pct > 5 OR vibration_max_mm_s > 4.5e0"
        ),
        "stream_alert_breaches": kpi_rows(
            60, f"{CLOSED} AND (critical_rate_pct > 5 OR vibration_max_mm_s > 4.5e0)"
        ),
        "documented_kpis_5m": f"""{with_kpis(5)}
SELECT plant_id, window_start, {settled_list("power_avg_mw", "power_max_mw", "efficiency_avg")}
FROM kpis""",
        "documented_kpis_1h": f"""{with_kpis(60)},
{SECONDS[len(METERED):].lstrip().removeprefix(",")}
SELECT coalesce(k.plant_id, s.plant_id) AS plant_id,
  coalesce(k.window_start, s.window_start) AS window_start, anomaly_count,
  {settled_list("energy_mwh", "critical_rate_pct", "temperature_max_c", "vibration_max_mm_s",
                "rain_avg_mm_h", "flow_avg_m3_s")},
  coalesce(maintenance_seconds, 0e0) AS maintenance_seconds
FROM kpis k FULL JOIN seconds s ON k.plant_id = s.plant_id AND k.window_start = s.window_start""",
        "bronze_project": raw_rows,
        "stream_bronze": raw_rows,
        "parse_events": parsed_events(),
        "curated_from_json": curated_rows,
        "curated_from_bronze": curated_rows,
        "stream_curated": curated_rows,
        "single_file_compaction": curated_rows,
        "retention_by_partition_date": f"""{CURATED}
SELECT event_id, plant_id, event_ts FROM curated
WHERE CAST(event_ts AS DATE) >= (
  SELECT CAST(max(event_ts) - INTERVAL '6 hours' AS DATE) FROM curated)""",
        "keyed_json_publish": f"{METERED} SELECT plant_id AS key, {EVENT_COLUMNS} FROM metered",
        "raw_retention": f"""{MEASURED}
SELECT seq AS kafka_offset, plant_id AS kafka_key, event_ts AS kafka_timestamp FROM measured
WHERE date_trunc('day', event_ts) >= (SELECT max(event_ts) - INTERVAL '2 days' FROM measured)""",
        "kpi_retention": f"""{with_kpis(60)}
SELECT plant_id, window_start, event_count FROM kpis WHERE CAST(window_start AS DATE) >=
  (SELECT CAST(max(window_start) - INTERVAL '7 days' AS DATE) FROM kpis)""",
        "layer_freshness": """
SELECT * FROM (VALUES ('within', true, CAST(600 AS BIGINT), true), ('beyond', true, 600, false),
  ('absent', false, NULL, false)) AS f(layer, has_files, age_seconds, healthy)""",
        "event_key": f"""{READINGS}
SELECT event_id, concat_ws('-', plant_id, seq, epoch_us(event_ts) // 1000) AS event_key FROM usable""",
        "oee_below_min": f"{METERED} SELECT event_id, oee < 0.70e0 AS oee_below_min FROM metered",
        "table_scan": kpi_rows(60),
        "plant_label": f"""{READINGS}
SELECT DISTINCT plant_id, upper(plant_id[1]) || replace(plant_id[2:], '_', ' ') AS label
FROM usable""",
        "quarantine": rejected_rows,
        "stream_quarantine": rejected_rows,
        "union_schema_versions": f"""{METERED}
SELECT event_id, versao, installed_mw, {', '.join(METRICS)}
FROM metered CROSS JOIN (VALUES ('2.0'), ('3.0')) AS v(versao)""",
        "union_files_by_name": f"""{MEASURED}
SELECT event_id, plant_id, status, CAST(NULL AS DOUBLE) AS value FROM measured
UNION ALL SELECT event_id, plant_id, NULL, value FROM measured""",
    }
