"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from penstock.functions import alerts, machine, numbers
from penstock.functions.numbers import settled_round
from penstock.model import CURATED_TABLE, EVENT_JSON, KPI_TABLE, RAW_TABLE, curated_from_wire
from penstock.operators import curated as cur
from penstock.operators import distribution, enrich, history, insight, kpis, raw
from penstock.session import pinned, scratch_path
from penstock.settings import CURVE, CURVE_V2, LIMITS_V2, Settings
from penstock.sources import log, newest, tables
from penstock.sources import readings as src
from penstock.streaming import jobs
from penstock.streaming.sinks import batch_writer, write_batch
from penstock.upkeep import dirty, freshness, retention, rewrite

Query = Callable[[SparkSession, str], DataFrame]

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
RETENTION = Settings()


def whole(df: DataFrame) -> DataFrame:
    """All columns of curated rows in a form every engine has: dates and metadata as text."""
    parts = F.concat_ws("/", "metadata.fonte", "metadata.versao", "metadata.topico")
    return dates_as_text(df.withColumn("metadata", parts))


def settled(df: DataFrame, digits: int = 6) -> DataFrame:
    """Double columns rounded, for results of sums that no engine adds in a fixed order."""
    return df.withColumns(
        {c: settled_round(F.col(c), digits) for c, kind in df.dtypes if kind == "double"}
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _metered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.metered(src.readings(spark, sf_dir))


def _usable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cur.quality_filter(src.readings(spark, sf_dir))


def _kpis(minutes: int) -> Query:
    return lambda spark, sf_dir: kpis.window_kpis(src.curated(spark, sf_dir), minutes)


_kpis_5m, _kpis_1h = _kpis(5), _kpis(60)


def dates_as_text(df: DataFrame) -> DataFrame:
    """Engines hand dates over in different types; their text is the same."""
    return df.withColumns({c: F.col(c).cast("string") for c, kind in df.dtypes if kind == "date"})


def _on(source: Query, operator: Callable[[DataFrame], DataFrame], settle: bool = False) -> Query:
    """The operator applied to the source; doubles settled where the operator adds them up."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = operator(source(spark, sf_dir))
        return settled(result) if settle else result

    return query


def _pick(source: Query, *columns: str) -> Query:
    return _on(source, lambda df: df.select(*columns))


_STORED: dict[tuple[str, str], str] = {}


def _curated_table(spark: SparkSession, sf_dir: str) -> str:
    """Path of the curated layer by date, written once per session from the given events."""
    known = (spark.sparkContext.applicationId, sf_dir)
    if known not in _STORED:
        path = f"{scratch_path(spark, 'layer')}/curated"
        write_batch(src.curated(spark, sf_dir), 0, path, ["event_date"], "event_id")
        _STORED[known] = path
    return _STORED[known]


def _newest_rows(n: int, where: str | None = None) -> Query:
    return lambda spark, sf_dir: newest.newest_rows(
        spark, _curated_table(spark, sf_dir), CURATED_TABLE, n, where
    )


def _recent_days(minutes: int) -> Query:
    return lambda spark, sf_dir: newest.recent_days(
        spark, _curated_table(spark, sf_dir), CURATED_TABLE, minutes
    )


# Curated ----------------------------------------------------------------------------------------


def quality_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = cur.quality_rejects(src.readings(spark, sf_dir))
    return rejected.select("event_id", "plant_id", "power_mw", "reason")


def alert_level_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = alerts.alert_level(
        F.col("status"),
        F.col("is_anomaly"),
        F.col("turbine_temp_c"),
        F.col("vibration_mm_s"),
        F.col("efficiency"),
        LIMITS_V2,
    )
    return _usable(spark, sf_dir).select("event_id", level.alias("alert_level"))


def expected_efficiency(curve) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        curved = enrich.efficiency_residual(_usable(spark, sf_dir), curve)
        return settled(
            curved.select("event_id", "expected_efficiency", "efficiency_residual"), digits=9
        )

    return query


def enrich_with_plant(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = enrich.enrich_with_plant(src.measured(_events(spark, sf_dir)), src.adapter_plants(spark))
    return joined.select(
        "event_id",
        "plant_id",
        "plant_name",
        "river",
        "state",
        "installed_mw",
        "head_m",
        "max_flow_m3_s",
        "base_efficiency",
    )


def _without_one_plant(spark: SparkSession) -> DataFrame:
    return src.adapter_plants(spark).filter("plant_id <> 'plant_4'")


def flag_unknown_plants(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = src.measured(_events(spark, sf_dir))
    flagged = enrich.flag_unknown_plants(measured, _without_one_plant(spark))
    return flagged.select("event_id", "plant_id", "plant_known")


def unknown_plants(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = src.measured(_events(spark, sf_dir))
    return enrich.unknown_plants(measured, _without_one_plant(spark)).select(
        "event_id", "plant_id", "status"
    )


def dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading sent twice; the earlier record of each is kept."""
    measured = src.measured(_events(spark, sf_dir))
    again = measured.withColumn("kafka_offset", F.col("seq") * 2)
    first = measured.withColumn("kafka_offset", F.col("seq") * 2 + 1)
    both = first.unionByName(again).select("event_id", "plant_id", "event_ts", "kafka_offset")
    return cur.dedup_events(both)


def anomaly_filter_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = src.curated(spark, sf_dir).withColumn("is_anomaly", F.col("is_anomaly").cast("string"))
    return insight.anomaly_filter(text).select("event_id", "plant_id")


def project_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    curated = src.curated(spark, sf_dir)
    wanted = ["event_id", "power_mw", "a_column_of_a_later_version"]
    return insight.project_existing(curated, wanted, {"event_id": "id", "power_mw": "MW"})


# Raw and JSON -----------------------------------------------------------------------------------


def _frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.event_frame(src.readings(spark, sf_dir))


PAYLOAD = [
    "event_id",
    "plant_id",
    "plant_name",
    "status",
    "is_anomaly",
    "installed_mw",
    "head_m",
    "flow_m3_s",
    "efficiency",
    "power_mw",
    "turbine_temp_c",
    "vibration_mm_s",
    "rain_mm_h",
]


def _with_payload(stored: DataFrame) -> DataFrame:
    """Raw rows with fields read from the stored text in place of the text itself, whose numbers other
    engines print differently."""
    kept = [c for c in RAW_TABLE.names if c != "raw_json"]
    text = stored.withColumn("value", F.col("raw_json"))
    parsed = curated_from_wire(cur.parse_json(text, EVENT_JSON, kept))
    return dates_as_text(parsed.select(*kept, *PAYLOAD))


def bronze_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_payload(raw.raw_project(_frame(spark, sf_dir)))


def parse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every field of events of both generations; some texts are cut short, some are no object, some
    have a field of a later generation."""
    usable = _usable(spark, sf_dir)
    frames = insight.union_by_name(*[src.event_frame(usable, version) for version in ("2.0", "3.0")])
    text, kind = F.col("value").cast("string"), F.col("offset") % 13
    changed = (
        F.when(kind == 0, F.left(text, F.lit(30)))
        .when(kind == 1, F.lit("[1, 2]"))
        .when(kind == 2, F.concat(F.lit('{"novo":{"a":1},'), F.substring(text, 2, 1_000_000)))
        .when(kind == 3, F.lit(None))
        .otherwise(text)
    )
    parsed = cur.parse_variant(frames.withColumn("value", changed.cast("binary")))
    unknown = F.concat_ws(",", F.transform(F.map_entries("unknown_fields"), lambda e: F.concat(e.key, F.lit("="), e.value)))
    metadata = F.when(F.col("metadata").isNotNull(), F.concat_ws("/", "metadata.fonte", "metadata.versao", "metadata.topico"))
    return parsed.withColumns({"unknown_fields": unknown, "metadata": metadata})


def curated_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whole(cur.curate(_frame(spark, sf_dir)))


def curated_from_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = raw.raw_project(_frame(spark, sf_dir))
    return whole(cur.curate(raw.raw_as_frame(stored)))


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cur.quarantine(_frame(spark, sf_dir)).select("kafka_offset", "reason")


def union_schema_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading as an event of both generations, read with one schema and completed."""
    usable = _usable(spark, sf_dir)
    frames = [src.event_frame(usable, version) for version in ("2.0", "3.0")]
    parsed = cur.parse_events(insight.union_by_name(*frames))
    complete = enrich.enrich_with_plant(parsed, src.adapter_plants(spark))
    return enrich.derived_metrics(complete).select(
        "event_id", F.col("metadata.versao").alias("versao"), "installed_mw", *METRICS
    )


def union_files_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = src.measured(_events(spark, sf_dir))
    return insight.union_by_name(
        measured.select("event_id", "plant_id", "status"),
        measured.select("event_id", "plant_id", "value"),
    )


def keyed_json_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key and all fields of the records that go to the log."""
    records = src.event_frame(_usable(spark, sf_dir)).withColumn("key", F.col("key").cast("string"))
    parsed = curated_from_wire(cur.parse_json(records, EVENT_JSON, ["key"]))
    parts = F.concat_ws("/", "metadata.fonte", "metadata.versao", "metadata.topico")
    return parsed.withColumn("metadata", parts)


def event_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = machine.event_key(F.col("plant_id"), F.col("seq"), F.col("event_ts"))
    return _usable(spark, sf_dir).select("event_id", key.alias("event_key"))


def oee_below_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    below = alerts.oee_below_min(F.col("oee"))
    return _metered(spark, sf_dir).select("event_id", below.alias("oee_below_min"))


def plant_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = numbers.plant_label(F.col("plant_id")).alias("label")
    return _usable(spark, sf_dir).select("plant_id", label).distinct()


# KPIs -------------------------------------------------------------------------------------------


def merge_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    partials = kpis.partial_kpis(src.curated(spark, sf_dir), 5)
    return settled(kpis.merge_kpis(partials, 60))


def documented_kpis_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    curated = src.curated(spark, sf_dir)
    seconds = history.maintenance_seconds(history.maintenance_episodes(curated))
    return settled(kpis.documented_kpis_1h(kpis.window_kpis(curated, 60), seconds))


def energy_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    running = history.running_energy(_metered(spark, sf_dir))
    return settled(kpis.energy_balance(running, 60))


# Insight ----------------------------------------------------------------------------------------


def recent_window_or_last_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day after the newest reading there is nothing recent, so the newest rows are given."""
    path = _curated_table(spark, sf_dir)
    later = newest.newest_time(spark, path, CURATED_TABLE) + F.expr("INTERVAL 1 DAY")
    table = tables.table_scan(spark, path, CURATED_TABLE)
    last = newest.newest_rows(spark, path, CURATED_TABLE, insight.SNAPSHOT_ROWS)
    return insight.recent_or_last(table, later, newest=last).select("event_id", "plant_id", "event_ts")


def silver_snapshot(compat: bool = False, days_later: int = 0) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = _curated_table(spark, sf_dir)
        now = newest.newest_time(spark, path, CURATED_TABLE) + F.expr(f"INTERVAL {days_later} DAYS")
        table = tables.table_scan(spark, path, CURATED_TABLE)
        last = newest.newest_rows(spark, path, CURATED_TABLE, insight.SNAPSHOT_ROWS)
        return settled(insight.silver_snapshot(table, now, compat, newest=last))

    return query


FALLBACK = ["plant_id", "window_start", "window_end", "window_minutes", "event_count", "power_avg_mw", "power_max_mw"]


def source_fallback(with_kpis: bool) -> Query:
    """Both branches: a KPI table that has rows, and one that has none yet."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = _curated_table(spark, sf_dir)
        curated = tables.table_scan(spark, path, CURATED_TABLE)
        table = kpis.window_kpis(curated, 5)
        now = newest.newest_time(spark, path, CURATED_TABLE)
        answered = insight.source_fallback(table if with_kpis else table.limit(0), curated, now)
        return settled(answered.select(*FALLBACK, "source"))

    return query


def trend_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(insight.trend_line(insight.rain_power_regression(_kpis_1h(spark, sf_dir))))


def power_distribution(method: str) -> Query:
    return _on(_usable, lambda df: distribution.power_distribution(df, method=method), settle=True)


def file_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = ("events", "lineitem")
    return tables.file_census(
        {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in layers}
    )


def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A KPI table by plant with its window bounds as text, read back and put in order."""
    path = f"{scratch_path(spark, 'table')}/kpis"
    as_text = {c: F.col(c).cast("string") for c in ("window_start", "window_end")}
    written = _kpis_1h(spark, sf_dir)
    written.withColumns(as_text).write.partitionBy("plant_id").parquet(path)
    stored = tables.table_scan(spark, path, tables.schema_probe(spark, path))
    return settled(insight.newest_first(tables.text_window_bounds(stored)))


def recent_files_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three newest of five files, each a fifth of the events."""
    events, path = _events(spark, sf_dir), f"{scratch_path(spark, 'files')}/events"
    for part in range(5):
        rows = events.filter(F.col("event_id") % 5 == part)
        rows.coalesce(1).write.mode("append").parquet(path)
    return tables.recent_files_scan(spark, path, events.schema, n=3)


# Streams ----------------------------------------------------------------------------------------

NOW_AVAILABLE = {"availableNow": True}


def _curated_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A stream reads a folder or a pattern, not one file.
    schema = tables.schema_probe(spark, f"{sf_dir}/events.parquet")
    events = tables.table_stream(spark, f"{sf_dir}/events*.parquet", schema)
    readings = src.readings_from(events, src.adapter_plants(spark))
    return cur.derive_columns(src.metered(readings))


def _frame_batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The readings as log records, each of them sent twice: in the same batch or in another one."""
    frame = _frame(spark, sf_dir)
    again = frame.withColumn("offset", F.col("offset") + 1_000_000_000_000)
    half = F.col("offset") % 2 == 0
    return [frame.union(again.filter(half)), again.filter(~half)]


def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "bronze")
    _frame(spark, sf_dir).write.parquet(f"{base}/log")
    frame = log.frame_source(spark, f"{base}/log")
    jobs.raw_job(
        frame, f"{base}/raw", f"{base}/state", trigger=NOW_AVAILABLE
    ).awaitTermination()
    return _with_payload(tables.table_scan(spark, f"{base}/raw", RAW_TABLE))


def stream_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "curated")
    for records in _frame_batches(spark, sf_dir):
        # Files of the advised size, however many; the next run of the stream takes all that are new.
        records.hint("rebalance").write.mode("append").parquet(f"{base}/log")
        frame = log.frame_source(spark, f"{base}/log")
        # By day only: a month of readings in one batch would make a file per plant and day.
        jobs.curated_job(
            frame, f"{base}/curated", f"{base}/state", by=["event_date"], trigger=NOW_AVAILABLE, unique=True
        ).awaitTermination()
    return whole(tables.table_scan(spark, f"{base}/curated", CURATED_TABLE))


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "quarantine")
    _frame(spark, sf_dir).write.parquet(f"{base}/log")
    frame = log.frame_source(spark, f"{base}/log")
    jobs.quarantine_job(
        frame, f"{base}/rejected", f"{base}/state", trigger=NOW_AVAILABLE
    ).awaitTermination()
    return spark.read.parquet(f"{base}/rejected").select("kafka_offset", "reason")


STREAM_BATCHES = 4


def _reading_batches(rows: DataFrame) -> list[DataFrame]:
    """Readings in batches that follow each other in time. Only the list of days is numbered in one task."""
    number = F.ntile(STREAM_BATCHES).over(Window.orderBy("event_date"))
    dates = pinned(rows.select("event_date").distinct().withColumn("part", number))
    parted = rows.join(F.broadcast(dates), "event_date").select(*rows.columns, "part")
    return [parted.filter(F.col("part") == part).drop("part") for part in range(1, STREAM_BATCHES + 1)]


def _partials(spark: SparkSession, sf_dir: str) -> str:
    """Path of the partial rows of a stream over the curated readings, each reading sent twice, in
    runs of the stream that each take the new files, however many."""
    base = scratch_path(spark, "partials")
    rows = _curated(spark, sf_dir)
    for batch in _reading_batches(rows.union(rows)):
        batch.write.mode("append").parquet(f"{base}/readings")
        readings = tables.table_stream(spark, f"{base}/readings", CURATED_TABLE)
        jobs.partial_job(
            readings, f"{base}/partials", f"{base}/state", trigger=NOW_AVAILABLE
        ).awaitTermination()
    return f"{base}/partials"


def _folded(spark: SparkSession, sf_dir: str, minutes: int) -> DataFrame:
    """KPIs of the windows that the stream has closed."""
    partials = tables.partial_scan(spark, _partials(spark, sf_dir))
    last = newest.newest_time(spark, _curated_table(spark, sf_dir), CURATED_TABLE)
    return kpis.fold(partials, minutes, last - F.expr("INTERVAL 10 MINUTES"))


def stream_window_kpis(minutes: int) -> Query:
    return lambda spark, sf_dir: settled(_folded(spark, sf_dir, minutes))


def stream_maintenance_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "episodes")
    write_batch(src.curated(spark, sf_dir), 0, f"{base}/curated", ["event_date"], "event_id")
    readings = tables.table_stream(spark, f"{base}/curated", CURATED_TABLE)
    jobs.run_job(
        readings, f"{base}/curated", f"{base}/runs", f"{base}/state", trigger=NOW_AVAILABLE
    ).awaitTermination()
    return jobs.stored_episodes(spark, f"{base}/runs")


def stream_alert_breaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(kpis.alert_breaches(_folded(spark, sf_dir, 60)))


# Upkeep -----------------------------------------------------------------------------------------


def compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day written in two batches and merged into one."""
    base = scratch_path(spark, "compaction")
    path = f"{base}/curated"
    rows, half = src.curated(spark, sf_dir), F.pmod(F.xxhash64("event_id"), F.lit(2))
    for number in range(2):
        write_batch(rows.filter(half == number), number, path, ["event_date"], "event_id")
    days = retention.partition_dates(spark, path, "event_date")
    rewrite.compact(spark, path, CURATED_TABLE, "event_date", days, ["event_date"], "event_id")
    stored = tables.table_scan(spark, path, CURATED_TABLE)
    return whole(stored)


def curated_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left six hours after the newest reading."""
    base = scratch_path(spark, "retention")
    write_batch(src.curated(spark, sf_dir), 0, f"{base}/curated", ["event_date"], "event_id")
    stored = tables.table_scan(spark, f"{base}/curated", CURATED_TABLE)
    now = stored.agg(F.max("event_ts")).first()[0]
    retention.curated_retention(spark, f"{base}/curated", now)
    left = tables.table_scan(spark, f"{base}/curated", CURATED_TABLE)
    return left.select("event_id", "plant_id", "event_ts")


def raw_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of the raw layer when its newest record came in."""
    base = scratch_path(spark, "retention")
    stored = raw.raw_project(_frame(spark, sf_dir))
    write_batch(stored, 0, f"{base}/raw", ["ingest_date"], "kafka_offset")
    now = stored.agg(F.max("kafka_timestamp")).first()[0]
    retention.raw_retention(spark, f"{base}/raw", now, RETENTION)
    left = tables.table_scan(spark, f"{base}/raw", RAW_TABLE)
    return left.select("kafka_offset", "kafka_key", "kafka_timestamp")


def kpi_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of a KPI table at its newest window."""
    base = scratch_path(spark, "retention")
    table = _kpis_1h(spark, sf_dir).withColumn("window_date", F.to_date("window_start"))
    write_batch(table, 0, f"{base}/kpis", ["window_date"], "plant_id")
    now = tables.kpi_scan(spark, f"{base}/kpis").agg(F.max("window_start")).first()[0]
    retention.kpi_retention(spark, f"{base}/kpis", now, RETENTION)
    return tables.kpi_scan(spark, f"{base}/kpis").select("plant_id", "window_start", "event_count")


def layer_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One layer under two bounds, ten minutes after its newest file; and a layer that is not there."""
    path = f"{sf_dir}/events.parquet"
    newest_file = tables.data_files(spark, path).agg(F.max("modificationTime")).first()[0]
    layers = {"within": (path, 601), "beyond": (path, 600), "absent": (f"{sf_dir}/none.parquet", 601)}
    found = freshness.layer_freshness(spark, layers, newest_file + timedelta(seconds=600))
    return found.select("layer", (F.col("files") > 0).alias("has_files"), "age_seconds", "healthy")


def rebuild_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KPI windows of all days again, after late readings, in place of the rows without them."""
    base = scratch_path(spark, "rebuild")
    rows, late = src.curated(spark, sf_dir), F.col("kafka_offset") % 20 == 7
    for number, part in enumerate((rows.filter(~late), rows.filter(late))):
        write_batch(part, number, f"{base}/curated", ["event_date"], "event_id")
        rewrite.rebuild_windows(
            spark,
            f"{base}/curated",
            CURATED_TABLE,
            f"{base}/kpis",
            60,
            date(1970, 1, 1),
            date(9999, 12, 31),
        )
    return settled(tables.kpi_scan(spark, f"{base}/kpis"))


def repair_late_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A twentieth of the readings comes after its windows were given out; the windows they touch are
    repaired, and hours are folded from them."""
    base = scratch_path(spark, "repair")
    rows, late = _curated(spark, sf_dir), F.col("kafka_offset") % 20 == 7
    sink = dirty.noting(
        batch_writer(f"{base}/curated", ["event_date"], "event_id"), f"{base}/curated", f"{base}/ledger"
    )
    sink(rows.filter(~late), 0)
    stored = tables.table_scan(spark, f"{base}/curated", CURATED_TABLE)
    partials = kpis.partial_kpis(stored, tables.PARTIAL_MINUTES)
    dated = partials.withColumn("window_date", F.to_date("window_start"))
    write_batch(dated, 0, f"{base}/partials", ["window_date"], "plant_id")
    sink(rows.filter(late), 1)
    dirty.repair(spark, f"{base}/curated", CURATED_TABLE, f"{base}/partials", f"{base}/ledger")
    return settled(kpis.fold(tables.partial_scan(spark, f"{base}/partials"), 60))


def _curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.table_scan(spark, _curated_table(spark, sf_dir), CURATED_TABLE)


def queries() -> dict[str, Query]:
    curated, metered = src.curated, _metered
    time_line = ["plant_id", "event_ts", "event_id"]
    latest_columns = [
        f.name
        for f in KPI_TABLE
        if f.dataType.simpleString() == "double" or f.name == "plant_name"
    ]
    return {
        "window_kpis_1m": _on(_kpis(1), settled),
        "window_kpis_5m": _on(_kpis_5m, settled),
        "window_kpis_1h": _on(_kpis_1h, settled),
        "merge_kpis": merge_kpis,
        "quality_filter": _pick(_usable, "event_id", "plant_id", "power_mw", "efficiency"),
        "quality_rejects": quality_rejects,
        "calendar_columns": _on(
            _pick(curated, "event_id", "event_ts", "event_date", "event_hour"), dates_as_text
        ),
        "performance_columns": _pick(curated, "event_id", *PERFORMANCE),
        "alert_flags": _pick(curated, "event_id", *FLAGS),
        "derived_metrics": _pick(metered, "event_id", *METRICS),
        "alert_level": _pick(metered, "event_id", "alert_level"),
        "alert_level_v2": alert_level_v2,
        "expected_efficiency": expected_efficiency(CURVE),
        "expected_efficiency_v2": expected_efficiency(CURVE_V2),
        "enrich_with_plant": enrich_with_plant,
        "flag_unknown_plants": flag_unknown_plants,
        "unknown_plants": unknown_plants,
        "dedup_events": dedup_events,
        "anomaly_filter": _pick(
            _on(curated, insight.anomaly_filter), "event_id", "plant_id", "event_ts"
        ),
        "anomaly_filter_text": anomaly_filter_text,
        "active_plants_filter": _pick(
            _on(curated, lambda df: insight.active_plants_filter(df, ["plant_1", "plant_3"])),
            "event_id",
            "plant_id",
            "power_mw",
        ),
        "drop_missing": _pick(
            _on(curated, lambda df: insight.drop_missing(df, ["turbine_temp_c"])),
            "event_id",
            "turbine_temp_c",
            "wear_index",
        ),
        "project_existing": project_existing,
        "recent_window_data_anchored": _pick(
            _on(_recent_days(60), lambda df: insight.recent_window(df, 60)),
            "event_id",
            "plant_id",
            "event_ts",
            "power_mw",
        ),
        "recent_window_summary": _on(
            _recent_days(60), lambda df: insight.recent_window_summary(df, 60)
        ),
        "recent_window_or_last_n": recent_window_or_last_n,
        "last_n_by_time": _pick(
            _on(_newest_rows(insight.SNAPSHOT_ROWS), insight.last_n_by_time),
            "event_id",
            "plant_id",
            "event_ts",
        ),
        "minute_series": _on(
            _recent_days(60), lambda df: insight.minute_series(df, 60), settle=True
        ),
        "latest_per_plant": _on(
            _kpis_1h, lambda df: insight.latest_per_plant(df, latest_columns), settle=True
        ),
        "fleet_kpis": _on(_kpis_5m, insight.fleet_kpis, settle=True),
        "alert_totals_per_plant": _on(_kpis_5m, insight.alert_totals_per_plant),
        "health_board": _on(_kpis_1h, insight.health_board, settle=True),
        "silver_snapshot": silver_snapshot(),
        "silver_snapshot_compat": silver_snapshot(compat=True),
        "silver_snapshot_fallback": silver_snapshot(days_later=1),
        "source_fallback": source_fallback(with_kpis=True),
        "source_fallback_snapshot": source_fallback(with_kpis=False),
        "top_recent_anomalies": _on(
            _newest_rows(insight.TOP_ANOMALIES, "is_anomaly"), insight.top_recent_anomalies
        ),
        "anomaly_level_counts": _on(
            _newest_rows(insight.TOP_ANOMALIES, "is_anomaly"), insight.anomaly_level_counts
        ),
        "anomaly_scan_coverage": _on(_events, insight.anomaly_scan_coverage),
        "file_census": file_census,
        "recent_files_scan": recent_files_scan,
        "kpi_table_view_5m": _on(_kpis_5m, insight.kpi_table_view),
        "kpi_table_view_1h": _on(_kpis_1h, insight.kpi_table_view),
        "newest_first": _on(_kpis_1h, insight.newest_first, settle=True),
        "distinct_plants": _on(_usable, insight.distinct_plants),
        "plant_palette_index": _on(_usable, insight.plant_palette_index),
        "rain_power_regression": _pick(
            _on(_kpis_1h, insight.rain_power_regression, settle=True),
            "windows",
            "slope",
            "intercept",
            "rain_min",
            "rain_max",
        ),
        "rain_power_regression_per_plant": _on(
            _kpis_1h, lambda df: insight.rain_power_regression(df, ["plant_id"]), settle=True
        ),
        "rain_power_trend_line": trend_line,
        "power_distribution": power_distribution("linear"),
        "power_distribution_midpoint": power_distribution("midpoint"),
        "power_outliers": _pick(
            _on(_usable, distribution.power_outliers), "plant_id", "power_mw"
        ),
        "value_outliers": _pick(
            _on(_usable, lambda df: distribution.power_outliers(df, "value")), "event_id", "plant_id", "value"
        ),
        "running_energy": _pick(
            _on(metered, history.running_energy, settle=True), *time_line, "cumulative_energy_mwh"
        ),
        "energy_balance_per_window": energy_balance,
        "running_availability": _pick(
            _on(metered, history.running_availability),
            *time_line,
            "available_readings",
            "total_readings",
            "availability",
        ),
        "running_oee": _pick(_on(metered, history.running_oee), *time_line, "oee"),
        "maintenance_episodes": _on(metered, history.maintenance_episodes),
        "maintenance_seconds": _on(
            _on(metered, history.maintenance_episodes), history.maintenance_seconds
        ),
        "alert_breaches": _on(_kpis_1h, kpis.alert_breaches, settle=True),
        "documented_kpis_5m": _on(_kpis_5m, kpis.documented_kpis_5m, settle=True),
        "documented_kpis_1h": documented_kpis_1h,
        "bronze_project": bronze_project,
        "parse_events": parse_events,
        "curated_from_json": curated_from_json,
        "curated_from_bronze": curated_from_bronze,
        "quarantine": quarantine,
        "union_schema_versions": union_schema_versions,
        "union_files_by_name": union_files_by_name,
        "stream_bronze": stream_bronze,
        "stream_curated": stream_curated,
        "stream_quarantine": stream_quarantine,
        "stream_window_kpis_5m": stream_window_kpis(5),
        "stream_window_kpis_1h": stream_window_kpis(60),
        "stream_maintenance_episodes": stream_maintenance_episodes,
        "stream_alert_breaches": stream_alert_breaches,
        "rebuild_windows": rebuild_windows,
        "repair_late_windows": repair_late_windows,
        "single_file_compaction": compaction,
        "retention_by_partition_date": curated_retention,
        "keyed_json_publish": keyed_json_publish,
        "event_key": event_key,
        "plant_label": plant_label,
        "oee_below_min": oee_below_min,
        "table_scan": table_scan,
        "layer_freshness": layer_freshness,
        "raw_retention": raw_retention,
        "kpi_retention": kpi_retention,
    }
