"""Records that are no events, a curated table without repeats, and intake from the settings."""

import json

import pytest
from pyspark.sql import functions as F

from penstock.model import CURATED_TABLE, EVENT_JSON
from penstock.operators import curated
from penstock.settings import Settings
from penstock.sources import log, tables
from penstock.sources import readings as src
from penstock.streaming import jobs
from penstock.streaming.sinks import unique_writer
from penstock.upkeep import freshness

FRAME = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp"


def frame_of(spark, texts):
    rows = [(None, None if t is None else bytearray(t.encode()), "t", 0, i, None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, FRAME)


def test_reasons_and_unknown_fields(spark):
    good = {"event_id": "e", "usina_id": "p", "potencia_mw": 1.5, "eficiencia": 0.9, "simulacao_t": 7}
    texts = [
        json.dumps(good),
        json.dumps(good | {"novo": {"a": [1, None]}, "outro": "x", "nulo": None}),
        json.dumps(good | {"potencia_mw": "much", "metadata": 3}),
        json.dumps(good)[:-5],
        "[1]",
        "null",
        '"text"',
        "",
        "  ",
        None,
        "{}",
    ]
    rows = {r.kafka_offset: r for r in curated.parse_variant(frame_of(spark, texts)).collect()}
    errors = [rows[i].json_error for i in range(len(texts))]
    no_object, empty = "no JSON object", "empty record"
    assert errors == [None, None, None, "not JSON", no_object, no_object, no_object, empty, empty, empty, None]
    assert rows[0].power_mw == 1.5 and rows[0].sim_step == 7 and rows[0].unknown_fields == {}
    found = rows[1].unknown_fields
    assert {k: json.loads(v) for k, v in found.items()} == {"novo": {"a": [1, None]}, "outro": "x", "nulo": None}
    assert rows[2].power_mw is None and rows[2].metadata is None and rows[2].efficiency == 0.9
    assert rows[10].event_id is None and rows[3].unknown_fields is None
    reasons = {r.kafka_offset: r.reason for r in curated.quarantine(frame_of(spark, texts)).collect()}
    assert reasons[3] == "not JSON" and reasons[4] == no_object and reasons[7] == empty
    assert reasons[9] == reasons[10] == "missing event id" and reasons[2] == "missing power" and reasons[0] == "no event time"


def test_both_parsers_agree(spark, sf_dir):
    frame = src.event_frame(src.readings(spark, sf_dir))
    one = curated.parse_events(frame)
    other = curated.parse_variant(frame).select(*one.columns)
    assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()
    assert len(EVENT_JSON) == 33


def test_text_is_parsed_once(spark, sf_dir):
    frame = src.event_frame(src.readings(spark, sf_dir))
    wanted = curated.parse_variant(frame).filter("power_mw > 1 and efficiency > 0").select("event_id", "oee")
    text = wanted._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("VariantExpressionEvalUtils") == 1, text


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    days = ("2024-01-03", "2024-01-04")
    found = src.curated(spark, sf_dir).filter(F.col("event_date").cast("string").isin(*days))
    return found.limit(60).persist()


def test_a_repeat_of_any_age_is_stored_once(spark, rows, tmp_path):
    path = str(tmp_path / "curated")
    sink = unique_writer(path, ["event_date"], "event_id", "event_id", "event_date", curated.dedup_events)
    later = rows.withColumn("kafka_offset", F.col("kafka_offset") + 10**9)
    first = rows.filter("event_date = '2024-01-03'")
    sink(first.union(first), 0)
    sink(rows.filter("event_date = '2024-01-04'"), 1)
    sink(later, 2)  # all of it again
    sink(later.limit(0), 3)
    sink(rows.filter("event_date = '2024-01-04'"), 1)  # batch 1 once more, after a failure
    spark.catalog.refreshByPath(path)
    stored = tables.table_scan(spark, path, CURATED_TABLE)
    assert stored.exceptAll(rows).isEmpty() and rows.exceptAll(stored).isEmpty()


def test_curated_job_without_repeats(spark, sf_dir, tmp_path):
    base = str(tmp_path)
    frame = src.event_frame(src.readings(spark, sf_dir).filter("event_ts < '2024-01-04'"))
    for number in range(3):
        again = frame.withColumn("offset", F.col("offset") + number * 10**9)
        again.coalesce(1).write.mode("append").parquet(f"{base}/log")
    jobs.curated_job(
        log.frame_source(spark, f"{base}/log", max_files=1), f"{base}/curated", f"{base}/state",
        by=["event_date"], trigger={"availableNow": True}, unique=True,
    ).awaitTermination()
    stored = tables.table_scan(spark, f"{base}/curated", CURATED_TABLE)
    assert stored.count() == curated.curate(frame).count() == stored.select("event_id").distinct().count()


def test_settings_reach_the_readers(spark, tmp_path):
    settings = Settings.from_env(
        {"BOOTSTRAP_SERVERS": "b:1", "TOPIC": "t", "MAX_OFFSETS_PER_TRIGGER": "9", "KPI_FRESH_SECONDS": "5"}
    )
    options = log.settings_options(settings)
    assert options["kafka.bootstrap.servers"] == "b:1" and options["subscribe"] == "t"
    assert options["maxOffsetsPerTrigger"] == "9"
    assert "maxOffsetsPerTrigger" not in log.settings_options(Settings())
    assert freshness.watched_layers("c", "k", settings) == {"curated": ("c", 300), "kpis": ("k", 5)}
    for i in range(3):
        spark.range(i, i + 1).coalesce(1).write.mode("append").parquet(f"{tmp_path}/t")
    schema = spark.read.parquet(f"{tmp_path}/t").schema
    for limit, batches in ((1, 3), (0, 1)):
        stream = tables.settings_stream(spark, f"{tmp_path}/t", schema, Settings(max_files_per_trigger=limit))
        query = (
            stream.writeStream.format("memory").queryName(f"intake{limit}")
            .option("checkpointLocation", f"{tmp_path}/state{limit}").trigger(availableNow=True).start()
        )
        query.awaitTermination()
        assert len([p for p in query.recentProgress if p.numInputRows]) == batches
