"""Replacing the batches of a closed day: compaction, and windows with late data."""

from __future__ import annotations

import json
import time
import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from penstock.operators import curated, kpis
from penstock.sources.tables import table_scan
from penstock.streaming.sinks import BATCH, write_batch
from penstock.upkeep.files import Folder

STAGED = "_staged"
MANIFEST = "_replaces"


def with_columns_of_layout(schema: T.StructType, *columns: tuple[str, T.DataType]) -> T.StructType:
    """A declared schema with the partition columns the layout adds."""
    known = set(schema.names)
    added = [T.StructField(n, kind) for n, kind in columns if n not in known]
    return T.StructType(schema.fields + added)


def replace_batches(
    spark: SparkSession, path: str, old: list[str], new: DataFrame, by: list[str], spread: str
) -> None:
    """Put `new` in place of the batch folders `old`, which were listed before `new` was read.

    A batch that arrives meanwhile has a folder of its own and is not touched. The new files are
    complete before the first old one goes; after a failure `finish` completes the change. In
    between, readers of these partitions see part of the rows, so run it on closed days.
    """
    stage = Folder(spark, path).below(f"{STAGED}/{uuid.uuid4().hex}")
    # Negative numbers keep rewritten batches apart from those of the stream.
    write_batch(new.drop(BATCH), -time.time_ns(), stage.path, by, spread)
    stage.write_text(MANIFEST, json.dumps(old))
    _swap(spark, path, stage)


def finish(spark: SparkSession, path: str) -> int:
    """Complete rewrites that were interrupted after their files were written; drop others.

    Call it before a rewrite starts, not while one is at work on the table.
    """
    staged = Folder(spark, path).below(STAGED)
    names = staged.folders()
    for name in names:
        stage = staged.below(name)
        if stage.read_text(MANIFEST) is None:
            stage.delete()
        else:
            _swap(spark, path, stage)
    return len(names)


def _swap(spark: SparkSession, path: str, stage: Folder) -> None:
    table = Folder(spark, path)
    for leaf in json.loads(stage.read_text(MANIFEST)):
        table.below(leaf).delete()
    for leaf in stage.leaves(BATCH):
        stage.below(leaf).move_to(f"{path}/{leaf}")
    stage.delete()


def batches_of(spark: SparkSession, path: str, column: str, day: date) -> list[str]:
    name = f"{column}={day.isoformat()}"
    return [f"{name}/{leaf}" for leaf in Folder(spark, path).below(name).leaves(BATCH)]


def compact(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    column: str,
    days: list[date],
    by: list[str],
    spread: str,
) -> int:
    """The batches of closed days as one batch with few, even files, in one job for all days.

    Days that are a single batch already are left alone. Returns the folders merged. A stream that
    reads this table sees the merged files as new; its watermark drops their rows as late, so a
    day is closed once every watermark has passed it.
    """
    per_day = [batches_of(spark, path, column, day) for day in days]
    old = [leaf for leaves in per_day if len(leaves) > 1 for leaf in leaves]
    if not old:
        return 0
    full = with_columns_of_layout(schema, (column, T.DateType()), (BATCH, T.LongType()))
    reader = spark.read.schema(full).option("basePath", path)
    rows = reader.parquet(*[f"{path}/{leaf}" for leaf in old])
    replace_batches(spark, path, old, rows, by, spread)
    return len(old)


def rebuild_windows(
    spark: SparkSession,
    curated_path: str,
    curated_schema: T.StructType,
    kpi_path: str,
    minutes: int,
    first: date,
    last: date,
) -> None:
    """KPI windows of closed days again from the curated table, late readings included.

    Window widths that divide a day, as all of ours do, never reach over midnight. Days that have
    KPIs but no readings any more cannot be rebuilt: the call is refused before anything changes.
    """
    old, gone = [], []
    sources = {n.partition("=")[2] for n in Folder(spark, curated_path).folders() if n.startswith("event_date=")}
    for name in Folder(spark, kpi_path).folders():
        value = name.partition("=")[2]
        if name.startswith("window_date=") and first.isoformat() <= value <= last.isoformat():
            if value not in sources:
                gone.append(value)
            old += [f"{name}/{leaf}" for leaf in Folder(spark, kpi_path).below(name).leaves(BATCH)]
    if gone:
        raise ValueError(f"no curated readings for {', '.join(sorted(gone))}")
    days = F.col("event_date").between(first, last)
    readings = table_scan(spark, curated_path, curated_schema).filter(days)
    windows = kpis.window_kpis(curated.dedup_events(readings), minutes)
    dated = windows.withColumn("window_date", F.to_date("window_start"))
    replace_batches(spark, kpi_path, old, dated, ["window_date"], "plant_id")
