"""Sinks that can be given the same micro-batch twice."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from penstock.upkeep.files import Folder

BATCH = "batch_id"
BatchFunction = Callable[[DataFrame, int], None]
Dedup = Callable[[DataFrame], DataFrame]


@contextmanager
def adaptive(session: SparkSession):
    """Adaptive execution for a write inside foreachBatch.

    A stateful stream runs with it off, since its state fixes the number of partitions. The batch
    handed to the sink is an ordinary table by then, whose rebalance would else be left out.
    """
    key = "spark.sql.adaptive.enabled"
    before = session.conf.get(key)
    session.conf.set(key, "true")
    try:
        yield
    finally:
        session.conf.set(key, before)


def write_batch(
    df: DataFrame, batch_id: int, path: str, by: list[str], spread: str, ways: int = 8
) -> None:
    """Write one batch to partitions of its own; writing it again replaces them.

    The rows of one partition are cut into `ways` pieces by a hash of the `spread` column, so a
    plant that sends a third of all rows is not written by one task. The rebalance hint then
    merges small pieces and splits large ones to the session's advised size.
    """
    way = F.pmod(F.xxhash64(spread), F.lit(ways))
    stamped = df.withColumns({BATCH: F.lit(batch_id).cast("long"), "_way": way})
    with adaptive(df.sparkSession):
        spread_out = stamped.hint("rebalance", *by, "_way").drop("_way")
        (
            spread_out.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "snappy")
            .partitionBy(*by, BATCH)
            .parquet(path)
        )


def batch_writer(path: str, by: list[str], spread: str, ways: int = 8) -> BatchFunction:
    """For foreachBatch. A batch without rows writes no partition."""
    return lambda batch, batch_id: write_batch(batch, batch_id, path, by, spread, ways)


def unique_writer(path: str, by: list[str], spread: str, key: str, day: str, first: Dedup) -> BatchFunction:
    """As `batch_writer`, for a table that holds each `key` once, however late it comes again.

    The table is its own index: a repeat carries the time of the first record, so it is looked for in
    the days of the batch only, in one column. Ids of the batch are met with those stored first, which
    broadcasts them while the batch is small; what the batch shares with the table is smaller still.
    The batch's own rows of an earlier attempt are no repeats. Batches are written one at a time."""

    def run(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        rows = first(batch).persist()
        try:
            days = [r[0] for r in rows.select(day).distinct().collect()]
            if not days:
                return
            if stored(session, path):
                schema = T.StructType([rows.schema[key], rows.schema[day], T.StructField(BATCH, T.LongType())])
                known = session.read.schema(schema).parquet(path)
                known = known.filter(F.col(day).isin(days) & (F.col(BATCH) != batch_id)).select(key, day)
                with adaptive(session):
                    repeats = known.join(rows.select(key, day), [key, day], "left_semi").distinct()
                    write_batch(rows.join(repeats, [key, day], "left_anti"), batch_id, path, by, spread)
            else:
                write_batch(rows, batch_id, path, by, spread)
        finally:
            rows.unpersist()

    return run


def stored(session: SparkSession, path: str) -> bool:
    """Whether there is a table yet."""
    return bool(Folder(session, path).folders())


def every(batches: int, task: Callable[[], None], then: BatchFunction) -> BatchFunction:
    """`then` for each batch, and `task` after each n-th; the count survives a restart."""

    def run(batch: DataFrame, batch_id: int) -> None:
        then(batch, batch_id)
        if (batch_id + 1) % batches == 0:
            task()

    return run
