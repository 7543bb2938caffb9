"""Sharding by a two-pass external shuffle.

Pass one scatters the records uniformly over buckets that fit into memory, by a seeded hash. Pass
two shuffles each bucket with Fisher-Yates, which is what Spark's `shuffle` does with an array. The
buckets, one after the other, are a permutation of all records, which is cut into shards whose
numbers of rows are at most one apart. Only DataFrame expressions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penstock.llm import common

SEED = 42
BUCKET_BYTES = 8 << 20
# Stands for the fields beside the text.
OVERHEAD = 16


def size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD


def shuffled(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, seed: int = SEED) -> tuple[DataFrame, int]:
    """`row` (the record) with `position`, gapless from 0, and the number of records.

    Buckets hold about `bucket_bytes`, however large the table: their number follows from its size,
    and a bucket goes by the hash of id and text, so copies of a text spread like other records.
    Records equal in both lie in one bucket. Collected: the table's size, and nothing else."""
    total, rows = docs.agg(F.sum(size(F.col("text"))), F.count("*")).first()
    n_buckets = max(1, -(-(total or 0) // bucket_bytes))
    scattered = docs.select(F.struct("*").alias("row"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("order"))
    scattered = scattered.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "order"), F.lit(n_buckets)))
    sizes = scattered.groupBy("bucket").agg(F.count("*").alias("n"))
    starts = common.starts(sizes, [], "bucket")
    # In the order of their hashes records come into the array alike at every attempt of a task.
    met = scattered.repartition("bucket").sortWithinPartitions("bucket", "order")
    filled = met.groupBy("bucket").agg(F.collect_list("row").alias("rows"))
    mixed = filled.select("bucket", F.shuffle("rows", seed).alias("rows"))
    placed = mixed.join(starts, "bucket").select("before", F.posexplode("rows").alias("place", "row"))
    return placed.select("row", (F.col("before") + F.col("place")).alias("position")), rows


def cut(position: Column, total: int, shards: int) -> tuple[Column, Column]:
    """(shard, slot): the first `total % shards` shards have one row more than the others."""
    small, more = divmod(total, shards)
    edge = more * (small + 1)
    shard = F.when(position < edge, F.floor(position / F.lit(small + 1))).otherwise(
        more + F.floor((position - edge) / F.lit(max(small, 1)))
    )
    start = F.least(shard, F.lit(more)) * (small + 1) + F.greatest(shard - more, F.lit(0)) * small
    return shard.cast("int"), (position - start).cast("long")


def sharded(docs: DataFrame, shards: int, bucket_bytes: int = BUCKET_BYTES, seed: int = SEED) -> DataFrame:
    """`row`, `shard` (from 0) and `slot` (gapless from 0 in its shard).

    Null texts and ids are values like others, null texts of size 16. Repeated rows are all kept.
    With fewer records than shards the last shards are empty."""
    placed, total = shuffled(docs, bucket_bytes, seed)
    shard, slot = cut(F.col("position"), total, shards)
    return placed.select("row", shard.alias("shard"), slot.alias("slot"))


def write(placed: DataFrame, path: str) -> None:
    """A folder for each shard, written by the tasks that shuffled; files hold `row` and `slot`."""
    placed.write.partitionBy("shard").parquet(path)
