"""What the operators of this folder share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from penstock.session import scratch_path
from penstock.upkeep.files import Folder

# A word: a run of characters other than space, tab, newline, vertical tab, form feed, return.
# `bytes.split()` cuts at the same six characters.
WORD = r"[^\x20\x09-\x0D]+"
# Numbers that one window of a running sum holds.
SPAN = 4096
# Texts that go to a Python worker at once, where few_texts() holds.
TEXTS = 500


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written once to the shared folder and read back: lineage ends here, and every later
    read sees the same rows also after executors were lost."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def few_texts(spark: SparkSession) -> Iterator[None]:
    """For tables written inside: Arrow batches of at most TEXTS rows. Executor and worker each hold whole
    batches outside the heap, several times over."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    own = int(before)
    spark.conf.set(key, str(min(own, TEXTS) if own > 0 else TEXTS))
    try:
        yield
    finally:
        spark.conf.set(key, before)


class Scratch:
    """Tables of one operator below a folder of its own, so that they can go as soon as the tables
    made of them are written."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.path = scratch_path(spark, label)
        self.last = ""
        self._count = 0

    def name(self, label: str) -> str:
        """A name not used before; `last` is the newest."""
        self._count += 1
        self.last = f"{label}-{self._count}"
        return self.last

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            Folder(self.spark, f"{self.path}/{name}").delete()

    def clear(self) -> None:
        Folder(self.spark, self.path).delete()


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo `divisor`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % divisor


def starts(counts: DataFrame, keys: list[str], order: str, span: int = SPAN) -> DataFrame:
    """`keys`, `order` and `before`: the sum of `n` over the rows of the same keys with a smaller
    `order`, a whole number from 0 that occurs once for each key; keys are not null.

    Sums of spans of `span` numbers come first, so no window holds all of a key's rows."""
    cut = counts.withColumn("span", F.expr(f"`{order}` div {span}"))
    along = Window.partitionBy(*keys).orderBy("span")
    inside = Window.partitionBy(*keys, "span").orderBy(order)
    spans = cut.groupBy(*keys, "span").agg(F.sum("n").alias("whole"))
    spans = spans.select(*keys, "span", (F.sum("whole").over(along) - F.col("whole")).alias("earlier"))
    own = cut.withColumn("own", F.sum("n").over(inside) - F.col("n"))
    return own.join(spans, [*keys, "span"]).select(*keys, order, (F.col("earlier") + F.col("own")).alias("before"))
