"""The stored layers, as tables and as streams of new files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from penstock.model import CURATED_TABLE, KPI_TABLE
from penstock.operators import kpis
from penstock.settings import Settings

# Width of the windows that are stored as partial rows; the widths of all KPI tables are multiples.
PARTIAL_MINUTES = 5


def table_scan(
    spark: SparkSession, path: str, schema: T.StructType, skip_unreadable: bool = False
) -> DataFrame:
    """A layer with its declared schema, so partition values keep their types.

    Filters and columns asked for later reach the scan; partitions prune by their values.
    Layout columns the schema does not name, such as the batch number, are left out.
    """
    reader = spark.read.schema(schema)
    if skip_unreadable:
        reader = reader.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
    return reader.parquet(path).select(*schema.names)


def kpi_scan(spark: SparkSession, path: str, skip_unreadable: bool = False) -> DataFrame:
    """KPI rows; a damaged or vanished file is an error unless asked to be skipped."""
    return table_scan(spark, path, KPI_TABLE, skip_unreadable).dropna(subset=["window_start"])


def partial_scan(spark: SparkSession, path: str) -> DataFrame:
    """Partial KPI rows by window date, to be folded into any width (`kpis.fold`)."""
    rows = kpis.partial_kpis(spark.createDataFrame([], CURATED_TABLE), PARTIAL_MINUTES)
    return table_scan(spark, path, T.StructType(rows.schema.fields + [T.StructField("window_date", T.DateType())]))


def text_window_bounds(kpis: DataFrame) -> DataFrame:
    """Window bounds stored as text, as times; rows whose start does not parse are dropped."""
    parsed = kpis.withColumns(
        {c: F.try_to_timestamp(F.col(c)) for c in ("window_start", "window_end")}
    )
    return parsed.dropna(subset=["window_start"])


def table_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """New files of a layer, all of them per trigger unless `max_files` is set. The schema is
    declared, so the layer may still be empty."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path).select(*schema.names)


def settings_stream(
    spark: SparkSession, path: str, schema: T.StructType, settings: Settings
) -> DataFrame:
    """`table_stream` with the intake of the job settings."""
    return table_stream(spark, path, schema, settings.max_files_per_trigger or None)


def schema_probe(spark: SparkSession, path: str) -> T.StructType:
    """The schema the files themselves state; for tables that have no declared one."""
    return spark.read.parquet(path).schema


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per data file: path, modification time, length. No file is opened.

    Folders and files whose names start with _ or . are not data and are left out.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = listing.option("pathGlobFilter", "*.parquet").load(path)
    return files.select("path", "modificationTime", "length")


def recent_files_scan(
    spark: SparkSession, path: str, schema: T.StructType, n: int = 60, skip_unreadable: bool = False
) -> DataFrame:
    """Rows of the n most recently written files; the other files are not opened.

    Only the n paths come to the driver. A damaged or vanished file is an error unless asked to be
    skipped.
    """
    newest = data_files(spark, path).orderBy(F.col("modificationTime").desc(), "path").limit(n)
    paths = [row.path for row in newest.select("path").collect()]
    if not paths:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    if skip_unreadable:
        reader = reader.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
    if paths != [path] and not paths[0].endswith(path):
        reader = reader.option("basePath", path)  # partition values come from below it
    return reader.parquet(*paths)


def file_census(tables: dict[str, DataFrame]) -> DataFrame:
    """Files and rows of each layer. Rows come from the file footers, not from the data."""
    counted = None
    for layer, table in tables.items():
        per_file = table.groupBy(F.col("_metadata.file_path").alias("file")).count()
        one = per_file.agg(
            F.lit(layer).alias("layer"),
            F.count(F.lit(1)).alias("files"),
            F.coalesce(F.sum("count"), F.lit(0)).alias("rows"),
        )
        counted = one if counted is None else counted.union(one)
    return counted
