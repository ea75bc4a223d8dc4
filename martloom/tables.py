"""Access to the sample tables with their explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martloom.schemas import SAMPLE_TABLES


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Scan one sample table; no schema inference job."""
    return spark.read.schema(SAMPLE_TABLES[name]).parquet(f"{base}/{name}.parquet")


def stream(spark: SparkSession, base: str, name: str, max_files: int | None = None) -> DataFrame:
    """The same table as a stream of files.

    The one-letter glob makes a single file and a folder of part files work alike.
    """
    reader = spark.readStream.schema(SAMPLE_TABLES[name])
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{base}/{name}.parque[t]")
