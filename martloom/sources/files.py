"""Delimited text, parquet and JSON files; local, HDFS and object-store paths alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martloom.operators.increments import past_watermark


def read_delimited(spark: SparkSession, path: str, schema: StructType, separator: str = ",",
                   quote: str = '"') -> DataFrame:
    """Text with a header line and an explicit schema; no inference pass.

    ``path`` may use any scheme the cluster knows, object stores included.
    """
    return (spark.read.schema(schema).option("header", True).option("sep", separator)
            .option("quote", quote).option("escape", quote).csv(path))


def write_delimited(df: DataFrame, path: str, separator: str = ",", quote_all: bool = False) -> None:
    """Text with a header line."""
    (df.write.mode("overwrite").option("header", True).option("sep", separator).option("quote", '"')
     .option("escape", '"').option("quoteAll", quote_all).csv(path))


def bulk_load(spark: SparkSession, text_path: str, schema: StructType, table_path: str,
              partition_by: list[str] | None = None) -> DataFrame:
    """Load quoted text into a typed parquet table; Spark splits the files by itself."""
    write_table(read_delimited(spark, text_path, schema), table_path, partition_by)
    return spark.read.parquet(table_path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Parquet table, replaced or appended to; with partitions only those written are replaced."""
    writer = df.write.mode(mode)
    if partition_by:
        # rows of a partition are dealt to writer tasks by size, so a hot day is several files
        df = df.hint("rebalance", *partition_by)
        writer = df.write.mode(mode).partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def append_run(df: DataFrame, path: str, run_date: str) -> None:
    """Append one run so that repeating it does not double the rows: its own partition is replaced."""
    write_table(df.withColumn("run_date", F.lit(run_date)), path, ["run_date"])


def read_partition(spark: SparkSession, path: str, column: str, value: str | Column,
                   schema: StructType | None = None) -> DataFrame:
    """Rows of one partition; the filter prunes the other folders."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path).filter(F.col(column) == value)


def read_json_increment(spark: SparkSession, landing: str, schema: StructType, key: str,
                        loaded: DataFrame, loaded_key: str) -> DataFrame:
    """Rows of landed JSON snapshots whose id lies above what is already loaded."""
    return past_watermark(spark.read.schema(schema).json(landing), key, loaded, loaded_key)


def preview(df: DataFrame, order: list[Column], rows: int = 10) -> DataFrame:
    """First rows in a stated order."""
    return df.orderBy(*order).limit(rows)


def named_views(frames: dict[str, DataFrame]) -> None:
    """Register frames under names for SQL users."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
