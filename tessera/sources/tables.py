"""Table sources (S1): parquet tables by name, ranges and local rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tessera.session import table_path


def load_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    """Read one parquet table; selecting ``columns`` here keeps the scan's
    ReadSchema to exactly what the query uses (Catalyst would prune anyway)."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def range_table(spark: SparkSession, start: int, end: int, step: int = 1,
                num_partitions: int | None = None, name: str = "id") -> DataFrame:
    """``parallelize(range(a, b, s), n)``: generated on the executors, never
    materialised on the driver."""
    df = spark.range(start, end, step, num_partitions)
    return df if name == "id" else df.withColumnRenamed("id", name)


def rows_table(spark: SparkSession, rows: Iterable, schema) -> DataFrame:
    """A small table from local rows with a fixed schema (nothing inferred).
    Only for small, bounded inputs such as parameters and fixtures."""
    return spark.createDataFrame(list(rows), schema=schema)


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan with fewer input splits than the cluster has cores
    (a small or unsplittable file) before CPU-heavy per-row work such as
    tokenizing or parsing.  A large input already has more splits than
    cores, and is returned untouched: no extra shuffle at scale."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    return df.repartition(cores) if splits < cores else df
