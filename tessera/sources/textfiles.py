"""Line-oriented files.

Text is read with ``spark.read.text`` (one row per line, ``value STRING``).
A gzip file cannot be split, so it arrives as one partition per file; it is
repartitioned straight after the scan so the work after it spreads out.
Files written here go to the shared checkpoint folder, never a local one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import shared_dir


def read_lines(spark: SparkSession, path: str, min_partitions: int | None = None,
               decode: bool = True) -> DataFrame:
    """One row for each line.

    ``min_partitions``: at least so many splits, as long as there are so many bytes; the split
    size follows from the files' total size.  ``decode=False``: the line's bytes as they
    are (``value BINARY``, ``parse_status``): a line that is not UTF-8 is ``failed`` and
    loses no byte."""
    lines = _reader(spark, path, min_partitions).text(path)
    if decode:
        return lines
    ok = F.is_valid_utf8("value")
    return lines.select(F.col("value").cast("binary").alias("value"),
                        F.when(ok, F.lit("parsed")).otherwise(F.lit("failed")).alias("parse_status"))


def _reader(spark: SparkSession, path: str, min_partitions: int | None):
    """A reader that splits its files for ``min_partitions``.  Split sizes belong to a
    session, so the table is bound to one of its own; everything else is shared."""
    if not min_partitions:
        return spark.read
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0] or 0
    own = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions"):
        own.conf.set(key, spark.conf.get(key))
    own.conf.set("spark.sql.files.maxPartitionBytes", str(max(1, size // min_partitions)))
    own.conf.set("spark.sql.files.openCostInBytes", "0")  # files are not put together beyond that size
    own.conf.set("spark.sql.files.minPartitionNum", str(min_partitions))
    return own.read


def read_gzip_lines(spark: SparkSession, path: str,
                    num_partitions: int | None = None) -> DataFrame:
    """Read gzip text.  One gzip file is one input split, so fewer files than cores
    (or than ``num_partitions``) are spread over them; more are left as they are."""
    df = spark.read.text(path)
    want = num_partitions or spark.sparkContext.defaultParallelism
    return df.repartition(want) if len(df.inputFiles()) < want else df


def write_lines(spark: SparkSession, lines: DataFrame, purpose: str,
                compression: str | None = None) -> str:
    """Write a one-column string DataFrame as text files into a fresh folder
    under the shared checkpoint location and return the folder."""
    out = shared_dir(spark, purpose)
    writer = lines.select(lines.columns[0]).write.mode("errorifexists")
    if compression:
        writer = writer.option("compression", compression)
    writer.text(out)
    return out


def read_word_set(spark: SparkSession, path: str) -> DataFrame:
    """A word list, one word per line, as a distinct one-column table."""
    return (spark.read.text(path)
            .selectExpr("trim(value) AS word")
            .where("word <> ''")
            .distinct())
