"""Log reports (G1-G17, S5) over parsed access-log records.

Every report is a grouped aggregate: Spark plans a partial aggregate before
the shuffle, so a hot host or endpoint is combined map-side and never lands
whole in one task.  Top-n reports use ``orderBy(...).limit(n)``, which plans
as TakeOrderedAndProject (a bounded per-partition heap); ties break by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from tessera.functions.clf import CLF_FIELDS, parse_clf, parsed_logs
from tessera.session import shared_dir
from tessera.sources.views import clf_lines_from


def load_logs(spark, sf_dir: str) -> DataFrame:
    """Parsed, well-formed access-log records derived from ``events``."""
    return parsed_logs(clf_lines_from(spark, sf_dir))


def read_report(lines: DataFrame) -> DataFrame:
    """Lines per parse status (read = parsed + failed)."""
    return (parse_clf(lines, keep_line=False).groupBy("parse_status")
            .agg(F.count(F.lit(1)).alias("n_lines")))


def load_with_report(lines: DataFrame) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """S4 and S5 in one pass: (parsed records, failed lines, counts).

    Every line is parsed once.  Records and failed lines are written together, in a folder
    of the shared location for each status, and the counts (``read``, ``parsed``, ``failed``) are
    metrics observed on the rows as they are written.  Both tables are then read from what was
    stored.  A metric counts a row of a repeated task once, as its writer commits it once."""
    spark, path, seen = lines.sparkSession, shared_dir(lines.sparkSession, "load"), Observation("load")
    failed = F.col("parse_status") == "failed"
    rows = parse_clf(lines).withColumn("line", F.when(failed, F.col("line")))
    schema = rows.schema
    rows.observe(seen, F.count(F.lit(1)).alias("read"), F.count(F.when(~failed, 1)).alias("parsed"),
                 F.count(F.when(failed, 1)).alias("failed")).write.partitionBy("parse_status").parquet(path)
    back = spark.read.schema(schema).parquet(path)
    return (back.where(F.col("parse_status") == "parsed").select(*CLF_FIELDS),
            back.where(failed).select("line"), {k: int(v) for k, v in seen.get.items()})


def failed_lines(lines: DataFrame) -> DataFrame:
    """The quarantined raw lines (the reference prints a sample of them)."""
    return parse_clf(lines).where(F.col("parse_status") == "failed").select("line")


def content_size_stats(logs: DataFrame) -> DataFrame:
    """Min, max and integer-floored mean content size."""
    return logs.agg(F.min("content_size").alias("min_size"),
                    F.max("content_size").alias("max_size"),
                    F.floor(F.sum("content_size") / F.count(F.lit(1))).alias("avg_size"))


def count_by(logs: DataFrame, key: str) -> DataFrame:
    """A4: rows per key."""
    return logs.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def response_code_counts(logs: DataFrame) -> DataFrame:
    """G1: requests per response code."""
    return count_by(logs, "response_code")


def response_code_share(logs: DataFrame) -> DataFrame:
    """Requests and share of all requests per code.  The total is the sum
    of the grouped counts (a handful of rows), so the log is parsed once."""
    counts = response_code_counts(logs)
    total = F.sum("n").over(Window.partitionBy())
    return counts.select("response_code", "n", (F.col("n") / total).alias("share"))


def frequent_hosts(logs: DataFrame, min_requests: int = 10) -> DataFrame:
    """Hosts with more than ``min_requests`` requests."""
    return count_by(logs, "host").where(F.col("n") > min_requests)


def endpoint_hits(logs: DataFrame) -> DataFrame:
    """Hits per endpoint."""
    return count_by(logs, "endpoint")


def top_by_count(counts: DataFrame, key: str, n: int) -> DataFrame:
    """O3: the n keys with the most rows; ties by key."""
    return counts.orderBy(F.desc("n"), F.asc(key)).limit(n)


def top_endpoints(logs: DataFrame, n: int = 10) -> DataFrame:
    """G5."""
    return top_by_count(endpoint_hits(logs), "endpoint", n)


def top_error_endpoints(logs: DataFrame, n: int = 10) -> DataFrame:
    """Top endpoints among responses other than 200."""
    return top_by_count(endpoint_hits(logs.where(F.col("response_code") != 200)),
                        "endpoint", n)


def unique_hosts(logs: DataFrame) -> DataFrame:
    """G7/A9."""
    return logs.agg(F.count_distinct("host").alias("n_hosts"))


def with_day(logs: DataFrame) -> DataFrame:
    return logs.withColumn("day", F.dayofmonth("date_time").cast("bigint"))


def daily_unique_hosts(logs: DataFrame) -> DataFrame:
    """Distinct hosts per day of month, sorted by day."""
    return (with_day(logs).groupBy("day").agg(F.count_distinct("host").alias("n_hosts"))
            .orderBy("day"))


def daily_avg_requests_per_host(logs: DataFrame) -> DataFrame:
    """Requests per day divided (integer) by distinct hosts that day."""
    return (with_day(logs).groupBy("day")
            .agg(F.expr("count(1) div count(DISTINCT host)").alias("avg_requests"))
            .orderBy("day"))


def not_found(logs: DataFrame) -> DataFrame:
    return logs.where(F.col("response_code") == 404)


def count_404(logs: DataFrame) -> DataFrame:
    """G10."""
    return not_found(logs).agg(F.count(F.lit(1)).alias("n"))


def distinct_404_endpoints(logs: DataFrame, n: int = 40) -> DataFrame:
    """Up to n distinct 404 endpoints, the first by name."""
    return not_found(logs).select("endpoint").distinct().orderBy("endpoint").limit(n)


def top_404_endpoints(logs: DataFrame, n: int = 20) -> DataFrame:
    """G12."""
    return top_by_count(count_by(not_found(logs), "endpoint"), "endpoint", n)


def top_404_hosts(logs: DataFrame, n: int = 25) -> DataFrame:
    """G13."""
    return top_by_count(count_by(not_found(logs), "host"), "host", n)


def errors_by_day(logs: DataFrame) -> DataFrame:
    """404s per day of month, sorted by day."""
    return count_by(with_day(not_found(logs)), "day").orderBy("day")


def top_error_days(logs: DataFrame, n: int = 5) -> DataFrame:
    """G15."""
    return top_by_count(count_by(with_day(not_found(logs)), "day"), "day", n)


def errors_by_hour(logs: DataFrame) -> DataFrame:
    """404s per hour of day, sorted by hour."""
    return (not_found(logs).withColumn("hour", F.hour("date_time").cast("bigint"))
            .transform(lambda d: count_by(d, "hour")).orderBy("hour"))
