"""Common Log Format parsing (S4, F6, F8) as column expressions.

One regular-expression pass rewrites a matching line into its nine groups
joined by a separator; ``split`` then yields the fields, instead of running the
pattern once per field.  Lines that do not match, carry an impossible date
(``try_make_timestamp_ntz`` gives NULL) or a non-numeric size are marked
``failed`` rather than aborting the job.  The time zone is parsed and dropped:
``date_time`` is TIMESTAMP_NTZ, independent of the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.once import groups, once

# The access-log pattern (the final, blank-tolerant form) and
# the English month abbreviations of the log's time field.
LOG_PATTERN = (r'^(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] '
               r'"(\S+) (\S+)\s*(\S*)\s*" (\d{3}) (\S+)')
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun",
          "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")

CLF_FIELDS = ("host", "client_identd", "user_id", "date_time", "method", "endpoint",
              "protocol", "response_code", "content_size")


def clf_time(text: Column) -> Column:
    """``dd/MMM/yyyy:HH:mm:ss zone`` → TIMESTAMP_NTZ (NULL when impossible, a
    second of 60 included, which the function itself would carry over)."""
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.substring(text, 4, 3))
    return F.try_make_timestamp_ntz(
        F.substring(text, 8, 4).try_cast("int"), month.cast("int"),
        F.substring(text, 1, 2).try_cast("int"), F.substring(text, 13, 2).try_cast("int"),
        F.substring(text, 16, 2).try_cast("int"),
        F.when(F.substring(text, 19, 2) < "60", F.substring(text, 19, 2)).try_cast("decimal(8,6)"))


def parse_clf(lines: DataFrame, col: str = "value", keep_line: bool = True) -> DataFrame:
    """Lines → ``parse_status`` ('parsed' / 'failed') plus the nine typed
    fields (NULL on failed rows).  Filter on ``parse_status`` to split."""
    keep = ["line"] if keep_line else []
    staged = once(lines.select(F.col(col).alias("line")), keep, _p=groups(F.col("line"), LOG_PATTERN, 9))
    p = F.col("_p")
    size_text = p.getItem(8)
    size = F.when(size_text == "-", F.lit(0).cast("bigint")).otherwise(size_text.try_cast("bigint"))
    typed = once(
        staged, keep,
        host=p.getItem(0), client_identd=p.getItem(1), user_id=p.getItem(2),
        date_time=clf_time(p.getItem(3)), method=p.getItem(4), endpoint=p.getItem(5),
        protocol=p.getItem(6), response_code=p.getItem(7).try_cast("int"),
        content_size=size)
    ok = (F.col("host").isNotNull() & F.col("date_time").isNotNull()
          & F.col("response_code").isNotNull() & F.col("content_size").isNotNull())
    return typed.withColumn("parse_status",
                            F.when(ok, F.lit("parsed")).otherwise(F.lit("failed")))


def parsed_logs(lines: DataFrame, col: str = "value") -> DataFrame:
    """Only the well-formed records, nine typed columns."""
    return (parse_clf(lines, col, keep_line=False)
            .where(F.col("parse_status") == "parsed").select(*CLF_FIELDS))
