"""Parsers of the delimited line formats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.once import groups, once

# The product-line and gold-line patterns and the header ids.  An
# input whose gold header has another first field names it by ``header_id``.
PRODUCT_PATTERN = r'^(.+),"(.+)",(.*),(.*),(.*)'
GOLD_PATTERN = r"^(.+),(.+)"
PRODUCT_HEADER_ID = '"id"'
GOLD_HEADER_ID = '"idAmazon"'


def _grouped(lines: DataFrame, col: str, pattern: str, n: int) -> DataFrame:
    """(_p, line): the pattern's groups, in one pass for each line; null if it does not match."""
    return once(lines.select(F.col(col).alias("line")), ["line"], _p=groups(F.col("line"), pattern, n))


def _status(is_header):
    return (F.when(F.col("_p").isNull(), F.lit("failed")).when(is_header, F.lit("header"))
            .otherwise(F.lit("parsed")))


def _unquoted(c):
    return F.replace(c, F.lit('"'), F.lit(""))


def parse_product_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """``(id, product, parse_status)``: product is title, description and
    manufacturer joined by blanks; quotes are stripped from the id only."""
    p = F.col("_p")
    return _grouped(lines, col, PRODUCT_PATTERN, 5).select(
        _unquoted(p[0]).alias("id"), F.when(p.isNotNull(), F.concat_ws(" ", p[1], p[2], p[3])).alias("product"),
        _status(p[0] == PRODUCT_HEADER_ID).alias("parse_status"))


def parse_gold_lines(lines: DataFrame, col: str = "value",
                     header_id: str = GOLD_HEADER_ID) -> DataFrame:
    """``(left_id, right_id, parse_status)`` with quotes removed; a line whose
    first field is ``header_id`` is the header."""
    p = F.col("_p")
    return _grouped(lines, col, GOLD_PATTERN, 2).select(
        _unquoted(p[0]).alias("left_id"), _unquoted(p[1]).alias("right_id"),
        _status(p[0] == F.lit(header_id)).alias("parse_status"))


def parse_rating_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """``user::item::rating::timestamp`` → (user BIGINT, item BIGINT, rating
    DOUBLE, parse_status); the timestamp is dropped.  Every line gives a row: one
    whose fields are missing or no numbers is ``failed`` and keeps its text in
    ``line``."""
    f = F.split(F.col(col), "::")
    user, item = F.get(f, F.lit(0)).try_cast("bigint"), F.get(f, F.lit(1)).try_cast("bigint")
    rating = F.get(f, F.lit(2)).try_cast("double")
    good = user.isNotNull() & item.isNotNull() & rating.isNotNull() & ~F.isnan(rating)
    return _with_status(lines, col, good, user=user, item=item, rating=rating)


def parse_title_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """``item::title::genres`` → (item BIGINT, title STRING, parse_status); genres
    are dropped.  As ratings, no line is lost."""
    f = F.split(F.col(col), "::")
    item, title = F.get(f, F.lit(0)).try_cast("bigint"), F.get(f, F.lit(1))
    return _with_status(lines, col, item.isNotNull() & title.isNotNull(), item=item, title=title)


def _with_status(lines: DataFrame, col: str, good, **fields) -> DataFrame:
    good = F.coalesce(good, F.lit(False))
    return lines.select(*[F.when(good, v).alias(k) for k, v in fields.items()],
                        F.when(good, F.lit("parsed")).otherwise(F.lit("failed")).alias("parse_status"),
                        F.when(~good, F.col(col)).alias("line"))


def parsed_only(rows: DataFrame) -> DataFrame:
    """The parsed rows, without status and text."""
    return rows.where(F.col("parse_status") == "parsed").drop("parse_status", "line")
