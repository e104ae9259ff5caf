"""Line-format views re-aimed on the given tables.

The reference's inputs (an access log, two product catalogues, a gold
mapping, rating and title files) do not ship, so each is rebuilt as text lines
derived row-for-row from a given table.  The parsers then run on real text,
and every derived view grows with its source table.

The log rule (``clf_lines``), one line per ``events`` row:

* host ``host<user_id>.example.net``; identd and user ``-``
* time ``[dd/MMM/yyyy:HH:mm:ss -0400]`` from ``ts`` (seconds kept)
* method ``POST`` for signup and purchase, else ``GET``
* endpoint ``/<event_type>/<event_id % 97>.html``
* protocol ``HTTP/1.0``; none when ``event_id % 10 = 5``; a trailing blank
  before the closing quote when ``event_id % 10 = 0``
* code: error 404 (500 when ``event_id % 4 = 3``), signup 302,
  click 200 (304 when ``event_id % 3 = 0``), otherwise 200
* size ``floor(value * 100)``; ``-`` for 304, 404, 500 or a missing value
* malformed: ``event_id % 500 = 249`` carries month ``Foo``;
  ``event_id % 500 = 499`` is cut after the endpoint

The other line formats hold malformed lines beside the good ones: a product and a title
line that break off, for parts whose key modulo 50 is 49; a gold line of one field, for pairs
whose right id is a multiple of 3; a rating line without a number, where user + item is a
multiple of 500.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import load_table, spread

# Fixed values of the log rule above.
LOG_ZONE = "-0400"
LOG_PROTOCOL = "HTTP/1.0"
LOG_HOST_SUFFIX = ".example.net"
ENDPOINT_MODULUS = 97
BAD_MONTH_ID = 249
CUT_LINE_ID = 499
MALFORMED_PERIOD = 500
CUT_PERIOD = 50


def log_response_code(event_id: Column, event_type: Column) -> Column:
    return (F.when(event_type == "error",
                   F.when(event_id % 4 == 3, F.lit(500)).otherwise(F.lit(404)))
            .when(event_type == "signup", F.lit(302))
            .when(event_type == "click",
                  F.when(event_id % 3 == 0, F.lit(304)).otherwise(F.lit(200)))
            .otherwise(F.lit(200)))


def _two(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def clf_time_text(ts: Column, month_override: Column | None = None) -> Column:
    """``dd/MMM/yyyy:HH:mm:ss`` built from the TIMESTAMP_NTZ fields, so no
    session time zone is involved."""
    from tessera.functions.clf import MONTHS
    month = F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month(ts))
    if month_override is not None:
        month = F.coalesce(month_override, month)
    return F.concat(_two(F.dayofmonth(ts)), F.lit("/"), month, F.lit("/"),
                    F.lpad(F.year(ts).cast("string"), 4, "0"), F.lit(":"), _two(F.hour(ts)),
                    F.lit(":"), _two(F.minute(ts)), F.lit(":"), _two(F.second(ts)))


def clf_lines(events: DataFrame) -> DataFrame:
    """``events`` → one Common Log Format line per row (``value STRING``)."""
    eid, et = F.col("event_id"), F.col("event_type")
    code = log_response_code(eid, et)
    host = F.concat(F.lit("host"), F.col("user_id").cast("string"), F.lit(LOG_HOST_SUFFIX))
    phase = eid % MALFORMED_PERIOD
    when_text = clf_time_text(F.col("ts"), F.when(phase == BAD_MONTH_ID, F.lit("Foo")))
    method = F.when(et.isin("signup", "purchase"), F.lit("POST")).otherwise(F.lit("GET"))
    endpoint = F.concat(F.lit("/"), et, F.lit("/"), (eid % ENDPOINT_MODULUS).cast("string"),
                        F.lit(".html"))
    protocol = (F.when(eid % 10 == 5, F.lit(""))
                .when(eid % 10 == 0, F.lit(f" {LOG_PROTOCOL} "))
                .otherwise(F.lit(f" {LOG_PROTOCOL}")))
    size = (F.when(code.isin(304, 404, 500) | F.col("value").isNull(), F.lit("-"))
            .otherwise(F.floor(F.col("value") * 100).cast("string")))
    head = F.concat(host, F.lit(" - - ["), when_text, F.lit(f" {LOG_ZONE}] \""), method,
                    F.lit(" "), endpoint)
    full = F.concat(head, protocol, F.lit("\" "), code.cast("string"), F.lit(" "), size)
    line = F.when(phase == CUT_LINE_ID, head).otherwise(full)
    return events.select(line.alias("value"))


def clf_lines_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clf_lines(spread(load_table(spark, sf_dir, "events",
                                       ["event_id", "ts", "user_id", "event_type", "value"])))


# Product catalogue lines (S6): header plus ``"id","title","description",
# "manufacturer","price"`` built from ``part``.
PRODUCT_HEADER = '"id","title","description","manufacturer","price"'


def _quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def product_lines(spark: SparkSession, part: DataFrame) -> DataFrame:
    body = part.select(F.concat_ws(
        ",", _quoted(F.col("p_partkey").cast("string")), _quoted(F.col("p_name")),
        _quoted(F.col("p_type")), _quoted(F.col("p_brand")),
        _quoted(F.col("p_retailprice").cast("string"))).alias("value"))
    cut = part.where(F.col("p_partkey") % CUT_PERIOD == CUT_PERIOD - 1).select(
        F.concat(_quoted(F.col("p_partkey").cast("string")), F.lit(","), F.col("p_name")).alias("value"))
    body = body.unionByName(cut)
    header = spark.range(1).select(F.lit(PRODUCT_HEADER).alias("value"))
    return header.unionByName(body)


# Gold mapping lines (S7): header plus ``"left","right"``.
GOLD_HEADER = '"idAmazon","idRight"'


def gold_lines(spark: SparkSession, pairs: DataFrame) -> DataFrame:
    body = pairs.select(F.concat_ws(",", _quoted(F.col("left_id").cast("string")),
                                    _quoted(F.col("right_id").cast("string"))).alias("value"))
    header = spark.range(1).select(F.lit(GOLD_HEADER).alias("value"))
    half = pairs.where(F.col("right_id") % 3 == 0).select(_quoted(F.col("left_id").cast("string")).alias("value"))
    return header.unionByName(body).unionByName(half)


def gold_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold pairs re-aimed: (benchmark item, document) where the document
    text contains the whole benchmark text."""
    from tessera.operators.resolution import containment_pairs
    left = load_table(spark, sf_dir, "benchmark", ["item_id", "text"])
    right = spread(load_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return containment_pairs(left, "item_id", right, "doc_id")


# Ratings (S8) and titles.
def _rating_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_quantity"])
    od = load_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .select(F.col("o_custkey").alias("user"),
                    F.col("l_partkey").alias("item"),
                    (F.lit(1.0) + (F.col("l_quantity") - 1) % 5).alias("rating"),
                    "o_orderdate"))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user BIGINT, item BIGINT, rating DOUBLE): one row per (customer, part), the
    mean of ``1 + (l_quantity - 1) % 5`` over that customer's order lines."""
    return (_rating_rows(spark, sf_dir).groupBy("user", "item")
            .agg(F.avg("rating").alias("rating")))


def rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user::item::rating::yyyymmdd`` lines (the last field is dropped on read)."""
    agg = (_rating_rows(spark, sf_dir).groupBy("user", "item")
           .agg(F.avg("rating").alias("rating"), F.max("o_orderdate").alias("d")))
    user, item = F.col("user").cast("string"), F.col("item").cast("string")
    good = F.concat_ws("::", user, item, F.col("rating").cast("string"), F.date_format("d", "yyyyMMdd"))
    bad = F.when((F.col("user") + F.col("item")) % 500 == 0, F.concat_ws("::", user, item, F.lit("none")))
    return agg.select(F.explode(F.array_compact(F.array(good, bad))).alias("value"))


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item BIGINT, title STRING) from ``part``."""
    return load_table(spark, sf_dir, "part", ["p_partkey", "p_name"]).select(
        F.col("p_partkey").alias("item"), F.col("p_name").alias("title"))


def title_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``item::title::genres`` lines; the part type stands in for genres."""
    part = load_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_type"])
    good = F.concat_ws("::", F.col("p_partkey").cast("string"), "p_name", "p_type")
    bad = F.when(F.col("p_partkey") % CUT_PERIOD == CUT_PERIOD - 1, F.col("p_partkey").cast("string"))
    return part.select(F.explode(F.array_compact(F.array(good, bad))).alias("value"))
