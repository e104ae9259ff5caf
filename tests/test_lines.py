"""Line parsers: no line is lost, and what is malformed is marked."""

from pyspark.sql import functions as F

from tessera.functions.clf import clf_time
from tessera.functions.lines import (
    parse_gold_lines, parse_product_lines, parse_rating_lines, parse_title_lines, parsed_only,
)


def lines(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_rating_lines(spark):
    bad = ["1::2", "", "a::2::3::4", "1::b::3::4", "1::2::x::4", "1::2::NaN::4", None,
           "99999999999999999999::1::2::3"]
    got = parse_rating_lines(lines(spark, "1::2::3.5::9", "3000000000::5::4::9", "-7::8::1::", *bad))
    rows = got.collect()
    assert len(rows) == 11
    assert [(r.user, r.item, r.rating) for r in rows if r.parse_status == "parsed"] == [
        (1, 2, 3.5), (3000000000, 5, 4.0), (-7, 8, 1.0)]
    assert [r.line for r in rows if r.parse_status == "failed"] == bad
    assert parsed_only(got).columns == ["user", "item", "rating"]


def test_title_lines(spark):
    rows = parse_title_lines(lines(spark, "1::A (1995)::Drama", "5000000000::::x", "x::B::y", "7")).collect()
    assert [(r.item, r.title, r.parse_status) for r in rows] == [
        (1, "A (1995)", "parsed"), (5000000000, "", "parsed"), (None, None, "failed"), (None, None, "failed")]


def test_gold_header(spark):
    rows = lines(spark, '"idAmazon","idOther"', '"b1","http://x/1"', "broken")
    assert [r.parse_status for r in parse_gold_lines(rows).collect()] == ["header", "parsed", "failed"]
    named = parse_gold_lines(lines(spark, '"left","right"', '"b1","c1"'), header_id='"left"').collect()
    assert [(r.parse_status, r.left_id, r.right_id) for r in named] == [
        ("header", "left", "right"), ("parsed", "b1", "c1")]


def test_product_lines(spark):
    rows = parse_product_lines(lines(spark, '"id","title","description","manufacturer","price"',
                                     '"b1","t","d","m","9"', "nothing")).collect()
    assert [(r.parse_status, r.id) for r in rows][1:] == [("parsed", "b1"), ("failed", None)]
    assert rows[0].parse_status == "header" and rows[1].product == 't "d" "m"'


def test_second_sixty_is_impossible(spark):
    t = lines(spark, "01/Aug/1995:00:00:59 -0400", "01/Aug/1995:00:00:60 -0400", "01/Aug/1995:00:00:6x -0400")
    got = [r[0] for r in t.select(clf_time(F.col("value"))).collect()]
    assert got[0] is not None and got[1] is None and got[2] is None
