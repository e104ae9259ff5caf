"""Property tests: the Spark column functions against small, independent
Python implementations, over generated inputs (batched: one Spark job per
example)."""

import datetime
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from tessera.functions.clf import CLF_FIELDS, LOG_PATTERN, MONTHS, parse_clf
from tessera.functions.text import simple_tokenize

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

_LOG = re.compile(LOG_PATTERN, re.ASCII)
_INT = re.compile(r"[+-]?\d+", re.ASCII)


def py_parse(line):
    m = _LOG.search(line)
    if not m:
        return ("failed",)
    g = m.groups()
    t = g[3]
    try:
        parts = [t[0:2], t[7:11], t[12:14], t[15:17], t[18:20]]
        if not all(_INT.fullmatch(p) for p in parts) or t[3:6] not in MONTHS:
            return ("failed",)
        day, year, hh, mm, ss = (int(p) for p in parts)
        ts = datetime.datetime(year, MONTHS.index(t[3:6]) + 1, day, hh, mm, ss)
    except ValueError:
        return ("failed",)
    size = 0 if g[8] == "-" else (int(g[8]) if _INT.fullmatch(g[8]) else None)
    if size is None:
        return ("failed",)
    return ("parsed", g[0], g[1], g[2], ts, g[4], g[5], g[6], int(g[7]), size)


word = st.text(alphabet="abcxyz019._-", min_size=1, max_size=6)
lines = st.builds(
    lambda host, day, mon, year, hh, mm, ss, meth, ep, proto, blanks, code, size, cut:
    (f'{host} - - [{day:02d}/{mon}/{year}:{hh:02d}:{mm:02d}:{ss:02d} -0400] '
     f'"{meth} {ep}{proto}{" " * blanks}" {code} {size}')[: cut or None],
    word, st.integers(0, 32), st.sampled_from(MONTHS + ("Foo",)), st.integers(1990, 2030),
    st.integers(0, 23), st.integers(0, 59), st.integers(0, 59),
    st.sampled_from(["GET", "POST", "HEAD"]), st.from_regex(r"/[a-z0-9/._]{0,8}", fullmatch=True),
    st.sampled_from(["", " HTTP/1.0", " HTTP/1.1"]), st.integers(0, 2),
    st.integers(100, 599), st.one_of(st.just("-"), st.integers(0, 10**7).map(str),
                                     st.just("12x")),
    st.one_of(st.just(0), st.integers(5, 60)))


@SETTINGS
@given(st.lists(lines, min_size=1, max_size=40))
def test_clf_parse_matches_python(spark, batch):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(batch)], "i int, value string")
    out = parse_clf(df.select("value")).collect()
    for line, row in zip(batch, out):
        want = py_parse(line)
        assert row["parse_status"] == want[0], line
        if want[0] == "parsed":
            assert tuple(row[c] for c in CLF_FIELDS) == want[1:], line


text = st.text(alphabet=st.sampled_from(list("aAbB zZ09_!?./-\n\t'é")), max_size=40)


@SETTINGS
@given(st.lists(text, min_size=1, max_size=30))
def test_tokenize_matches_python(spark, batch):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(batch)], "i int, value string")
    got = {r["i"]: list(r["t"]) for r in
           df.select("i", simple_tokenize(F.col("value")).alias("t")).collect()}
    for i, s in enumerate(batch):
        want = [t for t in re.split(r"\W+", s.lower(), flags=re.ASCII) if t]
        assert got[i] == want, s
