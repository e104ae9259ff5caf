"""Periodic run detection by recursive frequency splitting.

Method.  A run is a stretch of words with smallest period q, of at least
max(``least_words``, ``least_periods`` * q) words, that no neighbour extends.  Every word of a run
recurs q words on, so it occurs in the run at least as often as the shortest run
holds whole periods.  A word that occurs more rarely within the current segment is in no
run: the segment is split at all such words, short parts go, and each part is
counted again, until every word of a part is frequent in it.  Of ordinary prose next to nothing
survives.  Survivors are scanned lag by lag: at lag q a run shows as a stretch of at
least S = max(``least_words`` - q, (``least_periods`` - 1) * q) words that each equal the word q
on, and any such stretch covers an aligned block of half that length.  Blocks of all lags are compared through
prefix hashes at once, so a segment of m words takes m log m comparisons and not m
squared; a block that agrees is compared word by word and extended to its ends.  By the
theorem of Fine and Wilf a stretch with a smaller period lies in the run of a divisor of its lag, which was found before it,
so only smallest periods stay.

Scale.  Each text is worked on whole, in its own row: nothing is shuffled.  Memory
is a few numbers for each word of one text, and at most ``PAIRS`` block comparisons at a time.

Defined results.  Words are what lies between ASCII white space.  Null, empty and
blank texts have no words, no runs and an empty collapsed text.  Repeated rows give
repeated rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import byte_slices

PAIRS = 1 << 20
_FACTOR = np.uint64(0x9E3779B97F4A7C15)  # odd, so its powers stay odd


def frequent_segments(ids: np.ndarray, least: int, shortest: int) -> list[tuple[int, int]]:
    """Ascending (begin, end) of the segments of ``shortest`` words or more whose every word
    occurs ``least`` times or more within the segment."""
    open_, out = [(0, len(ids))], []
    while open_:
        lo, hi = open_.pop()
        if hi - lo < shortest:
            continue
        _, place, n = np.unique(ids[lo:hi], return_inverse=True, return_counts=True)
        rare = np.flatnonzero(n[place] < least)
        if not len(rare):
            out.append((lo, hi))
            continue
        begins, ends = np.r_[lo, lo + rare + 1], np.r_[lo + rare, hi]
        long = ends - begins >= shortest
        open_.extend(zip(begins[long].tolist(), ends[long].tolist()))
    return sorted(out)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _FACTOR, np.uint64)
    out[0] = 1
    return np.cumprod(out)  # wraps modulo 2^64


def _equal_until(ids: np.ndarray, at: int, lag: int) -> int:
    """The first place from ``at`` on whose word differs from the one ``lag`` on."""
    top, step = len(ids) - lag, 64
    while at < top:
        to = min(at + step, top)
        other = np.flatnonzero(ids[at:to] != ids[at + lag:to + lag])
        if len(other):
            return at + int(other[0])
        at, step = to, step * 2
    return top


def _equal_from(ids: np.ndarray, at: int, lag: int) -> int:
    """The first place from which on all words before ``at`` equal the ones ``lag`` on."""
    step = 64
    while at > 0:
        to = max(at - step, 0)
        other = np.flatnonzero(ids[to:at] != ids[to + lag:at + lag])
        if len(other):
            return to + int(other[-1]) + 1
        at, step = to, step * 2
    return 0


def lag_scan(ids: np.ndarray, least_words: int, least_periods: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs in a segment of word numbers."""
    m, found = len(ids), []
    lags = np.arange(1, m // least_periods + 1, dtype=np.int64)
    stretch = np.maximum(least_words - lags, (least_periods - 1) * lags)
    lags, stretch = lags[lags + stretch <= m], stretch[lags + stretch <= m]
    if not len(lags):
        return found
    block = (stretch + 1) // 2
    blocks = (m - lags) // block
    power = _powers(m + 1)
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03)
    prefix = np.r_[np.uint64(0), np.cumsum(mixed * power[:m], dtype=np.uint64)]
    ends = np.cumsum(blocks)
    first = 0
    while first < len(lags):
        have = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, have + PAIRS, "right")))
        q = np.repeat(lags[first:last], blocks[first:last])
        h = np.repeat(block[first:last], blocks[first:last])
        number = np.arange(len(q)) - np.repeat(ends[first:last] - blocks[first:last] - have, blocks[first:last])
        a = number * h
        same = (prefix[a + h] - prefix[a]) * power[q] == prefix[a + q + h] - prefix[a + q]
        a, q, h = a[same], q[same], h[same]
        for start, length, period in found:  # runs of the lags before
            inside = (q % period == 0) & (a >= start) & (a + h + q <= start + length)
            a, q, h = a[~inside], q[~inside], h[~inside]
        while len(a):
            lag, at = int(q[0]), int(a[0])
            begin, end = _equal_from(ids, at + 1, lag), _equal_until(ids, at, lag)
            if end < at + int(h[0]):  # the hashes agreed by chance
                a, q, h = a[1:], q[1:], h[1:]
                continue
            length = end + lag - begin
            over = (q == lag) & (a >= begin) & (a + h <= end)
            if length >= max(least_words, least_periods * lag):
                if not any(lag % p == 0 and s <= begin and begin + length <= s + n for s, n, p in found):
                    found.append((begin, length, lag))
                    over |= (q % lag == 0) & (a >= begin) & (a + h + q <= begin + length)
            a, q, h = a[~over], q[~over], h[~over]
        first = last
    return found


def word_runs(words: list, least_words: int = 24, least_periods: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    if len(words) < least_words:
        return []
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    # the fewest whole periods that the shortest run of any period holds
    least = min(max(least_words, least_periods * q) // q for q in range(1, least_words + 1))
    out = []
    for lo, hi in frequent_segments(ids, least, least_words):
        out += [(lo + s, n, p) for s, n, p in lag_scan(ids[lo:hi], least_words, least_periods)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that a run repeats: of a run its first period stays."""
    if not runs:
        return words
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    kept = np.cumsum(drop[:-1]) == 0
    return [w for w, k in zip(words, kept.tolist()) if k]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def detect(docs: DataFrame, *, least_words: int = 24, least_periods: int = 3, id_col: str = "doc_id",
           text: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row: its runs as (start, length,
    period) by start, then period, and its words without what the runs repeat."""
    def run(batches):
        for batch in batches:
            for a, b in byte_slices(batch.column(1)):
                sizes, runs, texts = [], [], []
                for t in batch.column(1).slice(a, b - a):
                    words = (t.as_py() or "").encode().split()
                    found = word_runs(words, least_words, least_periods)
                    sizes.append(len(words))
                    runs.append([{"start": s, "length": n, "period": p} for s, n, p in found])
                    texts.append(b" ".join(collapse(words, found)).decode())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(sizes, pa.int64()), pa.array(runs, pa.list_(_RUN)),
                     pa.array(texts, pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def longest_by_exponent(runs: str) -> F.Column:
    """The run with the greatest length / period, compared exactly; ties by start,
    then period.  Null if there is none."""
    return F.get(F.expr(f"""array_sort({runs}, (a, b) -> CASE
        WHEN a.length * b.period > b.length * a.period THEN -1
        WHEN a.length * b.period < b.length * a.period THEN 1
        WHEN a.start < b.start THEN -1 WHEN a.start > b.start THEN 1
        WHEN a.period < b.period THEN -1 WHEN a.period > b.period THEN 1 ELSE 0 END)"""), F.lit(0))
