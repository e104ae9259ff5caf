"""Best-fit packing of documents into fixed-length training sequences.

Method: bulk-synchronous best fit.  Documents become pieces of at most ``most``
tokens, and a piece is named by its length and its rank among pieces of that length.
Pieces of one length are interchangeable, and so are gaps of one size, so the rounds
work on runs: for every length the ranks still unplaced, for every open gap the
sequences that have it.  A round is one Spark job.  Lengths and gaps are dealt to
ranges of sizes; a run of pieces goes to the range of its successor, the first range
upwards with a gap that holds it.  Every range sorts and sweeps its runs on its own,
longest pieces first, each into the smallest gap that holds it; where several want
one gap the lower rank has it.  What is left of a gap is used again while it lies in
the range, and moves to its own range for the next round.  Pieces that no gap
anywhere holds open sequences, but only full ones, and no length does that a longer one
leaves room for.  The rounds end when what is left of each length would not fill
one sequence, at most about ``most`` * ln(``most``) pieces whatever the input; these are put
into the smallest gaps by one last sweep, which may open sequences.

Scale.  The driver sees the greatest gap of every range and the number of sequences,
nothing else; runs are written by each round and read by the next.  There is one run of
pieces for each length, and a round cuts at most two runs of gaps for each, so runs grow
with rounds and not with documents.  Outcomes are intervals of ranks, sent to all tasks in
blocks of at most ``BLOCK_ROWS``; every piece finds its sequence from its rank, in place.

Defined results.  Every row is packed, a null or empty text as its end token
alone.  Only documents longer than ``most`` are cut, into full pieces behind a
first one that holds the rest.  Rows with equal or null ids are packed one by one.
Very long texts are many pieces of one row.  Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize
from tessera.llm.tokens import WordEncoder
from tessera.operators.relational import number_rows
from tessera.session import shared_dir

MOST, END = 2048, 0
RANGES = 16
BLOCK_ROWS = 1 << 19  # of 48 bytes each
OPEN, LAST = -1, -2  # keys beside those of the ranges
STATE = "kind string, size long, first long, n long, each long, offset long, sequence long"


def pieces(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text: str = "text",
           most: int = MOST, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, task, nth): every piece, and its
    place among the task's pieces of its length."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        encoder, task, seen = WordEncoder.of(vocabulary, True), TaskContext.get().partitionId(), {}
        for batch in batches:
            row = 0
            for ids, counts in encoder.encode(batch.column(1)):
                of, piece, start, length, crc, nth, at = [], [], [], [], [], [], 0
                for n in counts.tolist():
                    own = ids[at:at + n].tobytes() + np.uint32(end).tobytes()
                    at, n = at + n, n + 1
                    first = (n - 1) % most + 1
                    cuts = [0, *range(first, n + 1, most)]
                    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        of.append(row), piece.append(i), start.append(a), length.append(b - a)
                        crc.append(zlib.crc32(own[4 * a:4 * b]))
                        nth.append(seen.get(b - a, 0))
                        seen[b - a] = nth[-1] + 1
                    row += 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(of, pa.int64())), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                     pa.array([task] * len(of), pa.int32()), pa.array(nth, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task int, nth long")


def ranked(cut: DataFrame) -> DataFrame:
    """``cut`` with the rank of each piece among all pieces of its length: what
    earlier tasks hold of that length (a sum over counts, a row for each task and
    length) and its place in its own task."""
    counts = cut.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return cut.join(base, ["task", "length"]).withColumn("rank", F.col("base") + F.col("nth")).drop("base")


class Sweep:
    """The gaps of one range of sizes from ``low`` on, and what becomes of them.  ``out``
    has rows of the state: 'run' for pieces placed (length, first rank, pieces, pieces in
    each sequence, offset there, first sequence), 'gap' for gaps below the range."""

    def __init__(self, most: int, low: int, gaps=()):
        self.most, self.low, self.out = most, low, []
        self.gaps: dict[int, list[tuple[int, int]]] = {}
        self.sizes: list[int] = []
        for gap, first, n in sorted(gaps):
            self._add(gap, first, n)

    def _add(self, gap, first, n):
        if gap < self.low:
            if gap:
                self.out.append(("gap", gap, first, n, 0, 0, 0))
            return
        if gap not in self.gaps:
            self.gaps[gap] = []
            insort(self.sizes, gap)
        self.gaps[gap].append((first, n))

    def put(self, length, rank, n, gap, first) -> int:
        """``n`` pieces into sequences of one gap, as many in each as fit; returns the
        number of sequences used."""
        each, used = gap // length, 0
        whole, rest = divmod(n, each)
        for count, k in ((whole, each), (int(rest > 0), rest)):
            if count:
                self.out.append(("run", length, rank, count * k, k, self.most - gap, first + used))
                self._add(gap - k * length, first + used, count)
                rank, used = rank + count * k, used + count
        return used

    def place(self, length, rank, n) -> tuple[int, int]:
        """Best fit of a run of pieces; the rank and number of those that found no gap."""
        while n:
            at = bisect_left(self.sizes, length)
            if at == len(self.sizes):
                break
            gap = self.sizes[at]
            runs = self.gaps[gap]
            first, many = runs.pop()
            if not runs:
                del self.gaps[self.sizes.pop(at)]
            took = min(n, many * (gap // length))
            used = self.put(length, rank, took, gap, first)
            if used < many:
                self._add(gap, first + used, many - used)
            rank, n = rank + took, n - took
        return rank, n

    def rows(self) -> list[tuple]:
        return self.out + [("gap", gap, first, n, 0, 0, 0) for gap, runs in self.gaps.items() for first, n in runs]


def sweep(key: int, pieces: list[tuple[int, int, int]], gaps: list[tuple[int, int, int]], low: int, opened: int,
          most: int) -> list[tuple]:
    """One range of a round.  ``pieces`` are (length, first rank, number), ``gaps`` (size,
    first sequence, number).  Key OPEN has the pieces that no gap holds, key LAST what
    the rounds leave; others place what their gaps hold."""
    now = Sweep(most, 1 if key == LAST else most + 1 if key == OPEN else low, gaps)
    room = 0  # the greatest gap that lengths before have opened
    for length, rank, n in sorted(pieces, reverse=True):
        if key != OPEN:
            rank, n = now.place(length, rank, n)
        each = most // length
        open_ = n if key == LAST else n - n % each if key == OPEN and room < length else 0
        if open_:
            opened += now.put(length, rank, open_, most, opened)
            rank, n, room = rank + open_, n - open_, max(room, most - each * length)
        if n:
            now.out.append(("piece", length, rank, n, 0, 0, 0))
    return now.rows()


def _home(tops: list[int], width: int) -> Column:
    """The range of a gap, or of the first gap upwards that may hold a run of pieces."""
    own = F.floor((F.col("size") - 1) / width)
    holds = [F.when((own <= b) & (F.col("size") <= top), b) for b, top in enumerate(tops) if top]
    return F.when(F.col("kind") == "gap", own).otherwise(F.coalesce(*holds, F.lit(OPEN))).cast("int")


def _round(opened: int, width: int, most: int):
    """A function of one range's rows of the state that sweeps them."""
    def run(key, table):
        key, given = key[0].as_py(), {"piece": [], "gap": []}
        for kind, *row in zip(*(table.column(c).to_pylist() for c in ("kind", "size", "first", "n"))):
            given[kind].append(tuple(row))
        rows = sweep(key, given["piece"], given["gap"], key * width + 1, opened, most)
        kind, *numbers = zip(*rows) if rows else [()] * 7
        return pa.table([pa.array(kind, pa.string()), *[pa.array(c, pa.int64()) for c in numbers]],
                        ["kind", "size", "first", "n", "each", "offset", "sequence"])
    return run


def runs_of(counts: DataFrame, most: int = MOST, ranges: int = RANGES) -> DataFrame:
    """(size, first, n, each, offset, sequence): of ``counts`` (length, n) every run of
    pieces of a length, by first rank, with the pieces in each sequence, their offset
    there and the first sequence; sequences are numbered without gaps.  Each round is
    a job that writes its state."""
    spark, width, paths = counts.sparkSession, -(-most // ranges), []
    state = counts.select(F.lit("piece").alias("kind"), F.col("length").alias("size"), F.lit(0).cast("long").alias("first"),
                          F.col("n").cast("long").alias("n"))
    tops, opened, last = [0] * ranges, 0, False
    while True:
        key = F.lit(LAST) if last else _home(tops, width)
        piece, run, seen = F.col("kind") == "piece", F.col("kind") == "run", Observation()
        after = (state.groupBy(key.alias("range")).applyInArrow(_round(opened, width, most), STATE).observe(
            seen, F.max(F.when(piece, 1)).alias("left"),
            F.max(F.when(piece, F.col("n") >= F.floor(F.lit(most) / F.col("size")))).alias("full"),
            F.max(F.when(run & (F.col("offset") == 0), F.col("sequence") + F.ceil(F.col("n") / F.col("each")))).alias("opened"),
            *[F.max(F.when((F.col("kind") == "gap") & (F.floor((F.col("size") - 1) / width) == b), F.col("size"))).alias(f"r{b}")
              for b in range(ranges)]))
        paths.append(shared_dir(spark, "packing-round"))
        after.write.parquet(paths[-1])
        found = seen.get
        if not found.get("left"):
            return spark.read.schema(STATE).parquet(*paths).where("kind = 'run'").drop("kind")
        tops, opened, last = [found[f"r{b}"] or 0 for b in range(ranges)], max(opened, found["opened"] or 0), not found["full"]
        state = spark.read.schema(STATE).parquet(paths[-1]).where("kind <> 'run'")


def pack(cut: DataFrame, most: int = MOST) -> DataFrame:
    """``cut`` with sequence_id and offset.  ``cut`` has to be stored: it is read
    for the counts and for the result."""
    runs = runs_of(cut.groupBy("length").agg(F.count("*").alias("n")), most)
    kept = [f for f in cut.schema.fields if f.name not in ("task", "nth")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", sequence_id long, offset long"
    # one block but for inputs whose runs are many; a block begins at a length and rank
    blocks = -(-runs.count() // BLOCK_ROWS)
    if blocks <= 1:
        return ranked(cut).mapInArrow(_lookup(runs, [f.name for f in kept]), schema)
    named = ranked(cut).withColumn("at", F.struct("length", "rank"))
    numbered = number_rows(runs.withColumn("at", F.struct(F.col("size").alias("length"), F.col("first").alias("rank"))), "at")
    numbered = materialize(numbered, "packing-runs")
    starts = [r["at"] for r in numbered.where((F.col("_rn") - 1) % BLOCK_ROWS == 0).orderBy("_rn").select("at").collect()]
    out = None
    for a, b in zip(starts, [*starts[1:], None]):
        def inside(c, a=a, b=b):
            edge = lambda r: F.struct(F.lit(r[0]).cast("long").alias("length"), F.lit(r[1]).cast("long").alias("rank"))
            return (c >= edge(a)) & (c < edge(b)) if b else c >= edge(a)
        part = named.where(inside(F.col("at"))).drop("at").mapInArrow(
            _lookup(numbered.where(inside(F.col("at"))), [f.name for f in kept]), schema)
        out = part if out is None else out.unionByName(part)
    return out


def _lookup(runs: DataFrame, kept: list[str]):
    """A function of batches that gives pieces their sequence and offset by a bounded
    block of ``runs``, which is broadcast."""
    rows = runs.select("size", "first", "sequence", "each", "offset").collect()
    known = runs.sparkSession.sparkContext.broadcast(_by_length(rows))

    def run(batches):
        table = known.value
        for batch in batches:
            length, rank = (np.asarray(batch.column(batch.schema.get_field_index(c))) for c in ("length", "rank"))
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for n in np.unique(length):
                here = np.flatnonzero(length == n)
                first_rank, first_sequence, each, base = table[int(n)]
                i = np.searchsorted(first_rank, rank[here], "right") - 1
                inside = rank[here] - first_rank[i]
                sequence[here] = first_sequence[i] + inside // each[i]
                offset[here] = base[i] + inside % each[i] * n
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(batch.schema.get_field_index(c)) for c in kept], pa.array(sequence), pa.array(offset)],
                [*kept, "sequence_id", "offset"])
    return run


def _by_length(runs) -> dict[int, tuple[np.ndarray, ...]]:
    out: dict[int, list] = {}
    for n, *row in sorted(map(tuple, runs)):
        out.setdefault(n, []).append(row)
    return {n: tuple(np.array(c, np.int64) for c in zip(*rows)) for n, rows in out.items()}


def pack_documents(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text: str = "text",
                   most: int = MOST, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    cut = materialize(pieces(docs, vocabulary, id_col=id_col, text=text, most=most, end=end), "pieces")
    return pack(cut, most)
