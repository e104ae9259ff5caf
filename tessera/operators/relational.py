"""General relational operators (P, A, O, U, J rows of the inventory).

Thin, declarative compositions: Catalyst prunes columns, pushes filters into
the parquet scan and plans two-phase aggregates and bounded top-k.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import broadcast_if_small, reliable_checkpoint

# --- projections, filters, flattening ------------------------------------


def flat_map_plural(words: DataFrame, col: str = "word") -> DataFrame:
    """Each word, then the word with an 's' suffix, as two rows."""
    w = F.col(col)
    return words.select(*[c for c in words.columns if c != col],
                        F.explode(F.array(w, F.concat(w, F.lit("s")))).alias(col))


def map_nested_plural(words: DataFrame, col: str = "word") -> DataFrame:
    """One row per word holding [word, word + 's']."""
    w = F.col(col)
    return words.withColumn("forms", F.array(w, F.concat(w, F.lit("s"))))


def flat_map_range(df: DataFrame, col: str, out: str = "k") -> DataFrame:
    """P5: one row per k in 1..x-1; rows with x <= 1 yield nothing
    (``sequence(1, 0)`` would count down, hence the guard)."""
    x = F.col(col)
    return (df.where(x > 1)
            .withColumn(out, F.explode(F.sequence(F.lit(1).cast(df.schema[col].dataType),
                                                  x - 1))))


def partition_concat(df: DataFrame, col: str, sep: str = ",") -> DataFrame:
    """Joined strings of a partition's values, one for each Arrow batch, so
    memory is bounded by a batch; NULL values are left out."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def join_batches(batches):
        for b in batches:
            values = pc.drop_null(pc.cast(b.column(0), pa.string()))
            if len(values):
                lists = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
                yield pa.RecordBatch.from_arrays([pc.binary_join(lists, sep)], ["joined"])

    return df.select(F.col(col)).mapInArrow(join_batches, "joined string")


def map_partitions(df: DataFrame, f, schema) -> DataFrame:
    """P7, flat: ``f(index, batches)`` of every partition, given its number and its rows as
    Arrow record batches, yields record batches of ``schema``.  Memory is what ``f`` holds;
    a partition is never gathered."""
    def run(batches):
        from pyspark import TaskContext
        yield from f(TaskContext.get().partitionId(), batches)

    return df.mapInArrow(run, schema)


def partition_lists(df: DataFrame, col: str, chunk: int = 1024) -> DataFrame:
    """P7, list-valued: (partition, chunk, values).  A partition's values are lists of
    ``chunk`` values, numbered from 0 without a gap, the last one shorter: a list for the
    whole partition would grow with it.  Nulls are kept."""
    import pyarrow as pa

    def chunks(index, number, values):
        import numpy as np
        ends = np.append(np.arange(0, len(values), chunk), len(values)).astype(np.int32)
        n = len(ends) - 1
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, index, np.int32)), pa.array(np.arange(number, number + n)),
             pa.ListArray.from_arrays(pa.array(ends), values)], ["partition", "chunk", "values"])

    def lists(index, batches):
        held, number = None, 0
        for batch in batches:
            values = batch.column(0)
            held = values if held is None else pa.concat_arrays([held, values])
            whole = len(held) // chunk
            if whole:
                yield chunks(index, number, held.slice(0, whole * chunk))
                held, number = held.slice(whole * chunk), number + whole
        if held is not None and len(held):
            yield chunks(index, number, held)

    kind = df.schema[col].dataType.simpleString()
    return map_partitions(df.select(col), lists, f"partition int, chunk long, values array<{kind}>")


def partition_summary(df: DataFrame, col: str) -> DataFrame:
    """(partition, n, total) of every partition: a function of a partition that is given its
    index and adds up its batches."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def add(index, batches):
        n, total = 0, None
        for batch in batches:
            n += batch.num_rows
            part = pc.sum(batch.column(0)).as_py()
            total = part if total is None else total + (part or 0)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([index], pa.int32()), pa.array([n], pa.int64()), pa.array([total], kind)], ["partition", "n", "total"])

    whole = df.schema[col].dataType.typeName() in ("byte", "short", "integer", "long")
    kind = pa.int64() if whole else pa.float64()
    return map_partitions(df.select(col), add, f"partition int, n long, total {'long' if whole else 'double'}")


def map_values(df: DataFrame, key: str, value: str, f) -> DataFrame:
    """Apply ``f`` (a Column → Column function) to the value only."""
    return df.select(key, f(F.col(value)).alias(value))


def swap_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """Re-key (a, b, …) → (b, a, …)."""
    rest = [c for c in df.columns if c not in (a, b)]
    return df.select(F.col(b).alias(a), F.col(a).alias(b), *rest)


def lookup(df: DataFrame, **eq) -> DataFrame:
    """P10: point lookup by equality on one or more columns."""
    cond = None
    for k, v in eq.items():
        c = F.col(k) == F.lit(v)
        cond = c if cond is None else cond & c
    return df.where(cond)


# --- aggregations --------------------------------------------------------


def sum_all(df: DataFrame, col: str, alias: str = "total") -> DataFrame:
    """A1."""
    return df.agg(F.sum(col).alias(alias))


def count_all(df: DataFrame, alias: str = "n") -> DataFrame:
    """A2."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def sum_by_key(df: DataFrame, key: str, col: str, alias: str = "total") -> DataFrame:
    """A5 (reduceByKey / groupByKey-then-sum give the same answer)."""
    return df.groupBy(key).agg(F.sum(col).alias(alias))


def collect_by_key(df: DataFrame, key: str, col: str, alias: str = "values") -> DataFrame:
    """All values per key, sorted.  Only for keys whose group is bounded
    (e.g. the lines of one order); ``collect_chunks`` takes keys of any size."""
    return df.groupBy(key).agg(F.sort_array(F.collect_list(col)).alias(alias))


def collect_chunks(df: DataFrame, key: str, col: str, chunk: int = 4096,
                   max_bytes: int | None = None) -> DataFrame:
    """A6 for keys of any size: (key, chunk, place, values), a key's values in order, in arrays of
    at most ``chunk``; ``chunk`` counts from 0 and ``place`` is the first value's place in the key.

    Rows are numbered in order of (key, value) by a range sort, and ``chunk`` rows that
    follow each other make a block: a key is split where a block ends, so a hot key
    lies in as many groups as it needs and is grouped by (key, block).  A block's end splits at most
    one key, so there are at most rows ÷ ``chunk`` split keys, whose first block
    and place are joined back, by broadcast where they are measured to be few.  Null values are kept, first."""
    order = df.select(F.col(key).alias("_key"), F.col(col).alias("_value"), F.monotonically_increasing_id().alias("_tie"))
    numbered = number_rows(order.withColumn("_order", F.struct("_key", "_value", "_tie")), "_order")
    blocks = numbered.withColumn("_block", F.floor((F.col("_rn") - 1) / chunk))
    lists = reliable_checkpoint(blocks.groupBy("_key", "_block").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_rn", "_value"))), lambda x: x["_value"]).alias("values"),
        F.min("_rn").alias("_first")))
    split = lists.groupBy("_key").agg(F.min("_block").alias("_from"), F.min("_first").alias("_start"),
                                      F.count(F.lit(1)).alias("_n")).where("_n > 1").withColumnRenamed("_key", "_split")
    joined = lists.join(broadcast_if_small(split, max_bytes), F.col("_key").eqNullSafe(F.col("_split")), "left")
    return joined.select(F.col("_key").alias(key), F.coalesce(F.col("_block") - F.col("_from"), F.lit(0)).alias("chunk"),
                         F.coalesce(F.col("_first") - F.col("_start"), F.lit(0)).alias("place"), "values")


def count_by_value(df: DataFrame, col: str) -> DataFrame:
    """A7."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A8."""
    return df.select(*cols).distinct()


# --- sorts, limits, samples ---------------------------------------------


def take_any(df: DataFrame, n: int) -> DataFrame:
    """O1: any n rows."""
    return df.limit(n)


def smallest_n(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """O2: n smallest by natural order of ``keys``."""
    return df.orderBy(*keys).limit(n)


def largest_n(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """``top(n)``."""
    return df.orderBy(*[F.desc(k) for k in keys]).limit(n)


def sample_rows(df: DataFrame, n: int, with_replacement: bool, seed: int,
                key: str) -> DataFrame:
    """N rows (all, if fewer and without replacement), named by ``key`` and the
    same on every run: rows are taken in order of md5('seed:key').

    Without replacement these are the n first: a bounded top-n.  With replacement,
    draw i of n takes place floor(md5('seed:draw:i') × N / 2³²) of the N rows numbered in
    that order, so a row may be drawn again; the draws are made by Spark, and the
    rows are numbered by a range sort, so neither passes through the driver."""
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    placed = df.withColumn("_r", order)
    if not with_replacement:
        return placed.orderBy("_r", key).limit(n).drop("_r")
    numbered = number_rows(placed.withColumn("_order", F.struct("_r", key)), "_order")
    total = numbered.count()
    hashed = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:draw:"), F.col("id").cast("string"))), 1, 8), 16, 10)
    draws = df.sparkSession.range(n if total else 0).select(
        (F.floor(hashed.cast("bigint").cast("double") * total / 4294967296.0) + 1).alias("_rn"))
    return numbered.join(draws, "_rn").drop("_rn", "_r", "_order")


def number_rows(df: DataFrame, order_key: str) -> DataFrame:
    """Dense row numbers 1..N in ``order_key`` order without moving all rows
    into one partition: range-partition and sort, take each row's position
    inside its partition, write that once to the shared checkpoint folder
    (range bounds come from sampling, so the layout must be fixed before it
    is read twice), then add per-partition offsets computed from a table
    with one row per partition."""
    ordered = (df.repartitionByRange(order_key).sortWithinPartitions(order_key)
               .withColumn("_pid", F.spark_partition_id())
               .withColumn("_local", F.monotonically_increasing_id()
                           - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)))
    fixed = reliable_checkpoint(ordered)
    sizes = fixed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_size"))
    offs = sizes.select("_pid", F.sum("_size").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)).alias("_off"))
    return (fixed.join(F.broadcast(offs), "_pid")
            .select(*df.columns,
                    (F.coalesce("_off", F.lit(0)) + F.col("_local") + 1).alias("_rn")))


# --- joins ---------------------------------------------------------------


def join_checked_broadcast(big: DataFrame, small: DataFrame, on, how: str = "inner",
                           max_bytes: int | None = None) -> DataFrame:
    """Broadcast the small side only within a measured size; above it the
    join is left to the planner (sort-merge with skew splitting)."""
    return big.join(broadcast_if_small(small, max_bytes), on, how)
