"""Helpers shared by the training-data operators: tables, written cuts of
lineage, row keys, labelled samples and connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir, shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table by name, read by Spark only (the folder may be a remote store)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder that
    ``spark.checkpoint.dir`` names and read it back: a lost executor then costs
    a re-read of files, not of the plan behind them."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """A reliable checkpoint; Spark removes its files with the last reference."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def row_key(*cols: str) -> list[Column]:
    """Two independent 64-bit hashes that name a row by its content.  Rows equal
    in every column share a key, which is harmless: they have equal results."""
    return [F.xxhash64(*cols).alias("k1"), F.xxhash64(F.lit("second"), *cols).alias("k2")]


def fold(doc_id, n: int) -> Column:
    """crc32 of the id's decimal text, modulo ``n``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string")) % n if isinstance(doc_id, str) \
        else F.crc32(doc_id.cast("string")) % n


def labelled_sample(labels: DataFrame, label: str, folds: int, held_out: int,
                    per_class: int, id_col: str = "doc_id") -> tuple[DataFrame, dict[int, int]]:
    """At most ``per_class`` training ids of each class, in order of a hash, and
    the full number of training ids in each class.

    Rows of the held-out fold, with a null id or a label other than 0 and 1 are
    left out before anything is learnt; an id with several rows counts once, by
    the mean of its labels (one half counts as 1).  Both results are bounded by
    ``per_class``: two top-n selections and a two-row count."""
    train = (labels.where(F.col(id_col).isNotNull() & F.col(label).isin(0, 1)
                          & (fold(id_col, folds) != held_out))
             .groupBy(F.col(id_col).alias("doc_id"))
             .agg((F.avg(label) >= 0.5).cast("int").alias("y")))
    counts = {r["y"]: r["n"] for r in train.groupBy("y").agg(F.count("*").alias("n")).collect()}
    picks = [train.where(F.col("y") == y)
             .orderBy(F.xxhash64(F.lit("sample"), "doc_id"), "doc_id").limit(per_class)
             for y in (0, 1)]
    return picks[0].unionByName(picks[1]), counts


def _signature(edges: DataFrame):
    return edges.agg(F.count("*").alias("n"),
                     F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``; a component is named
    by its smallest node.

    Alternating large-star and small-star rounds, each an aggregate by node and
    an equi-join back to the edges; a node's neighbours are never gathered.
    Self-loops, repeated and reversed edges are allowed; null ends are left
    out.  Every round is checkpointed, and the loop ends when the edge set stays
    the same."""
    e = (edges.where("a is not null and b is not null and a <> b")
         .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    e = checkpointed(e)
    before = _signature(e)
    for _ in range(max_rounds):
        if not before["n"]:
            break
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = (both.join(low, "a").where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a")
                 .select(F.inline(F.array(
                     F.struct(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")),
                     F.struct(F.col("a"), F.col("m").alias("b")))))
                 .where("a <> b").distinct())
        e = checkpointed(small)
        now = _signature(e)
        if (now["n"], now["h"]) == (before["n"], before["h"]):
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def vocabulary_path(name: str) -> str:
    """Where a public tokenizer file lies on the machine that runs this."""
    import public_tokenizers
    return public_tokenizers.path(name)


def small_side(df: DataFrame, limit_bytes: int = 16 << 20) -> DataFrame:
    """``df`` checkpointed, and marked for broadcast if its measured rows fit in
    ``limit_bytes``; a larger one is left to a shuffle join."""
    df = checkpointed(df)
    rows = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    size = df.agg(F.sum(2 * rows + 64).alias("b")).first()["b"] or 0
    return F.broadcast(df) if size <= limit_bytes else df


def byte_slices(texts, most: int = 12 << 20):
    """(begin, end) of runs of an Arrow string array of about ``most`` bytes each; a
    longer text is a run of its own.  Kernels then work on bounded input."""
    import numpy as np
    import pyarrow.compute as pc
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < len(texts):
        have = int(ends[begin - 1]) if begin else 0
        to = max(begin + 1, int(np.searchsorted(ends, have + most, "right")))
        yield begin, to
        begin = to
