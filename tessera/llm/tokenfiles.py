"""Token-ID output: Parquet files with one list of ids for each document.

Format.  Rows are in ascending document order over the files of a folder
(``doc_id, part, begin, n_tokens, ids``).  Ids are a list column, dictionary
encoded (a vocabulary's ids are few), the counters are delta encoded; row groups
and pages are kept small and Parquet's column and page indexes are written, so a
reader that wants some documents, or metadata only, skips the rest.  ``begin``
counts ids from the start of the document's part; parts are few, so the place of a
document in the whole stream is one small lookup away.

Method.  Documents are range-partitioned by id and sorted; equal ids are spread by
the text's hash and the row's place, so that one id may hold a third of the rows.
Every task encodes and writes its range; nothing passes through the driver.

Defined results.  A null or empty text has its end id alone.  Null ids come first;
rows with equal ids are all kept, in an arbitrary but fixed order.  Very long texts are
one row.  Other columns are ignored; an empty table gives files without rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import small_side
from tessera.llm.tokens import WordEncoder

END = 2
FORMAT = {
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.block.size": str(16 << 20),
    "parquet.page.size": str(128 << 10),
    "parquet.page.row.count.limit": "1000",
    "parquet.enable.dictionary": "true",
    "parquet.dictionary.page.size": str(1 << 20),
    **{f"parquet.enable.dictionary#{c}": "false" for c in ("doc_id", "begin", "n_tokens")},
}


def write(docs: DataFrame, path: str, vocabulary: str, *, id_col: str = "doc_id", text: str = "text",
          end: int = END) -> None:
    """Encode every whole text and write the files of ``path``, a shared folder."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"),
                       F.xxhash64(text).alias("tie"), F.monotonically_increasing_id().alias("row"))
    rows = (rows.repartitionByRange("doc_id", "tie", "row").sortWithinPartitions("doc_id", "tie", "row")
            .select("doc_id", "text"))

    def run(batches):
        encoder, part, begin = WordEncoder.of(vocabulary, False), TaskContext.get().partitionId(), 0
        for batch in batches:
            row = 0
            for ids, counts in encoder.encode(batch.column(1)):
                n, k = counts + 1, len(counts)
                to = np.cumsum(n)
                full = np.full(to[-1], end, np.int32)
                own = np.ones(len(full), bool)
                own[to - 1] = False
                full[own] = ids
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, to].astype(np.int32)), pa.array(full))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, k), pa.array(np.full(k, part, np.int32)),
                     pa.array(begin + to - n), pa.array(n), lists],
                    ["doc_id", "part", "begin", "n_tokens", "ids"])
                begin, row = begin + int(to[-1]), row + k

    (rows.mapInArrow(run, f"doc_id {kind}, part int, begin long, n_tokens long, ids array<int>")
     .write.options(**FORMAT).parquet(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document; ``start`` counts the ids
    of all documents before it.  Spark reads only the columns that are used."""
    rows = spark.read.parquet(path)
    # one row for each part, which is one task's output
    totals = rows.groupBy("part").agg(F.max(F.col("begin") + F.col("n_tokens")).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return rows.join(small_side(base), "part").select("doc_id", (F.col("base") + F.col("begin")).alias("start"), "n_tokens", "ids")


def documents(spark: SparkSession, path: str, low: int, high: int) -> DataFrame:
    """The rows of ids ``low`` to ``high``: row groups and pages are skipped by
    the files' indexes."""
    return spark.read.parquet(path).where(F.col("doc_id").between(low, high))


def checksums(rows: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32), both last ones taken from the ids."""
    def run(batches):
        for batch in batches:
            lists = batch.column(2)
            at, ids = np.asarray(lists.offsets), np.asarray(lists.values).astype("<u4")
            crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "start", "ids").mapInArrow(
        run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")
