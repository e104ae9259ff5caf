"""Benchmark decontamination as a prefix-filtered set join, in DataFrame and SQL
functions only.

Method.  Each benchmark item becomes windows of ``window`` consecutive words (an
item of fewer words is one window); equal windows are one.  A window is a set of
shingles of two neighbouring words (one word for windows of one word), and a
document contains the window only if it contains all of them, so one necessary
*prefix* shingle suffices to find it: the window's rarest by its count over all
documents.  Windows with a shingle that no document holds are dropped there and
then.  The documents' shingles are joined with the prefixes by hash; the
shingle's place in the window fixes where the window would start (positional
bound), it has to end inside the document (length bound), and the words there are
compared exactly with the window's.

Scale.  Documents are read twice (count, match) and never shuffled: the
benchmark's side is broadcast in blocks whose bytes are checked
(``block_bytes``); a benchmark beyond one block is matched block by block against
the streamed documents.  What is shuffled is one short row per document and one
per match, so a passage that a third of the documents share stays spread.

Defined results.  A null or empty text has no words, no hits and no items, and
is returned.  Null item texts and items without words have no window; a null
item id counts as no item.  Repeated rows of documents are each returned; rows
equal in id and text have equal results.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed, row_key

WINDOW, BLOCK_BYTES = 10, 48 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Characters between words: 00-2F, 3A-60 and 7B-7F, but for A-Z, which become a-z.
BETWEEN = "".join(c for c in map(chr, [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]) if c not in UPPER + " ")
HEADER = 0  # the key of a document's own row among its shingles


def words(text) -> F.Column:
    """Words of a text: A-Z lower-cased, null like empty.  One translation and a
    split at blanks take a quarter of the time of a regular expression."""
    plain = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER + BETWEEN, LOWER + " " * len(BETWEEN))
    return F.array_remove(F.split(plain, " ", -1), "")


def _key(size: int, first, second):
    """The hash of a shingle; one of two neighbours, or of a single word."""
    key = F.xxhash64(first, second) if size == 2 else F.xxhash64(first)
    return F.when(key == HEADER, F.lit(1)).otherwise(key)


def windows(benchmark: DataFrame, *, item_col: str = "item_id", text: str = "text",
            window: int = WINDOW) -> DataFrame:
    """(words, items): every distinct window and the ids of its items as text."""
    w = benchmark.select(F.col(item_col).cast("string").alias("item"), words(text).alias("w"))
    starts = F.expr(f"sequence(0, greatest(size(w) - {window}, 0))")
    return (w.where("size(w) > 0 and item is not null").select("item", "w", F.explode(starts).alias("at"))
            .groupBy(F.slice("w", F.col("at") + 1, F.least(F.lit(window), F.size("w"))).alias("words"))
            .agg(F.array_sort(F.collect_set("item")).alias("items")))


def _shingles(wins: DataFrame, size: int) -> DataFrame:
    """(words, items, place, key) of windows whose shingles have ``size`` words."""
    own = wins.where("size(words) >= 2") if size == 2 else wins.where("size(words) = 1")
    places = own.select("words", "items", F.explode(F.expr(f"sequence(0, size(words) - {size})")).alias("place"))
    return places.withColumn("key", _key(size, F.col("words")[F.col("place")], F.expr("get(words, place + 1)")))


def _occurrences(docs: DataFrame, size: int) -> DataFrame:
    """Every shingle of every document with its place; the last row of a document
    is its header.  ``w`` is the document's words with an empty one behind."""
    full = docs.select("doc_id", "k1", "k2", F.concat("w", F.array(F.lit(""))).alias("w"))
    rows = full.select("doc_id", "k1", "k2", "w", F.posexplode("w").alias("at", "word"))
    last = F.col("at") == F.size("w") - 1
    return rows.withColumn("key", F.when(last, F.lit(HEADER).cast("long")).otherwise(
        _key(size, F.col("word"), F.expr("get(w, at + 1)"))))


def _blocks(df: DataFrame, limit: int) -> list[DataFrame]:
    """``df`` in parts of about ``limit`` bytes at most, by a hash of its windows."""
    size = df.agg(F.sum(F.length(F.concat_ws(" ", "words")) * 2 + 16 * F.size("words")
                        + 24 * F.size("items") + 96).alias("b")).first()["b"] or 0
    n = -(-int(size) // limit) or 1
    return [df] if n == 1 else [df.where(F.pmod(F.xxhash64("words"), F.lit(n)) == i) for i in range(n)]


def rarest_shingles(docs: DataFrame, wins: DataFrame, size: int, block_bytes: int) -> DataFrame:
    """The prefix of each window: (key, place, words, items), its shingle with the
    smallest count over all documents.  Windows that cannot occur are left out."""
    held = checkpointed(_shingles(wins, size))
    counts = None
    for block in _blocks(held, block_bytes):
        found = (_occurrences(docs, size).join(F.broadcast(block.select("key").distinct()), "key", "leftsemi")
                 .groupBy("key").agg(F.count("*").alias("n")))
        counts = found if counts is None else counts.unionByName(found).distinct()
    ranked = held.join(counts, "key", "left").groupBy("words").agg(
        F.first("items").alias("items"),
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key", "place")).alias("best"))
    return ranked.where("best.n > 0").select("best.key", "best.place", "words", "items")


def matches(docs: DataFrame, wins: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, k1, k2, n_words, start, length, items): a row without a start for
    every document, and one for every occurrence of a window in a document."""
    sizes = [r["s"] for r in wins.select(F.least(F.lit(2), F.size("words")).alias("s")).distinct().collect()]
    out, headers = None, True
    for size in sorted(set(sizes), reverse=True) or [2]:
        prefix = checkpointed(rarest_shingles(docs, wins, size, block_bytes))
        for block in _blocks(prefix, block_bytes):
            side = block.select("key", "place", "words", "items")
            if headers:
                side = side.unionByName(docs.sparkSession.range(1).select(
                    F.lit(HEADER).cast("long").alias("key"), F.lit(0).alias("place"),
                    F.lit(None).cast("array<string>").alias("words"),
                    F.lit(None).cast("array<string>").alias("items")))
            found = _occurrences(docs, size).join(F.broadcast(side), "key")
            start = F.col("at") - F.col("place")
            found = found.where(
                F.col("words").isNull()
                | ((start >= 0) & (start + F.size("words") < F.size("w"))
                   & (F.slice("w", F.greatest(start, F.lit(0)) + 1, F.size("words")) == F.col("words"))))
            found = found.select("doc_id", "k1", "k2", (F.size("w") - 1).alias("n_words"),
                                 F.when(F.col("words").isNotNull(), start).alias("start"),
                                 F.size("words").alias("length"), "items")
            out = found if out is None else out.unionByName(found)
            headers = False
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text: str = "text",
                  item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, k1, k2, copies, n_words, n_hit, items, spans) of every distinct
    document, ``copies`` being the number of rows equal to it in id and text.

    ``spans`` are the occurrences as (start, length) in words, at most ten at one
    start; ``n_hit`` counts the words inside any of them; ``items`` are the item
    ids found, sorted as text.  The key (k1, k2) names the document's id and text."""
    wins = checkpointed(windows(benchmark, item_col=item_col, text=item_text, window=window))
    w = docs.select(F.col(id_col).alias("doc_id"), *row_key(id_col, text), words(text).alias("w"))
    found = matches(w, wins, block_bytes)
    header = F.col("start").isNull()
    per_doc = found.groupBy("k1", "k2").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").cast("long").alias("n_words"),
        F.count(F.when(header, 1)).alias("copies"),
        F.collect_set(F.when(~header, F.struct("start", "length"))).alias("spans"),
        F.collect_set("items").alias("items"))
    covered = F.aggregate(
        F.array_sort("spans"), F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s["start"] + s["length"] - F.greatest(a["end"], s["start"]))).alias("n"),
                              F.greatest(a["end"], s["start"] + s["length"]).alias("end")), lambda a: a["n"])
    return per_doc.select("doc_id", "k1", "k2", "copies", "n_words", covered.cast("long").alias("n_hit"),
                          F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"), "spans")
