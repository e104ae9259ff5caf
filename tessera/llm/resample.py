"""Target-distribution importance resampling.

Method.  Texts become bags of hashed n-grams by Arrow kernels alone: ``ascii_lower``,
``split_pattern_regex``, ``list_flatten`` and ``dictionary_encode`` turn a batch into
word numbers; an n-gram is the pair of the (n-1)-gram that starts at a place and the
word behind it, two shifted number arrays, encoded again; only distinct n-grams are
built as strings and hashed by CRC32.  A first pass counts the buckets of the corpus and of the
target; a bucket's gain is the rounded-down log ratio of both smoothed shares.  A
second pass takes each n-gram's gain and reduces it by document to the mean, the
importance weight.  Adding Gumbel noise, which depends on the id alone, and taking the highest
scores draws documents without replacement in proportion to their weights.

Scale.  A task sends one count for each bucket it saw, so both passes shuffle nothing
that grows with texts.  The gains, one number for each of ``buckets``, are what goes to
every task.  The draw is a range sort of short rows with the offsets of its
partitions: no row is gathered, and rows with one id and score are spread by their
place in the written table.

Defined results.  A null or empty text has no words, no features and weight 0.  Repeated
rows are rows of their own, each counted and each drawn or not; equal scores go to the smaller id,
null ids last, then to an arbitrary but fixed order.  A null id draws the noise of an empty id.  An empty
corpus gives an empty result, an empty target gives every bucket a count of nought.
Very long texts are worked on whole.  Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import byte_slices, materialize
from tessera.operators.relational import number_rows

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # fixed value: what lies between words


def _crc(strings: pa.Array, buckets: int) -> np.ndarray:
    return np.fromiter((zlib.crc32(s) for s in strings.cast(pa.large_binary()).to_pylist()),
                       np.int64, len(strings)) % buckets


def hashed_ngrams(texts: pa.Array, order: int, buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For n = 1 to ``order``: (text number, bucket) of every n-gram, texts in order."""
    # lowered before the cast: of a slice the cast keeps offsets that do not begin at 0, which ascii_lower misreads
    low = pc.ascii_lower(pc.fill_null(texts, "")).cast(pa.large_string())
    cut = pc.split_pattern_regex(low, SEPARATOR)
    words, owner = pc.list_flatten(cut), pc.list_parent_indices(cut)
    real = pc.not_equal(words, "")
    owner = owner.filter(real).to_numpy().astype(np.int64)
    coded = words.filter(real).dictionary_encode()
    word = coded.indices.to_numpy().astype(np.int64)
    gram, names, out = word, coded.dictionary, []
    for n in range(1, order + 1):
        if n > 1:
            size = max(len(word) - n + 1, 0)
            pairs = gram[:size] * max(len(coded.dictionary), 1) + word[n - 1:]
            both = pa.array(pairs).dictionary_encode()
            first, last = np.divmod(both.dictionary.to_numpy(), max(len(coded.dictionary), 1))
            names = pc.binary_join_element_wise(names.take(pa.array(first)), coded.dictionary.take(pa.array(last)),
                                                pa.scalar(" ", pa.large_string()))
            gram = both.indices.to_numpy().astype(np.int64)
        inside = owner[:len(gram)] == owner[n - 1:]  # an n-gram lies in one text
        out.append((owner[:len(gram)][inside], _crc(names, buckets)[gram][inside]))
    return out


def bucket_counts(docs: DataFrame, text: str, order: int, buckets: int) -> DataFrame:
    """(bucket, n): n-grams of all texts by bucket."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            texts = batch.column(0)
            for a, b in byte_slices(texts):
                for _, found in hashed_ngrams(texts.slice(a, b - a), order, buckets):
                    total += np.bincount(found, minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])

    return (docs.select(F.col(text).alias("text")).mapInArrow(run, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(corpus: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """floor(1000 ln) of each bucket's share of the target over its share of the
    corpus, both smoothed by one.  Reads at most ``buckets`` rows of each."""
    s, t = np.zeros(buckets), np.zeros(buckets)
    for counts, into in ((corpus, s), (target, t)):
        for bucket, n in counts.collect():
            into[bucket] = n
    ratio = ((t + 1) * (s.sum() + buckets)) / ((s + 1) * (t.sum() + buckets))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio.tolist()], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, *, order: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight): the floored mean gain of each row."""
    known = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches):
        for batch in batches:
            ids, texts = batch.columns
            for a, b in byte_slices(texts):
                places = np.arange(b - a + 1)
                words, total, n = None, 0, 0
                for owner, found in hashed_ngrams(texts.slice(a, b - a), order, len(known.value)):
                    ends = np.searchsorted(owner, places)
                    summed = np.r_[0, np.cumsum(known.value[found])][ends]
                    n, total = n + np.diff(ends), total + np.diff(summed)
                    words = n if words is None else words
                weight = np.where(n > 0, total // np.maximum(n, 1), 0)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(words), pa.array(n), pa.array(weight)],
                    ["doc_id", "n_words", "n_features", "weight"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_words long, n_features long, weight long")


def noise(seed: str, doc_id: str) -> F.Column:
    """floor(1000 g) for Gumbel noise g, from the first 32 bits of the SHA-256 of seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, *, percent: int = 10, least_words: int = 20, order: int = 1,
             buckets: int = 10_000, seed: str = "2024", id_col: str = "doc_id", text: str = "text",
             target_text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row.  Of the rows of
    at least ``least_words`` words ``percent`` in a hundred, rounded down, have a rank: 1, 2, 3
    and on, from the highest score."""
    gain = gains(bucket_counts(docs, text, order, buckets),
                 bucket_counts(target, target_text, order, buckets), buckets)
    scored = materialize(
        weigh(docs, gain, order=order, id_col=id_col, text=text)
        .withColumn("score", F.col("weight") + noise(seed, "doc_id"))
        .withColumn("row", F.monotonically_increasing_id()), "resample")
    able = scored.where(F.col("n_words") >= least_words)
    drawn = able.count() * percent // 100
    place = F.struct((-F.col("score")).alias("score"), F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    ranked = number_rows(able.withColumn("place", place), "place")
    rank = F.when(F.col("_rn") <= drawn, F.col("_rn").cast("bigint"))
    out = ["doc_id", "n_words", "n_features", "weight", "score"]
    return ranked.select(*out, rank.alias("rank")).unionByName(
        scored.where(F.col("n_words") < least_words).select(*out, F.lit(None).cast("bigint").alias("rank")))
