"""Text analytics (E1-E13): tokens, TF, IDF, TF-IDF, norms and cosine
similarity through an inverted index.

Everything is one long table keyed by (side, id, token) rather than per-record
dictionaries, so the work is spread by Spark's shuffles instead of being
collected and broadcast from the driver:

* ``term_counts``     sort each record's tokens and count runs inside the row
                      (no shuffle); TF = count / record length
* ``idf_weights``     distinct tokens per record, partial count per token
* ``tfidf``           term counts, written once, joined with IDF on token (measured,
                      broadcast only under a bound)
* ``unit_weights``    weight / norm, the norm a window over one document
* ``cosine_inverted`` exact similarity join at a threshold, on rare-token prefixes
* ``pair_products``   the products of given pairs only

``postings.TextIndex`` keeps all of this for two record tables that are tokenized
once, with tokens as numbers.

Frequent tokens carry little weight, so they fall out of the prefixes: the join
needs no salting, and nothing grows with the product of both tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.once import once
from tessera.functions.text import simple_tokenize, tokenize
from tessera.session import broadcast_if_small, broadcast_limit, fits_broadcast, reliable_checkpoint, stored

LEFT, RIGHT = "L", "R"


def corpus(left: DataFrame, left_id: str, right: DataFrame, right_id: str,
           text_col: str = "text") -> DataFrame:
    """Two record tables as one (side, id, text) table."""
    return (left.select(F.lit(LEFT).alias("side"), F.col(left_id).alias("id"),
                        F.col(text_col).alias("text"))
            .unionByName(right.select(F.lit(RIGHT).alias("side"),
                                      F.col(right_id).alias("id"),
                                      F.col(text_col).alias("text"))))


def doc_tokens(docs: DataFrame, stopwords: bool = True) -> DataFrame:
    """(…, id, tokens): F1/F2 per record; narrow, no shuffle."""
    tok = tokenize(F.col("text")) if stopwords else simple_tokenize(F.col("text"))
    keep = [c for c in docs.columns if c != "text"]
    return docs.select(*keep, tok.alias("tokens"))


def token_totals(tokens: DataFrame) -> DataFrame:
    """Total tokens (after stopword removal) over the given records."""
    return tokens.agg(F.coalesce(F.sum(F.size("tokens")), F.lit(0)).cast("bigint")
                      .alias("n_tokens"))


def _keys(df: DataFrame) -> list[str]:
    return [c for c in ("side", "id") if c in df.columns]


def term_counts(tokens: DataFrame) -> DataFrame:
    """(…, id, doc_len, token, n): one row per distinct token of a record,
    counted inside the row, so counting needs no shuffle."""
    return counts_of(term_runs(tokens))


def counts_of(runs: DataFrame) -> DataFrame:
    """The term counts, one row each, of records that hold them as ``runs``."""
    return runs.select(*[c for c in runs.columns if c != "runs"], F.inline("runs"))


def term_runs(tokens: DataFrame) -> DataFrame:
    """(…, id, doc_len, runs): one row per record, ``runs`` its distinct tokens with their
    counts (sort, find where runs start, take run lengths)."""
    keys = _keys(tokens)
    sorted_ = once(tokens, keys, s=F.sort_array("tokens"))
    s, n = F.col("s"), F.size("s")
    starts = F.when(n > 0, F.filter(F.sequence(F.lit(0), n - 1),
                                    lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1))))
    with_starts = once(sorted_, keys + ["s"], starts=starts)
    st_col = F.col("starts")
    runs = F.transform(st_col, lambda st, j: F.struct(
        F.get(s, st).alias("token"),
        (F.coalesce(F.get(st_col, j + 1), n) - st).cast("bigint").alias("n")))
    return with_starts.select(*keys, n.alias("doc_len"), runs.alias("runs"))


def term_frequency(tokens: DataFrame) -> DataFrame:
    """(…, id, token, tf) with tf = count of the token ÷ tokens in the
    record."""
    return term_counts(tokens).select(*_keys(tokens), "token",
                                      (F.col("n") / F.col("doc_len")).alias("tf"))


def idf_weights(tokens: DataFrame) -> DataFrame:
    """(token, n_docs, idf) with idf = N / n(t), no logarithm.  N counts
    every record, including records without tokens.  N is a one-row
    aggregate joined on a constant key (a broadcast of exactly one row)."""
    per_doc = tokens.select(F.explode(F.array_distinct("tokens")).alias("token"))
    return idf_of(per_doc, tokens)


def idf_of(per_doc: DataFrame, records: DataFrame) -> DataFrame:
    """(token, n_docs, idf) from the distinct tokens of each record and the records."""
    df_t = per_doc.groupBy("token").agg(F.count(F.lit(1)).alias("n_docs"))
    n = records.agg(F.count(F.lit(1)).alias("n_records")).withColumn("_k", F.lit(1))
    return (df_t.withColumn("_k", F.lit(1)).join(F.broadcast(n), "_k")
            .select("token", "n_docs",
                    (F.col("n_records").cast("double") / F.col("n_docs")).alias("idf")))


def lowest_idf_tokens(idf: DataFrame, n: int = 11) -> DataFrame:
    """The n tokens with the smallest IDF; ties by token."""
    return idf.select("token", "idf").orderBy("idf", "token").limit(n)


def idf_histogram(idf: DataFrame, bins: int = 50) -> DataFrame:
    """Equal-width histogram of IDF values over [min, max] with the
    maximum closed into the last bin.

    Tokens of one document frequency have one IDF, so they are counted together
    first.  There are at most √(2 × postings) different frequencies; bounds and
    bins are taken over these few rows, and the corpus is read once."""
    few = idf.groupBy("n_docs").agg(F.first("idf").alias("idf"), F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy()
    with_ends = few.select("n", "idf", F.min("idf").over(everything).alias("lo"), F.max("idf").over(everything).alias("hi"))
    b = F.floor(F.try_divide(F.col("idf") - F.col("lo"), F.col("hi") - F.col("lo")) * bins) + 1
    bucket = F.least(F.coalesce(b, F.lit(1)), F.lit(bins)).cast("bigint")
    return with_ends.groupBy(bucket.alias("bin")).agg(F.sum("n").alias("n"))


def tfidf(tokens: DataFrame, idf: DataFrame | None = None,
          max_bytes: int | None = None) -> DataFrame:
    """(…, id, token, w = tf * idf, n_docs).  ``idf`` defaults to the IDF
    of ``tokens`` itself; a token outside the IDF table is dropped.

    Term counts are written once to the shared folder, so texts are tokenized once;
    IDF comes from them."""
    counts = stored(term_counts(tokens), "term-counts")
    if idf is None:
        idf = reliable_checkpoint(idf_of(counts.select("token"), tokens))
    return weigh(counts, idf, max_bytes)


def weigh(counts: DataFrame, idf: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """(…, id, token, w = tf * idf, n_docs) of term counts."""
    joined = join_tokens(counts, idf, max_bytes)
    return joined.select(*_keys(counts), "token", (F.col("n") / F.col("doc_len") * F.col("idf")).alias("w"), "n_docs")


def join_tokens(postings: DataFrame, table: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """``postings`` with the columns of ``table``, one stored row per ``token`` with its
    ``n_docs``; postings of tokens outside the table are dropped.

    The table is measured.  Within ``max_bytes`` it is broadcast and the postings are
    joined where they are, with no shuffle.  A larger one is split by document
    frequency.  With P postings in all (the sum of ``n_docs``), R rows that fit and
    h = ceil(P / R), fewer than R tokens can have more than h postings; those hot tokens
    are broadcast (measured again), and their postings are joined where they are.  Every
    other token has at most h postings, so the shuffle join on them cannot be skewed; only
    their postings, the few of natural texts, are sent to it.  ``postings``, read twice, are stored."""
    values = [c for c in table.columns if c != "token"]
    if fits_broadcast(table, max_bytes):
        return postings.join(F.broadcast(table), "token").select(*postings.columns, *values)
    total = table.agg(F.sum("n_docs")).first()[0]
    h = -(-total // max(1, broadcast_limit(table, max_bytes) // 128))
    hot = broadcast_if_small(table.where(F.col("n_docs") > h), max_bytes)
    cold = table.where(F.col("n_docs") <= h)
    rest = postings.join(hot.select("token"), "token", "left_anti").join(cold, "token")
    return (postings.join(hot, "token").select(*postings.columns, *values)
            .unionByName(rest.select(*postings.columns, *values)))


def vector_norms(weights: DataFrame) -> DataFrame:
    """(…, id, norm) = sqrt(sum(w²)) per record."""
    return (weights.groupBy(*_keys(weights))
            .agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm")))


def unit_weights(weights: DataFrame) -> DataFrame:
    """Weights divided by their record's norm.  The window holds one
    record's distinct tokens, bounded by that single record's length."""
    w = Window.partitionBy(*_keys(weights))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(w))
    return weights.withColumn("u", F.try_divide(F.col("w"), norm))


def inverted_index(weights: DataFrame) -> DataFrame:
    """(token, …, id) rows: the weight table keyed by token, as
    ``postings.write_inverted`` stores it."""
    return weights.select("token", *_keys(weights))


def _token_key(postings: DataFrame) -> tuple[str, list[str]]:
    """The column that names a token, and those that order tokens from rare to
    frequent."""
    key = "tid" if "tid" in postings.columns else "token"
    return key, ["n_docs", key]


def shared_postings(unit: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """The postings of tokens that both sides hold, with ``top``, the token's
    greatest unit weight on the other side.  Other tokens add nothing to any product."""
    key, _ = _token_key(unit)
    on = lambda s: F.max(F.when(F.col("side") == s, F.col("u")))
    tops = unit.groupBy(key).agg(on(LEFT).alias("_l"), on(RIGHT).alias("_r")).where("_l is not null and _r is not null")
    return (unit.join(broadcast_if_small(tops, max_bytes), key)
            .withColumn("top", F.when(F.col("side") == LEFT, F.col("_r")).otherwise(F.col("_l"))).drop("_l", "_r"))


def prefixes(shared: DataFrame, min_similarity: float, max_bytes: int | None = None) -> DataFrame:
    """The postings to index: of each record its tokens from the rarest on, up to where no
    record of the other side can reach ``min_similarity`` by the tokens that remain.
    With these a record's product is at most Σ u·top, and at most the norm of its own
    weights among them (Cauchy–Schwarz); the smaller of both bounds counts.

    The bound over all of a record's tokens is its greatest, so a record below the threshold
    by it has no prefix.  It is a plain sum, combined before the shuffle; where the records
    above it are measured to be few, only their postings are sent to the window."""
    _, order = _token_key(shared)
    keys = _keys(shared)
    parts = F.col("u") * F.col("u"), F.col("u") * F.col("top")
    bound = lambda of: F.least(F.sqrt(of(F.sum(parts[0]))), of(F.sum(parts[1])))
    reach = reliable_checkpoint(shared.groupBy(*keys).agg(bound(lambda s: s).alias("most"))
                                .where(F.col("most") >= min_similarity - 1e-9).select(*keys))
    if fits_broadcast(reach, max_bytes):
        shared = shared.join(F.broadcast(reach), keys, "leftsemi")
    rest = (Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return shared.withColumn("rest", bound(lambda s: s.over(rest))).where(F.col("rest") >= min_similarity - 1e-9)


def cosine_inverted(weights: DataFrame, min_similarity: float, max_bytes: int | None = None) -> DataFrame:
    """Every left/right pair with cosine of ``min_similarity`` or more, exact.

    Tokens are ordered from rare to frequent, and of a record only its prefix is
    indexed (``prefixes``).  If the first token that two records share lay behind
    either prefix, their product would be below the threshold, so every pair sought shares a
    prefix token.  Candidates, ids from prefix ⋈ prefix, are then scored over all tokens;
    where they are measured to be few, only their records' postings leave the scan.  Frequent tokens carry little weight and fall out of the
    prefixes, so the join neither is skewed by them nor grows with left × right.
    ``weights`` are postings with ``w``, or with ``u``, stored, from ``TextIndex``."""
    unit = weights if "u" in weights.columns else reliable_checkpoint(unit_weights(weights).where("u is not null"))
    key, _ = _token_key(unit)
    prefix = prefixes(shared_postings(unit, max_bytes), min_similarity, max_bytes)
    side = lambda df, s, name, *v: df.where(F.col("side") == s).select(F.col("id").alias(name), key, *v)
    found = side(prefix, LEFT, "left_id").join(side(prefix, RIGHT, "right_id"), key) \
        .select("left_id", "right_id").distinct()
    found = reliable_checkpoint(found)
    few = fits_broadcast(found, max_bytes)
    lefts, rights = (F.broadcast(found.select(c).distinct()) if few else None for c in ("left_id", "right_id"))
    of = lambda rows, ids, name: rows.join(ids, name, "leftsemi") if few else rows
    scored = (found.join(of(side(unit, LEFT, "left_id", F.col("u").alias("a")), lefts, "left_id"), "left_id")
              .join(of(side(unit, RIGHT, "right_id", F.col("u").alias("b")), rights, "right_id"), ["right_id", key])
              .groupBy("left_id", "right_id").agg(F.sum(F.col("a") * F.col("b")).alias("cosine")))
    return scored.where(F.col("cosine") >= min_similarity)


def pair_products(weights: DataFrame, pairs: DataFrame, value: str = "w") -> DataFrame:
    """E7/J8 for given pairs: (left_id, right_id, dot, n_shared) over the tokens that
    each pair shares."""
    return (_shared_of(weights, pairs, value).groupBy("left_id", "right_id")
            .agg(F.sum(F.col("a") * F.col("b")).alias("dot"), F.count(F.lit(1)).alias("n_shared")))


def _shared_of(weights: DataFrame, pairs: DataFrame, value: str) -> DataFrame:
    key, _ = _token_key(weights)
    side = lambda s, name, v: weights.where(F.col("side") == s).select(
        F.col("id").alias(name), key, F.col(value).alias(v))
    return (pairs.select("left_id", "right_id").join(side(LEFT, "left_id", "a"), "left_id")
            .join(side(RIGHT, "right_id", "b"), ["right_id", key]))


def shared_tokens(weights: DataFrame, pairs: DataFrame, tokens: DataFrame | None = None) -> DataFrame:
    """E12 for given pairs: (left_id, right_id, n_shared, shared_tokens), the tokens in
    order; ``tokens`` names numbered ones.  A pair's list is bounded by its shorter record."""
    rows = _shared_of(weights, pairs, "w")
    if "tid" in weights.columns:
        rows = rows.join(tokens.select("tid", "token"), "tid")
    return rows.groupBy("left_id", "right_id").agg(
        F.count(F.lit(1)).alias("n_shared"), F.array_join(F.sort_array(F.collect_list("token")), " ").alias("shared_tokens"))


def text_weights(left: DataFrame, left_id: str, right: DataFrame, right_id: str
                 ) -> DataFrame:
    """TF-IDF postings of both record tables under their joint IDF."""
    toks = doc_tokens(corpus(left, left_id, right, right_id))
    return tfidf(toks)


def sparse_dot(a: DataFrame, b: DataFrame) -> DataFrame:
    """E7 on two (token, w) vectors: Σ a.w × b.w over shared tokens."""
    return (a.select("token", F.col("w").alias("a"))
            .join(b.select("token", F.col("w").alias("b")), "token")
            .agg(F.coalesce(F.sum(F.col("a") * F.col("b")), F.lit(0.0)).alias("dot")))


def cosine_of(a: DataFrame, b: DataFrame) -> DataFrame:
    """Cosine of two (token, w) vectors; NULL when a vector is empty."""
    na = a.agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("na"))
    nb = b.agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("nb"))
    d = sparse_dot(a, b)
    k = F.lit(1)
    return (d.withColumn("_k", k).join(F.broadcast(na.withColumn("_k", k)), "_k")
            .join(F.broadcast(nb.withColumn("_k", k)), "_k")
            .select(F.try_divide(F.col("dot"), F.col("na") * F.col("nb")).alias("cosine")))


def longest_record(tokens: DataFrame) -> DataFrame:
    """The record with the most tokens; ties by id."""
    return (tokens.select(*_keys(tokens), F.size("tokens").cast("bigint").alias("n_tokens"))
            .orderBy(F.desc("n_tokens"), *_keys(tokens)).limit(1))
