"""Entity resolution against a gold mapping (E14-E17) and the containment
join that re-aims the gold mapping on the given tables.

Threshold sweep (E16): instead of one job per threshold, scores and gold
pairs are labelled by one full outer join, and one aggregate reduces them to
at most 2 x 101 (kind, bucket) counts, gathered into a single row whose size
is fixed by construction.  Suffix and prefix sums are array expressions over
that row.  The scores are read once, so they are computed once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.text import pair_products
from tessera.session import broadcast_if_small, broadcast_stored, fits_broadcast, reliable_checkpoint

NTHRESHOLDS = 100


def _raw_split(text_col: str):
    return F.split(F.col(text_col), r"\W+")


def containment_pairs(left: DataFrame, left_id: str, right: DataFrame, right_id: str,
                      text_col: str = "text", max_bytes: int | None = None) -> DataFrame:
    """(left_id, right_id) where right text contains the whole left text.

    Candidates come from an equi-join on one key that the right text must hold:

    * an *interior* token of the left text, a run of word characters between
      non-word characters inside it: the right text has that run as a whole token;
    * for a left text without one, one of its runs of three characters (of all its
      characters, if it has one or two).

    Of each left record's keys the one with the fewest right documents is used; a
    key that no document has ends the search for that record.  Candidates are ids
    only; texts are joined once at the end and compared with ``instr``, so the
    answer is exact.  A side is broadcast where its measured bytes allow; otherwise
    it is a shuffle join, whose skewed partitions Spark splits.  An empty left text
    is in every right text: these pairs are dealt over ``_SALTS`` keys."""
    lt = left.select(F.col(left_id).alias("left_id"), F.col(text_col).alias("ltext")).where("ltext is not null")
    rt = right.select(F.col(right_id).alias("right_id"), F.col(text_col).alias("rtext")).where("rtext is not null")
    parts = _raw_split("ltext")
    interior = F.array_distinct(F.filter(
        F.slice(parts, 2, F.greatest(F.size(parts) - 2, F.lit(0))), lambda t: t != ""))
    lt = reliable_checkpoint(lt.withColumn("keys", interior))
    tokens = F.array_distinct(F.filter(_raw_split("rtext"), lambda t: t != ""))
    found = candidate_keys(lt.where(F.size("keys") > 0), rt, tokens, max_bytes)
    facts = lt.agg(F.count(F.when(F.length("ltext") == 0, 1)).alias("empty"),
                   F.collect_set(F.when(F.size("keys") == 0, loose_size("ltext"))).alias("sizes")).first()
    for more in loose_candidates(lt.where(F.size("keys") == 0), rt, facts["sizes"], max_bytes):
        found = found.unionByName(more)
    return verified_pairs(lt, rt, found, facts["empty"] > 0, max_bytes)


def loose_size(text_col: str):
    """The length of the character runs by which a text without interior tokens is
    searched: three, or what it has; null for an empty text."""
    return F.when(F.length(text_col) > 0, F.least(F.length(text_col), F.lit(3)))


def loose_candidates(loose: DataFrame, rt: DataFrame, sizes: list[int], max_bytes: int | None = None):
    """Candidates of left texts without an interior token, by their character runs, a
    table for each of the ``sizes`` (at most three) that occur."""
    for k in sizes:
        some = loose.where(loose_size("ltext") == k).withColumn("keys", _grams("ltext", k))
        yield candidate_keys(some, rt, _grams("rtext", k), max_bytes)


def verified_pairs(lt: DataFrame, rt: DataFrame, found: DataFrame, empty: bool,
                   max_bytes: int | None = None) -> DataFrame:
    """The candidates whose right text contains the left text, and, if there are ``empty``
    left texts, all their pairs, which are dealt over ``_SALTS`` keys.  ``lt`` is stored."""
    texts = broadcast_stored(lt.select("left_id", "ltext"), max_bytes)
    with_right = rt.join(broadcast_if_small(found, max_bytes), "right_id")
    pairs = with_right.join(texts, "left_id").where(F.instr("rtext", F.col("ltext")) > 0).select("left_id", "right_id")
    if not empty:
        return pairs
    salted = lt.where(F.length("ltext") == 0).select(
        "left_id", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
    dealt = rt.select("right_id", F.pmod(F.xxhash64("right_id"), F.lit(_SALTS)).cast("int").alias("salt"))
    return pairs.unionByName(dealt.join(salted, "salt").select("left_id", "right_id"))


_SALTS = 256


def _grams(text_col: str, k: int):
    """The distinct runs of ``k`` characters of a text."""
    t = F.col(text_col)
    starts = F.sequence(F.lit(1), F.greatest(F.length(t) - k + 1, F.lit(1)))
    return F.when(F.length(t) >= k, F.array_distinct(F.transform(starts, lambda i: F.substring(t, i, F.lit(k))))) \
        .otherwise(F.array().cast("array<string>"))


def candidate_keys(lt: DataFrame, rt: DataFrame, right_keys, max_bytes: int) -> DataFrame:
    """(left_id, right_id) where the right record holds the left record's rarest key."""
    wanted = broadcast_if_small(lt.select(F.explode("keys").alias("key")).distinct(), max_bytes)
    posting = reliable_checkpoint(rt.select("right_id", F.explode(right_keys).alias("key")).join(wanted, "key"))
    doc_freq = posting.groupBy("key").agg(F.count(F.lit(1)).alias("df"))
    rarest = (lt.select("left_id", F.explode("keys").alias("key")).join(doc_freq, "key", "left")
              .groupBy("left_id").agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "key")).alias("best"))
              .where(F.col("best.df") > 0).select("left_id", F.col("best.key").alias("key")))
    return posting.join(broadcast_if_small(rarest, max_bytes), "key").select("left_id", "right_id")


def label_pairs(sims: DataFrame, gold: DataFrame) -> DataFrame:
    """Scored pairs and gold pairs in one table (full outer join):
    (left_id, right_id, cosine or NULL when never scored, scored, is_gold).
    Everything downstream reads this table once."""
    keys = ["left_id", "right_id"]
    s = sims.select(*keys, "cosine", F.lit(True).alias("scored"))
    g = gold.select(*keys, F.lit(True).alias("is_gold"))
    return (s.join(g, keys, "full")
            .select(*keys, "cosine", F.coalesce("scored", F.lit(False)).alias("scored"),
                    F.coalesce("is_gold", F.lit(False)).alias("is_gold")))


def _labelled(sims: DataFrame, gold: DataFrame, max_bytes: int):
    """(labelled pairs, number of gold pairs or None).

    The gold pairs are written once to the shared folder and measured.  Within
    ``max_bytes`` they are broadcast against the streamed scores (no shuffle of the
    scores), and only scored pairs are labelled; unscored gold pairs are then known
    by count alone (score 0).  Otherwise a full outer join labels both, and the
    count is not needed."""
    keys = ["left_id", "right_id"]
    g = reliable_checkpoint(gold.select(*keys))
    if not fits_broadcast(g, max_bytes):
        return label_pairs(sims, g), None
    flagged = F.broadcast(g.withColumn("is_gold", F.lit(True)))
    lab = (sims.select(*keys, "cosine").join(flagged, keys, "left")
           .select(*keys, "cosine", F.lit(True).alias("scored"),
                   F.coalesce("is_gold", F.lit(False)).alias("is_gold")))
    return lab, g.count()


def gold_cosines(unit: DataFrame, gold: DataFrame) -> DataFrame:
    """(left_id, right_id, cosine) of the gold pairs that share a token, from
    gold ⋈ left postings ⋈ right postings: no other pair is scored."""
    return pair_products(unit, gold, "u").select("left_id", "right_id", F.col("dot").alias("cosine"))


def gold_scores(sims: DataFrame, gold: DataFrame) -> DataFrame:
    """Every gold pair with its score, 0 when never scored."""
    keys = ["left_id", "right_id"]
    return (gold.select(*keys).join(sims, keys, "left")
            .select(*keys, F.coalesce("cosine", F.lit(0.0)).alias("cosine")))


def gold_evaluation(unit: DataFrame, gold: DataFrame, n_left: DataFrame, n_right: DataFrame,
                    gold_unit: DataFrame | None = None) -> DataFrame:
    """The number of gold pairs, their mean cosine, and the mean cosine of all
    other left × right pairs, zeros included.

    No pair is formed for the last one: the cosines of the whole product sum to
    Σ_token (Σ_left u)(Σ_right u), so it is that sum less the gold pairs' over
    |left|·|right| − |gold|.  ``n_left`` and ``n_right`` are one-row counts ``n``.  ``gold_unit``
    are the postings of the records in gold pairs; with them ``unit`` is read once and need not be stored."""
    k = F.lit(1).alias("_k")
    per_token = unit.groupBy("tid" if "tid" in unit.columns else "token").agg(F.sum(F.when(F.col("side") == "L", F.col("u"))).alias("l"),
                                          F.sum(F.when(F.col("side") == "R", F.col("u"))).alias("r"))
    total = per_token.agg(F.coalesce(F.sum(F.col("l") * F.col("r")), F.lit(0.0)).alias("total")).select("*", k)
    own = gold_scores(gold_cosines(unit if gold_unit is None else gold_unit, gold), gold).agg(
        F.count(F.lit(1)).alias("true_dups"), F.coalesce(F.sum("cosine"), F.lit(0.0)).alias("own")).select("*", k)
    one = own
    for part in (total, n_left.select(F.col("n").alias("nl"), k), n_right.select(F.col("n").alias("nr"), k)):
        one = one.join(F.broadcast(part), "_k")
    others = F.col("nl").cast("double") * F.col("nr") - F.col("true_dups")
    return one.select("true_dups", F.try_divide(F.col("own"), F.col("true_dups")).alias("avg_sim_dups"),
                      F.try_divide(F.col("total") - F.col("own"), others).alias("avg_sim_non_dups"))


def score_bin(score) -> F.Column:
    """``int(score * 100)``; scores are non-negative so truncation is
    floor; a score above 1 by rounding is kept in the last bin."""
    return F.least(F.floor(score * NTHRESHOLDS), F.lit(NTHRESHOLDS)).cast("int")


def thresholds_below_or_at(score) -> F.Column:
    """k(s): how many thresholds t_n = n/100 (n = 0..99) satisfy t_n <= s,
    compared exactly as doubles.  Then s < t_n exactly when k(s) <= n."""
    return F.size(F.filter(F.sequence(F.lit(0), F.lit(NTHRESHOLDS - 1)),
                           lambda n: n / F.lit(float(NTHRESHOLDS)) <= score))


def _sweep_counts(sims: DataFrame, gold: DataFrame,
                  max_bytes: int | None = None) -> DataFrame:
    """One row holding at most 2 × 101 (kind, bucket, n) counts:
    kind 'f' = scored non-gold pairs per score bin (possible false
    positives; gold pairs that were scored are left out, unscored ones never
    entered), kind 'g' = gold pairs per k(score), unscored gold scoring 0.
    The row is bounded by construction, whatever the data size."""
    j, n_gold = _labelled(sims, gold, max_bytes)
    kind = F.when(F.col("is_gold"), F.lit("g")).otherwise(F.lit("f"))
    bucket = (F.when(F.col("is_gold"),
                     thresholds_below_or_at(F.coalesce("cosine", F.lit(0.0))))
              .otherwise(score_bin(F.col("cosine"))))
    per = j.groupBy(kind.alias("kind"), bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"))
    one = per.agg(F.collect_list(F.struct("kind", "b", "n")).alias("c"))
    if n_gold is None:
        return one
    # gold pairs never scored: score 0, known by count (exact gold count
    # minus the scored gold pairs in this row)
    scored_gold = F.aggregate(F.filter("c", lambda x: x["kind"] == "g"),
                              F.lit(0).cast("bigint"), lambda acc, x: acc + x["n"])
    unscored = F.struct(F.lit("g").alias("kind"),
                        thresholds_below_or_at(F.lit(0.0)).alias("b"),
                        (F.lit(n_gold).cast("bigint") - scored_gold).alias("n"))
    return one.select(F.concat("c", F.array(unscored)).alias("c"))


def _sum_where(pred) -> F.Column:
    return F.aggregate(F.filter("c", pred), F.lit(0).cast("bigint"),
                       lambda acc, x: acc + x["n"])


def first_threshold(min_similarity: float) -> int:
    """The first n with n / 100 at or above the similarity that pairs were joined
    at: below it, pairs are missing by design and nothing is reported."""
    return next(n for n in range(NTHRESHOLDS + 1) if n / NTHRESHOLDS >= min_similarity)


def similarity_bins(sims: DataFrame, gold: DataFrame, min_similarity: float = 0.0,
                    max_bytes: int | None = None) -> DataFrame:
    """Per bin from ``min_similarity`` to 100, scored pairs minus scored gold pairs."""
    one = _sweep_counts(sims, gold, max_bytes)
    return (one.select(F.explode(F.sequence(F.lit(first_threshold(min_similarity)), F.lit(NTHRESHOLDS))).alias("bin"), "c")
            .select("bin", _sum_where(lambda x: (x["kind"] == "f") & (x["b"] == F.col("bin")))
                    .alias("fp")))


def threshold_counts(sims: DataFrame, gold: DataFrame, min_similarity: float = 0.0,
                     max_bytes: int | None = None) -> DataFrame:
    """Per threshold t = n/100 (up to 99, from the ``min_similarity`` that
    ``sims`` were joined at): false positives (binned scores in bins >= n), false
    negatives (gold scores < t, exact) and true positives (gold pairs - false
    negatives)."""
    one = _sweep_counts(sims, gold, max_bytes)
    n = F.col("n")
    per_t = one.select(F.explode(F.sequence(F.lit(first_threshold(min_similarity)), F.lit(NTHRESHOLDS - 1))).alias("n"), "c")
    fp = _sum_where(lambda x: (x["kind"] == "f") & (x["b"] >= n))
    fn = _sum_where(lambda x: (x["kind"] == "g") & (x["b"] <= n))
    n_gold = _sum_where(lambda x: x["kind"] == "g")
    return per_t.select((n / F.lit(float(NTHRESHOLDS))).alias("threshold"), fp.alias("fp"),
                        fn.alias("fn"), (n_gold - fn).alias("tp"))


def threshold_prf(counts: DataFrame) -> DataFrame:
    """Precision, recall and F-measure per threshold; NULL where the
    denominator is zero."""
    tp, fp, fn = (F.col(c).cast("double") for c in ("tp", "fp", "fn"))
    p = F.try_divide(tp, tp + fp)
    r = F.try_divide(tp, tp + fn)
    return counts.select("threshold", p.alias("precision"), r.alias("recall"),
                         F.try_divide(2 * r * p, r + p).alias("f_measure"))
