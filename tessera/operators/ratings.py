"""Rating statistics and ALS recommendations.

Statistics are grouped aggregates (partial aggregation before the shuffle).
A trained model is checked by the equations that its factors must solve
(``normal_residuals``), and recommendations are made for all users at once from
blocks of item factors (``recommend_users``).  ALS is Spark ML's distributed block solver; predictions come from
``ALSModel.transform`` with cold-start rows dropped.  Ids are 64-bit; those ALS
cannot take are numbered densely in front of it.  Titles are joined without a broadcast hint: the title
table grows with the catalogue, so AQE decides from its measured size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import broadcast_if_small, broadcast_stored, release, reliable_checkpoint

# The reference's ALS settings.
ALS_ITERATIONS = 5
ALS_REG = 0.1
ALS_SEED = 5
ALS_RANKS = (4, 8, 12)
SPLIT_WEIGHTS = (6.0, 2.0, 2.0)
SPLIT_SEED = 0


def item_rating_stats(ratings: DataFrame) -> DataFrame:
    """(item, n_ratings, avg_rating)."""
    return ratings.groupBy("item").agg(F.count(F.lit(1)).alias("n_ratings"),
                                       F.avg("rating").alias("avg_rating"))


def item_rating_titles(ratings: DataFrame, titles: DataFrame) -> DataFrame:
    """The statistics with titles."""
    return item_rating_stats(ratings).join(titles, "item")


def best_items(ratings: DataFrame, titles: DataFrame, min_ratings: int,
               n: int = 20) -> DataFrame:
    """The n best items with more than ``min_ratings`` ratings, in a
    total order: mean rounded to 3 decimals, then title, then item, all
    descending."""
    stats = item_rating_titles(ratings, titles).where(F.col("n_ratings") > min_ratings)
    return (stats.orderBy(F.bround("avg_rating", 3).desc(), F.desc("title"), F.desc("item"))
            .limit(n).select("avg_rating", "title", "n_ratings", "item"))


def sort_total_order(stats: DataFrame, ascending: bool = False) -> DataFrame:
    """Full sort by (mean to 3 decimals, title), both the same direction."""
    key = [F.bround("avg_rating", 3), F.col("title"), F.col("item")]
    return stats.orderBy(*[k.asc() if ascending else k.desc() for k in key])


def split_ratings(ratings: DataFrame, weights: Sequence[float] = SPLIT_WEIGHTS,
                  seed: int = SPLIT_SEED) -> list[DataFrame]:
    """Weighted split (train, validation, test).

    A row's place is the first 32 bits of the md5 of seed, user and item: the same rows on every
    run, layout and engine, in one narrow pass.  Digests of lower-case hex digits stand in
    the order of the numbers, so they are compared as they are, once for each end that is not the first or last."""
    place = split_place(seed)
    ends, total, out, low = [], float(sum(weights)), [], 0
    for w in weights:
        ends.append(round((sum(weights[:len(ends)]) + w) / total * 2 ** 32))
    for high in ends:
        rows = ratings if low <= 0 else ratings.where(place >= f"{low:08x}" if low < 2 ** 32 else F.lit(False))
        out.append(rows if high >= 2 ** 32 else rows.where(place < f"{max(0, high):08x}"))
        low = high
    return out


def split_place(seed: int):
    """md5('seed:user:item') in hex digits."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("user").cast("string"), F.col("item").cast("string")))


def rmse_of(rows: DataFrame, pred_col: str = "prediction", actual_col: str = "rating") -> DataFrame:
    """R5 where one row holds both numbers: no join."""
    return rows.agg(F.sqrt(F.avg(F.pow(F.col(pred_col) - F.col(actual_col), 2))).alias("rmse"))


def rmse(predicted: DataFrame, actual: DataFrame, pred_col: str = "prediction",
         actual_col: str = "rating") -> DataFrame:
    """sqrt(mean((p − r)²)) over (user, item) pairs present in both."""
    p = predicted.select("user", "item", F.col(pred_col).alias("_p"))
    a = actual.select("user", "item", F.col(actual_col).alias("_a"))
    return rmse_of(p.join(a, ["user", "item"]), "_p", "_a")


INT_MAX = 2 ** 31 - 1


class Recommender:
    """A fitted ALS model for 64-bit ids.  ALS itself wants 32-bit numbers: ids
    beyond them are numbered densely, by one small table for users and one for
    items; ids within them are used as they are."""

    def __init__(self, model: ALSModel, users: DataFrame | None, items: DataFrame | None, reg: float = ALS_REG):
        self.model, self.users, self.items, self.reg = model, users, items, reg

    def user_factors(self) -> DataFrame:
        """(user, factors) under the ids of the ratings."""
        return self._named(self.model.userFactors, self.users, "user")

    def item_factors(self) -> DataFrame:
        """(item, factors) under the ids of the ratings."""
        return self._named(self.model.itemFactors, self.items, "item")

    @staticmethod
    def _named(factors: DataFrame, table: DataFrame | None, col: str) -> DataFrame:
        if table is None:
            return factors.select(F.col("id").cast("bigint").alias(col), F.col("features").alias("factors"))
        names = table.select(F.col("id").alias(col), F.col("number").alias("id"))
        return factors.join(names, "id").select(col, F.col("features").alias("factors"))


def _numbered(ratings: DataFrame, col: str, span) -> DataFrame | None:
    """(id, number) of a column, or None where its ids, from ``lo_`` to ``hi_``, are
    32-bit numbers."""
    from tessera.operators.relational import number_rows
    low, high = span[f"lo_{col}"], span[f"hi_{col}"]
    if low is None or -INT_MAX <= low and high <= INT_MAX:
        return None
    numbered = number_rows(ratings.select(F.col(col).alias("id")).distinct(), "id")
    return reliable_checkpoint(numbered.select("id", F.col("_rn").cast("int").alias("number")))


def _as_numbers(rows: DataFrame, users: DataFrame | None, items: DataFrame | None) -> DataFrame:
    for col, table in (("user", users), ("item", items)):
        if table is None:
            rows = rows.withColumn(f"als_{col}", F.col(col).cast("int"))
        else:
            rows = rows.join(table.select(F.col("id").alias(col), F.col("number").alias(f"als_{col}")), col)
    return rows


ROWS_PER_BLOCK = 4_000_000


def als_blocks(spark, n: int, rows_per_block: int = ROWS_PER_BLOCK) -> int:
    """Blocks of the factor tables: enough for every core, and for the ratings.  A factor
    is sent to each block that holds one of its ratings, so few large blocks shuffle less;
    4 million ratings and the factors they need stay below some 400 MB."""
    return max(10, spark.sparkContext.defaultParallelism, -(-n // rows_per_block))


def train_als(train: DataFrame, rank: int, iterations: int = ALS_ITERATIONS,
              reg: float = ALS_REG, seed: int = ALS_SEED) -> Recommender:
    """Fit an explicit-feedback ALS model."""
    return _fit(*_prepared(train), rank, iterations, reg, seed)


def _prepared(train: DataFrame) -> tuple:
    """The ratings under 32-bit numbers, the numbering, and the blocks of the factor
    tables: one look at the ratings serves every model trained on them."""
    ends = [f(c).alias(f"{n}_{c}") for c in ("user", "item") for n, f in (("lo", F.min), ("hi", F.max))]
    span = train.agg(F.count(F.lit(1)).alias("n"), *ends).first()
    users, items = _numbered(train, "user", span), _numbered(train, "item", span)
    return _as_numbers(train, users, items), users, items, als_blocks(train.sparkSession, span["n"])


def _fit(rows: DataFrame, users: DataFrame | None, items: DataFrame | None, blocks: int, rank: int,
         iterations: int = ALS_ITERATIONS, reg: float = ALS_REG, seed: int = ALS_SEED) -> Recommender:
    """Item factors are checkpointed in each iteration, by which ALS removes the shuffles
    behind them; else those of all iterations stay on disk until the model is trained."""
    als = ALS(rank=rank, maxIter=iterations, regParam=reg, seed=seed, userCol="als_user",
              itemCol="als_item", ratingCol="rating", coldStartStrategy="drop",
              numUserBlocks=blocks, numItemBlocks=blocks, checkpointInterval=1)
    model = als.fit(rows)
    release(rows.sparkSession)
    return Recommender(model, users, items, reg)


def predict(model: Recommender, pairs: DataFrame) -> DataFrame:
    """The rows of ``pairs`` with a prediction; cold-start pairs dropped."""
    rows = _as_numbers(pairs, model.users, model.items)
    return model.model.transform(rows).drop("als_user", "als_item")


def rank_search(train: DataFrame, validation: DataFrame, ranks=ALS_RANKS,
                parallelism: int | None = None) -> tuple[DataFrame, dict[int, Recommender]]:
    """One model per rank and its validation RMSE, as (rank, rmse).

    The fits are independent Spark jobs, so they are submitted from up to
    ``parallelism`` driver threads at once (as Spark ML's tuning classes do);
    each fit is still seeded and distributed."""
    from concurrent.futures import ThreadPoolExecutor
    ranks, prepared = list(ranks), _prepared(train)
    with ThreadPoolExecutor(max_workers=parallelism or len(ranks)) as pool:
        models = dict(zip(ranks, pool.map(lambda r: _fit(*prepared, r), ranks)))
    rows = None
    for r in ranks:
        e = rmse_of(predict(models[r], validation)).select(
            F.lit(r).alias("rank"), "rmse")
        rows = e if rows is None else rows.unionByName(e)
    return rows, models


def mean_baseline_rmse(train: DataFrame, test: DataFrame) -> DataFrame:
    """RMSE of predicting the training mean for every test pair; the
    mean is a one-row aggregate joined as a broadcast."""
    mean = train.agg(F.avg("rating").alias("train_mean")).withColumn("_k", F.lit(1))
    return (test.withColumn("_k", F.lit(1)).join(F.broadcast(mean), "_k")
            .agg(F.max("train_mean").alias("train_mean"),
                 F.sqrt(F.avg(F.pow(F.col("train_mean") - F.col("rating"), 2))).alias("rmse")))


NEW_USER_SCHEMA = T.StructType([T.StructField("item", T.LongType(), False),
                                T.StructField("rating", T.DoubleType(), False)])


def new_user_ratings(ratings: DataFrame, picks: DataFrame) -> DataFrame:
    """The picked (item, rating) rows under a fresh user id, one above
    the largest id in ``ratings`` (a one-row aggregate, broadcast)."""
    uid = ratings.agg((F.max("user") + 1).alias("user")).withColumn("_k", F.lit(1))
    return (picks.withColumn("_k", F.lit(1)).join(F.broadcast(uid), "_k")
            .select("user", F.col("item").cast("bigint").alias("item"),
                    F.col("rating").cast("double").alias("rating")))


_DEALT = 64


def unrated_pairs(users: DataFrame, items: DataFrame, ratings: DataFrame,
                  max_bytes: int | None = None) -> DataFrame:
    """J5 on stored ratings: (user, item) of every item that each of ``users`` (a
    few, such as those to recommend to now) has not rated: each user's missing
    items by one left anti join on (user, item).

    Items are dealt over ``_DEALT`` keys and each user asked for stands under every
    key, so the pairs come from an equi-join, by broadcast where the users are measured
    to be few and by a shuffle that no key dominates otherwise."""
    asked = users.select("user").distinct().select(
        "user", F.explode(F.sequence(F.lit(0), F.lit(_DEALT - 1))).alias("_deal"))
    dealt = items.select("item").distinct().withColumn("_deal", F.pmod(F.xxhash64("item"), F.lit(_DEALT)).cast("int"))
    return (dealt.join(broadcast_if_small(asked, max_bytes), "_deal").select("user", "item")
            .join(ratings.select("user", "item"), ["user", "item"], "left_anti"))


def unrated_items(items: DataFrame, user_ratings: DataFrame) -> DataFrame:
    """J5 for one user: items the user has not rated (left anti join)."""
    return items.select("item").distinct().join(user_ratings.select("item"), "item",
                                                "left_anti")


def normal_residuals(model: Recommender, train: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """(user, n_ratings, residual) of every trained user: how far its factors are
    from solving the equations that define them.

    Training solves the users last, from the final item factors, so for a user with
    n ratings (Σ v·vᵀ + λ·n·I)·u = Σ r·v over the items rated.  The difference of
    both sides is Σ v·(v·u − r) + λ·n·u, one sum for each rank: a plain aggregate by user,
    combined before its shuffle.  ``residual`` is its length over that of the terms
    summed, Σ |r|·|v| + λ·n·|u|, so single-precision factors give some 1e-7."""
    items, users = model.item_factors(), model.user_factors()
    rank = model.model.rank
    v, u = (lambda c: [F.col(c)[k].cast("double") for k in range(rank)])("v"), [F.col("u")[k].cast("double") for k in range(rank)]
    dot = sum((a * b for a, b in zip(v, u)), F.lit(0.0))
    length = lambda xs: F.sqrt(sum((x * x for x in xs), F.lit(0.0)))
    rows = (train.select("user", "item", "rating")
            .join(broadcast_if_small(items.withColumnRenamed("factors", "v"), max_bytes), "item")
            .join(users.withColumnRenamed("factors", "u"), "user")
            .withColumn("off", dot - F.col("rating")))
    sums = rows.groupBy("user").agg(
        F.count(F.lit(1)).alias("n_ratings"), F.first("u").alias("u"),
        *[F.sum(x * F.col("off")).alias(f"s{k}") for k, x in enumerate(v)],
        F.sum(F.abs("rating") * length(v)).alias("size"))
    pull = model.reg * F.col("n_ratings")
    left = [F.col(f"s{k}") + pull * x for k, x in enumerate(u)]
    return sums.select("user", "n_ratings", F.try_divide(length(left), F.col("size") + pull * length(u)).alias("residual"))


def residual_report(model: Recommender, train: DataFrame, tolerance: float = 1e-5) -> DataFrame:
    """One row: trained users, and how many miss the tolerance."""
    off = F.coalesce(F.col("residual") > tolerance, F.lit(False)) | F.isnan("residual")
    return normal_residuals(model, train).agg(
        F.count(F.lit(1)).alias("n_users"), F.coalesce(F.sum(off.cast("bigint")), F.lit(0)).cast("bigint").alias("n_off"))


BLOCK_BYTES = 64 << 20


def item_blocks(items: DataFrame, rank: int, block_bytes: int = BLOCK_BYTES):
    """The item factors cut into blocks of at most about ``block_bytes``, each (sorted
    ids, matrix): what one broadcast holds, whatever the catalogue's size."""
    import numpy as np
    n = items.count()
    cuts = max(1, -(-n * (8 + 4 * rank) // block_bytes))
    block = F.pmod(F.xxhash64("item"), F.lit(cuts))
    for b in range(cuts if n else 0):
        part = (items if cuts == 1 else items.where(block == b)).toArrow().sort_by("item")
        if part.num_rows:
            yield (part.column("item").to_numpy(),
                   np.asarray(part.column("factors").combine_chunks().flatten(), np.float32).reshape(part.num_rows, rank))


def by_direction(users: DataFrame, rank: int) -> DataFrame:
    """``users`` with the cell of their factors' direction: one bit for each of up to ten
    coordinates, whether it is above the median."""
    length = F.sqrt(sum((F.col("factors")[k].cast("double") * F.col("factors")[k] for k in range(rank)), F.lit(0.0)))
    turns = [F.try_divide(F.col("factors")[k].cast("double"), length) for k in range(min(rank, 10))]
    middles = users.agg(*[F.percentile_approx(t, 0.5).alias(f"m{k}") for k, t in enumerate(turns)]).first()
    bits = [F.when(t > F.lit(m).cast("double"), 1 << k).otherwise(0) for k, (t, m) in enumerate(zip(turns, middles))]
    return users.withColumn("cell", sum(bits, F.lit(0)))


def top_places():
    """A function of scores, in order of their ids, and a number: the places of that many best
    scores, ties by id.  (Made here, so that it travels to executors by value.)

    The last of that many best of some scores, every k-th, is at most the last of the best of all,
    so only scores from it on are compared further: one look at most of them, whatever they are."""
    def top(scores, most):
        import numpy as np
        if most >= len(scores):
            return np.argsort(-scores, kind="stable")
        least = lambda of: -np.partition(-of, most - 1)[most - 1]
        near, some = np.arange(len(scores)), scores[::int((len(scores) / most) ** 0.5)]
        if most < len(some) < len(scores):
            near = np.flatnonzero(scores >= least(some))
        near = near[scores[near] >= least(scores[near])] if len(near) > most else near
        return near[np.argsort(-scores[near], kind="stable")][:most]

    return top


RATED_HELD = 1 << 22   # rated items of the users that a task searches for together


def recommend_users(model: Recommender, ratings: DataFrame, n: int, users: DataFrame | None = None,
                    items: DataFrame | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """R13/R14 for many users: (user, item, prediction, place) of the ``n`` best items
    that each user (of ``users``, or every trained one) has not rated, among
    ``items`` or all trained ones; ties by item.

    Item factors are broadcast block by block.  Users, each with the list of what they have rated, are
    dealt over all cores once, those of like directions together: a task then proves for
    most items that they are none of the best of some users (``bestscores``) and multiplies the others with their factors,
    in products of at most 4 MB (or one user's).  Of each user n items leave the task,
    with what is rated left out; only if there is more than one block are the blocks' lists merged
    by a bounded window for each user.  So there is no row for each user and item."""
    import pyarrow as pa
    from tessera.operators.bestscores import CHUNK, best_unrated
    kept = model.item_factors()
    if items is not None:
        kept = kept.join(items.select("item").distinct(), "item", "leftsemi")
    kept = reliable_checkpoint(kept)
    rated = ratings.select("user", "item")
    if items is not None:  # of what is rated, only these items could be found
        rated = rated.join(broadcast_stored(kept.select("item")), "item", "leftsemi")
    lists = rated.groupBy("user").agg(F.collect_list("item").alias("rated"))
    rank, spark, held_rows, held_rated = model.model.rank, ratings.sparkSession, CHUNK, RATED_HELD
    asked = by_direction(model.user_factors(), rank)
    if users is not None:
        asked = asked.join(users.select("user").distinct(), "user", "leftsemi")
    # the work on a user grows with the items, not with the user's few bytes: dealt over all cores
    asked = reliable_checkpoint(asked.join(lists, "user", "left").select(
        "user", "factors", F.coalesce("rated", F.array().cast("array<bigint>")).alias("rated"), "cell")
        .repartitionByRange(4 * spark.sparkContext.defaultParallelism, "cell", "user")
        .sortWithinPartitions("cell", "user").drop("cell"))
    search = best_unrated(top_places())
    schema = "user long, item long, prediction float, place int"
    found = []
    for block in item_blocks(kept, rank, block_bytes):
        shared = spark.sparkContext.broadcast(block)

        def best(batches, shared=shared):
            import numpy as np
            ids, matrix = shared.value
            best_of = search(matrix)

            def of(held):
                table = pa.Table.from_batches(held)
                users, (factors, rated) = table.column(0).to_numpy(), (table.column(k).combine_chunks() for k in (1, 2))
                factors = np.asarray(factors.flatten(), np.float32).reshape(len(users), rank)
                owners = np.repeat(np.arange(len(users)), rated.value_lengths().to_numpy())
                items = rated.flatten().to_numpy()
                places = np.minimum(np.searchsorted(ids, items), len(ids) - 1)
                known = ids[places] == items
                rated = np.unique(owners[known] * len(ids) + places[known])
                made, rows = [], 0

                def batch():
                    who, what, scores, ranks = (np.concatenate(x) for x in zip(*made))
                    return pa.RecordBatch.from_arrays(
                        [pa.array(users[who]), pa.array(ids[what]), pa.array(scores), pa.array(ranks.astype(np.int32))],
                        ["user", "item", "prediction", "place"])

                for some in best_of(factors, n, rated):
                    made.append(some)
                    rows += len(some[0])
                    if rows >= 1 << 16:
                        yield batch()
                        made, rows = [], 0
                if made:
                    yield batch()

            held, rows, values = [], 0, 0
            for part in batches:
                held.append(part)
                rows, values = rows + part.num_rows, values + len(part.column(2).flatten())
                if rows >= held_rows or values >= held_rated:
                    yield from of(held)
                    held, rows, values = [], 0, 0
            if rows:
                yield from of(held)

        found.append(asked.mapInArrow(best, schema))
    if len(found) < 2:
        return found[0] if found else spark.createDataFrame([], schema)
    lists = found[0]
    for more in found[1:]:
        lists = lists.unionByName(more)
    place = F.row_number().over(Window.partitionBy("user").orderBy(F.desc("prediction"), "item"))
    return lists.withColumn("place", place).where(F.col("place") <= n)


def recommend_top_n(predictions: DataFrame, ratings: DataFrame, titles: DataFrame,
                    min_ratings: int = 75, n: int = 20) -> DataFrame:
    """The n best predictions among items with more than
    ``min_ratings`` ratings, with title and rating count; ties by item."""
    counts = ratings.groupBy("item").agg(F.count(F.lit(1)).alias("n_ratings"))
    return (predictions.join(counts, "item").join(titles, "item")
            .where(F.col("n_ratings") > min_ratings)
            .orderBy(F.desc("prediction"), F.asc("item")).limit(n)
            .select("prediction", "title", "n_ratings", "item"))
