"""Properties of the trained and random rating queries (no exact oracle)."""

import hashlib
import math

import numpy as np
import pytest

from pyspark.sql import functions as F

import __spark_entry__ as se
from tessera.operators import ratings as R
from tessera.operators.bestscores import best_unrated
from tessera.plans import params as K
from tessera.sources.views import ratings

from conftest import SF_SMALL


def test_rank_search_rows(spark):
    rows = se.queries()["als_rank_search"](spark, SF_SMALL).collect()
    assert sorted(r["rank"] for r in rows) == list(R.ALS_RANKS)
    assert all(math.isfinite(r["rmse"]) and r["rmse"] >= 0 for r in rows)


def test_als_repeatable_with_seed(spark):
    rt = ratings(spark, SF_SMALL).cache()
    a = R.predict(R.train_als(rt, 4), rt).select("user", "item", "prediction")
    b = R.predict(R.train_als(rt, 4), rt).select("user", "item", "prediction")
    pa = {(r[0], r[1]): r[2] for r in a.collect()}
    pb = {(r[0], r[1]): r[2] for r in b.collect()}
    assert pa.keys() == pb.keys()
    assert max(abs(pa[k] - pb[k]) for k in pa) < 1e-6


def test_recommendations_exclude_rated(spark):
    recs = se.queries()["recommend_unrated"](spark, SF_SMALL).collect()
    picked = {i for i, _ in K.NEW_USER_PICKS}
    assert recs and not ({r["item"] for r in recs} & picked)
    assert len({r["user"] for r in recs}) == 1


def test_recommend_top_n_floor(spark):
    top = se.queries()["recommend_top_n"](spark, SF_SMALL).collect()
    assert len(top) <= K.RECOMMEND_N
    assert all(r["n_ratings"] > K.RECOMMEND_MIN_RATINGS for r in top)
    preds = [r["prediction"] for r in top]
    assert preds == sorted(preds, reverse=True)


def test_mean_baseline(spark):
    row = se.queries()["mean_baseline_rmse"](spark, SF_SMALL).first()
    train, _, test = R.split_ratings(ratings(spark, SF_SMALL))
    assert 1.0 <= row["train_mean"] <= 5.0 and row["rmse"] >= 0
    n_test = test.count()
    assert n_test > 0 and train.count() > n_test


def test_split_sizes_add_up(spark):
    rows = {r["split"]: r["n"] for r in se.queries()["split_train_test"](spark, SF_SMALL).collect()}
    assert sum(rows.values()) == ratings(spark, SF_SMALL).count()
    assert rows["train"] > rows["validation"] > 0 and rows["test"] > 0


def test_ids_beyond_32_bits(spark):
    rt = ratings(spark, SF_SMALL).cache()
    big = rt.select((F.col("user") + 3_000_000_000).alias("user"), (F.col("item") * -4_000_000_000).alias("item"), "rating")
    got = R.predict(R.train_als(big, 4, iterations=1), big)
    assert got.count() == rt.count() and set(got.columns) == {"user", "item", "rating", "prediction"}
    unknown = spark.createDataFrame([(1, 1)], "user long, item long")
    assert R.predict(R.train_als(big, 4, iterations=1), unknown).count() == 0


def test_unrated_pairs_brute_force(spark):
    rt = ratings(spark, SF_SMALL).limit(300).cache()
    items, users = rt.select("item").distinct(), rt.select("user").distinct().orderBy("user").limit(3)
    rated = {(r["user"], r["item"]) for r in rt.collect()}
    want = {(u["user"], i["item"]) for u in users.collect() for i in items.collect()} - rated
    got = [(r["user"], r["item"]) for r in R.unrated_pairs(users, items, rt).collect()]
    assert len(got) == len(want) and set(got) == want


def _factors(df, col):
    return {r[col]: np.array(r["factors"], float) for r in df.collect()}


def test_normal_residuals_against_solving(spark):
    rt = ratings(spark, SF_SMALL).limit(2_000).cache()
    model = R.train_als(rt, 4)
    u, v = _factors(model.user_factors(), "user"), _factors(model.item_factors(), "item")
    by_user = {}
    for r in rt.collect():
        by_user.setdefault(r["user"], []).append((v[r["item"]], r["rating"]))
    for bound in (None, 0):  # item factors by broadcast, and by a shuffle join
        got = {r["user"]: r for r in R.normal_residuals(model, rt, max_bytes=bound).collect()}
        assert got.keys() == by_user.keys() == u.keys()
        for user, rows in by_user.items():
            a = sum(np.outer(x, x) for x, _ in rows) + R.ALS_REG * len(rows) * np.eye(4)
            assert np.allclose(np.linalg.solve(a, sum(x * y for x, y in rows)), u[user], rtol=1e-3, atol=1e-4)
            assert got[user]["n_ratings"] == len(rows) and got[user]["residual"] < 1e-5
    report = R.residual_report(model, rt).first()
    assert tuple(report) == (len(u), 0)
    model.reg = 0.2  # not what it was trained with
    assert R.residual_report(model, rt).first()["n_off"] > 0.9 * len(u)
    model.reg = R.ALS_REG
    assert R.residual_report(model, rt.withColumn("rating", F.col("rating") + 0.01)).first()["n_off"] > 0.9 * len(u)


@pytest.mark.parametrize("block_bytes", [R.BLOCK_BYTES, 700])
def test_recommendations_for_many_users(spark, block_bytes):
    rt = ratings(spark, SF_SMALL).limit(3_000).cache()
    hot = rt.select("item").distinct().selectExpr("77777 AS user", "item", "3.0 AS rating").where("item % 3 > 0")
    rt = rt.unionByName(hot).cache()   # one user has rated most items
    model = R.train_als(rt, 4, iterations=2)
    u, v = _factors(model.user_factors(), "user"), _factors(model.item_factors(), "item")
    rated = {(r["user"], r["item"]) for r in rt.collect()}
    for items in (None, set(sorted(v)[::3])):
        some = None if items is None else spark.createDataFrame([(i,) for i in items], "item long")
        got = {}
        found = R.recommend_users(model, rt, 7, items=some, block_bytes=block_bytes)
        for r in found.collect():
            got.setdefault(r["user"], []).append((r["place"], r["item"], r["prediction"]))
        for user, x in u.items():
            free = [i for i in v if (user, i) not in rated and (items is None or i in items)]
            mine = sorted(got.get(user, []))
            assert [p for p, _, _ in mine] == list(range(1, min(7, len(free)) + 1))
            assert all(i in free and abs(p - x @ v[i]) < 1e-5 for _, i, p in mine)
            best = sorted((-(x @ v[i]) for i in free))[:7]
            assert np.allclose([-p for _, _, p in mine], best, atol=1e-5)
        assert set(got) <= set(u)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    few = R.recommend_users(model, rt, 2, users=spark.createDataFrame([(77777,), (-1,)], "user long"))
    assert {r["user"] for r in few.collect()} == {77777}


def test_ties_and_exact_ends_of_the_bounded_list():
    ids = np.array([2, 3, 5, 8, 9])
    scores = np.array([1, 4, 4, 4, 0], np.float32)
    assert [ids[R.top_places()(scores, m)].tolist() for m in (1, 2, 3, 4, 9)] == [
        [3], [3, 5], [3, 5, 8], [3, 5, 8, 2], [3, 5, 8, 2, 9]]


def test_the_best_of_many_scores_are_found_from_a_few(monkeypatch):
    rng = np.random.default_rng(3)
    sizes, partition = [], np.partition
    monkeypatch.setattr(np, "partition", lambda a, k: sizes.append(len(a)) or partition(a, k))
    for scores in (rng.normal(size=50_000), np.arange(50_000.0), -np.arange(50_000.0), rng.integers(0, 9, 50_000) * 1.0,
                   np.zeros(50_000), np.where(np.arange(50_000) % 28, 1.0, 0.0)):
        scores = scores.astype(np.float32)
        for most in (1, 60, 20_000, 49_999, 50_000):
            want = np.argsort(-scores, kind="stable")[:most]
            assert R.top_places()(scores, most).tolist() == want.tolist()
    sizes.clear()
    R.top_places()(rng.normal(size=200_000).astype(np.float32), 60)
    assert sum(sizes) < 20_000  # of 200,000


def test_users_are_dealt_over_all_cores(spark, monkeypatch):
    rt = ratings(spark, SF_SMALL).limit(2_000).cache()
    model, parts = R.train_als(rt, 2, iterations=1), []
    keep = R.reliable_checkpoint
    monkeypatch.setattr(R, "reliable_checkpoint", lambda df: parts.append((df.columns, keep(df))) or parts[-1][1])
    R.recommend_users(model, rt, 3)
    assert [df.rdd.getNumPartitions() for c, df in parts if c[0] == "user"] == [4 * spark.sparkContext.defaultParallelism]


def test_factors_under_large_ids(spark):
    rt = ratings(spark, SF_SMALL).limit(500).cache()
    big = rt.select((F.col("user") + 3_000_000_000).alias("user"), "item", "rating").cache()
    model = R.train_als(big, 3, iterations=2)
    assert {r["user"] for r in model.user_factors().collect()} == {r["user"] for r in big.collect()}
    assert R.residual_report(model, big).first()["n_off"] == 0
    assert min(r["user"] for r in R.recommend_users(model, big, 1).collect()) >= 3_000_000_000


def test_training_drops_each_iterations_shuffles(spark, monkeypatch):
    made = []
    als = R.ALS
    monkeypatch.setattr(R, "ALS", lambda **k: made.append(k) or als(**k))
    rows = spark.createDataFrame([(u, i, float(1 + (u * i) % 5)) for u in range(30) for i in range(12) if (u + i) % 3],
                                 "user long, item long, rating double")
    model = R.train_als(rows, 2)
    assert made[0]["checkpointInterval"] == 1  # ALS then removes an iteration's shuffles with its checkpoint
    few = R.als_blocks(spark, 21_600_000)
    assert few == max(10, spark.sparkContext.defaultParallelism)
    assert R.residual_report(model, rows).collect()[0].n_off == 0


def _best(factors, matrix, n, rated=(), **sizes):
    """What ``best_unrated`` finds, by user: items, scores, and the numbers of products made at once."""
    made, flat = [], np.flatnonzero
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(np, "flatnonzero", lambda a: made.append(np.size(a) if np.ndim(a) == 2 else 0) or flat(a))
        parts = list(best_unrated(R.top_places(), **sizes)(matrix)(factors, n, np.array(sorted(rated), np.int64)))
    got = {}
    for users, items, scores, places in parts:
        for user, item, score, place in zip(users, items, scores, places):
            got.setdefault(user, []).append((place, item, score))
    assert all([p for p, _, _ in sorted(rows)] == list(range(1, len(rows) + 1)) for rows in got.values())
    return {user: ([i for _, i, _ in sorted(rows)], [s for _, _, s in sorted(rows)]) for user, rows in got.items()}, made


@pytest.mark.parametrize("kind", ["round", "one way", "copies", "equal", "few items", "wide"])
def test_the_best_unrated_are_found_without_most_products(kind):
    rng = np.random.default_rng(7)
    matrix = rng.normal(size=(90 if kind == "few items" else 12_000, 4)).astype(np.float32)
    factors = rng.normal(size=(1_500, 4)).astype(np.float32)
    if kind == "one way":
        matrix, factors = np.abs(matrix) + 1, np.abs(factors) + 5
    if kind == "copies":
        matrix = matrix[np.arange(12_000) // 3]
    if kind == "equal":
        matrix, factors = np.repeat(matrix[:1], 600, 0), factors[:70]
    if kind == "wide":
        matrix[::1000] *= 100
    factors[5], factors[6] = 0, 1e-20
    size = len(matrix)
    rated = {int(u * size + i) for u in range(len(factors)) for i in rng.integers(0, size, 9)}
    best = np.argsort(-(factors[9] @ matrix.T), kind="stable")
    rated |= {int(9 * size + i) for i in best[:size * 2 // 3]}          # one user has rated most items, the best of them
    rated |= {int(11 * size + i) for i in range(size)}                  # and one all
    got, made = _best(factors, matrix, 7, rated)
    assert 11 not in got and len(got) == len(factors) - 1
    scores = factors @ matrix.T
    for pair in rated:
        scores[pair // size, pair % size] = -np.inf
    for user, (items, found) in got.items():
        assert len(items) == len(set(items)) == 7 and np.isfinite(scores[user, items]).all()
        assert np.allclose(found, np.sort(scores[user])[::-1][:7], rtol=1e-4, atol=1e-5)
        assert np.allclose(found, scores[user, items], rtol=1e-4, atol=1e-5)
    assert got[5][0] == np.flatnonzero(np.isfinite(scores[5]))[:7].tolist()  # all at 0: ties by item
    if kind in ("round", "one way", "copies", "wide"):
        assert 0 < sum(made) < len(factors) * size // 2
        assert _best(factors, matrix, 7, rated, product=5_000)[0].keys() == got.keys()
    if kind == "round":
        assert max(_best(factors, matrix, 7, rated, product=5_000)[1]) <= size  # one user's, where 5,000 are fewer


def test_what_is_rated_is_left_out_where_products_are_made(spark):
    rt = ratings(spark, SF_SMALL).limit(2_000).cache()
    model = R.train_als(rt, 3, iterations=1)
    found = R.recommend_users(model, rt.unionByName(rt), 4)  # rated twice counts once
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and "Window" not in plan
    rows = found.collect()
    assert rows and not {(r["user"], r["item"]) for r in rows} & {(r["user"], r["item"]) for r in rt.collect()}
    assert [f.name for f in found.schema] == ["user", "item", "prediction", "place"]


def test_splits_are_the_numbers_of_the_digests(spark):
    rows = spark.range(3_000).selectExpr("id % 61 AS user", "id AS item", "1.0 AS rating").cache()

    def number(r):
        return int(hashlib.md5(f"0:{r['user']}:{r['item']}".encode()).hexdigest()[:8], 16)

    for weights in ((6.0, 2.0, 2.0), (1.0, 0.0), (0.0, 1.0), (1.0,)):
        parts, low = R.split_ratings(rows, weights), 0
        for k, part in enumerate(parts):
            high = round(sum(weights[:k + 1]) / sum(weights) * 2 ** 32)
            assert {r["item"] for r in part.collect()} == {r["item"] for r in rows.collect() if low <= number(r) < high}
            low = high
        assert "conv(" not in parts[0]._jdf.queryExecution().optimizedPlan().toString()
