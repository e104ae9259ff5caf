"""Properties of the random and scale-oriented operators, and brute-force
checks of the operators that avoid quadratic work."""

from pyspark.sql import functions as F

from tessera.operators import ratings as R
from tessera.operators import relational as P
from tessera.operators import resolution as ER
from tessera.operators import text as E
from tessera.operators.resolution import containment_pairs
from tessera.sources.tables import load_table

from conftest import SF_SMALL


def test_split_disjoint_and_complete(spark):
    df = spark.range(0, 5000).selectExpr("id as k", "id % 70 as user", "id as item")
    parts = R.split_ratings(df)
    sizes = [p.count() for p in parts]
    assert sum(sizes) == 5000
    ids = [set(r["k"] for r in p.collect()) for p in parts]
    assert not (ids[0] & ids[1]) and not (ids[0] & ids[2]) and not (ids[1] & ids[2])
    again = [p.count() for p in R.split_ratings(df.repartition(7))]
    assert again == sizes and abs(sizes[0] - 3000) < 150 and abs(sizes[1] - 1000) < 120


def test_sample_exact_size_and_seeded(spark):
    df = load_table(spark, SF_SMALL, "events", ["event_id", "event_type"])
    for repl in (False, True):
        a = P.sample_rows(df, 37, repl, 7, "event_id")
        rows_a = sorted(r["event_id"] for r in a.collect())
        rows_b = sorted(r["event_id"] for r in P.sample_rows(df, 37, repl, 7, "event_id").collect())
        assert len(rows_a) == 37
        assert rows_a == rows_b
    assert P.sample_rows(df, 10**6, False, 1, "event_id").count() == df.count()


def test_number_rows_dense(spark):
    df = spark.range(0, 3000, 1, 7).withColumn("k", (F.col("id") * 7919) % 3001)
    got = sorted(r["_rn"] for r in P.number_rows(df, "k").collect())
    assert got == list(range(1, 3001))


def _unit_vectors(w):
    vec = {}
    for r in E.unit_weights(w).collect():
        vec.setdefault((r["side"], r["id"]), {})[r["token"]] = r["u"]
    return vec


def _dot(a, b):
    return sum(u * b[t] for t, u in a.items() if t in b)


def test_similarity_join_is_exact(spark):
    b = load_table(spark, SF_SMALL, "benchmark", ["item_id", "text"])
    d = load_table(spark, SF_SMALL, "documents", ["doc_id", "text"])
    w = E.text_weights(b, "item_id", d, "doc_id")
    vec = _unit_vectors(w)
    left, right = ({i: v for (s, i), v in vec.items() if s == side} for side in "LR")
    for t in (0.05, 0.3, 0.0):
        got = {(r["left_id"], r["right_id"]): r["cosine"] for r in E.cosine_inverted(w, t).collect()}
        want = {(i, j): c for i, a in left.items() for j, x in right.items()
                if set(a) & set(x) and (c := _dot(a, x)) >= t}
        assert {k for k in got} == {k for k in want if want[k] >= t}
        assert all(abs(got[k] - want[k]) < 1e-9 for k in got) and got


def test_gold_evaluation_by_definition(spark):
    b = load_table(spark, SF_SMALL, "benchmark", ["item_id", "text"])
    d = load_table(spark, SF_SMALL, "documents", ["doc_id", "text"])
    w = E.text_weights(b, "item_id", d, "doc_id")
    vec = _unit_vectors(w)
    items, docs = ([r[0] for r in x.select(c).collect()] for x, c in ((b, "item_id"), (d, "doc_id")))
    scores = {(i, j): _dot(vec.get(("L", i), {}), vec.get(("R", j), {})) for i in items for j in docs}
    pairs = [(items[0], docs[0]), (items[1], docs[5]), (items[2], docs[9]), (items[3], docs[40])]
    gold = spark.createDataFrame(pairs, "left_id long, right_id long")
    n = [x.agg(F.count(F.lit(1)).alias("n")) for x in (b, d)]
    row = ER.gold_evaluation(E.unit_weights(w), gold, *n).first()
    own = [scores.pop(p) for p in pairs]
    assert row["true_dups"] == 4 and abs(row["avg_sim_dups"] - sum(own) / 4) < 1e-12
    assert abs(row["avg_sim_non_dups"] - sum(scores.values()) / len(scores)) < 1e-12


def test_containment_pairs_brute_force(spark):
    left = spark.createDataFrame(
        [(1, "quick brown fox"), (2, "fox"), (3, "n fox"), (4, "zzz qqq www"), (5, ".brown f"), (7, "ox"), (8, "a"), (9, "own fo"), (12, "!"),
         (6, "")],
        "item_id long, text string")
    right = spark.createDataFrame(
        [(10, "The quick brown fox jumps"), (11, "a fox!"), (12, "brown fox"), (13, "nothing")],
        "doc_id long, text string")
    lrows, rrows = left.collect(), right.collect()
    want = sorted((a["item_id"], b["doc_id"]) for a in lrows for b in rrows
                  if a["text"] in b["text"])
    for bound in (1 << 20, 0):          # broadcast path and shuffle-join path
        found = containment_pairs(left, "item_id", right, "doc_id", max_bytes=bound)
        assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
        got = sorted(tuple(r) for r in found.collect())
        assert got == want


def test_gold_pairs_match_brute_force(spark):
    from tessera.sources.views import gold_pairs
    b = load_table(spark, SF_SMALL, "benchmark", ["item_id", "text"]).collect()
    d = load_table(spark, SF_SMALL, "documents", ["doc_id", "text"]).collect()
    want = sorted((x["item_id"], y["doc_id"]) for x in b for y in d if x["text"] in y["text"])
    got = sorted(tuple(r) for r in gold_pairs(spark, SF_SMALL).collect())
    assert got == want


def test_tfidf_split_join_matches_broadcast(spark):
    b = load_table(spark, SF_SMALL, "benchmark", ["item_id", "text"])
    d = load_table(spark, SF_SMALL, "documents", ["doc_id", "text"])
    toks = E.doc_tokens(E.corpus(b, "item_id", d, "doc_id"))

    def rows(df):
        return sorted((r["side"], r["id"], r["token"], round(r["w"], 9), r["n_docs"])
                      for r in df.collect())
    small = rows(E.tfidf(toks))                             # IDF broadcast whole
    split = rows(E.tfidf(toks, max_bytes=50 * 128))     # hot tokens broadcast, rest shuffled
    assert small == split and len(small) > 0


def test_gold_paths_agree_on_data(spark):
    from tessera.sources.views import gold_pairs
    b = load_table(spark, SF_SMALL, "benchmark", ["item_id", "text"])
    d = load_table(spark, SF_SMALL, "documents", ["doc_id", "text"])
    sims = E.cosine_inverted(E.text_weights(b, "item_id", d, "doc_id"), 0.02)
    gold = gold_pairs(spark, SF_SMALL)
    for fn in (ER.similarity_bins, ER.threshold_counts):
        a = sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                   for r in fn(sims, gold).collect())
        z = sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                   for r in fn(sims, gold, max_bytes=0).collect())
        assert a == z and len(a) > 0


def test_checked_broadcast_paths_agree(spark):
    od = load_table(spark, SF_SMALL, "orders", ["o_orderkey", "o_custkey"])
    li = load_table(spark, SF_SMALL, "lineitem", ["l_orderkey", "l_partkey"])
    key = li.l_orderkey == od.o_orderkey
    a = P.join_checked_broadcast(li, od, key, max_bytes=10**12)
    z = P.join_checked_broadcast(li, od, key, max_bytes=0)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(a) == rows(z) and len(rows(a)) == li.count()
