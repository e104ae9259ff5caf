"""Threshold sweep against a direct Python version of its definition."""

from tessera.operators import resolution as ER

SIMS = [(1, 10, 0.29), (1, 11, 0.5), (2, 10, 1.0), (2, 12, 0.0), (3, 13, 0.995),
        (3, 14, 0.01), (4, 15, 0.7), (5, 16, 0.29), (6, 17, 0.3)]
GOLD = [(1, 10), (2, 10), (5, 16), (9, 99), (3, 14)]


def py_sweep():
    gold = set(GOLD)
    scored = {(a, b): s for a, b, s in SIMS}
    fp_bins = [0] * 101
    for (a, b), s in scored.items():
        if (a, b) not in gold:
            fp_bins[min(int(s * 100), 100)] += 1
    gold_scores = [scored.get(p, 0.0) for p in GOLD]
    out = {}
    for n in range(100):
        t = n / 100.0
        fp = sum(fp_bins[b] for b in range(101) if b / 100.0 >= t)
        fn = sum(1 for s in gold_scores if s < t)
        out[t] = (fp, fn, len(GOLD) - fn)
    return out


def test_threshold_counts_match_definition(spark):
    sims = spark.createDataFrame(SIMS, "left_id long, right_id long, cosine double")
    gold = spark.createDataFrame(GOLD, "left_id long, right_id long")
    for bound in (1_000_000, 0):         # broadcast gold, and full outer join
        got = {r["threshold"]: (r["fp"], r["fn"], r["tp"])
               for r in ER.threshold_counts(sims, gold, max_bytes=bound).collect()}
        assert got == py_sweep()
        bins = {r["bin"]: r["fp"] for r in ER.similarity_bins(sims, gold, max_bytes=bound).collect()}
        assert sum(bins.values()) == 5 and len(bins) == 101
    prf = {r["threshold"]: r for r in ER.threshold_prf(ER.threshold_counts(sims, gold)).collect()}
    assert prf[0.0]["precision"] == 5 / (5 + 5)
    late = [r["threshold"] for r in ER.threshold_counts(sims, gold, 0.3).collect()]
    assert sorted(late) == [n / 100 for n in range(30, 100)]
