"""The text index, stored posting lists, chunked collection, functions of partitions,
undecoded scans and the load that reports on itself."""

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.functions.lines import parse_gold_lines, parse_product_lines
from tessera.operators import logs as L
from tessera.operators import relational as P
from tessera.operators import text as E
from tessera.operators.postings import TextIndex, postings_of, write_inverted, write_records
from tessera.session import fits_broadcast, shared_dir, stored
from tessera.sources import textfiles
from tessera.sources.tables import load_table
from tessera.sources.views import clf_lines_from

from conftest import SF_SMALL


def given(spark):
    return (load_table(spark, SF_SMALL, "benchmark", ["item_id", "text"]),
            load_table(spark, SF_SMALL, "documents", ["doc_id", "text"]))


def scanned_rows(df):
    """(rows that the scan gave, rows of the result) of an executed query without a shuffle."""
    n = len(df.collect())
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value(), n


@pytest.mark.parametrize("max_bytes", [None, 2_000])
def test_index_agrees_with_the_separate_operators(spark, max_bytes):
    b, d = given(spark)
    index = TextIndex(b, "item_id", d, "doc_id", max_bytes=max_bytes).prepare()
    w = {(r["side"], r["id"], r["token"]): (r["w"], r["n_docs"]) for r in E.text_weights(b, "item_id", d, "doc_id").collect()}
    got = {(r["side"], r["id"], r["token"]): (r["w"], r["n_docs"]) for r in index.weights().collect()}
    assert got.keys() == w.keys() and all(abs(got[k][0] - w[k][0]) < 1e-12 and got[k][1] == w[k][1] for k in w)
    vec = defaultdict(dict)
    for (side, i, t), (x, _) in w.items():
        vec[side, i][t] = x
    for v in vec.values():
        norm = sum(x * x for x in v.values()) ** 0.5
        for t in v:
            v[t] /= norm
    for at in (0.0, 0.02, 0.3, 0.9):
        want = {}
        for (s, i), a in vec.items():
            for (z, j), x in vec.items():
                if (s, z) == ("L", "R") and a.keys() & x.keys():
                    c = sum(u * x[t] for t, u in a.items() if t in x)
                    if c >= at:
                        want[i, j] = c
        sims = {(r["left_id"], r["right_id"]): r["cosine"] for r in index.similar(at).collect()}
        assert sims.keys() == want.keys() and all(abs(sims[k] - want[k]) < 1e-9 for k in want)
    kept, shared = E.prefixes(E.shared_postings(index.numbered), 0.02).count(), len(w)
    assert kept < 0.1 * shared


def test_gold_pairs_of_awkward_texts(spark):
    left = ["quick brown fox", "fox", "n fox", "the of and", " the ", "own fo", "!", "", None, "xKb yyy z", "brown\n",
            "Fox jumps\nover", "a", "é fox ", "FOX", "zz", "i̇ brown x", "fox fox"]
    right = ["The quick brown fox jumps", "a fox!", "brown fox", None, "", "all of the of and more", "axKb yyy zoo",
             "the Fox jumps\nover it", "é fox é", "brown\n", "İ brown xi̇ brown x", "fox fox fox", "n fox the"]
    b = spark.createDataFrame(list(enumerate(left)), "item_id long, text string")
    d = spark.createDataFrame(list(enumerate(right)), "doc_id long, text string")
    want = {(i, j) for i, x in enumerate(left) for j, y in enumerate(right) if None not in (x, y) and x in y}
    for max_bytes in (None, 0):
        got = [tuple(r) for r in TextIndex(b, "item_id", d, "doc_id", max_bytes=max_bytes).gold.collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_index_of_empty_tables(spark):
    b, d = (x.limit(0) for x in given(spark))
    index = TextIndex(b, "item_id", d, "doc_id").prepare()
    assert index.weights().count() == index.similar(0.1).count() == index.gold.count() == 0


def test_histogram_reads_the_corpus_once(spark):
    b, d = given(spark)
    idf = E.idf_weights(E.doc_tokens(E.corpus(b, "item_id", d, "doc_id")))
    df = E.idf_histogram(idf, 7)
    values = [r["idf"] for r in idf.collect()]
    low, step = min(values), (max(values) - min(values)) / 7
    want = defaultdict(int)
    for v in values:
        want[min(int((v - low) / step) + 1, 7)] += 1
    assert {r["bin"]: r["n"] for r in df.collect()} == dict(want)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"ReadSchema: struct<text:string>", plan.split("== Initial Plan ==")[0])) == 2  # one for each table


def test_stored_lists(spark):
    words = spark.range(5_000).select(F.when(F.col("id") % 2 == 0, F.lit("R")).otherwise(F.lit("L")).alias("side"), "id",
                                      F.explode(F.array(F.lit("hot"), F.concat(F.lit("w"), F.col("id").cast("string")))).alias("token"))
    folder = shared_dir(spark, "inverted")
    lists = write_inverted(words, folder, 100)
    rows = sorted((r["token"], r["side"], r["chunk"], r["place"], r["ids"]) for r in lists.where("token = 'hot'").collect())
    for side, start in (("L", 1), ("R", 0)):
        mine = [r for r in rows if r[1] == side]
        assert [r[2] for r in mine] == list(range(len(mine))) and all(len(r[4]) <= 100 for r in mine)
        assert [r[3] for r in mine] == [sum(len(x[4]) for x in mine[:k]) for k in range(len(mine))]
        assert [i for r in mine for i in r[4]] == list(range(start, 5_000, 2))
    assert sorted(map(tuple, postings_of(lists).collect())) == sorted((r["token"], r["side"], r["id"]) for r in words.collect())
    import pyarrow.parquet as pq
    files = [re.sub("^file:/*", "/", f) for f in lists.inputFiles()]
    tokens = [t for f in sorted(files) for t in pq.read_table(f, columns=["token"]).column("token").to_pylist()]
    assert tokens == sorted(tokens)
    meta = pq.ParquetFile(files[0]).metadata.row_group(0)
    by_name = {meta.column(i).path_in_schema: meta.column(i) for i in range(meta.num_columns)}
    assert "DELTA_BINARY_PACKED" in by_name["place"].encodings
    assert any("DELTA_BINARY_PACKED" in c.encodings for n, c in by_name.items() if n.startswith("ids"))
    assert "PushedFilters: [IsNotNull(token), EqualTo(token,w77)]" in lists.where("token = 'w77'")._jdf.queryExecution().toString()


def test_record_lookup_reads_few_rows(spark):
    weights = spark.range(60_000).select(F.lit("R").alias("side"), (F.col("id") / 20).cast("bigint").alias("id"),
                                         F.md5(F.col("id").cast("string")).alias("token"),
                                         (F.col("id") / 7).alias("w"), F.lit(1).cast("bigint").alias("n_docs"))
    records = write_records(weights.repartition(5), shared_dir(spark, "records"))
    read, found = scanned_rows(P.lookup(records, side="R", id=1234))
    assert found == 20 and read <= 2_000  # pages of one row group
    assert records.count() == 60_000


def test_chunked_collection(spark):
    rows = [(None, 1), (None, None), ("a", 3), ("a", 3), ("b", None)] + [("hot", i % 900) for i in range(3_000)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(6)
    want = defaultdict(list)
    for k, v in rows:
        want[k].append(v)
    for max_bytes in (None, 0):
        chunks = P.collect_chunks(df, "k", "v", 64, max_bytes).collect()
        got = defaultdict(list)
        for r in sorted(chunks, key=lambda r: (r["k"] or "", r["chunk"])):
            assert 0 < len(r["values"]) <= 64 and r["place"] == len(got[r["k"]])
            got[r["k"]] += r["values"]
        assert {k: sorted(v, key=lambda x: (x is not None, x)) for k, v in want.items()} == dict(got)
        for k in want:
            assert sorted(r["chunk"] for r in chunks if r["k"] == k) == list(range(sum(r["k"] == k for r in chunks)))
    # the groups are by block: the hot key lies in as many as it needs
    assert sum(r["k"] == "hot" for r in chunks) >= 3_000 // 64
    assert P.collect_chunks(df.limit(0), "k", "v").collect() == []


def test_functions_of_partitions(spark):
    df = spark.range(0, 1_003, 1, 4).select(F.when(F.col("id") % 10 > 0, F.col("id")).alias("v")).withColumn("x", F.lit("y"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        lists = P.partition_lists(df, "v", 50).collect()
        summary = {r["partition"]: (r["n"], r["total"]) for r in P.partition_summary(df, "v").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    parts = defaultdict(list)
    for i, p in df.select("v", F.spark_partition_id()).collect():
        parts[p].append(i)
    assert len(parts) == 4
    for p, values in parts.items():
        mine = sorted((r["chunk"], r["values"]) for r in lists if r["partition"] == p)
        assert [c for c, _ in mine] == list(range(-(-len(values) // 50)))
        assert [v for _, some in mine for v in some] == values and all(len(v) == 50 for _, v in mine[:-1])
        assert summary[p] == (len(values), sum(v or 0 for v in values))
    assert P.partition_lists(df.limit(0), "v").collect() == []


def test_lines_as_bytes_and_splits(spark, tmp_path):
    lines = [b"plain", b"caf\xc3\xa9", b"caf\xe9", b"\xff\xfe\x00x", b"", b"tab\tnul\x00 end"] * 500
    (tmp_path / "a.txt").write_bytes(b"\n".join(lines) + b"\n")
    (tmp_path / "b.txt").write_bytes(b"last line without end")
    path = "file://" + str(tmp_path)
    got = textfiles.read_lines(spark, path, decode=False).collect()
    assert sorted(bytes(r["value"]) for r in got) == sorted([*lines, b"last line without end"])
    for r in got:
        try:
            bytes(r["value"]).decode()
            ok = True
        except UnicodeDecodeError:
            ok = False
        assert r["parse_status"] == ("parsed" if ok else "failed")
    for n in (1, 3, 17):
        split = textfiles.read_lines(spark, path, min_partitions=n)
        assert split.rdd.getNumPartitions() >= n and split.count() == len(lines) + 1
    both = split.join(spark.range(1).select(F.lit("plain").alias("value")), "value")  # a table like any other
    assert both.count() == 500


def test_load_reports_on_what_it_stored(spark):
    lines = clf_lines_from(spark, SF_SMALL)
    parsed, failed, seen = L.load_with_report(lines)
    plain = {r["parse_status"]: r["n_lines"] for r in L.read_report(lines).collect()}
    assert seen == {"read": lines.count(), **plain} and parsed.count() == plain["parsed"]
    assert sorted(r[0] for r in failed.collect()) == sorted(r[0] for r in L.failed_lines(lines).collect())
    assert sorted(map(tuple, parsed.collect())) == sorted(map(tuple, L.load_logs(spark, SF_SMALL).collect()))
    assert L.load_with_report(lines.limit(0))[2] == {"read": 0, "parsed": 0, "failed": 0}


def test_what_a_run_stored_is_dropped(spark):
    from tessera.plans import QUERIES
    from tessera.session import dropping

    def there(path):
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)

    outside = textfiles.write_lines(spark, spark.range(3).selectExpr("cast(id AS string)"), "kept")
    with dropping(spark) as names:
        n = QUERIES["inverted_index"](spark, SF_SMALL).count()
        assert n > 0 and names and all(map(there, names))
    assert not any(map(there, names)) and there(outside)


def test_one_regex_pass_keeps_every_group(spark):
    lines = ['"a","t","d","m","1"', '"id","title","description","manufacturer","price"', "no match", 'x,"","',
             '"b","quoted ""x"", y","","",', '"c\u0001","t\u0001","d","m","1"', ',"t",,,', None]
    pattern = re.compile(r'^(.+),"(.+)",(.*),(.*),(.*)')
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = [tuple(r) for r in parse_product_lines(df).collect()]
    for line, (i, product, status) in zip(lines, got):
        m = pattern.match(line) if line is not None else None
        if m is None:
            assert (i, product, status) == (None, None, "failed")
        else:
            assert (i, product) == (m[1].replace('"', ""), " ".join(m.group(2, 3, 4)))
            assert status == ("header" if m[1] == '"id"' else "parsed")
    gold = spark.createDataFrame([('"a","b"',), ("one",), ('"idAmazon","x"',), ("a,b,c",)], "value string")
    assert [tuple(r) for r in parse_gold_lines(gold).collect()] == [
        ("a", "b", "parsed"), (None, None, "failed"), ("idAmazon", "x", "header"), ("a,b", "c", "parsed")]


def test_only_rare_tokens_postings_are_shuffled(spark):
    rows = [("L" if k % 2 else "R", k, 10, t, 1 + k % 3) for k in range(400) for t in ("all", f"pair{k // 2}", f"own{k}", "gone")]
    postings = stored(spark.createDataFrame(rows, "side string, id long, doc_len int, token string, n long"), "test-postings")
    table = stored(postings.where("token <> 'gone'").groupBy("token").agg(F.count("*").alias("n_docs")), "test-tokens")
    got = E.join_tokens(postings, table, 20_000)
    assert not fits_broadcast(table, 20_000)
    plan = got._jdf.queryExecution().toString()
    assert "LeftAnti" in plan  # what is broadcast does not reach the shuffle join
    assert sorted(map(tuple, got.collect())) == sorted(
        (*r, {"a": 400, "p": 2, "o": 1}[r[3][0]]) for r in rows if r[3] != "gone")


def test_numbered_weights_need_no_window_over_postings(spark):
    left = spark.createDataFrame([(1, "red apple tree"), (2, "tree house"), (3, None), (4, "")], "item_id long, text string")
    right = spark.createDataFrame([(k, f"red tree number{k} house") for k in range(50)], "doc_id long, text string")
    index = TextIndex(left, "item_id", right, "doc_id", max_bytes=0)
    norms = {(r.side, r.id): r.norm for r in E.vector_norms(index.weights()).collect()}
    assert norms == pytest.approx({(r.side, r.id): r.norm for r in index.norms.collect()}) and len(norms) == 52
    rows = index.numbered.collect()
    assert len(rows) == 2 + 2 + 50 * 3 and all(r.u == pytest.approx(r.w / norms[r.side, r.id]) for r in rows)


def test_lists_are_sorted_once_and_numbered_over_partitions(spark, monkeypatch):
    monkeypatch.setattr(P, "number_rows", None)  # neither postings nor lists are numbered by a sort of their own
    rows = [(t, s, i) for i in range(3_000) for t, s in (("hot", "L"), ("hot", "R"), (f"t{i % 7}", "L"), (f"own{i}", "R"))]
    postings = spark.createDataFrame(rows, "token string, side string, id long").repartition(6)
    batch, fit = (spark.conf.get(k) for k in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.adaptive.coalescePartitions.enabled"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "150")  # lists go on over batches and partitions
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for block in (1, 64, 100_000):
            lists = write_inverted(postings, shared_dir(spark, "inverted"), block)
            got = defaultdict(list)
            for r in sorted(lists.collect(), key=lambda r: (r["token"], r["side"], r["chunk"])):
                seen = got[r["token"], r["side"]]
                assert 0 < len(r["ids"]) <= block and r["place"] == sum(map(len, seen))
                assert r["chunk"] == len(seen)
                seen.append(r["ids"])
            want = defaultdict(list)
            for t, s, i in rows:
                want[t, s].append(i)
            assert {k: sum(v, []) for k, v in got.items()} == want
        assert sum(map(len, got.values())) < len(got) + 8  # a list is cut by blocks and by partitions only
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", fit)
    assert write_inverted(postings.limit(0), shared_dir(spark, "inverted")).count() == 0


@pytest.mark.parametrize("max_bytes", [None, 0])
def test_gold_weights_hold_the_records_of_gold_pairs_only(spark, max_bytes):
    left = spark.createDataFrame([(1, "red apple tree"), (2, "tree house"), (3, None), (4, "!"), (5, "no such")], "item_id long, text string")
    right = spark.createDataFrame([(k, f"a red apple tree number{k} house") for k in range(3)] + [(k, f"red tree {k}!") for k in range(3, 50)],
                                  "doc_id long, text string")
    index = TextIndex(left, "item_id", right, "doc_id", max_bytes=max_bytes).prepare_gold()
    assert "numbered" not in vars(index) and "norms" not in vars(index)
    ids = {("L", r.left_id) for r in index.gold.collect()} | {("R", r.right_id) for r in index.gold.collect()}
    assert ids == {("L", 1), ("L", 4)} | {("R", k) for k in range(50)}  # "!" is in the texts from 3 on
    full = {(r.side, r.id, r.token): (r.w, r.n_docs) for r in index.weights().collect() if (r.side, r.id) in ids}
    assert {(r.side, r.id, r.token): (r.w, r.n_docs) for r in index.gold_weights.collect()} == full
    got, want = ({(r.left_id, r.right_id): r.dot for r in E.pair_products(x, index.gold, "u").collect()}
                 for x in (E.unit_weights(index.gold_weights), index.numbered))
    assert got == pytest.approx(want) and set(got) == {(1, 0), (1, 1), (1, 2)}
    shared = {(r.left_id, r.right_id): (r.n_shared, r.shared_tokens) for r in E.shared_tokens(index.gold_weights, index.gold).collect()}
    assert shared == {(1, k): (3, "apple red tree") for k in range(3)}


@pytest.mark.parametrize("max_bytes", [None, 0])
def test_only_records_that_can_reach_the_threshold_are_sent_to_the_window(spark, max_bytes):
    from pyspark.sql import Window
    rows = [(s, k, t, 2, u) for s in "LR" for k in range(60) for t, u in ((1, 0.001), (2, 0.9 if k < 3 else 0.01))]
    shared = E.shared_postings(spark.createDataFrame(rows, "side string, id long, tid long, n_docs long, u double"), max_bytes)
    shared = shared.withColumn("top", F.when(F.col("id") < 3, F.col("top")).otherwise(F.lit(0.02)))
    got = E.prefixes(shared, 0.5, max_bytes)
    assert ("LeftSemi" in got._jdf.queryExecution().toString()) == (max_bytes is None)
    upto = Window.partitionBy("side", "id").orderBy(F.desc("n_docs"), F.desc("tid")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rest = F.least(F.sqrt(F.sum(F.col("u") * F.col("u")).over(upto)), F.sum(F.col("u") * F.col("top")).over(upto))
    for t in (0.0, 0.5, 0.81, 0.9):
        want = shared.withColumn("rest", rest).where(F.col("rest") >= t - 1e-9).select("side", "id", "tid")
        assert sorted(map(tuple, E.prefixes(shared, t, max_bytes).select("side", "id", "tid").collect())) == sorted(map(tuple, want.collect()))
    assert {(r.side, r.id) for r in got.collect()} == {(s, k) for s in "LR" for k in range(3)}


def test_gold_evaluation_needs_no_stored_postings(spark):
    from tessera.operators import resolution as ER
    b, d = given(spark)
    index = TextIndex(b, "item_id", d, "doc_id").prepare_gold()
    gold = index.gold.unionByName(spark.createDataFrame([(index.gold.first()["left_id"], -1)], index.gold.schema))
    n = [x.agg(F.count(F.lit(1)).alias("n")) for x in (b, d)]
    got = ER.gold_evaluation(index.unit_postings(), gold, *n, E.unit_weights(index.gold_weights)).first()
    assert "numbered" not in vars(index)
    assert tuple(got) == pytest.approx(tuple(ER.gold_evaluation(index.numbered, gold, *n).first())) and got["avg_sim_dups"] > 0


@pytest.mark.parametrize("max_bytes, larger", [(None, "R"), (0, "L")])
def test_similar_weighs_only_records_that_can_reach_the_threshold(spark, max_bytes, larger):
    few = [(k, f"red apple tree number{k}") for k in range(4)] + [(4, None), (5, "!"), (6, "alone")]
    many = [(k, "red apple tree" + "".join(f" own{k}x{j}" for j in range(0 if k < 3 else 40))) for k in range(80)] + [(80, None), (81, "")]
    few, many = (spark.createDataFrame(x, "id long, text string").coalesce(1) for x in (few, many))
    sides = (few, many) if larger == "R" else (many, few)
    index = TextIndex(sides[0], "id", sides[1], "id", max_bytes=max_bytes)
    got = {(r.left_id, r.right_id): r.cosine for r in index.similar(0.01).collect()}
    assert "numbered" not in vars(index) and "norms" not in vars(index)  # no other record's weights are stored
    units = {(r.side, r.id, r.tid): r.u for r in index.reaching(0.01).collect()}
    assert {k[:2] for k in units} == {(larger, k) for k in range(3)} | {("LR"[larger == "L"], k) for k in range(4)}
    all_units = {(r.side, r.id, r.tid): r.u for r in index.numbered.collect()}
    assert units == pytest.approx({k: all_units[k] for k in units}) and len(all_units) > 200
    want = {(r.left_id, r.right_id): r.cosine for r in E.cosine_inverted(index.numbered, 0.01, max_bytes).collect()}
    assert got == pytest.approx(want) and len(got) == 12
