"""The registered queries: ``QUERIES[name](spark, sf_dir) -> DataFrame``.

Each query reads the given tables (or views Spark derives from them) whole.
Computed columns carry explicit aliases that match ``oracle.ORACLE_SQL``;
doubles that come out of aggregates are rounded to 9 places on both sides,
since summation order differs between engines.  ``ROWS_ONLY`` lists the
queries whose answer is random, trained or layout-dependent: those have no
exact oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as ftext
from tessera.functions.lines import (
    parse_gold_lines, parse_product_lines, parse_rating_lines, parse_title_lines, parsed_only,
)
from tessera.operators import logs as L
from tessera.operators import ratings as R
from tessera.operators import relational as P
from tessera.operators import resolution as ER
from tessera.operators import text as E
from tessera.operators.postings import TextIndex, postings_of, write_inverted, write_records
from tessera.plans import params as K
from tessera.sources import textfiles
from tessera.session import broadcast_if_small, release, reliable_checkpoint, shared_dir, stored
from tessera.sources.tables import load_table, range_table, rows_table, spread
from tessera.sources.views import (
    clf_lines_from, gold_lines, product_lines, rating_lines, ratings,
    title_lines, titles,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ROWS_ONLY: set[str] = set()


def query(name: str, rows_only: bool = False):
    def reg(fn: Query) -> Query:
        QUERIES[name] = fn
        if rows_only:
            ROWS_ONLY.add(name)
        return fn
    return reg


def r9(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 9)


# ---------------------------------------------------------------- shared parts

def logs(spark, sf):
    return L.load_logs(spark, sf)


def bench_docs(spark, sf):
    return (spread(load_table(spark, sf, "benchmark", ["item_id", "text"])),
            spread(load_table(spark, sf, "documents", ["doc_id", "text"])))


def corpus_tokens(spark, sf):
    b, d = bench_docs(spark, sf)
    return E.doc_tokens(E.corpus(b, "item_id", d, "doc_id"))


def text_index(spark, sf) -> TextIndex:
    b, d = bench_docs(spark, sf)
    return TextIndex(b, "item_id", d, "doc_id")


def gold(spark, sf):
    return text_index(spark, sf).gold


def doc_tokens_of(spark, sf, stopwords=True):
    d = spread(load_table(spark, sf, "documents", ["doc_id", "text"])).withColumnRenamed("doc_id", "id")
    return E.doc_tokens(d, stopwords=stopwords)


# ---------------------------------------------------------------- S: sources

@query("range_source")
def q_range_source(spark, sf):
    """A generated range over the order keys, held against the table: rows of
    the range, their sum over multiples of 7, how many of them are orders, and the
    cents of those."""
    od = load_table(spark, sf, "orders", ["o_orderkey", "o_totalprice"])
    top = od.agg(F.max("o_orderkey")).first()[0]
    n_parts = spark.sparkContext.defaultParallelism
    r = range_table(spark, 0, 0 if top is None else int(top) + 1, 1, n_parts)
    both = r.join(od, r["id"] == od["o_orderkey"], "left")
    return both.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.when(F.col("id") % 7 == 0, F.col("id"))).alias("total_sevens"),
                    F.count("o_orderkey").alias("n_orders"), F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"))


@query("local_rows")
def q_local_rows(spark, sf):
    """S1, local rows: a handful of (item, rating) rows and their titles."""
    picks = rows_table(spark, K.NEW_USER_PICKS, "item bigint, rating double")
    return titles(spark, sf).join(broadcast_if_small(picks), "item").select("item", "rating", "title")


@query("stopword_table_remove")
def q_stopword_table_remove(spark, sf):
    """S10/F2 for a word list kept as a file: the list is written to the
    shared folder, read back as a distinct word set, and anti-joined with the
    exploded tokens (broadcast only after its row count is checked)."""
    words = spark.createDataFrame([(w,) for w in ftext.STOPWORDS], "value string")
    path = textfiles.write_lines(spark, words, "stopwords")
    stop = textfiles.read_word_set(spark, path)
    t = doc_tokens_of(spark, sf, stopwords=False)
    kept = ftext.remove_stopwords_table(t.select("id", F.explode("tokens").alias("token")),
                                        stop, "token")
    per_doc = kept.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return (t.select("id").join(per_doc, "id", "left")
            .select(F.col("id").alias("doc_id"),
                    F.coalesce("n", F.lit(0)).cast("bigint").alias("n_tokens")))


@query("text_scan")
def q_text_scan(spark, sf):
    path = textfiles.write_lines(spark, clf_lines_from(spark, sf), "text-scan")
    return textfiles.read_lines(spark, path)


@query("gzip_scan")
def q_gzip_scan(spark, sf):
    path = textfiles.write_lines(spark, clf_lines_from(spark, sf), "gzip-scan", "gzip")
    return textfiles.read_gzip_lines(spark, path)


@query("clf_parse")
def q_clf_parse(spark, sf):
    return logs(spark, sf)


@query("clf_read_report")
def q_clf_read_report(spark, sf):
    return L.read_report(clf_lines_from(spark, sf))


@query("clf_load_report")
def q_clf_load_report(spark, sf):
    """The counts observed while the load wrote its records and failed lines,
    beside the rows that it stored."""
    parsed, failed, seen = L.load_with_report(clf_lines_from(spark, sf))
    rows = rows_table(spark, [(k, seen[k]) for k in ("parsed", "failed")], "parse_status string, n_lines bigint")
    stored = parsed.agg(F.count(F.lit(1)).alias("n_stored")).select(F.lit("parsed").alias("parse_status"), "n_stored") \
        .unionByName(failed.agg(F.count(F.lit(1)).alias("n_stored")).select(F.lit("failed").alias("parse_status"), "n_stored"))
    return rows.join(stored, "parse_status").select("parse_status", "n_lines", "n_stored")


@query("clf_load_parsed")
def q_clf_load_parsed(spark, sf):
    """S4 from what the same load stored."""
    return L.load_with_report(clf_lines_from(spark, sf))[0]


@query("text_scan_bytes")
def q_text_scan_bytes(spark, sf):
    """S2 without decoding: the lines' bytes, read in at least 16 splits, where
    every 7th line by event id ends with a byte that is no UTF-8."""
    ev = load_table(spark, sf, "events", ["event_id", "event_type"])
    body = F.concat(F.col("event_id").cast("string"), F.lit(" "), "event_type").cast("binary")
    bad = F.when(F.col("event_id") % 7 == 0, F.concat(body, F.unhex(F.lit("FF")))).otherwise(body)
    path = textfiles.write_lines(spark, ev.select(bad.cast("string").alias("value")), "bytes")
    return textfiles.read_lines(spark, path, min_partitions=16, decode=False).select(
        F.lower(F.hex("value")).alias("hex"), "parse_status")


@query("clf_failed_lines")
def q_clf_failed_lines(spark, sf):
    """The quarantined raw lines (all of them, not a sample)."""
    return L.failed_lines(clf_lines_from(spark, sf)).select(F.col("line").alias("value"))


@query("product_parse")
def q_product_parse(spark, sf):
    part = load_table(spark, sf, "part", ["p_partkey", "p_name", "p_type", "p_brand",
                                          "p_retailprice"])
    parsed = parse_product_lines(product_lines(spark, part))
    return parsed.where(F.col("parse_status") == "parsed").select("id", "product")


def _status_counts(parsed):
    return parsed.groupBy("parse_status").agg(F.count(F.lit(1)).alias("n_lines"))


@query("product_read_report")
def q_product_read_report(spark, sf):
    """S5 for product lines: lines per parse status (header, parsed, failed)."""
    part = load_table(spark, sf, "part", ["p_partkey", "p_name", "p_type", "p_brand",
                                          "p_retailprice"])
    return _status_counts(parse_product_lines(product_lines(spark, part)))


@query("gold_read_report")
def q_gold_read_report(spark, sf):
    """S5 for gold lines."""
    return _status_counts(parse_gold_lines(gold_lines(spark, gold(spark, sf))))


@query("gold_pairs_parse")
def q_gold_pairs_parse(spark, sf):
    parsed = parse_gold_lines(gold_lines(spark, gold(spark, sf)))
    return parsed.where(F.col("parse_status") == "parsed").select("left_id", "right_id")


@query("ratings_parse")
def q_ratings_parse(spark, sf):
    return parsed_only(parse_rating_lines(rating_lines(spark, sf))).select(
        "user", "item", r9("rating").alias("rating"))


@query("ratings_read_report")
def q_ratings_read_report(spark, sf):
    """S5 for rating lines: every line is parsed or failed, none is lost."""
    return _status_counts(parse_rating_lines(rating_lines(spark, sf)))


@query("titles_parse")
def q_titles_parse(spark, sf):
    return parsed_only(parse_title_lines(title_lines(spark, sf)))


@query("titles_read_report")
def q_titles_read_report(spark, sf):
    """S5 for title lines."""
    return _status_counts(parse_title_lines(title_lines(spark, sf)))


@query("stopword_remove")
def q_stopword_remove(spark, sf):
    t = doc_tokens_of(spark, sf, stopwords=True)
    return t.select(F.col("id").alias("doc_id"), F.size("tokens").cast("bigint").alias("n_tokens"),
                    F.array_join("tokens", " ").alias("tokens"))


# ---------------------------------------------------------------- P: projections

def lineitem(spark, sf, *cols):
    return load_table(spark, sf, "lineitem", list(cols))


@query("map_expr")
def q_map_expr(spark, sf):
    li = lineitem(spark, sf, "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")
    return li.select("l_orderkey", "l_linenumber",
                     (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))


@query("filter_chain")
def q_filter_chain(spark, sf):
    li = lineitem(spark, sf, "l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    return (li.where(F.col("l_quantity") > 10).where(F.col("l_discount") < 0.05)
            .where(F.col("l_quantity") % 2 == 1).select("l_orderkey", "l_linenumber"))


def part_words(spark, sf):
    part = load_table(spark, sf, "part", ["p_partkey", "p_name"])
    return part.select("p_partkey", F.explode(F.split("p_name", " ")).alias("word"))


@query("flat_map_rows")
def q_flat_map_rows(spark, sf):
    return P.flat_map_plural(part_words(spark, sf))


@query("map_nested")
def q_map_nested(spark, sf):
    out = P.map_nested_plural(part_words(spark, sf))
    return out.select("p_partkey", "word", F.array_join("forms", "|").alias("forms"))


@query("flat_map_range")
def q_flat_map_range(spark, sf):
    li = lineitem(spark, sf, "l_orderkey", "l_linenumber")
    return P.flat_map_range(li, "l_linenumber", "k").select("l_orderkey", "l_linenumber", "k")


@query("partition_concat")
def q_partition_concat(spark, sf):
    od = load_table(spark, sf, "orders", ["o_orderkey"])
    joined = P.partition_concat(od, "o_orderkey", ",")
    values = joined.select(F.explode(F.split("joined", ",")).alias("v"))
    return values.select(F.col("v").cast("bigint").alias("o_orderkey"))


@query("partition_rows")
def q_partition_rows(spark, sf):
    od = load_table(spark, sf, "orders", ["o_orderkey"])
    # by the partition index: the sums of partitions make up the table's, and no
    # index occurs twice
    p = P.partition_summary(od, "o_orderkey")
    return p.agg(F.sum("n").alias("n"), F.sum("total").alias("total"),
                 (F.count(F.lit(1)) - F.countDistinct("partition")).alias("repeated"))


@query("partition_flat")
def q_partition_flat(spark, sf):
    """The lists of all partitions, flattened."""
    od = load_table(spark, sf, "orders", ["o_orderkey"])
    return P.partition_lists(od, "o_orderkey", K.LIST_CHUNK).select(F.explode("values").alias("o_orderkey"))


@query("partition_chunks")
def q_partition_chunks(spark, sf):
    """Over all partitions, values in lists, lists that are too long, and numbers
    missing among a partition's lists."""
    od = load_table(spark, sf, "orders", ["o_orderkey"])
    lists = P.partition_lists(od, "o_orderkey", K.LIST_CHUNK)
    per = lists.groupBy("partition").agg(
        F.sum(F.size("values")).alias("n"), F.sum((F.size("values") > K.LIST_CHUNK).cast("bigint")).alias("long"),
        (F.max("chunk") + 1 - F.countDistinct("chunk")).alias("gaps"))
    return per.agg(F.sum("n").alias("n"), F.sum("long").alias("n_long"), F.sum("gaps").alias("n_gaps"))


@query("map_values")
def q_map_values(spark, sf):
    od = load_table(spark, sf, "orders", ["o_orderkey", "o_totalprice"])
    return P.map_values(od, "o_orderkey", "o_totalprice", lambda v: v * 2)


@query("rekey_pairs")
def q_rekey_pairs(spark, sf):
    g = P.swap_pairs(gold(spark, sf), "left_id", "right_id")
    return g.select(F.col("left_id").alias("doc_id"), F.col("right_id").alias("item_id"))


@query("pair_lookup")
def q_pair_lookup(spark, sf):
    records = write_records(text_index(spark, sf).weights(), shared_dir(spark, "records"))
    return P.lookup(records, side=E.LEFT, id=K.LOOKUP_ITEM).select("token", r9("w").alias("w"))


# ---------------------------------------------------------------- J: joins

@query("join_inner")
def q_join_inner(spark, sf):
    li = lineitem(spark, sf, "l_orderkey", "l_partkey", "l_quantity")
    od = load_table(spark, sf, "orders", ["o_orderkey", "o_custkey"])
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .select("l_orderkey", "o_custkey", "l_partkey", "l_quantity"))


@query("join_composite")
def q_join_composite(spark, sf):
    index = text_index(spark, sf).prepare_gold()
    s = ER.gold_cosines(E.unit_weights(index.gold_weights), index.gold)
    return s.select("left_id", "right_id", r9("cosine").alias("cosine"))


@query("join_left_default")
def q_join_left_default(spark, sf):
    index = text_index(spark, sf).prepare_gold()
    g = ER.gold_scores(ER.gold_cosines(E.unit_weights(index.gold_weights), index.gold), index.gold)
    return g.select("left_id", "right_id", r9("cosine").alias("cosine"))


@query("join_anti")
def q_join_anti(spark, sf):
    index = text_index(spark, sf).prepare(K.MIN_SIMILARITY)
    s = index.similar(K.MIN_SIMILARITY).join(index.gold, ["left_id", "right_id"], "left_anti")
    return s.select("left_id", "right_id", r9("cosine").alias("cosine"))


def new_user_picks(spark):
    return spark.createDataFrame(list(K.NEW_USER_PICKS), R.NEW_USER_SCHEMA)


@query("unrated_items")
def q_unrated_items(spark, sf):
    """J5 on the stored ratings: what the most active users have not rated."""
    rt = _ratings_fixed(spark, sf)
    users = (rt.groupBy("user").agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.desc("n"), "user").limit(K.USERS_ASKED))
    return R.unrated_pairs(users, titles(spark, sf), rt)


@query("join_broadcast")
def q_join_broadcast(spark, sf):
    index = text_index(spark, sf)
    bags = P.join_checked_broadcast(index.bags, E.vector_norms(index.weights()), ["side", "id"])
    out = index.weights_of(bags, "norm")
    return out.select("side", "id", "token", r9(F.col("w") / F.col("norm")).alias("unit_w"))


@query("shared_token_pairs")
def q_shared_token_pairs(spark, sf):
    index = text_index(spark, sf)
    return E.pair_products(index.reaching(K.MIN_SIMILARITY), index.similar(K.MIN_SIMILARITY)).select("left_id", "right_id", "n_shared")


@query("join_chain")
def q_join_chain(spark, sf):
    rt = ratings(spark, sf)
    means = R.item_rating_stats(rt).select("item", F.col("avg_rating").alias("prediction"))
    out = R.recommend_top_n(means, rt, titles(spark, sf), K.RECOMMEND_MIN_RATINGS,
                            K.RECOMMEND_N)
    return out.select(r9("prediction").alias("prediction"), "title", "n_ratings", "item")


# ---------------------------------------------------------------- A: aggregates

@query("sum_global")
def q_sum_global(spark, sf):
    return P.sum_all(lineitem(spark, sf, "l_quantity"), "l_quantity", "sum_qty")


@query("count_rows")
def q_count_rows(spark, sf):
    return P.count_all(lineitem(spark, sf, "l_orderkey"), "n")


@query("content_size_stats")
def q_content_size_stats(spark, sf):
    return L.content_size_stats(logs(spark, sf))


@query("count_by_key")
def q_count_by_key(spark, sf):
    return L.response_code_counts(logs(spark, sf))


@query("sum_by_key")
def q_sum_by_key(spark, sf):
    od = load_table(spark, sf, "orders", ["o_custkey", "o_totalprice"])
    out = P.sum_by_key(od, "o_custkey", "o_totalprice", "total")
    return out.select("o_custkey", r9("total").alias("total"))


@query("collect_by_key")
def q_collect_by_key(spark, sf):
    li = lineitem(spark, sf, "l_orderkey", "l_linenumber")
    out = P.collect_by_key(li, "l_orderkey", "l_linenumber", "lines")
    return out.select("l_orderkey", F.array_join("lines", ",").alias("lines"))


@query("collect_chunks")
def q_collect_chunks(spark, sf):
    """A6 for keys of any size: each key's values joined from its chunks; the event types
    are few and hot."""
    ev = load_table(spark, sf, "events", ["event_type", "event_id"])
    chunks = P.collect_chunks(ev, "event_type", "event_id", K.COLLECT_CHUNK)
    text = F.array_join(F.transform("values", lambda v: v.cast("string")), ",")
    return chunks.select("event_type", "chunk", "place", F.size("values").cast("bigint").alias("n"), F.md5(text).alias("digest"))


@query("collect_by_key_chunks")
def q_collect_by_key_chunks(spark, sf):
    """As ``collect_by_key``, the lists put together from chunks of two."""
    li = lineitem(spark, sf, "l_orderkey", "l_linenumber")
    chunks = P.collect_chunks(li, "l_orderkey", "l_linenumber", 2)
    whole = chunks.groupBy("l_orderkey").agg(F.flatten(F.transform(
        F.sort_array(F.collect_list(F.struct("chunk", "values"))), lambda c: c["values"])).alias("lines"))
    return whole.select("l_orderkey", F.array_join("lines", ",").alias("lines"))


@query("count_by_value")
def q_count_by_value(spark, sf):
    return P.count_by_value(load_table(spark, sf, "events", ["event_type"]), "event_type")


@query("distinct_rows")
def q_distinct_rows(spark, sf):
    return P.distinct_rows(load_table(spark, sf, "events", ["user_id", "event_type"]),
                           ["user_id", "event_type"])


@query("unique_hosts")
def q_unique_hosts(spark, sf):
    return L.unique_hosts(logs(spark, sf))


@query("daily_unique_hosts")
def q_daily_unique_hosts(spark, sf):
    return L.daily_unique_hosts(logs(spark, sf))


@query("daily_avg_requests_per_host")
def q_daily_avg(spark, sf):
    return L.daily_avg_requests_per_host(logs(spark, sf))


@query("item_rating_stats")
def q_item_rating_stats(spark, sf):
    s = R.item_rating_stats(ratings(spark, sf))
    return s.select("item", "n_ratings", r9("avg_rating").alias("avg_rating"))


@query("frequent_hosts")
def q_frequent_hosts(spark, sf):
    return L.frequent_hosts(logs(spark, sf), K.FREQUENT_HOST_MIN)


@query("response_code_share")
def q_response_code_share(spark, sf):
    s = L.response_code_share(logs(spark, sf))
    return s.select("response_code", "n", r9("share").alias("share"))


@query("mean_rating")
def q_mean_rating(spark, sf):
    return ratings(spark, sf).agg(r9(F.avg("rating")).alias("mean_rating"))


@query("idf_histogram")
def q_idf_histogram(spark, sf):
    return E.idf_histogram(E.idf_weights(corpus_tokens(spark, sf)), K.IDF_BINS)


@query("similarity_bins")
def q_similarity_bins(spark, sf):
    index = text_index(spark, sf).prepare(K.MIN_SIMILARITY)
    return ER.similarity_bins(index.similar(K.MIN_SIMILARITY), index.gold, K.MIN_SIMILARITY)


# ---------------------------------------------------------------- O: order

@query("take_any")
def q_take_any(spark, sf):
    """Any n rows: how many there are, and how many of them are rows of the table."""
    ev = load_table(spark, sf, "events", ["event_id"])
    some = reliable_checkpoint(P.take_any(ev, K.SMALL_N))
    return some.join(ev.withColumn("known", F.lit(1)), "event_id", "left").agg(
        F.count(F.lit(1)).alias("n"), F.sum("known").cast("bigint").alias("n_known"))


@query("smallest_n")
def q_smallest_n(spark, sf):
    li = lineitem(spark, sf, "l_orderkey", "l_linenumber", "l_extendedprice")
    return P.smallest_n(li, K.SMALL_N, "l_extendedprice", "l_orderkey", "l_linenumber")


@query("top_n_by_count")
def q_top_n_by_count(spark, sf):
    return L.top_endpoints(logs(spark, sf), K.TOP_ENDPOINTS)


@query("largest_n")
def q_largest_n(spark, sf):
    od = load_table(spark, sf, "orders", ["o_orderkey", "o_totalprice"])
    return P.largest_n(od, K.SMALL_N, "o_totalprice", "o_orderkey")


@query("sort_by_key")
def q_sort_by_key(spark, sf):
    ev = load_table(spark, sf, "events", ["user_id"])
    return P.count_by_value(ev, "user_id").orderBy("user_id")


@query("sort_positions")
def q_sort_positions(spark, sf):
    """Each row of the full sort with its place in it."""
    ev = load_table(spark, sf, "events", ["user_id"])
    placed = P.number_rows(P.count_by_value(ev, "user_id"), "user_id")
    return placed.select("user_id", "n", F.col("_rn").alias("position")).orderBy("position")


@query("sort_total_order")
def q_sort_total_order(spark, sf):
    s = R.item_rating_titles(ratings(spark, sf), titles(spark, sf))
    out = R.sort_total_order(s, ascending=False)
    return out.select("item", r9("avg_rating").alias("avg_rating"), "title", "n_ratings")


@query("longest_record")
def q_longest_record(spark, sf):
    out = E.longest_record(doc_tokens_of(spark, sf))
    return out.select(F.col("id").alias("doc_id"), "n_tokens")


@query("sample_rows")
def q_sample_rows(spark, sf):
    ev = load_table(spark, sf, "events", ["event_id", "event_type"])
    return P.sample_rows(ev, K.SAMPLE_N, True, K.SAMPLE_SEED, "event_id")


@query("sample_without_replacement")
def q_sample_without_replacement(spark, sf):
    ev = load_table(spark, sf, "events", ["event_id", "event_type"])
    return P.sample_rows(ev, K.SAMPLE_N, False, K.SAMPLE_SEED, "event_id")


@query("split_train_test")
def q_split_train_test(spark, sf):
    parts = R.split_ratings(ratings(spark, sf))
    out = None
    for name, df in zip(("train", "validation", "test"), parts):
        c = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("split"), "n")
        out = c if out is None else out.unionByName(c)
    return out


# ---------------------------------------------------------------- U: sets

@query("union_all")
def q_union_all(spark, sf):
    b, d = bench_docs(spark, sf)
    return E.corpus(b, "item_id", d, "doc_id").select("side", "id")


@query("array_unique")
def q_array_unique(spark, sf):
    t = doc_tokens_of(spark, sf, stopwords=False)
    return t.select(F.col("id").alias("doc_id"),
                    F.size(F.array_distinct("tokens")).cast("bigint").alias("n_unique"))


# ---------------------------------------------------------------- F: scalars

@query("tokenize")
def q_tokenize(spark, sf):
    t = doc_tokens_of(spark, sf, stopwords=False)
    return t.select(F.col("id").alias("doc_id"), F.size("tokens").cast("bigint").alias("n_tokens"),
                    F.array_join("tokens", " ").alias("tokens"))


@query("regex_lookbehind")
def q_regex_lookbehind(spark, sf):
    ev = load_table(spark, sf, "events", ["event_id", "props"])
    return ev.select("event_id", F.regexp_extract("props", r'(?<="k": )\d+', 0).alias("k"))


@query("rmse")
def q_rmse(spark, sf):
    rt = ratings(spark, sf)
    means = R.item_rating_stats(rt).select("item", F.col("avg_rating").alias("prediction"))
    return R.rmse_of(rt.join(means, "item")).select(r9("rmse").alias("rmse"))


# ---------------------------------------------------------------- G: log reports

@query("endpoint_hits")
def q_endpoint_hits(spark, sf):
    return L.endpoint_hits(logs(spark, sf))


@query("top_error_endpoints")
def q_top_error_endpoints(spark, sf):
    return L.top_error_endpoints(logs(spark, sf), K.TOP_ENDPOINTS)


@query("count_404")
def q_count_404(spark, sf):
    return L.count_404(logs(spark, sf))


@query("distinct_404_endpoints")
def q_distinct_404_endpoints(spark, sf):
    return L.distinct_404_endpoints(logs(spark, sf), K.DISTINCT_404_LIMIT)


@query("top_404_endpoints")
def q_top_404_endpoints(spark, sf):
    return L.top_404_endpoints(logs(spark, sf), K.TOP_404_ENDPOINTS)


@query("top_404_hosts")
def q_top_404_hosts(spark, sf):
    return L.top_404_hosts(logs(spark, sf), K.TOP_404_HOSTS)


@query("errors_by_day")
def q_errors_by_day(spark, sf):
    return L.errors_by_day(logs(spark, sf))


@query("top_error_days")
def q_top_error_days(spark, sf):
    return L.top_error_days(logs(spark, sf), K.TOP_ERROR_DAYS)


@query("errors_by_hour")
def q_errors_by_hour(spark, sf):
    return L.errors_by_hour(logs(spark, sf))


# ---------------------------------------------------------------- E: text

@query("token_totals")
def q_token_totals(spark, sf):
    return E.token_totals(corpus_tokens(spark, sf))


@query("term_frequency")
def q_term_frequency(spark, sf):
    tf = E.term_frequency(corpus_tokens(spark, sf))
    return tf.select("side", "id", "token", r9("tf").alias("tf"))


@query("idf_weights")
def q_idf_weights(spark, sf):
    idf = E.idf_weights(corpus_tokens(spark, sf))
    return idf.select("token", "n_docs", r9("idf").alias("idf"))


@query("lowest_idf_tokens")
def q_lowest_idf_tokens(spark, sf):
    out = E.lowest_idf_tokens(E.idf_weights(corpus_tokens(spark, sf)), K.LOWEST_IDF)
    return out.select("token", r9("idf").alias("idf"))


@query("tfidf_weights")
def q_tfidf_weights(spark, sf):
    return text_index(spark, sf).weights().select("side", "id", "token", r9("w").alias("w"))


@query("sparse_dot")
def q_sparse_dot(spark, sf):
    index = text_index(spark, sf).prepare_gold()
    d = E.pair_products(index.gold_weights, index.gold)
    return d.select("left_id", "right_id", r9("dot").alias("dot"))


@query("vector_norms")
def q_vector_norms(spark, sf):
    n = E.vector_norms(text_index(spark, sf).weights())
    return n.select("side", "id", r9("norm").alias("norm"))


@query("cosine_pair")
def q_cosine_pair(spark, sf):
    w = text_index(spark, sf).weights()
    a = P.lookup(w, side=E.LEFT, id=K.COSINE_LEFT)
    b = P.lookup(w, side=E.RIGHT, id=K.COSINE_RIGHT)
    return E.cosine_of(a, b).select(r9("cosine").alias("cosine"))


@query("inverted_index")
def q_inverted_index(spark, sf):
    lists = write_inverted(text_index(spark, sf).weights(), shared_dir(spark, "inverted"))
    return postings_of(lists)


@query("token_lookup")
def q_token_lookup(spark, sf):
    """The postings of one record's tokens, from the stored lists."""
    weights = text_index(spark, sf).weights()
    lists = write_inverted(weights, shared_dir(spark, "inverted"))
    tokens = [r["token"] for r in P.lookup(weights, side=E.LEFT, id=K.LOOKUP_ITEM).select("token").collect()]
    return postings_of(lists.where(F.col("token").isin(tokens)))  # one record's tokens


@query("shared_tokens")
def q_shared_tokens(spark, sf):
    index = text_index(spark, sf).prepare_gold()
    return E.shared_tokens(index.gold_weights, index.gold)


@query("cosine_inverted")
def q_cosine_inverted(spark, sf):
    found = text_index(spark, sf).similar(K.MIN_SIMILARITY)
    return found.select("left_id", "right_id", r9("cosine").alias("cosine"))


@query("gold_evaluation")
def q_gold_evaluation(spark, sf):
    count = lambda t: load_table(spark, sf, t).agg(F.count(F.lit(1)).alias("n"))
    index = text_index(spark, sf).prepare_gold()
    g = ER.gold_evaluation(index.unit_postings(), index.gold, count("benchmark"), count("documents"),
                           E.unit_weights(index.gold_weights))
    return g.select("true_dups", r9("avg_sim_dups").alias("avg_sim_dups"),
                    r9("avg_sim_non_dups").alias("avg_sim_non_dups"))


def _threshold_counts(spark, sf):
    index = text_index(spark, sf).prepare(K.MIN_SIMILARITY)
    return ER.threshold_counts(index.similar(K.MIN_SIMILARITY), index.gold, K.MIN_SIMILARITY)


@query("threshold_counts")
def q_threshold_counts(spark, sf):
    return _threshold_counts(spark, sf)


@query("threshold_prf")
def q_threshold_prf(spark, sf):
    p = ER.threshold_prf(_threshold_counts(spark, sf))
    return p.select("threshold", r9("precision").alias("precision"),
                    r9("recall").alias("recall"), r9("f_measure").alias("f_measure"))


# ---------------------------------------------------------------- R: ratings

@query("item_rating_titles")
def q_item_rating_titles(spark, sf):
    s = R.item_rating_titles(ratings(spark, sf), titles(spark, sf))
    return s.select("item", "title", "n_ratings", r9("avg_rating").alias("avg_rating"))


@query("best_items")
def q_best_items(spark, sf):
    out = R.best_items(ratings(spark, sf), titles(spark, sf), K.BEST_MIN_RATINGS, K.BEST_N)
    return out.select(r9("avg_rating").alias("avg_rating"), "title", "n_ratings", "item")


def _ratings_fixed(spark, sf):
    """Ratings written once to the shared checkpoint folder: every ALS fit,
    split and evaluation reads the same rows, and lineage is cut."""
    return stored(ratings(spark, sf), "ratings")


def _splits(spark, sf):
    return R.split_ratings(_ratings_fixed(spark, sf))


@query("als_predict", rows_only=True)
def q_als_predict(spark, sf):
    train, val, _ = _splits(spark, sf)
    m = R.train_als(train, K.ALS_RANK)
    return R.predict(m, val).select("user", "item", "rating", "prediction")


@query("als_predicted_pairs")
def q_als_predicted_pairs(spark, sf):
    """R6/R7 as far as SQL knows them: the validation pairs that get a prediction,
    those whose user and item were trained on."""
    train, val, _ = _splits(spark, sf)
    p = R.predict(R.train_als(train, K.ALS_RANK, iterations=1), val)
    return p.where(F.col("prediction").isNotNull()).select("user", "item", r9("rating").alias("rating"))


@query("als_rank_search", rows_only=True)
def q_als_rank_search(spark, sf):
    train, val, _ = _splits(spark, sf)
    rows, _ = R.rank_search(train, val)
    return rows


@query("als_test_rmse", rows_only=True)
def q_als_test_rmse(spark, sf):
    train, val, test = _splits(spark, sf)
    rows, models = R.rank_search(train, val)
    best = rows.orderBy("rmse", "rank").first()["rank"]   # three rows
    return R.rmse_of(R.predict(models[best], test)).select(
        F.lit(best).alias("rank"), "rmse")


@query("mean_baseline_rmse")
def q_mean_baseline_rmse(spark, sf):
    train, _, test = _splits(spark, sf)
    return R.mean_baseline_rmse(train, test).select(r9("train_mean").alias("train_mean"), r9("rmse").alias("rmse"))


def _with_new_user(spark, sf):
    rt = _ratings_fixed(spark, sf)
    train, _, test = R.split_ratings(rt)
    mine = R.new_user_ratings(rt, new_user_picks(spark))
    model = R.train_als(train.unionByName(mine), K.ALS_RANK)
    return rt, test, mine, model


@query("als_new_user", rows_only=True)
def q_als_new_user(spark, sf):
    _, test, _, model = _with_new_user(spark, sf)
    return R.rmse_of(R.predict(model, test))


@query("recommend_unrated", rows_only=True)
def q_recommend_unrated(spark, sf):
    _, _, mine, model = _with_new_user(spark, sf)
    cand = _unrated_pairs(spark, sf, mine)
    return R.predict(model, cand).select("user", "item", "prediction")


def _unrated_pairs(spark, sf, mine):
    """(new user, item) for every item the new user has not rated; the one
    user id is attached by a one-row broadcast join on a constant key."""
    uid = mine.select("user").distinct().withColumn("_k", F.lit(1))
    return (R.unrated_items(titles(spark, sf), mine).withColumn("_k", F.lit(1))
            .join(F.broadcast(uid), "_k").select("user", "item"))


@query("recommend_top_n", rows_only=True)
def q_recommend_top_n(spark, sf):
    rt, _, mine, model = _with_new_user(spark, sf)
    pred = R.predict(model, _unrated_pairs(spark, sf, mine))
    return R.recommend_top_n(pred, rt, titles(spark, sf), K.RECOMMEND_MIN_RATINGS,
                             K.RECOMMEND_N)


def _one_of(df, **names):
    return df.select(*[F.lit(v).alias(k) for k, v in names.items()], *df.columns)


@query("als_normal_residual")
def q_als_normal_residual(spark, sf):
    """The three models of the rank search and the one with the new
    user: their trained users, and how many do not solve their normal equations.  Each
    report, one row, is taken before the next, so the disk holds the shuffles of one."""
    rt = _ratings_fixed(spark, sf)
    train, val, _ = R.split_ratings(rt)

    def report(name, model, rows):
        row = reliable_checkpoint(_one_of(R.residual_report(model, rows), model=name))
        release(spark)
        return row

    _, models = R.rank_search(train, val)
    out = None
    for rank, model in models.items():
        row = report(f"rank {rank}", model, train)
        out = row if out is None else out.unionByName(row)
    more = train.unionByName(reliable_checkpoint(R.new_user_ratings(rt, new_user_picks(spark))))
    return out.unionByName(report("new user", R.train_als(more, K.ALS_RANK), more))


@query("als_new_user_pairs")
def q_als_new_user_pairs(spark, sf):
    """R11, R12 as far as SQL knows them: the test pairs that the model with the new
    user predicts."""
    rt = _ratings_fixed(spark, sf)
    train, _, test = R.split_ratings(rt)
    more = train.unionByName(R.new_user_ratings(rt, new_user_picks(spark)))
    p = R.predict(R.train_als(more, K.ALS_RANK, iterations=1), test)
    return p.where(F.col("prediction").isNotNull()).select("user", "item", r9("rating").alias("rating"))


@query("recommend_unrated_pairs")
def q_recommend_unrated_pairs(spark, sf):
    """R13 as far as SQL knows it: the (user, item) pairs scored for the new user."""
    _, _, mine, model = _with_new_user(spark, sf)
    return R.predict(model, _unrated_pairs(spark, sf, mine)).select("user", "item")


@query("recommend_users")
def q_recommend_users(spark, sf):
    """R13, R14 for every user at once: of the recommendations of each trained user,
    how many there are, how many of them are different items, how many the user has
    rated, and how many have too few ratings."""
    rt = _ratings_fixed(spark, sf)
    train, _, _ = R.split_ratings(rt)
    counts = stored(rt.groupBy("item").agg(F.count(F.lit(1)).alias("n_ratings")), "counts")
    often = counts.where(F.col("n_ratings") > K.RECOMMEND_MIN_RATINGS)
    got = R.recommend_users(R.train_als(train, K.ALS_RANK), rt, K.RECOMMEND_N, items=often)
    seen = got.join(rt.select("user", "item", F.lit(1).alias("rated")), ["user", "item"], "left").join(counts, "item", "left")
    return seen.groupBy("user").agg(
        F.count(F.lit(1)).alias("n_items"), F.countDistinct("item").alias("n_different"), F.count("rated").alias("n_rated"),
        F.count(F.when(F.coalesce("n_ratings", F.lit(0)) <= K.RECOMMEND_MIN_RATINGS, 1)).alias("n_rare"),
        F.max("place").cast("bigint").alias("last_place"))
