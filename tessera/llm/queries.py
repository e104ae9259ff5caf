"""The registered queries of this subpackage: each applies one operator, with
its production parameters, to the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (decontaminate, lmscore, packing, periodic, quality, resample, secretscan, simhash, tokencount,
                         tokenfiles, toxicity, vectors, warc)
from tessera.llm.common import table, vocabulary_path
from tessera.session import shared_dir

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def _query(f):
    QUERIES[f.__name__] = f
    return f


@_query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@_query
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


@_query
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.cluster(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@_query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    rows = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                       (F.col("n_hit") > 0).alias("contaminated"))


ORACLE_SQL["op2_decontamination"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
wins AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, list_slice(w, s, s + least(len(w), 10) - 1) AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM wins),
parts AS (
  SELECT r, n, s, list_slice(w, s, s + n - 1) AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM docs, sizes WHERE len(w) >= n)),
hits AS (SELECT p.r, p.s, p.n, x.item FROM parts p JOIN wins x ON p.n = x.n AND p.win = x.win),
places AS (SELECT r, count(DISTINCT q) AS n_hit
           FROM (SELECT r, unnest(range(s, s + n)) AS q FROM hits) GROUP BY r),
found AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(p.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(f.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(f.ids, '')) AS items_sha256,
       coalesce(p.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN places p USING (r) LEFT JOIN found f USING (r)
"""


@_query
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"))


def _joined_spans(spans: str):
    return F.concat_ws(",", F.expr(f"transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end))"))


@_query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, ledger = table(spark, sf_dir, "documents"), shared_dir(spark, "secret-ledger")
    secretscan.scan(docs, ledger)
    found = secretscan.findings(docs, ledger)
    base = found.withColumn("base", F.expr("filter(spans, s -> s.kind in ('assign', 'access', 'hex'))"))
    count = lambda kind: F.expr(f"cast(size(filter(base, s -> s.kind = '{kind}')) as bigint)").alias(f"n_{kind}")
    return base.select(F.col("id").alias("doc_id"), count("assign"), count("access"), count("hex"),
                       F.sha2(_joined_spans("base"), 256).alias("base_sha256"), _joined_spans("spans").alias("spans"))


@_query
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "token-files")
    tokenfiles.write(table(spark, sf_dir, "documents"), path, vocabulary_path("word_bpe_49k.json"))
    return tokenfiles.checksums(tokenfiles.read(spark, path))


@_query
def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.cluster(table(spark, sf_dir, "embeddings"))


@_query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.tiktoken"))


@_query
def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1 and toxic = 0").select("doc_id")
    return lmscore.score_documents(table(spark, sf_dir, "documents"), good)


@_query
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


# CRC32 by its byte table: DuckDB has no such function
ORACLE_SQL["op13_importance_resampling"] = r"""
WITH byte_table AS (
  SELECT list(list_reduce(list_concat([CAST(i AS BIGINT)], CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
                          lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
              ORDER BY i) AS t
  FROM range(256) r(i)),
docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM benchmark),
own AS (SELECT r, word, count(*) AS n FROM (SELECT r, unnest(w) AS word FROM docs) GROUP BY ALL),
words AS (SELECT DISTINCT word FROM (SELECT word FROM own UNION ALL SELECT word FROM items)),
hashed AS (
  SELECT word, xor(list_reduce(list_concat([4294967295],
           list_transform(range(0, strlen(word)), lambda k: CAST('0x' || substr(hex(encode(word)), 2 * k + 1, 2) AS BIGINT))),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM words, byte_table),
corpus AS (SELECT bucket, sum(n) AS s FROM own JOIN hashed USING (word) GROUP BY 1),
target AS (SELECT bucket, count(*) AS t FROM items JOIN hashed USING (word) GROUP BY 1),
sizes AS (SELECT (SELECT coalesce(sum(s), 0) FROM corpus)::DOUBLE AS s_all, (SELECT coalesce(sum(t), 0) FROM target)::DOUBLE AS t_all),
gains AS (
  SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (s_all + 10000))
                                 / ((coalesce(s, 0) + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS gain
  FROM corpus FULL JOIN target USING (bucket), sizes),
sums AS (SELECT r, sum(n) AS n, sum(n * gain) AS total FROM own JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY r),
scored AS (
  SELECT docs.r, doc_id, coalesce(n, 0)::BIGINT AS n_features,
         coalesce(floor(total::DOUBLE / n), 0)::BIGINT AS weight,
         CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM docs LEFT JOIN sums ON docs.r = sums.r),
final AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM scored),
ranked AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, r) AS place, count(*) OVER () AS able
  FROM final WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score,
       CASE WHEN place <= able * 10 // 100 THEN place END AS rank
FROM final LEFT JOIN ranked USING (r)
"""


def _with_planted_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the repeats that the query's contract plants: of the rows
    whose crc32(doc_id) ends in 0 the words from ``a`` on repeat with period ``p``."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.expr(r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w <> '')")
    once = docs.select("doc_id", "text", F.inline(F.array(F.struct(
        F.when(h % 10 == 0, words).alias("w"), F.floor(h / 10).alias("g")))))
    n = F.size("w")
    with_start = once.withColumn("n", n).withColumn("a", F.when(n > 0, F.col("g") % n))
    p = F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)) + 1
    planted = F.expr("""array_join(transform(sequence(0, n - 1), i ->
        get(w, cast(if(i < a, i, a + (i - a) % p) as int))), ' ')""")
    return with_start.withColumn("p", p).select(
        "doc_id", F.when(F.coalesce(F.col("n") > 0, F.lit(False)), planted).otherwise(F.col("text")).alias("text"))


@_query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.detect(_with_planted_repeats(table(spark, sf_dir, "documents")))
    listed = F.array_join(F.expr("transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n'))"), "")
    best = found.withColumn("best", periodic.longest_by_exponent("runs"))
    return best.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                       F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                       F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@_query
def op12_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, folder = table(spark, sf_dir, "pages"), shared_dir(spark, "warc")
    warc.write(pages, folder)
    kind = pages.schema["page_id"].dataType
    found = warc.read(spark, folder, payloads=False)
    return found.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                        F.col("refers_to").cast(kind).alias("refers_to"))


ORACLE_SQL["op12_warc_zip"] = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
           FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN older THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN older THEN first END AS refers_to
FROM (SELECT *, payload_bytes >= 1000 AND first IS NOT NULL AND (page_id IS NULL OR page_id < first) AS older FROM g)
"""
