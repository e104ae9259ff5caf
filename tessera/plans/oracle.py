"""DuckDB oracle SQL for every exact query (``queries.QUERIES`` minus
``ROWS_ONLY``).  Tables are DuckDB views named after the parquet files.

The log oracle reads ``events`` columns directly and never parses text, so
the Spark parser is checked independently of the rule that wrote the lines.
Text oracles tokenize with DuckDB's own regex split (RE2, ASCII ``\\W``).
"""

from __future__ import annotations

from tessera.functions.text import STOPWORDS
from tessera.operators.ratings import SPLIT_SEED
from tessera.plans import params as K


def _sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


STOP = _sql_list(STOPWORDS)

# -- log records straight from events (no text) ------------------------------
CODE = """CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 4 = 3 THEN 500 ELSE 404 END
            WHEN event_type = 'signup' THEN 302
            WHEN event_type = 'click' THEN CASE WHEN event_id % 3 = 0 THEN 304 ELSE 200 END
            ELSE 200 END"""

EV = f"""ev AS (
  SELECT event_id, ts, user_id AS uid, event_type, value, {CODE} AS code FROM events)"""

LOGS = f"""{EV},
logs AS (
  SELECT 'host' || uid || '.example.net' AS host, '-' AS client_identd, '-' AS user_id,
         date_trunc('second', ts) AS date_time,
         CASE WHEN event_type IN ('signup', 'purchase') THEN 'POST' ELSE 'GET' END AS method,
         '/' || event_type || '/' || (event_id % 97) || '.html' AS endpoint,
         CASE WHEN event_id % 10 = 5 THEN '' ELSE 'HTTP/1.0' END AS protocol,
         code AS response_code,
         CASE WHEN code IN (304, 404, 500) OR value IS NULL THEN 0
              ELSE floor(value * 100)::BIGINT END AS content_size
  FROM ev WHERE event_id % 500 NOT IN (249, 499))"""

LINES = f"""{EV},
parts AS (
  SELECT event_id, code, value,
         'host' || uid || '.example.net - - [' ||
         CASE WHEN event_id % 500 = 249 THEN strftime(ts, '%d/Foo/%Y:%H:%M:%S')
              ELSE strftime(ts, '%d/%b/%Y:%H:%M:%S') END || ' -0400] "' ||
         CASE WHEN event_type IN ('signup', 'purchase') THEN 'POST' ELSE 'GET' END || ' ' ||
         '/' || event_type || '/' || (event_id % 97) || '.html' AS head,
         CASE WHEN event_id % 10 = 5 THEN '' WHEN event_id % 10 = 0 THEN ' HTTP/1.0 '
              ELSE ' HTTP/1.0' END AS proto
  FROM ev),
lines AS (
  SELECT CASE WHEN event_id % 500 = 499 THEN head
              ELSE head || proto || '" ' || code || ' ' ||
                   CASE WHEN code IN (304, 404, 500) OR value IS NULL THEN '-'
                        ELSE CAST(floor(value * 100)::BIGINT AS VARCHAR) END
         END AS value
  FROM parts)"""

# -- text: tokens, TF, IDF, TF-IDF, unit weights, cosine ---------------------
RAW_TOKENS = "list_filter(regexp_split_to_array(lower(text), '\\W+'), lambda t: t <> '')"
TOKENS = (f"list_filter(regexp_split_to_array(lower(text), '\\W+'), "
          f"lambda t: t <> '' AND NOT list_contains({STOP}, t))")

TEXT = f"""corpus AS (
  SELECT 'L' AS side, item_id AS id, text FROM benchmark
  UNION ALL SELECT 'R' AS side, doc_id AS id, text FROM documents),
toks AS (SELECT side, id, {TOKENS} AS tokens FROM corpus),
occ AS (SELECT side, id, len(tokens) AS doc_len, unnest(tokens) AS token FROM toks),
tf AS (SELECT side, id, token, count(*) / any_value(doc_len) AS tf
       FROM occ GROUP BY side, id, token),
nrec AS (SELECT count(*) AS n FROM toks),
idf AS (SELECT token, count(*) AS n_docs, (SELECT n FROM nrec)::DOUBLE / count(*) AS idf
        FROM tf GROUP BY token),
w AS (SELECT tf.side, tf.id, tf.token, tf.tf * idf.idf AS w FROM tf JOIN idf USING (token)),
norms AS (SELECT side, id, sqrt(sum(w * w)) AS norm FROM w GROUP BY side, id),
u AS (SELECT w.side, w.id, w.token, w.w / norms.norm AS u FROM w JOIN norms USING (side, id)),
pairs AS (SELECT a.id AS left_id, b.id AS right_id, sum(a.u * b.u) AS cosine,
                 sum(a.w * b.w) AS dot, count(*) AS n_shared,
                 array_to_string(list_sort(list(a.token)), ' ') AS shared_tokens
         FROM (SELECT u.*, w.w FROM u JOIN w USING (side, id, token)) a
         JOIN (SELECT u.*, w.w FROM u JOIN w USING (side, id, token)) b ON a.token = b.token
         WHERE a.side = 'L' AND b.side = 'R' GROUP BY 1, 2),
sims AS (SELECT left_id, right_id, cosine FROM pairs WHERE cosine >= {K.MIN_SIMILARITY}),
gold AS (SELECT b.item_id AS left_id, d.doc_id AS right_id
         FROM benchmark b JOIN documents d ON contains(d.text, b.text))"""

DOCS_RAW = f"SELECT doc_id, {RAW_TOKENS} AS tokens FROM documents"
DOCS_STOP = f"SELECT doc_id, {TOKENS} AS tokens FROM documents"

# -- ratings -----------------------------------------------------------------
RATINGS = """ratings AS (
  SELECT o_custkey AS "user", l_partkey AS item,
         avg(1 + (l_quantity - 1) % 5) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
titles AS (SELECT p_partkey AS item, p_name AS title FROM part),
stats AS (SELECT item, count(*) AS n_ratings, avg(rating) AS avg_rating
          FROM ratings GROUP BY item)"""

# -- the 6:2:2 split: the first 32 bits of md5('seed:user:item') ------------------
PLACED = f"""placed AS (
  SELECT *, CASE WHEN place < {round(0.6 * 2 ** 32)} THEN 'train'
                 WHEN place < {round(0.8 * 2 ** 32)} THEN 'validation' ELSE 'test' END AS split
  FROM (SELECT *, CAST('0x' || substr(md5('{SPLIT_SEED}:' || "user" || ':' || item), 1, 8) AS BIGINT) AS place
        FROM ratings))"""

PICKED = "(" + ", ".join(str(i) for i, _ in K.NEW_USER_PICKS) + ")"

# -- threshold sweep ---------------------------------------------------------
SWEEP = f"""{TEXT},
scored_gold AS (SELECT s.* FROM sims s JOIN gold USING (left_id, right_id)),
signed AS (SELECT least(floor(cosine * 100), 100)::INT AS bin, 1 AS d FROM sims
           UNION ALL
           SELECT least(floor(cosine * 100), 100)::INT AS bin, -1 AS d FROM scored_gold),
bins AS (SELECT r.range::INT AS bin, coalesce(sum(s.d), 0)::BIGINT AS fp
         FROM range(101) r LEFT JOIN signed s ON s.bin = r.range GROUP BY r.range),
gs AS (SELECT g.left_id, g.right_id, coalesce(s.cosine, 0.0) AS cosine
       FROM gold g LEFT JOIN sims s USING (left_id, right_id)),
ngold AS (SELECT count(*) AS n_gold FROM gs),
th AS (SELECT range::INT AS n FROM range(100)),
counts AS (
  SELECT th.n AS n, th.n / 100.0::DOUBLE AS threshold,
         (SELECT sum(fp) FROM bins WHERE bins.bin >= th.n)::BIGINT AS fp,
         (SELECT count(*) FROM gs WHERE gs.cosine < th.n / 100.0::DOUBLE)::BIGINT AS fn,
         (SELECT n_gold FROM ngold) AS n_gold
  FROM th)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _top(select_from: str, order: str, n: int) -> str:
    return f"{select_from} ORDER BY {order} LIMIT {n}"


ORACLE_SQL: dict[str, str] = {
    # S
    "range_source": """SELECT count(*) AS n,
        sum(CASE WHEN range % 7 = 0 THEN range END)::BIGINT AS total_sevens,
        count(o_orderkey) AS n_orders, sum(CAST(round(o_totalprice * 100) AS BIGINT))::BIGINT AS cents
        FROM range(0, (SELECT max(o_orderkey) + 1 FROM orders)) r LEFT JOIN orders ON range = o_orderkey""",
    "stopword_table_remove": f"""SELECT doc_id, len(tokens)::BIGINT AS n_tokens
        FROM ({DOCS_STOP})""",
    "product_read_report": """SELECT 'header' AS parse_status, 1::BIGINT AS n_lines
        UNION ALL SELECT 'parsed', count(*) FROM part
        UNION ALL SELECT 'failed', count(*) FROM part WHERE p_partkey % 50 = 49""",
    "gold_read_report": _with(TEXT) + """SELECT 'header' AS parse_status, 1::BIGINT AS n_lines
        UNION ALL SELECT 'parsed', count(*) FROM gold
        UNION ALL SELECT 'failed', count(*) FROM gold WHERE right_id % 3 = 0 HAVING count(*) > 0""",
    "text_scan": _with(LINES) + "SELECT value FROM lines",
    "gzip_scan": _with(LINES) + "SELECT value FROM lines",
    "clf_parse": _with(LOGS) + "SELECT * FROM logs",
    "clf_read_report": _with(EV) + """
        SELECT CASE WHEN event_id % 500 IN (249, 499) THEN 'failed' ELSE 'parsed' END
               AS parse_status, count(*) AS n_lines FROM ev GROUP BY 1""",
    "clf_load_report": _with(EV) + """
        SELECT CASE WHEN event_id % 500 IN (249, 499) THEN 'failed' ELSE 'parsed' END
               AS parse_status, count(*) AS n_lines, count(*) AS n_stored FROM ev GROUP BY 1""",
    "clf_load_parsed": _with(LOGS) + "SELECT * FROM logs",
    "text_scan_bytes": """SELECT lower(hex(encode(event_id || ' ' || event_type))) ||
               CASE WHEN event_id % 7 = 0 THEN 'ff' ELSE '' END AS hex,
               CASE WHEN event_id % 7 = 0 THEN 'failed' ELSE 'parsed' END AS parse_status FROM events""",
    "clf_failed_lines": _with(LINES.replace(
        "SELECT CASE WHEN event_id % 500 = 499", "SELECT event_id, CASE WHEN event_id % 500 = 499"))
        + "SELECT value FROM lines WHERE event_id % 500 IN (249, 499)",
    "product_parse": """SELECT CAST(p_partkey AS VARCHAR) AS id,
        p_name || ' "' || p_type || '" "' || p_brand || '"' AS product FROM part""",
    "gold_pairs_parse": _with(TEXT) + """SELECT CAST(left_id AS VARCHAR) AS left_id,
        CAST(right_id AS VARCHAR) AS right_id FROM gold""",
    "ratings_parse": _with(RATINGS) + """SELECT "user", item, round(rating, 9) AS rating
        FROM ratings""",
    "ratings_read_report": _with(RATINGS) + """SELECT 'parsed' AS parse_status, count(*) AS n_lines
        FROM ratings UNION ALL SELECT 'failed', count(*) FROM ratings WHERE ("user" + item) % 500 = 0""",
    "titles_read_report": """SELECT 'parsed' AS parse_status, count(*) AS n_lines FROM part
        UNION ALL SELECT 'failed', count(*) FROM part WHERE p_partkey % 50 = 49""",
    "titles_parse": "SELECT p_partkey AS item, p_name AS title FROM part",
    "stopword_remove": f"""SELECT doc_id, len(tokens)::BIGINT AS n_tokens,
        array_to_string(tokens, ' ') AS tokens FROM ({DOCS_STOP})""",
    # P
    "map_expr": """SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS revenue
        FROM lineitem""",
    "filter_chain": """SELECT l_orderkey, l_linenumber FROM lineitem
        WHERE l_quantity > 10 AND l_discount < 0.05 AND l_quantity % 2 = 1""",
    "flat_map_rows": """SELECT p_partkey, unnest([word, word || 's']) AS word
        FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part)""",
    "map_nested": """SELECT p_partkey, word, word || '|' || word || 's' AS forms
        FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part)""",
    "flat_map_range": """SELECT l_orderkey, l_linenumber, k::INTEGER AS k FROM (
        SELECT l_orderkey, l_linenumber, unnest(range(1, l_linenumber)) AS k
        FROM lineitem WHERE l_linenumber > 1)""",
    "partition_concat": "SELECT o_orderkey FROM orders",
    "partition_rows": """SELECT count(*) AS n, sum(o_orderkey)::BIGINT AS total, 0::BIGINT AS repeated
        FROM orders""",
    "partition_flat": "SELECT o_orderkey FROM orders",
    "partition_chunks": "SELECT count(*) AS n, 0::BIGINT AS n_long, 0::BIGINT AS n_gaps FROM orders",
    "map_values": "SELECT o_orderkey, o_totalprice * 2 AS o_totalprice FROM orders",
    "rekey_pairs": _with(TEXT) + "SELECT right_id AS doc_id, left_id AS item_id FROM gold",
    "pair_lookup": _with(TEXT) + f"""SELECT token, round(w, 9) AS w FROM w
        WHERE side = 'L' AND id = {K.LOOKUP_ITEM}""",
    # J
    "join_inner": """SELECT l_orderkey, o_custkey, l_partkey, l_quantity
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "join_composite": _with(TEXT) + """SELECT left_id, right_id, round(cosine, 9) AS cosine
        FROM pairs JOIN gold USING (left_id, right_id)""",
    "join_left_default": _with(TEXT) + """SELECT left_id, right_id,
        round(coalesce(cosine, 0.0), 9) AS cosine
        FROM gold LEFT JOIN pairs USING (left_id, right_id)""",
    "join_anti": _with(TEXT) + """SELECT left_id, right_id, round(cosine, 9) AS cosine
        FROM sims ANTI JOIN gold USING (left_id, right_id)""",
    "unrated_items": _with(RATINGS) + f"""SELECT asked."user", t.item
        FROM (SELECT "user", count(*) AS n FROM ratings GROUP BY 1 ORDER BY n DESC, "user"
              LIMIT {K.USERS_ASKED}) asked CROSS JOIN (SELECT DISTINCT item FROM titles) t
        WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r."user" = asked."user" AND r.item = t.item)""",
    "join_broadcast": _with(TEXT) + """SELECT side, id, w.token, round(w.w / norms.norm, 9) AS unit_w
        FROM w JOIN norms USING (side, id)""",
    "shared_token_pairs": _with(TEXT) + """SELECT left_id, right_id, n_shared
        FROM pairs JOIN sims USING (left_id, right_id)""",
    "join_chain": _with(RATINGS) + _top(
        """SELECT round(s.avg_rating, 9) AS prediction, t.title, s.n_ratings, s.item
           FROM stats s JOIN titles t USING (item)
           WHERE s.n_ratings > """ + str(K.RECOMMEND_MIN_RATINGS),
        "s.avg_rating DESC, s.item ASC", K.RECOMMEND_N),
    # A
    "sum_global": "SELECT sum(l_quantity) AS sum_qty FROM lineitem",
    "count_rows": "SELECT count(*) AS n FROM lineitem",
    "content_size_stats": _with(LOGS) + """SELECT min(content_size) AS min_size,
        max(content_size) AS max_size, floor(sum(content_size) / count(*))::BIGINT AS avg_size
        FROM logs""",
    "count_by_key": _with(LOGS) + "SELECT response_code, count(*) AS n FROM logs GROUP BY 1",
    "sum_by_key": """SELECT o_custkey, round(sum(o_totalprice), 9) AS total
        FROM orders GROUP BY 1""",
    "collect_by_key": """SELECT l_orderkey,
        array_to_string(list_sort(list(l_linenumber)), ',') AS lines
        FROM lineitem GROUP BY 1""",
    "collect_by_key_chunks": """SELECT l_orderkey,
        array_to_string(list_sort(list(l_linenumber)), ',') AS lines
        FROM lineitem GROUP BY 1""",
    "collect_chunks": f"""WITH placed AS (
          SELECT event_type, event_id, row_number() OVER (ORDER BY event_type, event_id) - 1 AS rn,
                 row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS place FROM events),
        blocks AS (
          SELECT event_type, rn // {K.COLLECT_CHUNK} AS block, min(place) AS place, count(*) AS n,
                 md5(array_to_string(list(event_id ORDER BY event_id), ',')) AS digest
          FROM placed GROUP BY 1, 2)
        SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY block) - 1 AS chunk,
               place, n, digest FROM blocks""",
    "count_by_value": "SELECT event_type, count(*) AS n FROM events GROUP BY 1",
    "distinct_rows": "SELECT DISTINCT user_id, event_type FROM events",
    "unique_hosts": _with(LOGS) + "SELECT count(DISTINCT host) AS n_hosts FROM logs",
    "daily_unique_hosts": _with(LOGS) + """SELECT dayofmonth(date_time)::BIGINT AS day,
        count(DISTINCT host) AS n_hosts FROM logs GROUP BY 1 ORDER BY 1""",
    "daily_avg_requests_per_host": _with(LOGS) + """SELECT dayofmonth(date_time)::BIGINT AS day,
        count(*) // count(DISTINCT host) AS avg_requests FROM logs GROUP BY 1 ORDER BY 1""",
    "item_rating_stats": _with(RATINGS) + """SELECT item, n_ratings,
        round(avg_rating, 9) AS avg_rating FROM stats""",
    "frequent_hosts": _with(LOGS) + f"""SELECT host, count(*) AS n FROM logs GROUP BY 1
        HAVING count(*) > {K.FREQUENT_HOST_MIN}""",
    "response_code_share": _with(LOGS) + """SELECT response_code, count(*) AS n,
        round(count(*) / (SELECT count(*) FROM logs), 9) AS share FROM logs GROUP BY 1""",
    "mean_rating": _with(RATINGS) + "SELECT round(avg(rating), 9) AS mean_rating FROM ratings",
    "idf_histogram": _with(TEXT) + f""", b AS (SELECT min(idf) AS lo, max(idf) AS hi FROM idf)
        SELECT least(coalesce(floor((idf - lo) / nullif(hi - lo, 0) * {K.IDF_BINS}) + 1, 1),
                     {K.IDF_BINS})::BIGINT AS bin, count(*) AS n
        FROM idf, b GROUP BY 1""",
    "similarity_bins": _with(SWEEP) + f"SELECT bin, fp FROM bins WHERE bin / 100.0 >= {K.MIN_SIMILARITY}",
    # O
    "take_any": f"""SELECT least(count(*), {K.SMALL_N}) AS n, least(count(*), {K.SMALL_N}) AS n_known
        FROM events""",
    "sample_rows": f"""WITH numbered AS (
          SELECT event_id, event_type,
                 row_number() OVER (ORDER BY md5('{K.SAMPLE_SEED}:' || event_id), event_id) AS rn FROM events),
        draws AS (
          SELECT floor(CAST('0x' || substr(md5('{K.SAMPLE_SEED}:draw:' || range), 1, 8) AS BIGINT)::DOUBLE
                       * (SELECT count(*) FROM events) / 4294967296.0::DOUBLE)::BIGINT + 1 AS rn
          FROM range({K.SAMPLE_N}))
        SELECT event_id, event_type FROM numbered JOIN draws USING (rn)""",
    "sample_without_replacement": f"""SELECT event_id, event_type FROM events
        ORDER BY md5('{K.SAMPLE_SEED}:' || event_id), event_id LIMIT {K.SAMPLE_N}""",
    "split_train_test": _with(RATINGS, PLACED) + """SELECT split, count(*) AS n FROM placed GROUP BY 1""",
    "smallest_n": _top("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem",
                       "l_extendedprice, l_orderkey, l_linenumber", K.SMALL_N),
    "top_n_by_count": _with(LOGS) + _top(
        "SELECT endpoint, count(*) AS n FROM logs GROUP BY 1", "n DESC, endpoint",
        K.TOP_ENDPOINTS),
    "largest_n": _top("SELECT o_orderkey, o_totalprice FROM orders",
                      "o_totalprice DESC, o_orderkey DESC", K.SMALL_N),
    "sort_by_key": "SELECT user_id, count(*) AS n FROM events GROUP BY 1 ORDER BY 1",
    "sort_positions": """SELECT user_id, count(*) AS n, row_number() OVER (ORDER BY user_id) AS position
        FROM events GROUP BY 1""",
    "local_rows": f"""SELECT item, rating, p_name AS title
        FROM (VALUES {", ".join(map(str, K.NEW_USER_PICKS))}) v(item, rating) JOIN part ON p_partkey = item""",
    "sort_total_order": _with(RATINGS) + """SELECT s.item, round(s.avg_rating, 9) AS avg_rating,
        t.title, s.n_ratings FROM stats s JOIN titles t USING (item)
        ORDER BY round_even(s.avg_rating, 3) DESC, t.title DESC, s.item DESC""",
    "longest_record": _top(f"SELECT doc_id, len(tokens)::BIGINT AS n_tokens FROM ({DOCS_STOP})",
                           "n_tokens DESC, doc_id", 1),
    # U
    "union_all": """SELECT 'L' AS side, item_id AS id FROM benchmark
        UNION ALL SELECT 'R' AS side, doc_id AS id FROM documents""",
    "array_unique": f"""SELECT doc_id, len(list_distinct(tokens))::BIGINT AS n_unique
        FROM ({DOCS_RAW})""",
    # F
    "tokenize": f"""SELECT doc_id, len(tokens)::BIGINT AS n_tokens,
        array_to_string(tokens, ' ') AS tokens FROM ({DOCS_RAW})""",
    "regex_lookbehind": """SELECT event_id, regexp_extract(props, '"k": (\\d+)', 1) AS k
        FROM events""",
    "rmse": _with(RATINGS) + """SELECT round(sqrt(avg(pow(s.avg_rating - r.rating, 2))), 9)
        AS rmse FROM ratings r JOIN stats s USING (item)""",
    # G
    "endpoint_hits": _with(LOGS) + "SELECT endpoint, count(*) AS n FROM logs GROUP BY 1",
    "top_error_endpoints": _with(LOGS) + _top(
        "SELECT endpoint, count(*) AS n FROM logs WHERE response_code <> 200 GROUP BY 1",
        "n DESC, endpoint", K.TOP_ENDPOINTS),
    "count_404": _with(LOGS) + "SELECT count(*) AS n FROM logs WHERE response_code = 404",
    "top_404_endpoints": _with(LOGS) + _top(
        "SELECT endpoint, count(*) AS n FROM logs WHERE response_code = 404 GROUP BY 1",
        "n DESC, endpoint", K.TOP_404_ENDPOINTS),
    "top_404_hosts": _with(LOGS) + _top(
        "SELECT host, count(*) AS n FROM logs WHERE response_code = 404 GROUP BY 1",
        "n DESC, host", K.TOP_404_HOSTS),
    "errors_by_day": _with(LOGS) + """SELECT dayofmonth(date_time)::BIGINT AS day, count(*) AS n
        FROM logs WHERE response_code = 404 GROUP BY 1 ORDER BY 1""",
    "top_error_days": _with(LOGS) + _top(
        """SELECT dayofmonth(date_time)::BIGINT AS day, count(*) AS n
           FROM logs WHERE response_code = 404 GROUP BY 1""", "n DESC, day",
        K.TOP_ERROR_DAYS),
    "errors_by_hour": _with(LOGS) + """SELECT hour(date_time)::BIGINT AS hour, count(*) AS n
        FROM logs WHERE response_code = 404 GROUP BY 1 ORDER BY 1""",
    # E
    "token_totals": _with(TEXT) + """SELECT coalesce(sum(len(tokens)), 0)::BIGINT AS n_tokens
        FROM toks""",
    "term_frequency": _with(TEXT) + "SELECT side, id, token, round(tf, 9) AS tf FROM tf",
    "idf_weights": _with(TEXT) + "SELECT token, n_docs, round(idf, 9) AS idf FROM idf",
    "lowest_idf_tokens": _with(TEXT) + _top("SELECT token, round(idf, 9) AS idf FROM idf",
                                            "idf, token", K.LOWEST_IDF),
    "tfidf_weights": _with(TEXT) + "SELECT side, id, token, round(w, 9) AS w FROM w",
    "sparse_dot": _with(TEXT) + """SELECT left_id, right_id, round(dot, 9) AS dot
        FROM pairs JOIN gold USING (left_id, right_id)""",
    "vector_norms": _with(TEXT) + "SELECT side, id, round(norm, 9) AS norm FROM norms",
    "cosine_pair": _with(TEXT) + f"""SELECT round(
          (SELECT coalesce(sum(a.w * b.w), 0.0) FROM w a JOIN w b ON a.token = b.token
           WHERE a.side = 'L' AND a.id = {K.COSINE_LEFT}
             AND b.side = 'R' AND b.id = {K.COSINE_RIGHT})
          / ((SELECT norm FROM norms WHERE side = 'L' AND id = {K.COSINE_LEFT})
             * (SELECT norm FROM norms WHERE side = 'R' AND id = {K.COSINE_RIGHT})), 9)
        AS cosine""",
    "inverted_index": _with(TEXT) + "SELECT token, side, id FROM w",
    "token_lookup": _with(TEXT) + f"""SELECT token, side, id FROM w
        WHERE token IN (SELECT token FROM w WHERE side = 'L' AND id = {K.LOOKUP_ITEM})""",
    "shared_tokens": _with(TEXT) + """SELECT left_id, right_id, n_shared, shared_tokens
        FROM pairs JOIN gold USING (left_id, right_id)""",
    "cosine_inverted": _with(TEXT) + """SELECT left_id, right_id, round(cosine, 9) AS cosine
        FROM sims""",
    "gold_evaluation": _with(TEXT) + """, product AS (
          SELECT b.item_id AS left_id, d.doc_id AS right_id, coalesce(p.cosine, 0.0) AS cosine
          FROM benchmark b CROSS JOIN documents d
          LEFT JOIN pairs p ON p.left_id = b.item_id AND p.right_id = d.doc_id)
        SELECT (SELECT count(*) FROM gold) AS true_dups,
        round((SELECT avg(cosine) FROM product JOIN gold USING (left_id, right_id)), 9)
          AS avg_sim_dups,
        round((SELECT avg(cosine) FROM product ANTI JOIN gold USING (left_id, right_id)), 9)
          AS avg_sim_non_dups""",
    "threshold_counts": _with(SWEEP) + f"""SELECT threshold, fp, fn, n_gold - fn AS tp
        FROM counts WHERE threshold >= {K.MIN_SIMILARITY}""",
    "threshold_prf": _with(SWEEP) + """, c AS (
          SELECT threshold, fp::DOUBLE AS fp, fn::DOUBLE AS fn, (n_gold - fn)::DOUBLE AS tp
          FROM counts WHERE threshold >= """ + str(K.MIN_SIMILARITY) + """),
        p AS (SELECT threshold, CASE WHEN tp + fp = 0 THEN NULL ELSE tp / (tp + fp) END AS pr,
                     CASE WHEN tp + fn = 0 THEN NULL ELSE tp / (tp + fn) END AS re FROM c)
        SELECT threshold, round(pr, 9) AS precision, round(re, 9) AS recall,
               round(CASE WHEN re + pr = 0 THEN NULL ELSE 2 * re * pr / (re + pr) END, 9)
               AS f_measure FROM p""",
    "distinct_404_endpoints": _with(LOGS) + f"""SELECT DISTINCT endpoint FROM logs
        WHERE response_code = 404 ORDER BY endpoint LIMIT {K.DISTINCT_404_LIMIT}""",
    # R
    "als_predicted_pairs": _with(RATINGS, PLACED) + """SELECT "user", item, round(rating, 9) AS rating
        FROM placed WHERE split = 'validation'
          AND "user" IN (SELECT "user" FROM placed WHERE split = 'train')
          AND item IN (SELECT item FROM placed WHERE split = 'train')""",
    "als_normal_residual": _with(RATINGS, PLACED) + """, n AS (
          SELECT count(DISTINCT "user") AS n FROM placed WHERE split = 'train')
        SELECT unnest(['rank 4', 'rank 8', 'rank 12', 'new user']) AS model,
               unnest([n, n, n, n + 1]) AS n_users, 0::BIGINT AS n_off FROM n""",
    "als_new_user_pairs": _with(RATINGS, PLACED) + f"""SELECT "user", item, round(rating, 9) AS rating
        FROM placed WHERE split = 'test' AND "user" IN (SELECT "user" FROM placed WHERE split = 'train')
          AND (item IN (SELECT item FROM placed WHERE split = 'train') OR item IN {PICKED})""",
    "recommend_unrated_pairs": _with(RATINGS, PLACED) + f"""
        SELECT (SELECT max("user") + 1 FROM ratings) AS "user", item FROM (SELECT DISTINCT item FROM titles)
        WHERE item NOT IN {PICKED} AND item IN (SELECT item FROM placed WHERE split = 'train')""",
    "recommend_users": _with(RATINGS, PLACED) + f""", often AS (
          SELECT item FROM stats WHERE n_ratings > {K.RECOMMEND_MIN_RATINGS}
          INTERSECT SELECT item FROM placed WHERE split = 'train'),
        open AS (
          SELECT u."user", (SELECT count(*) FROM often) - count(o.item) AS n
          FROM (SELECT DISTINCT "user" FROM placed WHERE split = 'train') u
          JOIN ratings r ON r."user" = u."user" LEFT JOIN often o ON o.item = r.item GROUP BY 1)
        SELECT "user", least(n, {K.RECOMMEND_N}) AS n_items, least(n, {K.RECOMMEND_N}) AS n_different,
               0::BIGINT AS n_rated, 0::BIGINT AS n_rare, least(n, {K.RECOMMEND_N}) AS last_place
        FROM open WHERE n > 0""",
    "mean_baseline_rmse": _with(RATINGS, PLACED) + """, m AS (
          SELECT avg(rating) AS train_mean FROM placed WHERE split = 'train')
        SELECT round(any_value(train_mean), 9) AS train_mean,
               round(sqrt(avg(pow(train_mean - rating, 2))), 9) AS rmse
        FROM placed, m WHERE split = 'test'""",
    "item_rating_titles": _with(RATINGS) + """SELECT s.item, t.title, s.n_ratings,
        round(s.avg_rating, 9) AS avg_rating FROM stats s JOIN titles t USING (item)""",
    "best_items": _with(RATINGS) + _top(
        """SELECT round(s.avg_rating, 9) AS avg_rating, t.title, s.n_ratings, s.item
           FROM stats s JOIN titles t USING (item)
           WHERE s.n_ratings > """ + str(K.BEST_MIN_RATINGS),
        "round_even(s.avg_rating, 3) DESC, t.title DESC, s.item DESC", K.BEST_N),
}
