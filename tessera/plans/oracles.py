"""The catalogue's queries in DuckDB's SQL, for checking results."""

from __future__ import annotations

_O = "(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders)"
_E = "(SELECT *, CAST(ts AS DATE) AS day FROM events)"

ORACLES: dict[str, str] = {
    "member_vs_cohort_majority": f"""
WITH e AS (SELECT day, user_id, user_id % 5 AS cohort, event_type FROM {_E}),
own AS (SELECT day, cohort, user_id, event_type, row_number() OVER (PARTITION BY day, user_id ORDER BY n DESC, event_type) AS r
        FROM (SELECT day, cohort, user_id, event_type, count(*) AS n FROM e GROUP BY ALL)),
c AS (SELECT day, cohort, event_type, count(*) AS n FROM e GROUP BY ALL),
m AS (SELECT day, cohort, event_type, row_number() OVER (PARTITION BY day, cohort ORDER BY n DESC, event_type) AS r FROM c),
k AS (SELECT day, cohort, string_agg(event_type || ':' || n, ',' ORDER BY event_type) AS counts FROM c GROUP BY ALL)
SELECT own.day, own.cohort, own.user_id, own.event_type AS own_type, m.event_type AS majority_type, k.counts,
       own.event_type = m.event_type AS agrees
FROM own JOIN m ON own.day = m.day AND own.cohort = m.cohort AND m.r = 1 JOIN k ON own.day = k.day AND own.cohort = k.cohort
WHERE own.r = 1""",
    "timeline_in_range": f"""
SELECT o_orderkey, o_orderdate, c_name, n_name, o_totalprice FROM {_O} o JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey
WHERE c_mktsegment = 'BUILDING' AND o_orderdate BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'""",
    "authored_by_types": """
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS shipped, p_name, p_type FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE p_type IN ('ECONOMY', 'STANDARD', 'PROMO') AND CAST(l_shipdate AS DATE) BETWEEN DATE '1998-01-01' AND DATE '1998-06-30'""",
    "clean_corpus": r"""
SELECT doc_id, lang, length(clean) AS clean_chars, md5(clean) AS clean_md5, CAST(quality AS VARCHAR) AS quality
FROM (SELECT doc_id, lang, trim(regexp_replace(text, '\s+', ' ', 'g')) AS clean FROM documents) LEFT JOIN labels USING (doc_id)
WHERE length(clean) > 0""",
    "roster_as_of": f"""
WITH r AS (SELECT o_custkey, o_orderstatus, min(o_orderdate) AS from_date, max(o_orderdate) AS to_date FROM {_O} GROUP BY ALL)
SELECT o_custkey, o_orderstatus, from_date, to_date, o_custkey || '-' || o_orderstatus AS role_id,
       CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'P' THEN 2 ELSE 3 END AS kind_rank
FROM r WHERE from_date <= DATE '1998-06-30' AND (to_date >= DATE '1998-06-30' OR (o_orderstatus = 'P' AND NOT EXISTS (
  SELECT 1 FROM r h WHERE h.o_custkey = r.o_custkey AND h.o_orderstatus <> r.o_orderstatus
  AND r.to_date < h.from_date AND h.from_date <= DATE '1998-06-30')))""",
    "stale_holders": f"""
SELECT o_custkey, to_date, newest, date_diff('day', to_date, newest)::INTEGER AS days_since_seen
FROM (SELECT o_custkey, max(o_orderdate) AS to_date FROM {_O} GROUP BY 1), (SELECT max(o_orderdate) AS newest FROM {_O})
WHERE to_date < newest - 90""",
    "members_without_record": f"""
SELECT o_orderkey, o.o_custkey, latest_status FROM {_O} o
JOIN (SELECT o_custkey, o_orderstatus AS latest_status FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM {_O}) WHERE r = 1) c USING (o_custkey)
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
    "decision_sheet": f"""
SELECT o_orderkey, o_orderdate, o_orderstatus, lines, CAST(CASE WHEN o_orderstatus = 'F' THEN n END AS VARCHAR) AS n_if_finished
FROM {_O} o LEFT JOIN (SELECT l_orderkey, count(*) AS n, string_agg(l_linenumber || ':' || l_partkey || ':' || l_returnflag, ',' ORDER BY l_linenumber, l_partkey, l_returnflag) AS lines
FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""",
    "reconcile_two_sources": """
WITH s AS (SELECT l_orderkey, CASE WHEN min(l_linestatus) = max(l_linestatus) THEN min(l_linestatus) ELSE 'P' END AS line_status FROM lineitem GROUP BY 1)
SELECT 'result' AS kind, o_orderkey, o_orderstatus, line_status FROM orders JOIN s ON o_orderkey = l_orderkey WHERE line_status <> o_orderstatus
UNION ALL SELECT 'missing', o_orderkey, o_orderstatus, NULL FROM orders WHERE NOT EXISTS (SELECT 1 FROM s WHERE l_orderkey = o_orderkey)""",
    "coverage_gaps": f"""
SELECT strftime(o_orderdate, '%Y-%m') AS month, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'P' THEN 'in_progress' ELSE 'finished' END AS cause,
       count(*) AS n_orders, min(o_orderkey) AS first_key
FROM {_O} WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' UNION SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F')
GROUP BY 1, 2""",
    "latest_copy": """
SELECT user_id, event_type, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS at, value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""",
    "upsert_image": """
WITH c AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'U2' ELSE 'U1' END AS s FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, coalesce(s, o_orderstatus) AS o_orderstatus, o_totalprice FROM orders LEFT JOIN c USING (o_orderkey)
UNION ALL SELECT -o_orderkey - 1, NULL, 'N', NULL FROM orders WHERE o_orderpriority = '2-HIGH'""",
    "replace_partition": f"""
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS "year", CASE WHEN year(o_orderdate) = 1996 THEN 'R' ELSE o_orderstatus END AS o_orderstatus
FROM {_O} WHERE NOT (year(o_orderdate) = 1996 AND o_orderstatus = 'P')""",
    "stale_rows_removed": """
SELECT o_orderkey, CASE WHEN o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') THEN CAST(o_custkey AS VARCHAR) END AS o_custkey, o_orderstatus
FROM orders WHERE o_orderstatus <> 'O' OR o_orderkey IN (SELECT l_orderkey FROM lineitem)""",
    "positional_pairs": f"""
WITH n AS (SELECT user_id, day, event_type, event_id, row_number() OVER (PARTITION BY user_id, day, event_type ORDER BY ts, event_id) AS k,
           count(*) OVER (PARTITION BY user_id, day, event_type) AS n FROM {_E} WHERE event_type IN ('click', 'purchase'))
SELECT a.user_id, a.day, a.k, a.event_id AS click_id, b.event_id AS purchase_id FROM n a JOIN n b
ON a.user_id = b.user_id AND a.day = b.day AND a.k = b.k AND a.n = b.n AND a.event_type = 'click' AND b.event_type = 'purchase'""",
    "nearest_pair": """
WITH p AS (SELECT a.event_id AS purchase_id, a.user_id, b.event_id AS click_id, abs(date_diff('microsecond', a.ts, b.ts)) AS micros
           FROM events a LEFT JOIN events b ON a.user_id = b.user_id AND b.event_type = 'click' WHERE a.event_type = 'purchase')
SELECT purchase_id, user_id, click_id, micros FROM (SELECT *, row_number() OVER (PARTITION BY purchase_id ORDER BY micros, click_id) AS r FROM p) WHERE r = 1""",
    "tolerance_pairs": """
SELECT a.s_nationkey, a.s_suppkey AS a_key, b.s_suppkey AS b_key, abs(a.s_acctbal - b.s_acctbal) AS difference
FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey < b.s_suppkey AND abs(a.s_acctbal - b.s_acctbal) <= 500""",
    "interval_cover": f"""
WITH i AS (SELECT o_custkey, min(o_orderdate) AS "start", CASE WHEN count(*) FILTER (o_orderstatus = 'O') > 0 THEN NULL ELSE max(o_orderdate) END AS "end" FROM {_O} GROUP BY 1)
SELECT i.o_custkey, i."start", i."end", count(*) AS n_lines FROM lineitem JOIN orders o ON l_orderkey = o_orderkey JOIN i ON i.o_custkey = o.o_custkey
WHERE CAST(l_shipdate AS DATE) >= i."start" AND (i."end" IS NULL OR CAST(l_shipdate AS DATE) <= i."end") GROUP BY ALL""",
    "asof_last_event": """
SELECT a.event_id AS purchase_id, a.user_id, b.event_id AS click_id, abs(date_diff('microsecond', b.ts, a.ts)) AS micros
FROM (SELECT * FROM events WHERE event_type = 'purchase') a ASOF JOIN (SELECT * FROM events WHERE event_type = 'click') b
ON a.user_id = b.user_id AND a.ts >= b.ts""",
    "name_cascade": """
WITH p AS (SELECT p_partkey AS id, p_type, p_size AS y, split_part(p_name, ' ', 2) || '|' || split_part(p_name, ' ', 1) AS f,
           split_part(p_name, ' ', 2) || '|' || left(split_part(p_name, ' ', 1), 1) AS i FROM part),
c AS (SELECT a.id, 1 AS step, b.id AS other, a.y = b.y AS same FROM p a JOIN p b ON a.f = b.f AND b.p_type = 'ECONOMY'
      UNION ALL SELECT a.id, 2, b.id, a.y = b.y FROM p a JOIN p b ON a.i = b.i AND b.p_type = 'ECONOMY'
      UNION ALL SELECT a.id, 3, b.id, a.y = b.y FROM p a JOIN p b ON a.f = b.f
      UNION ALL SELECT a.id, 4, b.id, a.y = b.y FROM p a JOIN p b ON a.i = b.i),
n AS (SELECT id, step, CASE WHEN count(*) > 1 THEN count(*) FILTER (same) ELSE 1 END AS n,
      CASE WHEN count(*) > 1 THEN min(other) FILTER (same) ELSE min(other) END AS other FROM c GROUP BY 1, 2),
b AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY step) AS r FROM n WHERE n > 0)
SELECT p.id AS p_partkey, CAST(CASE WHEN n = 1 THEN other END AS VARCHAR) AS matched_id, CAST(step AS VARCHAR) AS step, CAST(n AS VARCHAR) AS n_candidates FROM p LEFT JOIN b ON p.id = b.id AND r = 1""",
    "link_precedence": """
WITH t AS (SELECT l_orderkey, p_type, CASE WHEN l_returnflag = 'R' THEN 0 END AS a, CASE WHEN l_linestatus = 'F' THEN 1 END AS b FROM lineitem JOIN part ON l_partkey = p_partkey),
k AS (SELECT l_orderkey, p_type, a AS k FROM t WHERE a IS NOT NULL UNION SELECT l_orderkey, p_type, b FROM t WHERE b IS NOT NULL UNION SELECT l_orderkey, p_type, 2 FROM t)
SELECT l_orderkey, CASE k WHEN 0 THEN 'returned' WHEN 1 THEN 'finished' ELSE 'any' END AS via, count(*) AS n_targets,
       CASE WHEN count(*) = 1 THEN min(p_type) END AS p_type
FROM k JOIN (SELECT l_orderkey, min(k) AS k FROM k GROUP BY 1) USING (l_orderkey, k) GROUP BY 1, k""",
    "shared_doc_exclusion": """
WITH d AS (SELECT DISTINCT l_partkey, l_orderkey FROM lineitem)
SELECT l_partkey, l_orderkey FROM d WHERE l_partkey NOT IN (SELECT l_partkey FROM d GROUP BY 1 HAVING count(*) > 30)""",
    "array_overlap_join": """
WITH n AS (SELECT DISTINCT page_id, unnest(regexp_extract_all(url, '[0-9]+')) AS x FROM pages
           INTERSECT SELECT DISTINCT page_id, unnest(regexp_extract_all(html, '[0-9]+')) FROM pages)
SELECT page_id, count(*) AS n_shared, string_agg(x, ',' ORDER BY x) AS shared FROM n GROUP BY 1""",
    "token_overlap": """
WITH a AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(text), '[a-z]{5,}')) AS w FROM documents),
b AS (SELECT item_id, list_distinct(regexp_extract_all(lower(text), '[a-z]{5,}')) AS w FROM benchmark),
s AS (SELECT doc_id, item_id, count(*) AS n_shared FROM (SELECT doc_id, unnest(w) AS x FROM a) JOIN (SELECT item_id, unnest(w) AS x FROM b) USING (x) GROUP BY ALL)
SELECT doc_id, item_id, n_shared, n_shared / greatest(1, least(len(a.w), len(b.w))) AS ratio FROM s JOIN a USING (doc_id) JOIN b USING (item_id)
WHERE n_shared / greatest(1, least(len(a.w), len(b.w))) >= 0.5 AND n_shared >= 3""",
    "semi_filter": """
SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity >= 49)""",
    "dimension_lookup": """
SELECT user_id, o_orderkey FROM (SELECT DISTINCT user_id FROM events) LEFT JOIN
(SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) ON user_id = o_custkey AND r = 1""",
    "self_join_replacement": f"""
WITH o AS (SELECT *, o_orderkey IN (SELECT l_orderkey FROM lineitem) AS good FROM {_O})
SELECT a.o_orderkey AS lost_key, a.o_custkey, a.o_orderdate,
       (SELECT CAST(b.o_orderkey AS VARCHAR) FROM o b WHERE b.good AND b.o_custkey = a.o_custkey AND b.o_orderdate >= a.o_orderdate ORDER BY b.o_orderdate, b.o_orderkey LIMIT 1) AS replaced_by
FROM o a WHERE NOT a.good""",
    "unreferenced_rows": """
SELECT 'unreferenced' AS kind, count(*) AS n FROM nation WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'orphans', count(*) FROM customer WHERE c_nationkey IS NOT NULL AND c_nationkey NOT IN (SELECT n_nationkey FROM nation)""",
    "pivot_totals": """
SELECT l_returnflag, count(*) FILTER (l_linestatus = 'F') AS "n_F", count(*) FILTER (l_linestatus = 'O') AS "n_O",
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM lineitem GROUP BY 1""",
    "distinct_counts": """
SELECT event_type, count(DISTINCT user_id) AS n_users, count(DISTINCT CASE WHEN value > 50 THEN user_id END) AS n_big_users,
       count(*) FILTER (value > 50) AS n_big FROM events GROUP BY 1""",
    "interval_combine": f"""
SELECT o_custkey, min(o_orderdate) AS from_date, CASE WHEN count(*) FILTER (o_orderstatus = 'O') = 0 THEN max(o_orderdate) END AS to_date FROM {_O} GROUP BY 1""",
    "priority_merge": """
WITH c AS (SELECT c_nationkey AS nation, min(c_name) AS name, max(c_acctbal) AS balance FROM customer GROUP BY 1),
s AS (SELECT s_nationkey AS nation, min(s_name) AS name, max(s_acctbal) AS balance FROM supplier GROUP BY 1)
SELECT nation, CASE WHEN c.nation IS NULL THEN 'supplier' ELSE 'customer' END AS source,
       CASE WHEN c.nation IS NULL THEN s.name ELSE c.name END AS name, CASE WHEN s.nation IS NULL THEN c.balance ELSE s.balance END AS balance
FROM c FULL JOIN s USING (nation)""",
    "successor_close": f"""
WITH f AS (SELECT c_nationkey, c_mktsegment, o_custkey, o_orderstatus, max(o_orderdate) AS seen FROM {_O} JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
n AS (SELECT p.c_nationkey, p.c_mktsegment, p.o_custkey, p.seen, l.o_custkey AS who, l.seen AS since,
      row_number() OVER (PARTITION BY p.c_nationkey, p.c_mktsegment, p.o_custkey ORDER BY l.seen NULLS LAST, l.o_custkey) AS r
      FROM f p LEFT JOIN f l ON l.o_orderstatus = 'F' AND l.c_nationkey = p.c_nationkey AND l.c_mktsegment = p.c_mktsegment AND l.o_custkey <> p.o_custkey AND l.seen > p.seen
      WHERE p.o_orderstatus = 'P')
SELECT c_nationkey, c_mktsegment, o_custkey, seen AS "start", since - 1 AS "end", CAST(who AS VARCHAR) AS successor FROM n WHERE r = 1""",
    "completeness_status": """
SELECT o_orderkey, CASE WHEN count(l_orderkey) = 0 THEN 'unanswered' WHEN count(*) FILTER (l_linestatus = 'F') = 0 THEN 'failed'
       WHEN count(*) FILTER (l_linestatus = 'F') < count(*) THEN 'partial' ELSE 'complete' END AS status
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""",
    "table_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}"
        for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
    ),
    "snapshot_diff": f"""
WITH o AS (SELECT *, o_orderstatus || '/' || o_orderpriority AS bin FROM {_O}),
b AS (SELECT bin, count(*) AS n_before FROM o WHERE o_orderdate < DATE '2000-01-01' GROUP BY 1),
n AS (SELECT bin, count(*) AS n_now FROM o WHERE o_orderpriority <> '1-URGENT' AND o_orderstatus <> 'O' GROUP BY 1)
SELECT bin, CAST(n_before AS VARCHAR) AS n_before, CAST(n_now AS VARCHAR) AS n_now, coalesce(n_now IS NULL AND n_before IS NOT NULL, FALSE) OR coalesce(n_now < n_before * 0.95, FALSE) AS failed FROM b FULL JOIN n USING (bin)""",
    "first_last_evidence": f"""
SELECT user_id, event_type, min(day) AS first_day, max(day) AS last_day, arg_min(event_id, (ts, event_id)) AS first_event FROM {_E} GROUP BY 1, 2""",
    "only_target": """
SELECT o_custkey, CASE WHEN count(DISTINCT o_orderpriority) = 1 THEN min(o_orderpriority) END AS priority, count(*) AS n FROM orders GROUP BY 1""",
    "speaker_islands": """
WITH s AS (SELECT *, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER w OR row_number() OVER w = 1 THEN 1 ELSE 0 END AS st FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
p AS (SELECT *, CAST(sum(st) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS part FROM s)
SELECT user_id, part, event_type, count(*) AS n, min(event_id) AS first_id FROM p GROUP BY 1, 2, 3""",
    "running_before": """
SELECT conv_id, turn, role, count(*) FILTER (role = 'user') OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS user_turns_before FROM conversations""",
    "stream_interleave": f"""
WITH n AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY day, event_type) AS n FROM {_E} WHERE event_type IN ('click', 'purchase'))
SELECT user_id, event_type, min(n) AS first_at, max(n) AS last_at FROM n GROUP BY 1, 2""",
    "block_split": """
WITH b AS (SELECT *, count(*) FILTER (event_type = 'signup') OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS block,
           count(*) FILTER (event_type = 'signup') OVER (PARTITION BY user_id) AS openings FROM events)
SELECT user_id, block, count(*) AS n, min(event_id) AS low_id, max(event_id) AS high_id FROM b WHERE block > 0 AND openings >= 2 GROUP BY 1, 2""",
    "last_n_context": """
SELECT conv_id, turn, array_to_string(list(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), ',') AS lengths FROM conversations""",
    "carry_forward": """
SELECT event_id, user_id, last_value(CASE WHEN event_type = 'signup' THEN CAST(event_id AS VARCHAR) END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_signup FROM events""",
    "unique_suffix": """
SELECT p_partkey, CASE WHEN r = 1 THEN p_name ELSE p_name || '-' || r END AS unique_name
FROM (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS r FROM part)""",
    "first_interruption": f"""
WITH o AS (SELECT *, first_value(event_type) OVER (PARTITION BY user_id, day ORDER BY ts, event_id) AS opening FROM {_E}),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY ts, event_id) AS r FROM o WHERE event_type <> opening)
SELECT user_id, day, opening, event_id, event_type FROM r WHERE r = 1""",
    "row_number_positions": """
SELECT conv_id, turn, row_number() OVER w AS position, role, lead(role) OVER w AS next_role FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""",
    "lookback_window": f"SELECT event_type, max(day) - 14 AS refetch_from FROM {_E} GROUP BY 1",
    "numeric_key_sort": """
SELECT p_brand, n_parts, brand_no, CAST(row_number() OVER (ORDER BY brand_no NULLS FIRST, p_brand) AS INTEGER) AS place
FROM (SELECT p_brand, count(*) AS n_parts, TRY_CAST(split_part(p_brand, '#', 2) AS INTEGER) AS brand_no FROM part GROUP BY ALL)""",
    "longest_match": """
SELECT p_partkey, (SELECT x FROM (SELECT unnest(['red', 'red w', 'small', 'small r', 'large', 'blue', 'green g', 'b', 'g']) AS x)
  WHERE starts_with(p_name, x) ORDER BY length(x) DESC LIMIT 1) AS prefix FROM part""",
    "enum_rank_sort": """
SELECT c_mktsegment, count(*) AS n, CASE c_mktsegment WHEN 'MACHINERY' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'HOUSEHOLD' THEN 3 ELSE 4 END AS place FROM customer GROUP BY 1""",
    "set_algebra": """
SELECT o_custkey, 'both' AS kind FROM (SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1996 INTERSECT SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1997)
UNION ALL SELECT o_custkey, 'only_1996' FROM (SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1996 EXCEPT SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1997)""",
    "first_source_wins": """
SELECT nation, coalesce(min(name) FILTER (k = 0), min(name)) AS name FROM (SELECT s_nationkey AS nation, s_name AS name, 0 AS k FROM supplier UNION ALL SELECT c_nationkey, c_name, 1 FROM customer) GROUP BY 1""",
    "sentence_explode": r"""
SELECT doc_id, unnest(range(len(s))) AS pos, unnest(list_transform(s, lambda x: length(x))) AS n_chars FROM (SELECT doc_id, regexp_split_to_array(text, '[.!?]\s+') AS s FROM documents)""",
    "html_text": r"""
WITH t AS (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, trim(regexp_replace(regexp_replace(regexp_replace(html,
  '(?s)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS body FROM pages)
SELECT page_id, title, length(body) AS n_chars, md5(body) AS text_md5 FROM t""",
    "json_props": """
SELECT event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k, count(json_extract_string(props, '$.k')) AS n_k FROM events GROUP BY 1""",
    "category_map": """
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'construction' WHEN 'MACHINERY' THEN 'machines' WHEN 'HOUSEHOLD' THEN 'homes' ELSE lower(c_mktsegment) END AS label FROM customer""",
    "period_of_date": f"""
SELECT CASE WHEN o_orderdate >= DATE '2000-09-30' THEN 15 WHEN o_orderdate >= DATE '1998-10-26' THEN 14 WHEN o_orderdate >= DATE '1996-03-15' THEN 13
       WHEN o_orderdate >= DATE '1994-06-01' THEN 12 END AS period, count(*) AS n, min(o_orderdate) AS first_day FROM {_O} GROUP BY 1""",
    "normalized_names": """
SELECT c_custkey, trim(regexp_replace(regexp_replace(lower(c_name), '[^a-z ]+', ' ', 'g'), ' +', ' ', 'g')) || ' von ' || lower(c_mktsegment) AS name FROM customer""",
    "case_insensitive_like": "SELECT p_partkey, p_name, p_type FROM part WHERE p_name ILIKE '%RING%' AND p_type NOT ILIKE 'promo%'",
    "exists_flags": """
SELECT o_custkey, count(*) AS n, count(*) FILTER (EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')) AS n_returned,
       count(*) FILTER (EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)) AS n_any FROM orders GROUP BY 1""",
    "scalar_conversions": f"""
SELECT o_orderkey, round(o_totalprice, 2) AS price, CASE WHEN o_custkey % 3 = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE o_orderkey || '-' || (o_orderkey + o_custkey % 3) END AS pages,
       CAST(o_orderkey AS INTEGER) AS first_page, o_orderdate AS day, o_orderdate - 1 AS day_before, o_custkey || '/' || o_orderkey AS cited FROM {_O}""",
    "table_invariants": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_repeated FROM (SELECT 1 FROM {t} GROUP BY {k} HAVING count(*) > 1)"
        for t, k in (("customer", "c_custkey"), ("orders", "o_orderkey"), ("part", "p_partkey"), ("supplier", "s_suppkey"), ("lineitem", "l_orderkey, l_linenumber"), ("events", "event_id"))
    ),
    "first_and_last_wins": f"""
SELECT user_id, day, event_type, arg_min(event_id, (ts, event_id)) AS first_id, arg_max(event_id, (ts, event_id)) AS last_id FROM {_E} GROUP BY ALL""",
    "dates_in_text": f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate END AS numeric_day,
       CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate END AS worded_day, o_orderdate AS first_day FROM {_O}""",
    "numbers_in_text": r"""
SELECT o_orderkey, array_to_string(found, ',') AS numbers, CAST(len(found) AS INTEGER) AS n_numbers
FROM (SELECT o_orderkey, regexp_extract_all('Drucksachen ' || o_custkey % 100 || '/' || o_orderkey || ', 3/7 und 12/1234567', '\b(\d{1,2}/\d{1,6})\b', 1) AS found FROM orders)""",
    "event_histogram": f"SELECT day, event_type, count(*) AS n FROM {_E} GROUP BY ALL",
    "bare_column": f"SELECT o_custkey, count(*) AS n, arg_min(o_orderstatus, (o_orderdate, o_orderkey)) AS first_status FROM {_O} GROUP BY ALL",
    "first_match_in_order": f"""
SELECT user_id, CAST(arg_min(event_id, (ts, event_id)) FILTER (WHERE value > 50) AS VARCHAR) AS first_over FROM {_E} GROUP BY ALL""",
    "distinct_in_order": """
WITH f AS (SELECT l_orderkey, l_returnflag AS v, min(l_linenumber) AS n FROM lineitem GROUP BY ALL),
s AS (SELECT l_orderkey, l_linestatus AS v, min(l_linenumber) AS n FROM lineitem GROUP BY ALL)
SELECT l_orderkey, flags, statuses FROM (SELECT l_orderkey, string_agg(v, ',' ORDER BY n, v) AS flags FROM f GROUP BY ALL)
JOIN (SELECT l_orderkey, string_agg(v, ',' ORDER BY n, v) AS statuses FROM s GROUP BY ALL) USING (l_orderkey)""",
    "word_sets_and_prefixes": """
SELECT p_partkey, list_has_any(string_split(lower(p_name), ' '), ['ring', 'widget']) AS has_word,
       starts_with(p_type, 'ECO') OR starts_with(p_type, 'PROMO') AS begins FROM part""",
    "most_common_first": """
WITH n AS (SELECT l_suppkey, l_quantity, count(*) AS n, min(row(l_orderkey, l_linenumber, l_partkey, l_extendedprice)) AS f FROM lineitem GROUP BY ALL)
SELECT l_suppkey, l_quantity AS quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, f) AS r FROM n) WHERE r = 1""",
    "lines_of_characters": r"""
SELECT conv_id, turn // 20 AS page, row_number() OVER (PARTITION BY conv_id, turn // 20 ORDER BY turn) AS line, role = 'assistant' AS bold,
       trim(regexp_replace(text, '[ \t\r\n]+', ' ', 'g')) AS text FROM conversations WHERE trim(regexp_replace(text, '[ \t\r\n]+', ' ', 'g')) <> ''""",
    "interruption_machine": f"""
WITH e AS (SELECT CAST(user_id AS VARCHAR) || '/' || CAST(day AS VARCHAR) AS speech, ts, event_type, event_id, CAST(trunc(value) AS BIGINT) AS words, event_type = 'signup' AS announced FROM {_E}),
m AS (SELECT *, event_type = first_value(event_type) OVER w AS main FROM e WINDOW w AS (PARTITION BY speech ORDER BY ts, event_id)),
r AS (SELECT *, lag(main) OVER w AS after_main, coalesce(lag(announced) OVER w, false) AS told,
      sum(CASE WHEN main THEN words ELSE 0 END) OVER w AS said, row_number() OVER (PARTITION BY speech, event_type ORDER BY ts, event_id) AS nth FROM m
      WINDOW w AS (PARTITION BY speech ORDER BY ts, event_id)),
b AS (SELECT *, coalesce(max(CASE WHEN NOT main THEN said END) OVER (PARTITION BY speech ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM r),
g AS (SELECT *, CASE WHEN NOT main AND (nth = 1 OR (after_main AND said - before >= 30)) THEN event_id END AS start_id,
      CASE WHEN after_main AND told THEN 'kurzintervention' ELSE 'zwischenfrage' END AS kind FROM b)
SELECT speech, event_id, CASE WHEN NOT main THEN last_value(CASE WHEN start_id IS NOT NULL THEN kind END IGNORE NULLS) OVER p END AS interruption,
       CAST(CASE WHEN NOT main THEN last_value(start_id IGNORE NULLS) OVER p END AS VARCHAR) AS interruption_start
FROM g WINDOW p AS (PARTITION BY speech, event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "step_votes_to_items": f"""
WITH li AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, CAST(o_orderdate AS VARCHAR) AS sitting_id, o_custkey AS position,
            l_orderkey || '-' || l_linenumber || '-' || l_partkey AS line FROM lineitem JOIN {_O} ON l_orderkey = o_orderkey),
items AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS item, sitting_id, position, l_partkey FROM li WHERE l_linenumber > 1),
listed AS (SELECT v.line, arg_min(item, i.position) AS item FROM li v JOIN items i ON v.sitting_id = i.sitting_id AND v.l_partkey = i.l_partkey WHERE v.l_linenumber <= 2 GROUP BY 1),
decided AS (SELECT line, arg_max(CAST(l_orderkey AS VARCHAR), l_suppkey) AS item FROM li WHERE l_linenumber = 1 AND l_returnflag = 'R' GROUP BY 1)
SELECT li.line AS vote_id, li.sitting_id, coalesce(d.item, x.item) AS agenda_item_id FROM li LEFT JOIN decided d ON li.line = d.line LEFT JOIN listed x ON li.line = x.line WHERE l_linenumber <= 2""",
    "step_procedures_of_numbers": """
WITH names AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
crowd AS (SELECT l_partkey, count(*) AS n FROM names GROUP BY 1)
SELECT DISTINCT '21/' || p_partkey AS number, CAST(l_suppkey AS VARCHAR) AS vorgang_id FROM names JOIN part ON l_partkey = p_partkey JOIN crowd USING (l_partkey)
JOIN supplier ON s_suppkey = l_suppkey AND s_acctbal > 0 WHERE p_size % 5 <> 0 AND NOT (p_size % 2 = 0 AND n > 1)""",
    "step_referrals": f"""
WITH li AS (SELECT l_orderkey, CAST(o_orderdate AS VARCHAR) AS day, 'Ausschuss ' || l_suppkey % 7 AS committee,
            row(l_linenumber, l_partkey, 'Ausschuss ' || l_suppkey % 7, 'A' || l_partkey, l_returnflag = 'R', 'Q' || CAST(l_quantity AS INTEGER)) AS n,
            'A' || l_partkey AS short, l_returnflag = 'R' AS lead, 'Q' || CAST(l_quantity AS INTEGER) AS kind FROM lineitem JOIN {_O} ON l_orderkey = o_orderkey)
SELECT CAST(l_orderkey AS VARCHAR) AS position_id, committee, min(day) AS vorgang_id, arg_min(short, n) AS committee_short, bool_or(lead) AS "lead", arg_min(kind, n) AS kind FROM li GROUP BY l_orderkey, committee""",
    "step_retired": """
SELECT 'pdf-' || c_custkey AS id, c_name FROM customer WHERE c_custkey % 3 > 0
AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority LIKE '1%' UNION SELECT s_suppkey FROM supplier)""",
    "portraits_with_names": """
SELECT CAST(c_custkey AS VARCHAR) AS person_id, s_name AS image_url, c_mktsegment AS first_name, c_name AS last_name FROM supplier JOIN customer ON c_custkey = s_suppkey * 3""",
}
