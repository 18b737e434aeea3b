"""DuckDB SQL stating what each catalogue query must return.

The SQL runs on the same Parquet tables (registered as views). Column names
and types follow the Spark results; computed doubles are rounded to 6 places
on both sides.
"""

from __future__ import annotations

# Shared expressions of the table mappings (see ``analogues``).
_MASTER_FROM_PART = """
    CAST(p_partkey AS VARCHAR) AS ticker, p_name AS name, p_brand AS market,
    'us' AS locale, CAST(p_size AS VARCHAR) AS primary_exchange, p_type AS type,
    p_size > 25 AS active, 'usd' AS currency_name,
    lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS cik"""

_BAR_FROM_LINEITEM = """
    CAST(l_partkey AS VARCHAR) AS ticker, l_quantity AS volume,
    l_extendedprice AS volume_weighted, l_extendedprice AS open_price,
    l_extendedprice * (1 - l_discount) AS close_price,
    l_extendedprice * (1 + l_tax) AS high_price,
    l_extendedprice * (1 - l_discount) * (1 - l_tax) AS low_price,
    l_linenumber AS number_of_transaction, CAST(l_shipdate AS DATE) AS transaction_date"""

_WITH_MASTER = f"""
SELECT p_name AS name, p_brand AS market, 'us' AS locale,
       CAST(p_size AS VARCHAR) AS primary_exchange, p_type AS type, p_size > 25 AS active,
       'usd' AS currency_name, lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS cik,
       {_BAR_FROM_LINEITEM},
       CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month
FROM lineitem JOIN part ON l_partkey = p_partkey
"""

_ENRICHED = f"""{_WITH_MASTER}WHERE CAST(l_shipdate AS DATE) > DATE '2000-12-31'
"""

_NULLABLE_ORDER = """
    o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS o_custkey, o_orderstatus, o_totalprice,
    CAST(o_orderdate AS DATE) AS transaction_date, o_orderpriority"""

_ORDER_BOUNDS = """
(SELECT min(CAST(o_orderdate AS DATE)) AS first, max(CAST(o_orderdate AS DATE)) AS last FROM orders)
"""

_DAYS = f"""
SELECT CAST(d.day AS DATE) AS day
FROM {_ORDER_BOUNDS} b, generate_series(CAST(b.first AS TIMESTAMP), CAST(b.last AS TIMESTAMP),
                                        INTERVAL 1 DAY) AS d(day)
"""

_SCORED = """
SELECT event_type AS ticker, CAST(ts AS DATE) AS day,
       CASE user_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 ELSE -1 END AS score
FROM events
"""

_CLOSES = """
SELECT event_type AS ticker, CAST(ts AS DATE) AS day, avg(value) AS close
FROM events WHERE isodow(ts) <= 5 GROUP BY 1, 2
"""

_RETURNS = f"""
SELECT ticker, day, close, close / lag(close) OVER (PARTITION BY ticker ORDER BY day) - 1 AS ret
FROM ({_CLOSES}) c
"""

_ARTICLE_EVENTS = """
SELECT *, event_id // 10 AS aid FROM events
"""

_SENTIMENT_BAND = """
CASE WHEN value > 20 THEN 'positive' WHEN value > 10 THEN 'neutral'
     WHEN value > 1 THEN 'negative' END"""

_PAIRS = f"""
        sd AS (SELECT ticker, day, sum(score) AS s, count(*) AS n FROM ({_SCORED}) x GROUP BY 1, 2),
        px AS ({_CLOSES}),
        rt AS ({_RETURNS}),
        fut AS (SELECT ticker, day, lead(ret, 1) OVER (PARTITION BY ticker ORDER BY day) AS ret FROM rt),
        al AS (SELECT sd.ticker, sd.s, sd.n,
                      (SELECT min(px.day) FROM px WHERE px.ticker = sd.ticker AND px.day >= sd.day) AS tday
               FROM sd),
        roll AS (SELECT ticker, tday AS day, sum(s) / sum(n) AS avg_score
                 FROM al WHERE tday IS NOT NULL GROUP BY 1, 2),
        pairs AS (SELECT ticker, day, roll.avg_score AS x, fut.ret AS y
                  FROM roll JOIN fut USING (ticker, day)
                  WHERE roll.avg_score IS NOT NULL AND fut.ret IS NOT NULL)"""

ORACLE_SQL: dict[str, str] = {
    "scan_parquet": "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part",
    "json_parse_master": f"""
        SELECT {_MASTER_FROM_PART}, '2024-01-01T00:00:00Z' AS last_updated_utc FROM part""",
    "json_parse_bars": f"SELECT {_BAR_FROM_LINEITEM} FROM lineitem",
    "json_encode_rows": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "json_parse_props": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "envelope_flatten": """
        SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS date_time FROM events""",
    "news_flatten": f"""
        WITH ev AS ({_ARTICLE_EVENTS}),
        art AS (
            SELECT aid, 'article ' || aid AS article_title,
                   'publisher ' || (aid % 5) AS publisher,
                   CASE WHEN aid % 4 = 0 THEN NULL ELSE 'author ' || (aid % 13) END AS author,
                   strftime(min(ts), '%Y-%m-%d') AS publication_date,
                   string_agg(event_type, ',' ORDER BY event_id) AS related_ticker
            FROM ev GROUP BY aid)
        SELECT ev.event_type AS ticker, art.article_title, art.publisher, art.author,
               art.publication_date, {_SENTIMENT_BAND} AS sentiment, art.related_ticker
        FROM ev JOIN art USING (aid)
        WHERE ev.event_type IN ('click', 'view', 'purchase')""",
    "arrays_zip_explode": """
        SELECT event_id, event_type, CAST(ts AS DATE) AS day FROM events""",
    "parse_published": """
        SELECT event_id, 'good' AS variant, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS published_utc,
               CAST(ts AS DATE) AS publication_date, strftime(ts, '%Y-%m-%d') AS publication_day
        FROM events
        UNION ALL
        SELECT event_id, 'fractional', strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.123Z',
               CAST(NULL AS DATE), CAST(NULL AS VARCHAR)
        FROM events
        UNION ALL
        SELECT event_id, 'junk', 'junk-' || event_id, CAST(NULL AS DATE), CAST(NULL AS VARCHAR)
        FROM events""",
    "news_horizon": """
        SELECT event_id, user_id, event_type, value FROM events
        WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 20 DAY""",
    "filter_isin": """
        SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view', 'purchase')""",
    "filter_semi": """
        SELECT event_id, event_type FROM events
        WHERE event_type IN (SELECT event_type FROM events WHERE value > 400)""",
    "master_clean": f"SELECT DISTINCT {_MASTER_FROM_PART} FROM part",
    "master_latest": """
        SELECT CAST(p_partkey AS VARCHAR) AS ticker,
               CASE WHEN p_size > 25 THEN 'new ' || p_name ELSE p_name END AS name,
               p_brand AS market, 'us' AS locale, CAST(p_size AS VARCHAR) AS primary_exchange,
               p_type AS type, p_size > 25 AS active, 'usd' AS currency_name,
               lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS cik
        FROM part""",
    "dedup_full_row": "SELECT DISTINCT p_brand, p_type, p_size FROM part",
    "master_count": f"SELECT count(*) AS n_rows FROM (SELECT DISTINCT {_MASTER_FROM_PART} FROM part)",
    "enrich_batch": _ENRICHED,
    "stream_master_ingest": """
        SELECT CAST(s_suppkey AS VARCHAR) AS ticker, s_name AS name, 'stocks' AS market,
               'us' AS locale, 'X' || CAST(s_nationkey AS VARCHAR) AS primary_exchange,
               'CS' AS type, s_acctbal > 0 AS active, 'usd' AS currency_name,
               lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS cik,
               '2024-01-01T00:00:00Z' AS last_updated_utc
        FROM supplier""",
    "stream_enrich": _ENRICHED,
    "late_rows": """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, o_totalprice FROM orders
        WHERE CAST(o_orderdate AS DATE) > DATE '1998-01-31' - 7
          AND CAST(o_orderdate AS DATE) <= DATE '1998-01-31'""",
    "filter_after_cut": """
        SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_date, o_totalprice
        FROM orders WHERE CAST(o_orderdate AS DATE) > DATE '1998-01-31'""",
    "scan_month_range": """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS transaction_date,
               CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
        FROM orders
        WHERE year(o_orderdate) * 100 + month(o_orderdate) BETWEEN 200012 AND 200201""",
    "latest_partition": """
        SELECT CAST(year(max(o_orderdate)) AS INTEGER) AS year,
               CAST(month(max(o_orderdate)) AS INTEGER) AS month FROM orders""",
    "lake_cut_date": "SELECT CAST(max(o_orderdate) AS DATE) AS cut_date FROM orders",
    "cut_roundtrip": "SELECT CAST(max(o_orderdate) AS DATE) AS cut_date FROM orders",
    "table_overwrite": "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",
    "union_widen": "SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, p_retailprice FROM part",
    "incremental_load": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
               CAST(o_orderdate AS DATE) AS transaction_date, o_orderpriority
        FROM orders WHERE CAST(o_orderdate AS DATE) > DATE '1996-06-30'""",
    "incremental_rerun": f"""
        SELECT {_NULLABLE_ORDER}, CASE WHEN length(o_orderpriority) > 6 THEN 'o_orderpriority_too_long' END AS violations,
               CAST(1 AS BIGINT) AS n_cuts, (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) AS cut
        FROM orders WHERE CAST(o_orderdate AS DATE) > DATE '1996-06-30'""",
    "incremental_versions": f"""
        SELECT {_NULLABLE_ORDER} FROM (
            SELECT * FROM orders UNION SELECT * REPLACE ('X' AS o_orderstatus) FROM orders)
        WHERE CAST(o_orderdate AS DATE) > DATE '1996-06-30'""",
    "lake_backfill": _ENRICHED,
    "message_rejects": """
        WITH m AS (SELECT l_orderkey * 10 + l_linenumber AS mark, l_partkey, CAST(l_shipdate AS DATE) AS day FROM lineitem),
        r AS (SELECT *, CASE WHEN mark % 11 = 0 THEN 'malformed' WHEN mark % 13 = 0 THEN 'no_ticker'
                             WHEN mark % 17 = 0 THEN 'malformed' WHEN l_partkey IS NULL THEN 'no_ticker' WHEN day IS NULL THEN 'no_day' END AS reason,
                     CASE WHEN mark % 11 = 0 THEN '{"T":"' || mark || '","v":' WHEN mark % 13 = 0 THEN '{"t":' || mark || '}'
                          WHEN mark % 17 = 0 THEN '{"T":"1","date_time":"' || mark || 'th"}' END AS value FROM m)
        SELECT 'message' AS kind, reason, value, count(*) AS n_rows FROM r WHERE reason IS NOT NULL GROUP BY ALL
        UNION ALL
        SELECT 'route', CASE WHEN reason IS NOT NULL THEN 'rejected' WHEN day <= DATE '2000-12-31' THEN 'before_cut'
                             WHEN p_partkey IS NULL THEN 'unmatched' ELSE 'lake' END AS route, NULL, count(*)
        FROM r LEFT JOIN part ON l_partkey = p_partkey AND p_partkey % 3 <> 0 GROUP BY ALL""",
    "unmatched_replay": _ENRICHED,
    "daily_run_late": f"SELECT DISTINCT * EXCLUDE (year, month) FROM ({_WITH_MASTER}WHERE l_shipdate IS NOT NULL)",
    "day_calendar": _DAYS,
    "calendar_gaps": f"""
        SELECT day FROM ({_DAYS}) c
        WHERE day NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderdate IS NOT NULL)""",
    "month_calendar": f"""
        SELECT CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month,
               'lake/year=' || year(m) || '/month=' || month(m) AS path
        FROM {_ORDER_BOUNDS} b,
             generate_series(CAST(date_trunc('month', b.first) AS TIMESTAMP),
                             CAST(date_trunc('month', b.last) AS TIMESTAMP), INTERVAL 1 MONTH) AS s(m)""",
    "decode_cut_token": "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS cut_date FROM orders",
    "contract_split": """
        WITH d AS (
            SELECT text IS NULL AS text_null, coalesce(length(text) > 255, false) AS text_too_long,
                   lang IS NULL AS lang_null, coalesce(length(lang) > 10, false) AS lang_too_long,
                   source IS NULL AS source_null, coalesce(length(source) > 10, false) AS source_too_long
            FROM documents),
        c AS (
            SELECT c_name IS NULL AS c_name_null, coalesce(length(c_name) > 255, false) AS c_name_too_long,
                   c_mktsegment IS NULL AS c_mktsegment_null,
                   coalesce(length(c_mktsegment) > 10, false) AS c_mktsegment_too_long
            FROM customer)
        SELECT 'documents' AS table_name, rule, n_rows FROM (
            SELECT count(*) FILTER (WHERE text_null) AS text_null,
                   count(*) FILTER (WHERE text_too_long) AS text_too_long,
                   count(*) FILTER (WHERE lang_null) AS lang_null,
                   count(*) FILTER (WHERE lang_too_long) AS lang_too_long,
                   count(*) FILTER (WHERE source_null) AS source_null,
                   count(*) FILTER (WHERE source_too_long) AS source_too_long,
                   count(*) FILTER (WHERE NOT (text_null OR text_too_long OR lang_null OR lang_too_long
                                               OR source_null OR source_too_long)) AS valid
            FROM d) UNPIVOT (n_rows FOR rule IN (text_null, text_too_long, lang_null, lang_too_long,
                                                 source_null, source_too_long, valid))
        UNION ALL
        SELECT 'customer' AS table_name, rule, n_rows FROM (
            SELECT count(*) FILTER (WHERE c_name_null) AS c_name_null,
                   count(*) FILTER (WHERE c_name_too_long) AS c_name_too_long,
                   count(*) FILTER (WHERE c_mktsegment_null) AS c_mktsegment_null,
                   count(*) FILTER (WHERE c_mktsegment_too_long) AS c_mktsegment_too_long,
                   count(*) FILTER (WHERE NOT (c_name_null OR c_name_too_long OR c_mktsegment_null
                                               OR c_mktsegment_too_long)) AS valid
            FROM c) UNPIVOT (n_rows FOR rule IN (c_name_null, c_name_too_long, c_mktsegment_null,
                                                 c_mktsegment_too_long, valid))""",
    "contract_rejects": """
        SELECT doc_id, violations FROM (
            SELECT doc_id, concat_ws(',',
                CASE WHEN text IS NULL THEN 'text_null' END,
                CASE WHEN length(text) > 255 THEN 'text_too_long' END,
                CASE WHEN lang IS NULL THEN 'lang_null' END,
                CASE WHEN length(lang) > 10 THEN 'lang_too_long' END,
                CASE WHEN source IS NULL THEN 'source_null' END,
                CASE WHEN length(source) > 10 THEN 'source_too_long' END) AS violations
            FROM documents) WHERE violations <> ''""",
    "next_trading_day": """
        WITH sd AS (SELECT DISTINCT event_type AS ticker, CAST(ts AS DATE) AS day FROM events),
        px AS (SELECT DISTINCT event_type AS ticker, CAST(ts AS DATE) AS day FROM events
               WHERE isodow(ts) <= 5)
        SELECT ticker, day,
               (SELECT min(px.day) FROM px WHERE px.ticker = sd.ticker AND px.day >= sd.day) AS next_trade
        FROM sd""",
    "sentiment_daily": f"""
        SELECT ticker, day, count(*) AS n_articles, round(avg(score), 6) AS avg_score
        FROM ({_SCORED}) s GROUP BY ticker, day""",
    "daily_return": f"""
        SELECT ticker, day, round(close, 6) AS close, round(ret, 6) AS ret FROM ({_RETURNS}) r""",
    "sentiment_price_corr": f"""
        WITH {_PAIRS}
        SELECT ticker, count(*) AS n_pairs,
               round(CASE WHEN count(*) > 1 AND min(x) < max(x) AND min(y) < max(y)
                          THEN covar_pop(x, y) / nullif(stddev_pop(x) * stddev_pop(y), 0) END, 6) AS corr
        FROM pairs GROUP BY ticker""",
    "rolling_sentiment_corr": f"""
        WITH {_PAIRS},
        p AS (SELECT ticker, day, round(x, 9) AS x, round(y, 9) AS y FROM pairs)
        SELECT ticker, day, count(*) OVER w AS n_pairs,
               round(CASE WHEN count(*) OVER w > 1 AND min(x) OVER w < max(x) OVER w AND min(y) OVER w < max(y) OVER w
                          THEN covar_pop(x, y) OVER w / (stddev_pop(x) OVER w * stddev_pop(y) OVER w) END, 6) AS corr
        FROM p WINDOW w AS (PARTITION BY ticker ORDER BY day RANGE BETWEEN INTERVAL 9 DAYS PRECEDING AND CURRENT ROW)""",
}


# Published rows keep the contract; the others are marked with what they break.
ORACLE_SQL["publish_articles"] = f"""
    SELECT *, CASE WHEN sentiment IS NULL THEN 'sentiment_null' END AS violations
    FROM ({ORACLE_SQL['news_flatten']})"""
ORACLE_SQL["news_stream"] = ORACLE_SQL["news_flatten"]
