"""DuckDB SQL for every registered query, written against the test tables alone."""

from __future__ import annotations

_DAY = "l_shipdate >= TIMESTAMP '1998-03-16' AND l_shipdate < TIMESTAMP '1998-03-17'"
_MONEY = "CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2))"
_ITEMS = "CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT)"


def _top(keys: str, names: str, first: str, second: str | None, limit: int) -> str:
    measures = f"{_MONEY} AS {first}" + (f", {_ITEMS} AS {second}" if second else "")
    return f"""
        SELECT {names}, {measures}
        FROM lineitem JOIN part ON l_partkey = p_partkey
        WHERE {_DAY}
        GROUP BY {keys} HAVING {_MONEY} > 0
        ORDER BY {first} DESC, {keys} LIMIT {limit}"""


_AMOUNT = f"SELECT {_MONEY} AS total_amount FROM lineitem WHERE {_DAY}"
_NEW = f"SELECT count(*) AS new_count FROM lineitem WHERE {_DAY}"
_GMV = """
    SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS order_amount
    FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1996-09-17'"""
_TM = _top("p_brand", "p_brand AS tm", "total_amount", "pro_cnt", 10)
_SPU = _top("p_partkey, p_name", "p_partkey AS spu_id, p_name AS spu_name", "order_amount", "order_ct", 10)
_CATEGORY = _top("p_type", "p_type AS category3_id, lower(p_type) AS category3_name", "order_amount", None, 4)
_TRADEMARK = _top("p_brand", "p_brand AS tm_id, lower(p_brand) AS tm_name", "order_amount", None, 20)


def _scalar(figure: str, column: str) -> str:
    return f"""
        SELECT '{{"status":0,"data":' || coalesce(CAST({column} AS VARCHAR), 'null') || '}}' AS json
        FROM ({figure})"""


def _table(ranking: str, heads: str, row: str, order: str) -> str:
    return f"""
        SELECT '{{"status":0,"data":{{"columns":[{heads}],"rows":['
            || coalesce(string_agg({row}, ',' ORDER BY {order}), '') || ']}}}}' AS json
        FROM ({ranking})"""


def _heads(*columns: tuple[str, str]) -> str:
    return ",".join(f'{{"name":"{name}","id":"{i}"}}' for name, i in columns)


_BRAND_HEADS = _heads(("商品名称", "tm"), ("品牌交易额", "total_amount"), ("订单数", "pro_cnt"))
_BRAND_ROW = """
    '{"tm":"' || tm || '","total_amount":' || total_amount || ',"pro_cnt":' || pro_cnt || '}'"""

# One event per change record; the row image of a delete is the older one.
_EVENT_COLUMNS = """
    event_id, user_id, CASE WHEN event_id % 4 = 3 THEN value - 1 ELSE value END AS value, props,
    CASE WHEN event_id % 2 = 0 THEN 'n' END AS note"""
_EVENT_TYPE = """
    CASE event_id % 4 WHEN 0 THEN 'insert' WHEN 1 THEN 'read' WHEN 2 THEN 'update' ELSE 'delete' END"""
_FLAT = f"""
    SELECT 'shop' AS "database", event_type AS "table", {_EVENT_TYPE} AS type, {_EVENT_COLUMNS},
        CAST(7 + CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END AS INTEGER) AS n_keys
    FROM events"""

_DIMS = """
    SELECT (CASE WHEN c_custkey % 3 = 0 THEN 'idle_' ELSE 'shop_' END) || c_custkey AS "database",
        'g2-' || c_custkey AS guid,
        CASE WHEN c_custkey % 2 = 0 THEN 't2-' || c_custkey END AS tenantid
    FROM customer"""
_ENRICHED = f"""
    SELECT coalesce(guid, f."database") AS "database", tenantid, o_orderkey AS order_id,
        'orders' AS "table", 'insert' AS type
    FROM (SELECT o_orderkey,
              CASE WHEN o_orderkey % 17 <> 0 THEN 'shop_' || o_custkey END AS "database"
          FROM orders) f
    LEFT JOIN ({_DIMS}) d ON f."database" = d."database" """


_CAPTURED = f"""
    SELECT o_orderstatus AS "table", coalesce(guid, 'shop_' || o_custkey) AS "database", tenantid,
        o_orderkey AS order_id, o_orderpriority AS "Name", 'insert' AS type
    FROM orders LEFT JOIN ({_DIMS}) d ON 'shop_' || o_custkey = d."database" """


def _dotted(n: str) -> str:
    return " || '.' || ".join(f"((({n}) >> {s}) & 255)" for s in (24, 16, 8, 0))


_IPS = f"""
    SELECT o_orderkey,
        CASE o_orderkey % 3
            WHEN 0 THEN {_dotted('(o_custkey % 1048576) * 2048 + (o_orderkey * 37) % 2048')}
            WHEN 1 THEN {_dotted('2147483648 + (o_custkey % 8192) * 262144 + (o_orderkey * 977) % 262144')}
            ELSE CASE o_custkey % 3 WHEN 0 THEN '999.1.0.300' WHEN 1 THEN 'host' || o_custkey END
        END AS ip
    FROM orders"""
_NUMBERS = f"""
    SELECT o_orderkey, ip,
        CASE WHEN ip IS NULL THEN NULL
             WHEN regexp_full_match(ip, '[0-9]{{1,3}}(\\.[0-9]{{1,3}}){{3}}') THEN
                ((((((CAST(split_part(ip, '.', 1) AS BIGINT) << 8)
                    | CAST(split_part(ip, '.', 2) AS BIGINT)) << 8)
                    | CAST(split_part(ip, '.', 3) AS BIGINT)) << 8)
                    | CAST(split_part(ip, '.', 4) AS BIGINT))
             ELSE 0 END AS number
    FROM ({_IPS})"""
_LOCATION = f"""
    WITH ranges AS (
        SELECT lo, lo + span AS hi, max(location) AS location FROM (
            SELECT (p_partkey % 1048576) * 2048 AS lo, 1500 AS span,
                p_name || ',' || p_brand || ',city,isp' AS location FROM part
            UNION ALL
            SELECT 2147483648 + (s_suppkey % 8192) * 262144, 150000,
                s_name || ',' || s_nationkey || ',city,isp' FROM supplier)
        GROUP BY lo, span)
    SELECT o_orderkey, ip,
        CASE WHEN ip IS NULL THEN '请传入一个ip' ELSE coalesce(location, 'Other IDC') END AS location
    FROM ({_NUMBERS}) LEFT JOIN ranges ON number BETWEEN lo AND hi"""

_FACTS = """
    SELECT l_orderkey || '-' || l_linenumber AS id,
        CASE WHEN l_linenumber % 3 <> 0 THEN CAST(round(l_extendedprice * 100) AS BIGINT) ELSE 0 END
            AS total_amount,
        CASE WHEN l_linenumber % 2 = 0 THEN l_returnflag END AS is_new,
        CASE WHEN l_linenumber % 4 <> 0 THEN CAST(l_quantity AS BIGINT) ELSE 0 END AS pro_cnt,
        l_linestatus AS tm
    FROM lineitem"""

_ORDER_ID = "CASE WHEN o_custkey % 11 <> 0 THEN CAST(o_orderkey AS VARCHAR) END"

_LINES = """
    SELECT event_type || ':' || user_id || ':' || event_type
        || CASE WHEN event_id % 5 = 0 THEN '::' ELSE '' END AS value FROM events"""


_NUMBERED_LINES = _LINES.replace("AS value", "AS value, event_id")
_UNUSABLE = "(o_orderkey % 7 = 0 OR o_orderkey % 5 = 0)"
_UNUSABLE_TEXT = """
    CASE WHEN o_orderkey % 7 = 0 THEN 'no json'
        WHEN o_orderkey % 5 = 0 THEN '{"source":{"db":"shop"}}' END"""

_WALK = """
    WITH RECURSIVE walk(id, path, up) AS (
        SELECT p_partkey, CAST(p_partkey AS VARCHAR),
            CASE WHEN p_partkey > 0 AND p_partkey % 5 <> 0 THEN p_partkey // 2 END
        FROM part
        UNION ALL
        SELECT id, path || ',' || up, CASE WHEN up > 0 THEN up // 2 END
        FROM walk WHERE up IS NOT NULL)"""


def _words(lines: str, delimiter: str) -> str:
    return f"""
        SELECT word, count(*) AS n FROM (
            SELECT unnest(CASE WHEN line <> '' AND rtrim(line, '{delimiter}') = '' THEN []
                ELSE string_split(rtrim(line, '{delimiter}'), '{delimiter}') END) AS word
            FROM ({lines}))
        GROUP BY word"""


def _doc_lines(text: str) -> str:
    return f"SELECT unnest(string_split_regex({text}, '\\r\\n|\\r|\\n')) AS line FROM documents"


_LANDED = """
    SELECT event_type AS "table", CAST(CAST(ts AS DATE) AS VARCHAR) AS dt, event_id, value,
        CASE WHEN event_id % 3 <> 0 THEN CAST(event_id * 1000 AS VARCHAR) END AS changed,
        CAST(NULL AS VARCHAR) AS body_table,
        CAST(CASE WHEN event_id % 3 <> 0 THEN 3 ELSE 2 END AS INTEGER) AS n_keys
    FROM events"""
_EVENT = f"""
    SELECT 'shop' AS "database", event_type AS "table", {_EVENT_TYPE} AS type, {_EVENT_COLUMNS}
    FROM events"""

ALL = {
    "tm_amount_topk": _TM,
    "amount_by_day": _AMOUNT,
    "new_count_by_day": _NEW,
    "gmv_by_day": _GMV,
    "spu_topk": _SPU,
    "category3_topk": _CATEGORY,
    "trademark_topk": _TRADEMARK,
    "report_amount": _scalar(_AMOUNT, "total_amount"),
    "report_new": _scalar(_NEW, "new_count"),
    "report_gmv": _scalar(_GMV, "order_amount"),
    "report_brands": _table(
        _TM,
        _BRAND_HEADS,
        _BRAND_ROW,
        "total_amount DESC, tm",
    ),
    "report_products": _table(
        _SPU,
        _heads(("商品名称", "spu_name"), ("交易额", "order_amount"), ("订单数", "order_ct")),
        """'{"spu_name":"' || spu_name || '","order_amount":' || order_amount || ',"order_ct":'
            || order_ct || '}'""",
        "order_amount DESC, spu_id, spu_name",
    ),
    "report_categories": f"""
        SELECT '{{"status":0,"data":[' || coalesce(string_agg(
            '{{"name":"' || category3_name || '","value":' || order_amount || '}}', ','
            ORDER BY order_amount DESC, category3_id), '') || ']}}' AS json
        FROM ({_CATEGORY})""",
    "report_trademarks": f"""
        SELECT '{{"status":0,"data":{{"categories":['
            || coalesce(string_agg('"' || tm_name || '"', ',' ORDER BY order_amount DESC, tm_id), '')
            || '],"series":[{{"data":['
            || coalesce(string_agg(CAST(order_amount AS VARCHAR), ',' ORDER BY order_amount DESC, tm_id), '')
            || ']}}]}}}}' AS json
        FROM ({_TRADEMARK})""",
    "cdc_flat": _FLAT,
    "cdc_nested": f"""
        SELECT 'shop-dbo' AS "database", event_type AS "table", {_EVENT_TYPE} AS type, {_EVENT_COLUMNS}
        FROM events""",
    "cdc_collision": """
        SELECT CASE event_id % 3 WHEN 0 THEN 'C' WHEN 2 THEN 'shop' END AS "database",
            'T' AS "table", 'insert' AS type, event_id,
            CAST(CASE WHEN event_id % 3 = 1 THEN 3 ELSE 4 END AS INTEGER) AS n_keys
        FROM events""",
    "cdc_quarantine": """
        SELECT CAST(event_id AS VARCHAR) AS key,
            CASE WHEN event_id % 2 = 0 THEN 'kept' ELSE 'aside' END AS state
        FROM events""",
    "snapshot_and_changes": f"""
        SELECT 'shop' AS "database", 'events' AS "table", 'read' AS type, event_id, user_id, value,
            props, NULL AS note, CAST(7 AS INTEGER) AS n_keys
        FROM events UNION ALL {_FLAT}""",
    "changes_of_two_tables": f"{_FLAT} WHERE event_type IN ('click', 'view')",
    "changes_of_server": _FLAT,
    "dimension_latest": _DIMS,
    "dimension_deletes": """
        SELECT 'shop_' || c_custkey AS "database", 'g-' || c_name AS guid
        FROM customer WHERE c_custkey % 4 <> 0""",
    "enrich_two_key": _ENRICHED,
    "enrich_one_key": """
        SELECT coalesce('g-' || n_name, 'db_' || c_nationkey) AS "database", c_custkey AS cust_id,
            'customer' AS "table"
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "enrich_columns": f"""
        SELECT o_orderkey, coalesce(guid, 'shop_' || o_custkey) AS "database", tenantid AS dim_tenantid
        FROM orders LEFT JOIN ({_DIMS}) d ON 'shop_' || o_custkey = d."database" """,
    "dimension_stream": _DIMS,
    "enrich_stream": _ENRICHED,
    "union_sources": """
        SELECT 'customer' AS source, c_custkey AS id FROM customer
        UNION ALL SELECT 'supplier', s_suppkey FROM supplier
        UNION ALL SELECT 'orders', o_orderkey FROM orders
        UNION ALL SELECT 'supplier', s_suppkey FROM supplier""",
    "ip_number": _NUMBERS,
    "ip_location": _LOCATION,
    "ip_location_large": _LOCATION,
    "parent_path": f"""
        {_WALK}
        SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS id,
            coalesce(path, CAST(l_partkey AS VARCHAR)) AS path
        FROM lineitem LEFT JOIN (SELECT id, path FROM walk WHERE up IS NULL) w ON l_partkey = w.id""",
    "id_projection": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS key,
            coalesce('{{"id":"' || {_ORDER_ID} || '"}}', '{{}}') AS body
        FROM orders""",
    "id_suffix": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS key,
            '{{"id":"' || coalesce({_ORDER_ID}, 'null') || 'f"}}' AS body
        FROM orders""",
    "flatten_projection": f"""
        SELECT 'shop-dbo' AS "database", {_ORDER_ID} AS id, CAST(o_custkey AS INTEGER) AS age,
            o_orderpriority AS name, 'insert' AS type, 'orders' AS "table"
        FROM orders""",
    "typed_rows": f"SELECT *, '2024-01-02 03:04:05' AS date FROM ({_FACTS})",
    "typed_rows_of_text": f"SELECT *, '2024-01-02 03:04:05' AS date FROM ({_FACTS})",
    "positional_insert": f"""
        SELECT id AS c_id, total_amount AS c_amount, is_new AS c_new, pro_cnt AS c_count, tm AS c_tm
        FROM ({_FACTS})""",
    "rewrite_event": """
        SELECT CASE WHEN event_id % 3 <> 0 THEN CAST(event_id * 1000 AS VARCHAR)
                ELSE '1704164645000' END AS head_time,
            event_type AS head_table, event_id, value, CAST(NULL AS VARCHAR) AS body_table,
            CASE WHEN event_id % 3 <> 0 THEN CAST(event_id * 1000 AS VARCHAR) END AS body_time
        FROM events""",
    "drop_transient": "SELECT s_suppkey, s_name, s_nationkey FROM supplier",
    "column_value_lists": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS key,
            CASE WHEN {_ORDER_ID} IS NULL THEN '``' ELSE '`id`' END AS columns,
            '''' || coalesce({_ORDER_ID}, '') || '''' AS vals
        FROM orders""",
    "source_list": """
        SELECT 'h' || s_suppkey AS ip, CAST(1433 + s_nationkey AS INTEGER) AS port,
            'db' || s_nationkey AS db, 'dbo.T' || s_suppkey AS tb, 'u' AS "user", 'p' AS pwd
        FROM supplier, (VALUES (1), (2)) AS twice(n)""",
    "word_counts": _words(
        _doc_lines("regexp_replace(text, '(\\r\\n|\\r|\\n)$', '')") + " WHERE text <> ''", " "
    ),
    "word_counts_of_files": _words(_doc_lines("text"), " "),
    "word_pairs": f"""
        SELECT '(' || word || ',1)' AS line, n FROM ({_words(f"SELECT value AS line FROM ({_LINES})", ":")})""",
    "token_lists": f"""
        SELECT value, CAST(3 AS INTEGER) AS n, replace(rtrim(value, ':'), ':', '|') AS parts
        FROM ({_LINES})""",
    "colon_count_stream": """
        SELECT CAST(event_id % 5 AS INTEGER) AS batch, word, count(*) AS n FROM (
            SELECT event_id, unnest([event_type, CAST(user_id AS VARCHAR), event_type]) AS word FROM events)
        GROUP BY ALL""",
    "tail_to_messages": f"""
        SELECT 'log' AS topic, value, count(*) AS n FROM ({_LINES}) GROUP BY value""",
    "land_by_table": _LANDED,
    "land_stream": _LANDED,
    "capture_enrich_land": _CAPTURED,
    "capture_stream_to_files": _CAPTURED,
    "capture_stream_to_report": _table(
        f"""SELECT tm, CAST(sum(total_amount) AS BIGINT) AS total_amount,
            CAST(sum(pro_cnt) AS BIGINT) AS pro_cnt
        FROM ({_FACTS}) GROUP BY tm HAVING sum(total_amount) > 0
        ORDER BY total_amount DESC, tm LIMIT 10""",
        _BRAND_HEADS,
        _BRAND_ROW,
        "total_amount DESC, tm",
    ),
    "append_dynamic": """
        SELECT 'shop' AS "database", 'customer' AS "table", 'read' AS type, c_custkey AS id,
            c_name AS name, CAST(NULL AS DOUBLE) AS balance, c_nationkey AS nation
        FROM customer
        UNION ALL
        SELECT 'shop', 'supplier', 'read', s_suppkey, NULL, s_acctbal, NULL FROM supplier""",
    "topic_by_table": f"""
        SELECT "table" AS topic, CAST(event_id AS VARCHAR) AS key, * FROM ({_EVENT})""",
    "figures_of_table": f"""
        SELECT 'amount' AS figure, total_amount AS value FROM ({_AMOUNT})
        UNION ALL SELECT 'new', CAST(new_count AS DECIMAL(18,2)) FROM ({_NEW})""",
    "streams_per_source": _FLAT,
    "union_of_source_list": _FLAT,
    "parent_paths_of_table": f"""
        {_WALK}
        SELECT CAST(id AS VARCHAR) AS id, path FROM walk
        WHERE up IS NULL AND id > 0 AND id % 5 <> 0""",
    "running_count_stream": _words(f"SELECT value AS line FROM ({_LINES})", ":"),
    "append_dynamic_stream": """
        SELECT 'shop' AS "database", 'customer' AS "table", 'read' AS type, c_custkey AS id,
            c_name AS name, CAST(NULL AS DOUBLE) AS balance
        FROM customer
        UNION ALL
        SELECT 'shop', 'supplier', 'read', s_suppkey, NULL, s_acctbal FROM supplier""",
    "fan_out_sinks": f"""
        SELECT e.*, sink FROM ({_EVENT}) e, (VALUES ('rows'), ('text')) AS sinks(sink)""",
    "cdc_repeated_keys": """
        SELECT 'T' AS "table", o_orderkey AS order_id, o_custkey AS n FROM orders""",
    "capture_quarantine": f"""
        SELECT CASE WHEN {_UNUSABLE} THEN 'aside' ELSE 'kept' END AS state,
            CASE WHEN {_UNUSABLE} THEN '_unusable' ELSE o_orderstatus END AS "table",
            CAST(o_orderkey AS VARCHAR) AS key, {_UNUSABLE_TEXT} AS value
        FROM orders""",
    "facts_quarantine": f"""
        SELECT CASE WHEN {_UNUSABLE} THEN 'aside' ELSE 'kept' END AS state, count(*) AS n
        FROM orders GROUP BY ALL""",
    "malformed_envelopes_land": f"""
        SELECT CASE WHEN order_id % 9 = 0 THEN 'unknow-source' ELSE "table" END AS "table",
            CASE WHEN order_id % 9 <> 0 THEN "database" END AS "database",
            CASE WHEN order_id % 9 <> 0 THEN order_id END AS order_id,
            CASE WHEN order_id % 9 = 0 THEN 'broken ' || order_id END AS text
        FROM ({_ENRICHED})""",
    "typed_rows_malformed": """
        SELECT CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 5 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS id,
            CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 5 <> 0 THEN CAST(5 AS BIGINT) END AS total_amount,
            CASE WHEN o_orderkey % 7 = 0 THEN 'no json' WHEN o_orderkey % 5 = 0 THEN '{"type":"insert"}' END AS aside
        FROM orders""",
    "ip_location_overlap": f"""
        WITH ranges AS (
            SELECT lo + gap AS lo, lo + gap + span AS hi, kind || '-' || s_suppkey AS location
            FROM (SELECT s_suppkey, 2147483648 + (s_suppkey % 8192) * 262144 AS lo FROM supplier),
                (VALUES (0, 262143, 'wide'), (60000, 20000, 'inner'), (65000, 1000, 'deep')) AS k(gap, span, kind)
            UNION ALL
            SELECT (p_partkey % 1048576) * 2048, (p_partkey % 1048576) * 2048 + 1500, 'part-' || p_partkey
            FROM part),
        hits AS (
            SELECT o_orderkey, arg_max(location, lo) AS location
            FROM ({_NUMBERS}) JOIN ranges ON number BETWEEN lo AND hi GROUP BY o_orderkey)
        SELECT n.o_orderkey, ip,
            CASE WHEN ip IS NULL THEN '请传入一个ip' ELSE coalesce(location, 'Other IDC') END AS location
        FROM ({_NUMBERS}) n LEFT JOIN hits ON n.o_orderkey = hits.o_orderkey""",
    "enrich_large": _ENRICHED,
    "dimension_of_changes": """
        SELECT 'shop_' || c_custkey AS "database",
            CASE WHEN c_custkey % 2 = 0 THEN 'g2-' ELSE 'g1-' END || c_custkey AS guid,
            CASE WHEN c_custkey % 3 <> 0 THEN 't-' || c_custkey END AS tenantid
        FROM customer""",
    "clock_texts": """
        SELECT event_id, CAST(20240102 AS INTEGER) AS today, '1704164645000' AS millis,
            strftime(ts, '%Y-%m-%d-%H') AS hour
        FROM events""",
    "payload_texts": f"SELECT value, event_id FROM ({_NUMBERED_LINES})",
    "restarted_stream": f"SELECT value, event_id FROM ({_NUMBERED_LINES})",
    "dataset_controls": """
        SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10""",
}
