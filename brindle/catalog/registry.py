"""Registration of queries, and the shared parts of the checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from brindle.functions.hashing import HASH_BITS, PRIME, lane_numbers

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``; ``oracle`` is SQL that must agree with it."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


# The bindings of brindle.datasets in the SQL of the checking engine.
_CTES = {
    "k_events": """
        k_events AS (
            SELECT *, TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events
        )""",
    "visit": """
        visit AS (
            SELECT strftime(ts, '%Y-%m-%d') AS date, user_id,
                   CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d') AS session_id,
                   event_id % 50 AS page_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS action_time,
                   CASE WHEN event_type = 'error' THEN 'word ' || CAST(k AS VARCHAR) END AS search_keyword,
                   CASE WHEN event_type = 'view' THEN event_id % 1000 END AS click_product_id,
                   CASE WHEN event_type = 'click'
                        THEN [CAST(event_id % 1000 AS VARCHAR), CAST(k AS VARCHAR)] END AS order_product_ids,
                   CASE WHEN event_type = 'purchase' THEN [CAST(event_id % 1000 AS VARCHAR)] END AS pay_product_ids,
                   CAST(user_id % 27 AS VARCHAR) AS city_id,
                   CASE WHEN event_type = 'view' THEN CAST(k AS VARCHAR) END AS click_category_id,
                   CASE WHEN event_type = 'click'
                        THEN [CAST(k AS VARCHAR), CAST((k + 1) % 100 AS VARCHAR)] END AS order_category_ids,
                   CASE WHEN event_type = 'purchase' THEN [CAST(k AS VARCHAR)] END AS pay_category_ids
            FROM k_events
        )""",
    "action": """
        action AS (
            SELECT click_category_id AS category_id, 'click' AS action FROM visit WHERE click_category_id IS NOT NULL
            UNION ALL
            SELECT unnest(order_category_ids), 'order' FROM visit
            UNION ALL
            SELECT unnest(pay_category_ids), 'pay' FROM visit
        )""",
    "category": """
        category AS (
            SELECT category_id,
                   CAST(count(*) FILTER (action = 'click') AS BIGINT) AS clicks,
                   CAST(count(*) FILTER (action = 'order') AS BIGINT) AS orders,
                   CAST(count(*) FILTER (action = 'pay') AS BIGINT) AS pays
            FROM action GROUP BY category_id
        )""",
    "doc_line": """
        doc_line AS (
            SELECT unnest(string_split(text, chr(10))) AS value FROM documents
        )""",
    "doc_word": """
        doc_word AS (
            SELECT unnest(CASE WHEN value = '' THEN ['']
                               WHEN rtrim(value, ' ') = '' THEN CAST([] AS VARCHAR[])
                               ELSE string_split(rtrim(value, ' '), ' ') END) AS word
            FROM doc_line
        )""",
    "sale_course": """
        sale_course AS (
            SELECT p_partkey AS courseid, p_name AS coursename, p_type AS status,
                   CAST(p_size AS BIGINT) AS pointlistid, p_partkey % 25 AS majorid, p_partkey % 12 AS chapterid,
                   'chapter ' || CAST(p_partkey % 12 AS VARCHAR) AS chaptername, p_partkey % 7 AS edusubjectid,
                   'subject ' || CAST(p_partkey % 7 AS VARCHAR) AS edusubjectname, p_partkey % 100 AS teacherid,
                   'teacher ' || CAST(p_partkey % 100 AS VARCHAR) AS teachername, p_brand AS coursemanager,
                   CAST(p_retailprice AS DECIMAL(18,2)) AS money, dt, dn
            FROM part
            CROSS JOIN (VALUES ('d0'), ('d1'), ('d2')) d(dt)
            CROSS JOIN (VALUES ('webA'), ('webB')) s(dn)
        )""",
    "cart": """
        cart AS (
            SELECT l_partkey AS courseid, l_orderkey AS orderid,
                   'course ' || CAST(l_partkey AS VARCHAR) AS coursename,
                   l_discount AS cart_discount, CAST(l_extendedprice AS DECIMAL(18,2)) AS sellmoney,
                   strftime(l_shipdate, '%Y-%m-%d') AS cart_createtime,
                   'd' || CAST(l_orderkey % 4 AS VARCHAR) AS dt,
                   CASE WHEN l_orderkey % 3 = 0 THEN 'webA' ELSE 'webB' END AS dn
            FROM lineitem
        )""",
    "pay": """
        pay AS (
            SELECT CASE WHEN o_orderstatus = 'F' THEN o_orderkey ELSE -1 - o_orderkey END AS orderid,
                   o_orderpriority AS pay_discount,
                   CAST(o_totalprice AS DECIMAL(18,2)) AS paymoney,
                   strftime(o_orderdate, '%Y-%m-%d') AS pay_createtime,
                   'd' || CAST(o_orderkey % 4 AS VARCHAR) AS dt,
                   CASE WHEN o_orderkey % 3 = 0 THEN 'webA' ELSE 'webB' END AS dn
            FROM orders
        )""",
    # Days d0 and d2 renewed, a new day d9, and what else was there gone stale.
    "renewed_cart": """
        renewed_cart AS (
            SELECT courseid, orderid, CASE WHEN dt IN ('d0', 'd2') THEN coursename ELSE 'stale' END AS coursename,
                   cart_discount, sellmoney, cart_createtime, dt, dn FROM cart
            UNION ALL
            SELECT courseid, orderid, coursename, cart_discount, sellmoney, cart_createtime, 'd9', dn FROM cart
            WHERE dt = 'd3' AND dn = 'webA'
        )""",
}
_NEEDS = {"renewed_cart": ("cart",), "visit": ("k_events",), "action": ("visit",), "category": ("action",), "doc_word": ("doc_line",)}


def with_ctes(names: str, body: str) -> str:
    """``body`` behind the named bindings and what they build on."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, ()):
            add(needed)
        if name not in wanted:
            wanted.append(name)

    for name in names.split():
        add(name)
    return "WITH " + ",".join(_CTES[name] for name in wanted) + "\n" + body


def sql_hash(value: str, seed: int = 0) -> str:
    """``functions.seeded_hash`` in the SQL of the checking engine."""
    text = f"'{seed}:' || COALESCE(CAST({value} AS VARCHAR), '')"
    return f"CAST('0x' || substr(md5({text}), 1, {HASH_BITS // 4}) AS BIGINT)"


def sql_integer_hash(value: str, seed: int = 0) -> str:
    """``functions.integer_hash`` in the SQL of the checking engine."""
    number = f"CAST(COALESCE({value}, 0) AS BIGINT)"
    above = f"(({number} - ({number} & {PRIME})) // {PRIME + 1})"
    low, middle, high = f"({number} & {PRIME})", f"({above} & {PRIME})", f"((({above} - ({above} & {PRIME})) // {PRIME + 1}) & 3)"
    lanes = []
    for lane in (0, 1):
        one, two, *factors = lane_numbers(seed, lane)
        x = f"(({low} + ({middle} * {one}) % {PRIME} + {high} * {two}) % {PRIME})"
        made = f"CAST({factors[0]} AS BIGINT)"
        for factor in factors[1:]:
            made = f"(({made} * {x} + {factor}) % {PRIME})"
        lanes.append(made)
    return f"({lanes[0]} * {1 << (HASH_BITS - 31)} + ({lanes[1]} >> {62 - HASH_BITS}))"


def sql_bucket(value: str, buckets: int | str, seed: int = 0) -> str:
    """``functions.bucket_of`` of a whole number in the SQL of the checking engine."""
    return f"CASE WHEN {value} IS NULL THEN 0 ELSE {sql_integer_hash(value, seed)} % CAST({buckets} AS BIGINT) END"
