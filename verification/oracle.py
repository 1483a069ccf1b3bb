"""The same results as plain SQL over the given tables.

Written from the table definitions, not from the operators: each query is a
chain of common table expressions, assembled from the named parts below.
"""

from __future__ import annotations

# name -> (parts it reads, definition)
PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "customer_cells": (
        (),
        """
        SELECT c_custkey AS customer_id,
               CASE WHEN c_acctbal >= -700 THEN 'Customer' END AS first_name,
               split_part(c_name, '#', 2) AS last_name,
               CASE WHEN c_acctbal BETWEEN 0 AND 299.99 THEN NULL
                    WHEN c_acctbal BETWEEN 300 AND 599.99 THEN '  '
                    ELSE 'user' || CAST(c_custkey AS VARCHAR) || '@example.com' END AS email,
               CASE WHEN NOT c_acctbal BETWEEN 600 AND 899.99 THEN n_name END AS city,
               CASE WHEN c_acctbal BETWEEN 900 AND 1199.99 THEN ''
                    ELSE substr(r_name, 1, 2) END AS state,
               DATE '2020-01-01' + CAST(floor(abs(c_acctbal) / 10) AS INTEGER) AS signup_date,
               c_mktsegment AS loyalty_tier,
               c_acctbal
        FROM customer JOIN nation ON c_nationkey = n_nationkey
                      JOIN region ON n_regionkey = r_regionkey
        """,
    ),
    "customer_rows": (
        ("customer_cells",),
        """
        SELECT customer_id, first_name, last_name, email, city, state, signup_date,
               loyalty_tier, 1 AS batch FROM customer_cells
        UNION ALL
        SELECT customer_id, first_name, last_name, email, city, state, signup_date,
               loyalty_tier, 1 FROM customer_cells WHERE c_acctbal BETWEEN 1200 AND 1499.99
        UNION ALL
        SELECT customer_id, first_name, last_name, email, 'Moved', state, signup_date,
               loyalty_tier, 2 FROM customer_cells WHERE loyalty_tier = 'HOUSEHOLD'
        """,
    ),
    "customers_feed": (
        ("customer_rows",),
        """
        SELECT customer_id, first_name, last_name, email, city, state, signup_date, loyalty_tier,
               CAST('2024-01-0' || CAST(batch AS VARCHAR) || ' 00:00:00' AS TIMESTAMP) AS _ingest_ts,
               'batch-' || CAST(batch AS VARCHAR) AS _source_path,
               'batch-' || CAST(batch AS VARCHAR) AS _source_name,
               CAST(0 AS BIGINT) AS _source_size_bytes,
               sha256(CAST(customer_id AS VARCHAR) || '||' || coalesce(first_name, '') || '||' ||
                      coalesce(last_name, '') || '||' || coalesce(email, '') || '||' ||
                      coalesce(city, '') || '||' || coalesce(state, '') || '||' ||
                      coalesce(CAST(signup_date AS VARCHAR), '') || '||' ||
                      coalesce(loyalty_tier, '')) AS _bronze_row_key
        FROM customer_rows
        """,
    ),
    "customers": (("customers_feed",), "SELECT DISTINCT * FROM customers_feed"),
    "products": (
        (),
        """
        SELECT product_id, product_name, category, brand, price, created_date,
               TIMESTAMP '2024-01-01 00:00:00' AS _ingest_ts,
               'batch-1' AS _source_path, 'batch-1' AS _source_name,
               CAST(0 AS BIGINT) AS _source_size_bytes,
               sha256(CAST(product_id AS VARCHAR) || '||' || product_name || '||' || category ||
                      '||' || brand || '||' || CAST(price AS VARCHAR) || '||' ||
                      CAST(created_date AS VARCHAR)) AS _bronze_row_key
        FROM (SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
                     p_brand AS brand, p_retailprice AS price,
                     DATE '2019-01-01' + p_size * 20 AS created_date
              FROM part)
        """,
    ),
    "transaction_cells": (
        (),
        """
        SELECT l_orderkey * 8 + l_linenumber AS transaction_id,
               CASE WHEN o_totalprice >= 6000 THEN o_custkey END AS customer_id,
               CASE WHEN l_linenumber = 7 THEN -l_partkey ELSE l_partkey END AS product_id,
               CAST(l_quantity AS INTEGER) AS quantity,
               l_extendedprice AS transaction_amount,
               l_shipdate AS transaction_timestamp,
               CASE WHEN l_returnflag = 'R' THEN 'store' ELSE 'online' END AS channel,
               CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END AS batch
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        """,
    ),
    "transaction_keys": (
        ("transaction_cells",),
        """
        SELECT *, sha256(CAST(transaction_id AS VARCHAR) || '||' ||
                         coalesce(CAST(customer_id AS VARCHAR), '') || '||' ||
                         CAST(product_id AS VARCHAR) || '||' || CAST(quantity AS VARCHAR) ||
                         '||' || CAST(transaction_amount AS VARCHAR) || '||' ||
                         strftime(transaction_timestamp, '%Y-%m-%d %H:%M:%S') || '||' ||
                         channel) AS _bronze_row_key
        FROM transaction_cells
        """,
    ),
    "transactions": (
        ("transaction_keys",),
        """
        SELECT DISTINCT transaction_id, customer_id, product_id, quantity, transaction_amount,
               transaction_timestamp, channel,
               CAST('2024-01-0' || CAST(batch AS VARCHAR) || ' 00:00:00' AS TIMESTAMP) AS _ingest_ts,
               'batch-' || CAST(batch AS VARCHAR) AS _source_path,
               'batch-' || CAST(batch AS VARCHAR) AS _source_name,
               CAST(0 AS BIGINT) AS _source_size_bytes, _bronze_row_key
        FROM transaction_keys
        """,
    ),
    "later_transactions": (
        ("transaction_keys",),
        """
        SELECT DISTINCT transaction_id, customer_id, product_id, quantity, transaction_amount,
               transaction_timestamp, channel,
               TIMESTAMP '2024-01-03 00:00:00' AS _ingest_ts, 'batch-3' AS _source_path,
               'batch-3' AS _source_name, CAST(0 AS BIGINT) AS _source_size_bytes,
               _bronze_row_key
        FROM transaction_keys WHERE channel = 'store' OR quantity >= 25
        """,
    ),
    "stored_transactions": (
        ("transactions",),
        "SELECT * FROM transactions WHERE channel = 'online'",
    ),
    "latest_customers": (
        ("customers",),
        """
        SELECT * EXCLUDE (n) FROM (
            SELECT *, row_number() OVER (
                PARTITION BY customer_id
                ORDER BY _ingest_ts DESC, _source_path, _bronze_row_key) AS n
            FROM customers) WHERE n = 1
        """,
    ),
    "latest_transactions": (
        ("transactions",),
        """
        SELECT * EXCLUDE (n) FROM (
            SELECT *, row_number() OVER (
                PARTITION BY transaction_id
                ORDER BY _ingest_ts DESC, _source_path, _bronze_row_key) AS n
            FROM transactions) WHERE n = 1
        """,
    ),
    "customer_state": (
        ("latest_customers",),
        """
        SELECT customer_id,
               trim(coalesce(first_name, 'Unknown')) AS first_name,
               trim(coalesce(last_name, 'Unknown')) AS last_name,
               trim(coalesce(first_name, '') || ' ' || coalesce(last_name, '')) AS customer_name,
               CASE WHEN email IS NULL OR trim(email) = ''
                    THEN 'unknown+' || CAST(customer_id AS VARCHAR) || '@imputed.invalid'
                    ELSE trim(email) END AS email,
               email AS email_raw,
               CASE WHEN city IS NULL OR trim(city) = '' THEN 'Unknown'
                    ELSE trim(city) END AS city,
               city AS city_raw,
               CASE WHEN state IS NULL OR trim(state) = '' THEN 'UN'
                    ELSE trim(state) END AS state,
               signup_date, loyalty_tier, _ingest_ts AS as_of_ingest_ts,
               _bronze_row_key AS row_hash
        FROM latest_customers
        """,
    ),
    "dim_customer": (
        ("customer_state",),
        """
        SELECT row_number() OVER (ORDER BY customer_id) AS customer_sk, *,
               TIMESTAMP '2024-02-01 00:00:00' AS valid_from,
               '9999-12-31 23:59:59' AS valid_to, TRUE AS is_current
        FROM customer_state
        """,
    ),
    "dim_product": (
        ("products",),
        """
        SELECT row_number() OVER (ORDER BY product_id) AS product_sk, product_id, product_name,
               category, brand, price, created_date, _ingest_ts AS as_of_ingest_ts,
               _bronze_row_key AS row_hash, TIMESTAMP '2024-02-01 00:00:00' AS valid_from,
               '9999-12-31 23:59:59' AS valid_to, TRUE AS is_current
        FROM products
        """,
    ),
    "missing_products": (
        ("transactions", "products"),
        """
        SELECT transaction_id, product_id FROM transactions t
        WHERE NOT EXISTS (SELECT 1 FROM products p WHERE p.product_id = t.product_id)
        """,
    ),
    "quarantine": (
        ("missing_products", "latest_customers"),
        """
        SELECT TIMESTAMP '2024-02-01 00:00:00' AS quarantined_at, 'bronze' AS source_layer,
               'transaction' AS entity, CAST(transaction_id AS VARCHAR) AS business_key,
               'product_id_not_in_bronze_product_feed' AS reason
        FROM missing_products
        UNION ALL
        SELECT TIMESTAMP '2024-02-01 00:00:00', 'bronze', 'customer',
               CAST(customer_id AS VARCHAR), 'email_null_will_impute_in_dim'
        FROM latest_customers WHERE email IS NULL OR trim(email) = ''
        """,
    ),
    "fact": (
        ("latest_transactions", "dim_product", "dim_customer"),
        """
        SELECT t.transaction_id, c.customer_sk, p.product_sk,
               CAST(t.transaction_timestamp AS DATE) AS order_date, t.transaction_timestamp,
               t.transaction_amount, t.quantity, t.channel,
               t.customer_id IS NULL OR c.customer_sk IS NULL AS is_anonymous_or_unlinked
        FROM latest_transactions t
        JOIN dim_product p ON p.product_id = t.product_id
        LEFT JOIN dim_customer c ON c.customer_id = t.customer_id
        """,
    ),
    "corrections": (
        ("transaction_cells",),
        """
        SELECT *, TIMESTAMP '2024-01-03 00:00:00' AS _ingest_ts, 'batch-3' AS _source_path,
               sha256(CAST(transaction_id AS VARCHAR) || '||' ||
                      coalesce(CAST(customer_id AS VARCHAR), '') || '||' ||
                      CAST(product_id AS VARCHAR) || '||' || CAST(quantity AS VARCHAR) ||
                      '||' || CAST(transaction_amount AS VARCHAR) || '||' ||
                      strftime(transaction_timestamp, '%Y-%m-%d %H:%M:%S') || '||' ||
                      channel) AS _bronze_row_key
        FROM (SELECT transaction_id, customer_id,
                     CASE WHEN quantity = 50 THEN -abs(product_id) ELSE product_id END
                         AS product_id,
                     quantity, quantity * 100.0::DOUBLE AS transaction_amount,
                     transaction_timestamp
                         + CASE WHEN quantity = 49 THEN INTERVAL 40 DAY ELSE INTERVAL 0 DAY END
                         AS transaction_timestamp,
                     channel
              FROM transaction_cells WHERE quantity >= 45)
        """,
    ),
    "corrected_transactions": (
        ("transactions", "corrections"),
        """
        SELECT * EXCLUDE (n) FROM (
            SELECT *, row_number() OVER (
                PARTITION BY transaction_id
                ORDER BY _ingest_ts DESC, _source_path, _bronze_row_key) AS n
            FROM (SELECT transaction_id, customer_id, product_id, quantity, transaction_amount,
                         transaction_timestamp, channel, _ingest_ts, _source_path,
                         _bronze_row_key FROM transactions
                  UNION ALL BY NAME SELECT * FROM corrections)) WHERE n = 1
        """,
    ),
    "corrected_fact": (
        ("corrected_transactions", "dim_product", "dim_customer"),
        """
        SELECT t.transaction_id, c.customer_sk, p.product_sk,
               CAST(t.transaction_timestamp AS DATE) AS order_date, t.transaction_timestamp,
               t.transaction_amount, t.quantity, t.channel,
               t.customer_id IS NULL OR c.customer_sk IS NULL AS is_anonymous_or_unlinked
        FROM corrected_transactions t
        JOIN dim_product p ON p.product_id = t.product_id
        LEFT JOIN dim_customer c ON c.customer_id = t.customer_id
        """,
    ),
    # Rejects are known by the text of their records: what a cell hides does not count.
    "bad_sales": (
        ("transaction_cells",),
        """
        SELECT CASE quantity WHEN 50 THEN 'short_record' WHEN 49 THEN 'long_record'
                    WHEN 47 THEN 'required_null:transaction_id'
                    WHEN 45 THEN 'cast_failed:transaction_timestamp'
                    ELSE 'cast_failed:transaction_amount' END AS reason,
               CASE WHEN quantity = 47 THEN ' '
                    WHEN quantity < 50 OR channel = 'online'
                    THEN CAST(transaction_id AS VARCHAR) END AS key,
               (quantity, channel,
                CASE WHEN quantity <> 47 AND (quantity < 50 OR channel = 'online')
                     THEN transaction_id END,
                CASE WHEN quantity < 50 OR channel = 'online' THEN (customer_id, product_id) END,
                CASE WHEN quantity IN (45, 47, 49) THEN transaction_amount END,
                CASE WHEN quantity IN (46, 47, 48, 49) OR (quantity = 50 AND channel = 'store')
                     THEN transaction_timestamp END) AS record
        FROM transaction_cells WHERE quantity >= 45
        """,
    ),
    "priority_history": (
        (),
        """
        SELECT customer_id, priority, moment AS valid_from,
               lead(moment) OVER (PARTITION BY customer_id ORDER BY moment) AS next
        FROM (SELECT *, lag(priority) OVER (PARTITION BY customer_id ORDER BY moment) AS before
              FROM (SELECT o_custkey AS customer_id, CAST(o_orderdate AS TIMESTAMP) AS moment,
                           min(o_orderpriority) AS priority
                    FROM orders GROUP BY 1, 2))
        WHERE before IS NULL OR before <> priority
        """,
    ),
    "order_states": (
        (),
        """
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month, o_orderkey,
               o_orderstatus AS status, o_totalprice AS price, o_orderpriority AS priority,
               CAST(o_orderdate AS DATE) AS order_date
        FROM orders
        """,
    ),
    "fact_before": (
        ("fact",),
        "SELECT * FROM fact WHERE order_date < DATE '1999-07-01' "
        "OR (channel = 'online' AND order_date < DATE '2000-01-01')",
    ),
    "fact_after": (("fact",), "SELECT * FROM fact WHERE order_date >= DATE '1999-07-01'"),
}


def _daily(fact: str) -> str:
    return f"""
        SELECT order_date AS transaction_date,
               (sum(CAST(round(transaction_amount * 100) AS HUGEINT)) / 100.0) AS total_revenue,
               (sum(CAST(round(transaction_amount * 100) AS HUGEINT)) / 100.0)
                   / count(DISTINCT transaction_id) AS average_order_value,
               count(DISTINCT transaction_id) AS total_orders
        FROM {fact} GROUP BY order_date
    """


def _spend(fact: str) -> str:
    return f"""
        SELECT month, customer_id, customer_name, total_spend, transaction_count,
               CAST(rank() OVER (PARTITION BY month ORDER BY total_spend DESC) AS INTEGER)
                   AS rank_by_spend
        FROM (SELECT CAST(date_trunc('month', f.order_date) AS DATE) AS month,
                     c.customer_id, c.customer_name,
                     (sum(CAST(round(f.transaction_amount * 100) AS HUGEINT)) / 100.0)
                         AS total_spend,
                     count(*) AS transaction_count
              FROM {fact} f JOIN dim_customer c ON f.customer_sk = c.customer_sk
              GROUP BY 1, 2, 3)
    """


def _category(fact: str) -> str:
    return f"""
        SELECT f.order_date AS transaction_date, p.category,
               (sum(CAST(round(f.transaction_amount * 100) AS HUGEINT)) / 100.0) AS total_revenue
        FROM {fact} f JOIN dim_product p ON f.product_sk = p.product_sk
        GROUP BY 1, 2
    """


for _suffix, _fact_part in (
    ("", "fact"),
    ("_before", "fact_before"),
    ("_after", "fact_after"),
    ("_corrected", "corrected_fact"),
):
    PARTS[f"daily{_suffix}"] = ((_fact_part,), _daily(_fact_part))
    PARTS[f"spend{_suffix}"] = ((_fact_part, "dim_customer"), _spend(_fact_part))
    PARTS[f"category{_suffix}"] = ((_fact_part, "dim_product"), _category(_fact_part))


def _with_parts(parts: tuple[str, ...], select: str) -> str:
    """Prefix a SELECT with the parts it needs, each after those it reads."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for needed in PARTS[name][0]:
                visit(needed)
            ordered.append(name)

    for part in parts:
        visit(part)
    if not ordered:
        return select
    definitions = ", ".join(f"{name} AS ({PARTS[name][1]})" for name in ordered)
    return f"WITH {definitions} {select}"


def _upserted(before: str, after: str, keys: tuple[str, ...]) -> str:
    same = " AND ".join(f"s.{k} = t.{k}" for k in keys)
    return (
        f"SELECT * FROM {after} UNION ALL BY NAME SELECT * FROM {before} t "
        f"WHERE NOT EXISTS (SELECT 1 FROM {after} s WHERE {same})"
    )


# An empty text does not survive CSV: it comes back as NULL, under the same key.
_CUSTOMER_CONTENT = """
    SELECT DISTINCT customer_id, first_name, last_name, email, city,
           nullif(state, '') AS state, signup_date, loyalty_tier, _bronze_row_key
    FROM customers
"""

_SELECTS: dict[str, tuple[tuple[str, ...], str]] = {
    "load_feed_transactions": (
        ("transaction_keys",),
        """
        SELECT DISTINCT transaction_id, customer_id, product_id, quantity, transaction_amount,
               transaction_timestamp, channel, _bronze_row_key, TRUE AS has_lineage
        FROM transaction_keys WHERE quantity < 45
        """,
    ),
    "feed_rejects": (
        ("bad_sales", "transaction_keys"),
        """
        SELECT 'transactions' AS feed, reason, count(DISTINCT record) AS n_rows,
               count(DISTINCT key) AS n_keys
        FROM bad_sales GROUP BY reason
        UNION ALL SELECT 'bucket', 'other', count(DISTINCT record), NULL FROM bad_sales
        UNION ALL
        SELECT 'good', NULL, count(DISTINCT (transaction_id, _bronze_row_key)),
               count(DISTINCT transaction_id)
        FROM transaction_keys WHERE quantity < 45
        """,
    ),
    "file_ledger": (
        ("customers",),
        """
        SELECT DISTINCT customer_id, first_name, last_name, email, city,
               nullif(state, '') AS state, signup_date, loyalty_tier, _bronze_row_key,
               CASE WHEN _source_path = 'batch-2' THEN 2
                    WHEN loyalty_tier = 'BUILDING' THEN 3 ELSE 1 END AS read_by
        FROM customers
        """,
    ),
    "distinct_rollup": (
        ("transaction_cells",),
        """
        SELECT level, day, id_name, count(*) AS n_rows, count(DISTINCT id) AS n_distinct,
               count(*) - count(DISTINCT id) AS surplus
        FROM (SELECT CAST(transaction_timestamp AS DATE) AS on_day,
                     unnest([{'id_name': 'customer_id', 'id': customer_id},
                             {'id_name': 'product_id', 'id': product_id},
                             {'id_name': 'transaction_id', 'id': transaction_id}],
                            recursive := true)
              FROM transaction_cells) ids,
             LATERAL (VALUES ('day', on_day),
                             ('month', CAST(date_trunc('month', on_day) AS DATE)),
                             ('all', NULL)) AS levels(level, day)
        WHERE id IS NOT NULL
        GROUP BY level, day, id_name
        """,
    ),
    "reconcile_content": (
        ("fact",),
        """
        SELECT order_month, transaction_id, order_date, transaction_amount, quantity, channel,
               sum(in_left)::BIGINT AS n_left, sum(1 - in_left)::BIGINT AS n_right
        FROM (SELECT CAST(date_trunc('month', order_date) AS DATE) AS order_month,
                     transaction_id, order_date, transaction_amount, quantity, channel,
                     1 AS in_left
              FROM fact
              UNION ALL
              SELECT CAST(date_trunc('month', f.order_date) AS DATE), f.transaction_id,
                     f.order_date,
                     CASE WHEN f.order_date < DATE '1997-01-01'
                               AND o.transaction_id IS NOT NULL
                          THEN o.transaction_amount ELSE f.transaction_amount END,
                     f.quantity, f.channel, 0
              FROM fact f
              LEFT JOIN fact o
                ON f.transaction_id % 8 IN (1, 2)
                   AND date_trunc('month', o.order_date) = date_trunc('month', f.order_date)
                   AND o.transaction_id = CASE f.transaction_id % 8
                       WHEN 1 THEN f.transaction_id + 1 ELSE f.transaction_id - 1 END)
        GROUP BY ALL HAVING sum(in_left) <> sum(1 - in_left)
        """,
    ),
    "quarantine_audit": (
        ("transactions", "products", "latest_customers"),
        """
        SELECT 'transaction' AS entity, CAST(t.transaction_id AS VARCHAR) AS business_key,
               'product_id_not_in_bronze_product_feed' AS reason, 'bronze' AS source_layer,
               count(*) AS n_rows, 'run-1' AS first_run,
               TIMESTAMP '2024-02-01 00:00:00' AS first_seen_at, 'run-3' AS last_run,
               TIMESTAMP '2024-02-03 00:00:00' AS last_seen_at,
               NULL::VARCHAR AS resolved_run, NULL::TIMESTAMP AS resolved_at,
               CASE WHEN count(p.product_id) < count(*) THEN 1 ELSE 2 END AS times_opened
        FROM transactions t LEFT JOIN products p ON p.product_id = t.product_id
        WHERE p.product_id IS NULL OR p.price >= 1500 GROUP BY t.transaction_id
        UNION ALL
        SELECT 'customer', CAST(customer_id AS VARCHAR), 'email_null_will_impute_in_dim', 'bronze',
               1, 'run-1', TIMESTAMP '2024-02-01 00:00:00', 'run-2',
               TIMESTAMP '2024-02-02 00:00:00', 'run-3', TIMESTAMP '2024-02-03 00:00:00', 1
        FROM latest_customers WHERE email IS NULL OR trim(email) = ''
        """,
    ),
    "late_versions": (
        ("priority_history",),
        """
        SELECT customer_id, priority, valid_from,
               coalesce(strftime(next, '%Y-%m-%d %H:%M:%S'), '9999-12-31 23:59:59') AS valid_to,
               next IS NULL AS is_current
        FROM priority_history
        """,
    ),
    "version_at": (
        ("priority_history",),
        """
        SELECT s.*, h.priority, h.valid_from
        FROM (SELECT l_orderkey, l_linenumber, l_partkey,
                     CASE WHEN o_totalprice >= 6000 THEN o_custkey END AS customer_id,
                     CAST(l_shipdate AS TIMESTAMP) - INTERVAL 60 DAY AS asked_at
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey) s
        LEFT JOIN priority_history h
          ON h.customer_id = s.customer_id AND s.asked_at >= h.valid_from
             AND (h.next IS NULL OR s.asked_at < h.next)
        """,
    ),
    "change_feed": (
        ("order_states",),
        """
        SELECT * EXCLUDE (order_date), 'delete' AS what FROM order_states
        WHERE order_date < DATE '2000-01-01' AND priority = '5-LOW'
        UNION ALL
        SELECT * EXCLUDE (order_date), 'insert' FROM order_states
        WHERE order_date >= DATE '2000-01-01' AND priority <> '5-LOW'
        UNION ALL
        SELECT order_month, o_orderkey,
               CASE WHEN order_date >= DATE '1999-07-01' THEN 'X' ELSE status END,
               CASE WHEN order_date >= DATE '1999-07-01' THEN price * 2 ELSE price END,
               priority, 'second'
        FROM order_states
        UNION ALL
        SELECT order_month, o_orderkey, status, price, priority, what
        FROM order_states, (VALUES ('table'), ('replayed')) AS both_ways(what)
        WHERE priority <> '5-LOW'
        """,
    ),
    "incremental_fact": (
        ("corrected_fact",),
        """
        SELECT f.* EXCLUDE (customer_sk, product_sk), p.product_id, c.customer_id, c.city
        FROM corrected_fact f JOIN dim_product p USING (product_sk)
        LEFT JOIN dim_customer c ON c.customer_sk = f.customer_sk
        """,
    ),
    "incremental_marts": (
        ("daily_corrected", "spend_corrected", "category_corrected"),
        """
        SELECT 'daily' AS mart, transaction_date AS day, NULL::VARCHAR AS key,
               total_revenue AS total, total_orders AS n_rows,
               average_order_value AS average, NULL::INTEGER AS place
        FROM daily_corrected
        UNION ALL
        SELECT 'spend', month, CAST(customer_id AS VARCHAR) || ' ' || customer_name,
               total_spend, transaction_count, NULL, rank_by_spend
        FROM spend_corrected
        UNION ALL
        SELECT 'category', transaction_date, category, total_revenue, NULL, NULL, NULL
        FROM category_corrected
        """,
    ),
    "feed_customers": (("customers",), "SELECT * FROM customers"),
    "feed_products": (("products",), "SELECT * FROM products"),
    "feed_transactions": (("transactions",), "SELECT * FROM transactions"),
    "row_key": (
        ("customers_feed",),
        "SELECT customer_id, _source_path, _bronze_row_key AS row_key FROM customers_feed",
    ),
    "bronze_upsert": (
        ("stored_transactions", "later_transactions"),
        _upserted("stored_transactions", "later_transactions", ("_bronze_row_key",)),
    ),
    "bronze_upsert_keep": (
        ("stored_transactions", "later_transactions"),
        _upserted("later_transactions", "stored_transactions", ("_bronze_row_key",)),
    ),
    "bronze_counts": (
        ("customers", "products", "transactions"),
        """
        SELECT 'customers' AS table_name, count(*) AS row_count,
               count(DISTINCT customer_id) AS dist_keys FROM customers
        UNION ALL SELECT 'products', count(*), count(DISTINCT product_id) FROM products
        UNION ALL SELECT 'transactions', count(*), count(DISTINCT transaction_id)
                  FROM transactions
        """,
    ),
    "duplicate_counts": (
        ("customers", "products", "transactions"),
        """
        SELECT 'dup_customer_id' AS check_name,
               count(*) - count(DISTINCT customer_id) AS dup_count FROM customers
        UNION ALL SELECT 'dup_product_id', count(*) - count(DISTINCT product_id) FROM products
        UNION ALL SELECT 'dup_transaction_id', count(*) - count(DISTINCT transaction_id)
                  FROM transactions
        """,
    ),
    "sample_rows": (
        ("customers",),
        "SELECT * FROM customers ORDER BY customer_id, _bronze_row_key LIMIT 3",
    ),
    "incremental_since": (
        ("customers",),
        "SELECT * FROM customers WHERE _ingest_ts > TIMESTAMP '2024-01-01 00:00:00'",
    ),
    "latest_customers": (("latest_customers",), "SELECT * FROM latest_customers"),
    "latest_products": (("products",), "SELECT * FROM products"),
    "latest_transactions": (("latest_transactions",), "SELECT * FROM latest_transactions"),
    "clean_customers": (
        ("customer_state",),
        "SELECT * EXCLUDE (row_hash) FROM customer_state",
    ),
    "customer_row_hash": (
        ("customer_state",),
        "SELECT customer_id, row_hash FROM customer_state",
    ),
    "surrogate_key": (
        (),
        "SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) AS order_sk "
        "FROM orders",
    ),
    "dim_customer": (("dim_customer",), "SELECT * FROM dim_customer"),
    "dim_product": (("dim_product",), "SELECT * FROM dim_product"),
    "dim_health": (
        ("dim_customer", "dim_product"),
        """
        SELECT 'dim_customer' AS obj, count(*) AS n, count(DISTINCT customer_id) AS dist_bk,
               CAST(sum(CASE WHEN is_current THEN 1 ELSE 0 END) AS BIGINT) AS current_rows
        FROM dim_customer
        UNION ALL
        SELECT 'dim_product', count(*), count(DISTINCT product_id),
               CAST(sum(CASE WHEN is_current THEN 1 ELSE 0 END) AS BIGINT)
        FROM dim_product
        """,
    ),
    "quarantine_missing_product": (("missing_products",), "SELECT * FROM missing_products"),
    "quarantine_rows": (("quarantine",), "SELECT * FROM quarantine"),
    "quarantine_by_reason": (
        ("quarantine",),
        """
        SELECT CASE WHEN reason LIKE '%product_id_not_in%' THEN 'missing_product'
                    WHEN reason LIKE '%email_null%' THEN 'email_null_audit'
                    ELSE 'other' END AS quarantine_category, count(*) AS n
        FROM quarantine GROUP BY 1 ORDER BY 1
        """,
    ),
    "fact_transaction": (("fact",), "SELECT * FROM fact"),
    "fact_enriched": (
        ("fact", "dim_customer", "dim_product"),
        """
        SELECT f.transaction_id, f.order_date, c.customer_name, p.category,
               f.transaction_amount, f.is_anonymous_or_unlinked
        FROM fact f LEFT JOIN dim_customer c ON f.customer_sk = c.customer_sk
                    JOIN dim_product p ON f.product_sk = p.product_sk
        """,
    ),
    "scd2_apply": (
        ("customer_cells", "customer_state"),
        """
        , first_batch AS (
            SELECT customer_id, first_name, last_name, email, city, state, signup_date,
                   loyalty_tier,
                   sha256(CAST(customer_id AS VARCHAR) || '||' || coalesce(first_name, '') ||
                          '||' || coalesce(last_name, '') || '||' || coalesce(email, '') ||
                          '||' || coalesce(city, '') || '||' || coalesce(state, '') || '||' ||
                          coalesce(CAST(signup_date AS VARCHAR), '') || '||' ||
                          coalesce(loyalty_tier, '')) AS row_hash
            FROM customer_cells),
        old AS (
            SELECT row_number() OVER (ORDER BY customer_id) AS customer_sk, customer_id,
                   trim(coalesce(first_name, 'Unknown')) AS first_name,
                   trim(coalesce(last_name, 'Unknown')) AS last_name,
                   trim(coalesce(first_name, '') || ' ' || coalesce(last_name, ''))
                       AS customer_name,
                   CASE WHEN email IS NULL OR trim(email) = ''
                        THEN 'unknown+' || CAST(customer_id AS VARCHAR) || '@imputed.invalid'
                        ELSE trim(email) END AS email,
                   email AS email_raw,
                   CASE WHEN city IS NULL OR trim(city) = '' THEN 'Unknown'
                        ELSE trim(city) END AS city,
                   city AS city_raw,
                   CASE WHEN state IS NULL OR trim(state) = '' THEN 'UN'
                        ELSE trim(state) END AS state,
                   signup_date, loyalty_tier,
                   TIMESTAMP '2024-01-01 00:00:00' AS as_of_ingest_ts, row_hash
            FROM first_batch),
        changed AS (
            SELECT s.* FROM customer_state s
            WHERE NOT EXISTS (SELECT 1 FROM old o
                              WHERE o.customer_id = s.customer_id AND o.row_hash = s.row_hash))
        SELECT o.*, TIMESTAMP '2024-02-01 00:00:00' AS valid_from,
               CASE WHEN c.customer_id IS NULL THEN '9999-12-31 23:59:59'
                    ELSE '2024-03-01 00:00:00' END AS valid_to,
               c.customer_id IS NULL AS is_current
        FROM old o LEFT JOIN changed c ON o.customer_id = c.customer_id
        UNION ALL
        SELECT (SELECT max(customer_sk) FROM old) + row_number() OVER (ORDER BY customer_id),
               changed.*, TIMESTAMP '2024-03-01 00:00:00', '9999-12-31 23:59:59', TRUE
        FROM changed
        """,
    ),
    "daily_revenue": (("daily",), "SELECT * FROM daily"),
    "customer_spend_by_month": (("spend",), "SELECT * FROM spend"),
    "category_sales_daily": (("category",), "SELECT * FROM category"),
    "net_revenue": (
        (),
        """
        SELECT CAST(l_shipdate AS DATE) AS transaction_date,
               sum(CAST(round(l_extendedprice * (1 - l_discount) * 10000) AS HUGEINT)) / 10000.0
                   AS total_revenue,
               sum(CAST(round(l_extendedprice * (1 - l_discount) * 10000) AS HUGEINT)) / 10000.0
                   / count(DISTINCT l_orderkey * 8 + l_linenumber) AS average_order_value,
               count(DISTINCT l_orderkey * 8 + l_linenumber) AS total_orders
        FROM lineitem GROUP BY 1
        """,
    ),
    "rank_text": (
        (),
        """
        SELECT c_custkey, c_nationkey, c_mktsegment,
               rank() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment DESC) AS segment_rank
        FROM customer
        """,
    ),
    "rank_within": (
        (),
        """
        SELECT o_orderkey, o_orderpriority, price,
               rank() OVER (PARTITION BY o_orderpriority ORDER BY price DESC) AS price_rank
        FROM (SELECT o_orderkey, o_orderpriority,
                     CAST(floor(o_totalprice / 1000) * 1000 AS DOUBLE) AS price FROM orders)
        """,
    ),
    "gold_daily_upsert": (
        ("daily_before", "daily_after"),
        _upserted("daily_before", "daily_after", ("transaction_date",)),
    ),
    "gold_spend_upsert": (
        ("spend_before", "spend_after"),
        _upserted("spend_before", "spend_after", ("month", "customer_id")),
    ),
    "gold_category_upsert": (
        ("category_before", "category_after"),
        _upserted("category_before", "category_after", ("transaction_date", "category")),
    ),
    "change_set": (
        ("daily_before", "daily_after"),
        """
        , changed AS (
            SELECT s.transaction_date, t.transaction_date IS NOT NULL AS known
            FROM daily_after s LEFT JOIN daily_before t ON s.transaction_date = t.transaction_date
            WHERE t.transaction_date IS NULL
               OR t.total_revenue IS DISTINCT FROM s.total_revenue
               OR t.average_order_value IS DISTINCT FROM s.average_order_value
               OR t.total_orders IS DISTINCT FROM s.total_orders)
        SELECT s.*, CASE WHEN known THEN 'update_postimage' ELSE 'insert' END AS change_type
        FROM daily_after s JOIN changed c ON s.transaction_date = c.transaction_date
        UNION ALL
        SELECT t.*, 'update_preimage'
        FROM daily_before t JOIN changed c ON t.transaction_date = c.transaction_date
        """,
    ),
    "reconcile_revenue": (
        ("fact", "daily"),
        """
        SELECT (SELECT round((sum(CAST(round(transaction_amount * 100) AS HUGEINT)) / 100.0), 2)
                FROM fact) AS fact_total,
               (SELECT round((sum(CAST(round(total_revenue * 100) AS HUGEINT)) / 100.0), 2)
                FROM daily) AS sum_daily
        """,
    ),
    "layer_summary": (
        ("customers", "transactions", "fact", "quarantine", "daily", "spend", "category"),
        """
        SELECT (SELECT count(*) FROM customers) AS n_customers,
               (SELECT count(*) FROM products) AS n_products,
               (SELECT count(*) FROM transactions) AS n_transactions,
               (SELECT count(*) FROM dim_customer) AS dim_customer,
               (SELECT count(*) FROM dim_product) AS dim_product,
               (SELECT count(*) FROM fact) AS fact_transaction,
               (SELECT count(*) FROM quarantine) AS quarantine_rows,
               (SELECT count(*) FROM daily) AS n_daily,
               (SELECT count(*) FROM spend) AS n_cust_mo,
               (SELECT count(*) FROM category) AS n_cat_day
        """,
    ),
    "load_feed": (("customers",), _CUSTOMER_CONTENT),
    "file_ingest": (("customers",), _CUSTOMER_CONTENT),
    "replace_table": (("dim_customer",), "SELECT * FROM dim_customer"),
    "merge_table": (
        ("spend_before", "spend_after"),
        _upserted("spend_before", "spend_after", ("month", "customer_id")),
    ),
    "ordered_export": (
        (),
        """
        SELECT 1::BIGINT AS line_no, 'day,order,priority,note' AS line
        UNION ALL
        SELECT 1 + row_number() OVER (ORDER BY CAST(o_orderdate AS DATE), o_orderkey) AS line_no,
               CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || ',' || o_orderkey || ','
               || CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority ELSE '' END
               || ',"' || o_orderstatus || ', ""' || o_custkey || '""' || '"' AS line
        FROM orders
        """,
    ),
    "filter_limit": (
        (),
        "SELECT * FROM orders WHERE o_totalprice > 100000 ORDER BY o_orderkey LIMIT 5",
    ),
}

ORACLE_SQL: dict[str, str] = {
    name: _with_parts(parts, select) for name, (parts, select) in _SELECTS.items()
}
