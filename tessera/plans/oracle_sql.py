"""DuckDB oracle SQL for the correctness gate.

Written independently of the DataFrame code: the fixture derivations are
restated in SQL, keep-latest is a ROW_NUMBER with explicit NULL ordering, and
the marts are computed another way than in Spark: ranks by counting what
comes before, times by joining the two statuses.  Views ``orders``, ``lineitem`` ...
are pre-registered by the checker.
"""

from __future__ import annotations

RAW = {
    "orders_raw": """
SELECT CAST(o_orderkey AS VARCHAR) AS orderid,
       CASE WHEN o_orderstatus = 'P' THEN 'X' ELSE '' END || CAST(o_custkey AS VARCHAR) AS memberid,
       'S' || CAST(o_orderkey % 20 AS VARCHAR) AS storeid,
       CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS campaignid,
       CAST(o_orderdate AS DATE) AS orderdate,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS subtotal,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS total,
       'orders.csv' AS source_name
FROM orders
UNION ALL
SELECT CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR),
       'S' || CAST(o_orderkey % 20 AS VARCHAR),
       CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END,
       CAST(o_orderdate AS DATE) + 1,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR),
       CAST(CAST(o_totalprice + 1 AS DECIMAL(12,2)) AS VARCHAR),
       'orders_resend.csv'
FROM orders WHERE o_orderstatus = 'O'""",
    "orders_items_raw": """
SELECT CAST(l.l_orderkey AS VARCHAR) AS orderid,
       CASE WHEN p.p_size <= 45 THEN p.p_name END AS itemname,
       CAST(CAST(CASE WHEN l.l_returnflag = 'R' THEN -l.l_extendedprice ELSE l.l_extendedprice END
                 AS DECIMAL(12,2)) AS VARCHAR) AS price,
       'orders_items.csv' AS source_name
FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey""",
    "order_status_raw": """
SELECT CAST(o_orderkey AS VARCHAR) AS orderid, 'Submitted' AS status,
       strftime(o_orderdate, '%d/%m/%Y %H:%M:%S') AS statustimestamp,
       'order_status.csv' AS source_name
FROM orders
UNION ALL
SELECT CAST(l_orderkey AS VARCHAR), 'Delivered', strftime(l_shipdate, '%d/%m/%Y %H:%M:%S'),
       'order_status.csv'
FROM lineitem
UNION ALL
SELECT CAST(user_id AS VARCHAR), event_type,
       CASE WHEN event_type <> 'error' THEN strftime(ts, '%d/%m/%Y %H:%M:%S') END,
       'order_events.csv'
FROM events""",
    "members_raw": """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS membershiptype,
       strftime(DATE '2023-01-01' + CAST(c_custkey % 300 AS INTEGER), '%-d/%-m/%Y') AS joindate,
       strftime(DATE '2023-01-01' + CAST(c_custkey % 300 AS INTEGER) + 365, '%d/%m/%Y') AS expirationdate,
       'members.csv' AS source_name
FROM customer
UNION ALL
SELECT CAST(c_custkey AS VARCHAR), c_name,
       CASE WHEN c_acctbal < 0 THEN 'SUSPENDED' ELSE c_mktsegment END,
       CASE WHEN NOT (c_acctbal < 0)
            THEN strftime(DATE '2023-01-01' + CAST(c_custkey % 300 AS INTEGER) + 30, '%d/%m/%Y') END,
       strftime(DATE '2023-01-01' + CAST(c_custkey % 300 AS INTEGER) + 395, '%d/%m/%Y'),
       'members_update.csv'
FROM customer WHERE c_acctbal < 0 OR c_mktsegment = 'BUILDING'""",
    "marketing_raw": """
SELECT o_orderpriority AS campaignid,
       CASE o_orderstatus WHEN 'F' THEN 'Gold' WHEN 'O' THEN 'Silver' ELSE 'Silver,Gold' END AS targetaudience,
       'S' || CAST(min(o_orderkey) % 20 AS VARCHAR) AS storeid,
       strftime(min(o_orderdate), '%d/%m/%Y') AS campaignstartdate,
       strftime(max(o_orderdate), '%d/%m/%Y') AS campaignenddate,
       'marketing.csv' AS source_name
FROM orders GROUP BY o_orderpriority, o_orderstatus""",
    "preferences_raw": """
SELECT CAST(user_id AS VARCHAR) AS memberid,
       CASE WHEN event_type <> 'error' THEN event_type END AS preference,
       'preferences.csv' AS source_name
FROM (SELECT DISTINCT user_id, event_type FROM events)""",
}

BRONZE = {
    "base_orders": """
SELECT substr(orderid, 1, 100) AS orderid, substr(memberid, 1, 100) AS memberid,
       substr(storeid, 1, 100) AS storeid, substr(campaignid, 1, 100) AS campaignid,
       orderdate, TRY_CAST(subtotal AS DECIMAL(10,2)) AS subtotal,
       TRY_CAST(total AS DECIMAL(10,2)) AS total, source_name
FROM orders_raw""",
    "base_orders_items": """
SELECT substr(orderid, 1, 100) AS orderid, itemname, TRY_CAST(price AS DECIMAL(10,2)) AS price,
       source_name
FROM orders_items_raw""",
    "base_order_status": """
SELECT substr(orderid, 1, 100) AS orderid, substr(status, 1, 50) AS status,
       try_strptime(statustimestamp, '%d/%m/%Y %H:%M:%S') AS statustimestamp, source_name
FROM order_status_raw WHERE statustimestamp IS NOT NULL""",
    "base_members": """
SELECT substr(id, 1, 100) AS memberid, name AS membername,
       substr(membershiptype, 1, 50) AS membershiptype,
       CAST(try_strptime(joindate, '%d/%m/%Y') AS DATE) AS joindate,
       CAST(try_strptime(expirationdate, '%d/%m/%Y') AS DATE) AS expirationdate, source_name
FROM members_raw""",
    "base_marketing": """
SELECT substr(campaignid, 1, 100) AS campaignid, targetaudience,
       CAST(try_strptime(campaignstartdate, '%d/%m/%Y') AS DATE) AS campaignstartdate,
       CAST(try_strptime(campaignenddate, '%d/%m/%Y') AS DATE) AS campaignenddate, source_name
FROM marketing_raw""",
    "base_preferences": """
SELECT substr(memberid, 1, 100) AS memberid, preference, source_name
FROM preferences_raw""",
}

SILVER = {
    "stg_orders": """
SELECT orderid, memberid, storeid, campaignid, orderdate, subtotal, total, source_name
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY orderid ORDER BY orderdate DESC NULLS FIRST,
             source_name ASC NULLS FIRST, memberid ASC NULLS FIRST, storeid ASC NULLS FIRST,
             campaignid ASC NULLS FIRST, subtotal ASC NULLS FIRST, total ASC NULLS FIRST) AS rn
      FROM base_orders) WHERE rn = 1""",
    "stg_members": """
SELECT memberid, membername, membershiptype, joindate, expirationdate, source_name
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY memberid ORDER BY joindate DESC NULLS FIRST,
             source_name ASC NULLS FIRST, membername ASC NULLS FIRST,
             membershiptype ASC NULLS FIRST, expirationdate ASC NULLS FIRST) AS rn
      FROM base_members WHERE memberid IS NOT NULL) WHERE rn = 1""",
    "stg_marketing": """
SELECT campaignid, targetaudience, campaignstartdate, campaignenddate, source_name
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY campaignid ORDER BY campaignstartdate DESC NULLS FIRST,
             source_name ASC NULLS FIRST, targetaudience ASC NULLS FIRST,
             campaignenddate ASC NULLS FIRST) AS rn
      FROM base_marketing WHERE campaignid IS NOT NULL) WHERE rn = 1""",
    "stg_order_status": """
SELECT orderid, status, statustimestamp, source_name
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY orderid, status ORDER BY statustimestamp DESC NULLS FIRST,
             source_name ASC NULLS FIRST) AS rn
      FROM base_order_status WHERE orderid IS NOT NULL AND statustimestamp IS NOT NULL) WHERE rn = 1""",
    "stg_orders_items": """
SELECT orderid, itemname, price, source_name FROM base_orders_items
WHERE orderid IS NOT NULL AND itemname IS NOT NULL""",
    "stg_preferences": """
SELECT memberid, preference, source_name FROM base_preferences
WHERE memberid IS NOT NULL AND preference IS NOT NULL""",
}

GOLD = {
    "build_orders": """
SELECT o.orderid, o.storeid, o.campaignid, o.orderdate, o.subtotal, o.total, o.source_name,
       m.membername, m.membershiptype, m.joindate, m.expirationdate,
       mk.targetaudience, mk.campaignstartdate, mk.campaignenddate
FROM stg_orders o
LEFT JOIN stg_members m ON o.memberid = m.memberid
LEFT JOIN stg_marketing mk ON o.campaignid = mk.campaignid""",
    "build_order_items": "SELECT orderid, itemname, price, source_name FROM stg_orders_items",
    "build_order_status": "SELECT orderid, status, statustimestamp, source_name FROM stg_order_status",
    "build_member_preferences": """
SELECT p.memberid, p.preference, m.membername, m.membershiptype, m.joindate, m.expirationdate
FROM stg_preferences p LEFT JOIN stg_members m ON p.memberid = m.memberid""",
}

MARTS = {
    "mart_gross_revenue": """
SELECT storeid, campaignid, CAST(SUM(total) AS DECIMAL(38,2)) AS total_revenue
FROM build_orders GROUP BY storeid, campaignid""",
    # Ranks are counted: one more than the groups that come before by value.
    "mart_popular_items": """
SELECT strftime(month, '%b-%Y') AS month_year, itemname, n AS order_count,
       CASE bigger WHEN 0 THEN 'Most Popular' WHEN 1 THEN 'Second Most Popular' ELSE
           CASE smaller WHEN 0 THEN 'Least Popular' ELSE 'Second Least Popular' END END AS popularity_label
FROM (SELECT month, itemname, n,
             COUNT(*) OVER (PARTITION BY month ORDER BY n RANGE BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS bigger,
             COUNT(*) OVER (PARTITION BY month ORDER BY n RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS smaller
      FROM (SELECT date_trunc('month', orderdate) AS month, itemname, COUNT(*) AS n
            FROM build_order_items JOIN build_orders USING (orderid) GROUP BY ALL))
WHERE least(bigger, smaller) < 2""",
    "mart_spending_members": """
SELECT CAST(month AS DATE) AS month, membername, spent AS total_spent,
       CASE WHEN spent IS NOT DISTINCT FROM top THEN 'Highest Spending' ELSE 'Lowest Spending' END AS spending_label
FROM (SELECT *, CASE WHEN COUNT(spent) OVER m = COUNT(*) OVER m THEN MAX(spent) OVER m END AS top,
             MIN(spent) OVER m AS low
      FROM (SELECT date_trunc('month', orderdate) AS month, membername, CAST(SUM(total) AS DECIMAL(38,2)) AS spent
            FROM build_orders WHERE membername IS NOT NULL GROUP BY ALL)
      WINDOW m AS (PARTITION BY month))
WHERE spent IS NOT DISTINCT FROM top OR spent IS NOT DISTINCT FROM low""",
    "mart_order_processing_times": """
SELECT o.storeid, CAST(SUM(s.us) AS DOUBLE) / COUNT(*) / 1000000.0 AS avg_delivery_seconds,
       CAST(sign(SUM(s.us)) * ((2 * abs(SUM(s.us)) + COUNT(*)) // (2 * COUNT(*))) AS BIGINT) AS avg_delivery_micros
FROM build_orders o
JOIN (SELECT a.orderid, CAST(epoch_us(MIN(b.statustimestamp)) - epoch_us(MIN(a.statustimestamp)) AS HUGEINT) AS us
      FROM build_order_status a JOIN build_order_status b ON a.orderid = b.orderid
      WHERE a.status = 'Submitted' AND b.status = 'Delivered' GROUP BY a.orderid) s ON s.orderid = o.orderid
GROUP BY o.storeid""",
}

INCREMENTAL = {
    "orders_revision_raw": """
SELECT CAST(o_orderkey AS VARCHAR) AS orderid,
       CASE WHEN o_orderstatus = 'P' THEN 'X' ELSE '' END || CAST(o_custkey AS VARCHAR) AS memberid,
       'S' || CAST(o_orderkey % 20 AS VARCHAR) AS storeid,
       CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS campaignid,
       CAST(o_orderdate AS DATE) + CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS orderdate,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS subtotal,
       CAST(CAST(o_totalprice + 1 AS DECIMAL(12,2)) AS VARCHAR) AS total,
       'orders_revision.csv' AS source_name
FROM orders""",
    "base_orders_revision": """
SELECT substr(orderid, 1, 100) AS orderid, substr(memberid, 1, 100) AS memberid,
       substr(storeid, 1, 100) AS storeid, substr(campaignid, 1, 100) AS campaignid,
       orderdate, TRY_CAST(subtotal AS DECIMAL(10,2)) AS subtotal,
       TRY_CAST(total AS DECIMAL(10,2)) AS total, source_name
FROM orders_revision_raw""",
    "inc_target": "SELECT * FROM base_orders WHERE orderdate < DATE '2000-01-01'",
    "inc_new": """
SELECT * FROM base_orders_revision
WHERE orderdate >= (SELECT MAX(orderdate) FROM inc_target)""",
    "inc_target_stg": """
SELECT orderid, memberid, storeid, campaignid, orderdate, subtotal, total, source_name
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY orderid ORDER BY orderdate DESC NULLS FIRST,
             source_name ASC NULLS FIRST, memberid ASC NULLS FIRST, storeid ASC NULLS FIRST,
             campaignid ASC NULLS FIRST, subtotal ASC NULLS FIRST, total ASC NULLS FIRST) AS rn
      FROM inc_target) WHERE rn = 1""",
    "inc_changes": """
SELECT orderid, memberid, storeid, campaignid, orderdate, subtotal, total, source_name
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY orderid ORDER BY orderdate DESC NULLS FIRST,
             source_name ASC NULLS FIRST, memberid ASC NULLS FIRST, storeid ASC NULLS FIRST,
             campaignid ASC NULLS FIRST, subtotal ASC NULLS FIRST, total ASC NULLS FIRST) AS rn
      FROM inc_new WHERE orderid IS NOT NULL) WHERE rn = 1""",
}

#: The delivery after the revision, merged into what the revision left.
RELOCATION = {
    "relocation": """
SELECT CAST(o_orderkey AS VARCHAR) AS orderid,
       CASE WHEN o_orderstatus = 'P' THEN 'X' ELSE '' END || CAST(o_custkey AS VARCHAR) AS memberid,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'T' || CAST(o_orderkey % 7 AS VARCHAR)
            ELSE 'S' || CAST(o_orderkey % 20 AS VARCHAR) END AS storeid,
       CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS campaignid,
       CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(CAST(o_orderdate AS DATE) + INTERVAL 120 MONTH AS DATE)
            ELSE CAST(o_orderdate AS DATE) END AS orderdate,
       CAST(o_totalprice AS DECIMAL(10,2)) AS subtotal,
       CASE WHEN o_orderkey % 20 <> 3 THEN CAST(CAST(o_totalprice + 2 AS DECIMAL(12,2)) AS DECIMAL(10,2)) END AS total,
       'orders_relocation.csv' AS source_name
FROM orders""",
    "revised": """
SELECT * FROM inc_target_stg t WHERE NOT EXISTS (SELECT 1 FROM inc_changes c WHERE c.orderid = t.orderid)
UNION ALL SELECT * FROM inc_changes""",
    "relocated": """
SELECT * FROM relocation WHERE orderdate >= (SELECT MAX(orderdate) FROM revised)""",
    "stg_orders": """
SELECT * FROM revised t WHERE NOT EXISTS (SELECT 1 FROM relocated c WHERE c.orderid = t.orderid)
UNION ALL SELECT * FROM relocated""",
}

LANDING = {
    "delivered_orders": """
SELECT CASE WHEN o_orderstatus <> 'P' OR o_orderpriority <> '1-URGENT' THEN CAST(o_orderkey AS VARCHAR) END AS orderid, CAST(o_custkey AS VARCHAR) AS memberid,
       'S' || CAST(o_orderkey % 20 AS VARCHAR) AS storeid,
       CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS campaignid,
       CAST(o_orderdate AS DATE) AS orderdate,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS subtotal,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS total,
       o_orderstatus
FROM orders""",
    "stream_day1": """
SELECT orderid, memberid, storeid, campaignid, orderdate,
       TRY_CAST(subtotal AS DECIMAL(10,2)) AS subtotal, TRY_CAST(total AS DECIMAL(10,2)) AS total
FROM delivered_orders WHERE o_orderstatus <> 'P' AND orderdate < DATE '2000-01-01'""",
    "stream_day2": """
SELECT orderid, memberid, storeid, campaignid, orderdate, TRY_CAST(subtotal AS DECIMAL(10,2)) AS subtotal,
       TRY_CAST(CAST(CAST(o_totalprice + 1 AS DECIMAL(12,2)) AS VARCHAR) AS DECIMAL(10,2)) AS total
FROM delivered_orders d JOIN orders o ON d.orderid = CAST(o.o_orderkey AS VARCHAR)
WHERE d.o_orderstatus <> 'P'
  AND d.orderdate >= (SELECT MAX(orderdate) FROM stream_day1)""",
}

ALL_CTES = {**RAW, **BRONZE, **SILVER, **GOLD, **MARTS, **INCREMENTAL, **LANDING}


def with_models(final_select: str) -> str:
    """Prefix ``final_select`` with every model as a CTE (unused ones cost nothing)."""
    ctes = ",\n".join(f"{name} AS ({body.strip()})" for name, body in ALL_CTES.items())
    return f"WITH {ctes}\n{final_select.strip()}"


def after_deliveries(name: str, columns: str = "*") -> str:
    """A mart over the orders as three deliveries have left them."""
    ctes = {**RAW, **BRONZE, **INCREMENTAL, **{k: v for k, v in SILVER.items() if k != "stg_orders"}, **RELOCATION, **GOLD, **MARTS}
    body = ",\n".join(f"{n} AS ({sql.strip()})" for n, sql in ctes.items())
    return f"WITH {body}\nSELECT {columns} FROM {name}"


def model_select(name: str, columns: str = "*") -> str:
    return with_models(f"SELECT {columns} FROM {name}")
