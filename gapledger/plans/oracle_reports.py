"""SQL twins of the report plans."""

from __future__ import annotations

from .oracle_recon import with_

_BRANDS = ", ".join(f"'Brand#{i}'" for i in range(1, 70, 2))
_M = "CAST(date_trunc('month', {c}) AS DATE)"

SQL = {
    "funnel": f"""
WITH s AS (
  SELECT {_M.format(c='o_orderdate')} AS period, 'opps_open' AS stage FROM orders
  UNION ALL SELECT {_M.format(c='o_orderdate')}, 'won' FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT {_M.format(c='l_shipdate')}, 'agreements' FROM lineitem
  UNION ALL SELECT {_M.format(c='l_shipdate')}, 'signed' FROM lineitem WHERE l_linestatus = 'F'),
a AS (SELECT period, count(*) AS opps_open FROM s WHERE stage = 'opps_open' GROUP BY 1),
b AS (SELECT period, count(*) AS won FROM s WHERE stage = 'won' GROUP BY 1),
c AS (SELECT period, count(*) AS agreements FROM s WHERE stage = 'agreements' GROUP BY 1),
d AS (SELECT period, count(*) AS signed FROM s WHERE stage = 'signed' GROUP BY 1)
SELECT a.period, a.opps_open, b.won, c.agreements, d.signed
FROM a JOIN b ON a.period = b.period JOIN c ON a.period = c.period JOIN d ON a.period = d.period""",
    "compare_counts": with_("opp", "led") + f""",
c AS (SELECT {_M.format(c='close_date')} AS period, count(DISTINCT account_id) AS crm
       FROM opp WHERE status_code = 'F' GROUP BY 1),
l AS (SELECT {_M.format(c='date_reserved')} AS period, count(DISTINCT account_id) AS ledger
       FROM led WHERE desks_changed > 0 GROUP BY 1)
SELECT c.period, c.crm, l.ledger, crm - ledger AS diff FROM c JOIN l ON l.period = c.period""",
    "note_share": """
SELECT period, total, matching, round(100.0 * matching / total, 6) AS share_pct FROM (
  SELECT CAST(ts AS DATE) AS period, count(*) AS total,
         count(*) FILTER (WHERE props LIKE '%"k": 1%') AS matching
  FROM events GROUP BY 1) t
WHERE matching > 0""",
    "durations": """
SELECT CAST(year(o.o_orderdate) AS INTEGER) AS year, CAST(month(o.o_orderdate) AS INTEGER) AS month,
       o.o_orderpriority AS product_type, c.c_mktsegment AS deal_type, count(*) AS n,
       round(avg(extract(day FROM (l.l_shipdate - o.o_orderdate))), 6) AS avg_duration
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
WHERE o.o_orderstatus = 'F'
GROUP BY 1, 2, 3, 4""",
    "segment_volumes": with_("opp", "acc") + f"""
SELECT {_M.format(c='opp.close_date')} AS period, acc.country_key AS type_id, acc.segment AS segment, count(opp.opp_id) AS opps,
       CAST(SUM(CASE WHEN opp.status_code = 'F' THEN opp.desks END) AS BIGINT) AS desks_won
FROM opp JOIN acc ON opp.account_id = acc.account_id GROUP BY 1, 2, 3""",
    "segment_volumes_month_of_year": with_("opp", "acc") + """
SELECT CAST(month(opp.close_date) AS INTEGER) AS period, acc.country_key AS type_id, acc.segment AS segment,
       count(opp.opp_id) AS opps, CAST(SUM(CASE WHEN opp.status_code = 'F' THEN opp.desks END) AS BIGINT) AS desks_won
FROM opp JOIN acc ON opp.account_id = acc.account_id GROUP BY 1, 2, 3""",
    "funnel_six_stages": """
SELECT period, l.n AS leads, t.n AS tours, a.n AS opps_open, b.n AS won, c.n AS agreements, d.n AS signed FROM
  (SELECT CAST(month(ts) AS INTEGER) AS period, count(*) AS n FROM events WHERE event_type = 'view' GROUP BY 1) l
  JOIN (SELECT CAST(month(ts) AS INTEGER) AS period, count(*) AS n FROM events WHERE event_type = 'click' GROUP BY 1) t USING (period)
  JOIN (SELECT CAST(month(o_orderdate) AS INTEGER) AS period, count(*) AS n FROM orders GROUP BY 1) a USING (period)
  JOIN (SELECT CAST(month(o_orderdate) AS INTEGER) AS period, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) b USING (period)
  JOIN (SELECT CAST(month(l_shipdate) AS INTEGER) AS period, count(*) AS n FROM lineitem GROUP BY 1) c USING (period)
  JOIN (SELECT CAST(month(l_shipdate) AS INTEGER) AS period, count(*) AS n FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1) d USING (period)""",
    "events_in_range": """
SELECT event_type, count(event_id) AS n FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' GROUP BY 1""",
    "reuse_conflicts": with_("reuse") + """
SELECT record_id, company_id, crm_response, opportunity_id_found, 1 AS conflict FROM reuse
WHERE crm_response LIKE '%New Opportunity :%' AND opportunity_id_found IS NOT NULL
UNION ALL SELECT record_id, company_id, crm_response, opportunity_id_found, 2 FROM reuse
WHERE crm_response LIKE '%Update Opportunity :%' AND opportunity_id_found IS NULL
UNION ALL SELECT record_id, company_id, crm_response, opportunity_id_found, 3 FROM reuse
WHERE crm_response LIKE '%Update Opportunity :%' AND opportunity_id_found IS NOT NULL
  AND crm_response NOT LIKE '%' || opportunity_id_found || '%'""",
    "tag_effort": """
SELECT event_type AS tag, count(event_id) AS n,
       round(avg(extract(hour FROM (ts - CAST(CAST(ts AS DATE) AS TIMESTAMP)))), 6) AS diff
FROM events WHERE lower(event_type) LIKE '%click%' OR lower(event_type) LIKE '%sign%'
GROUP BY 1""",
    "tag_effort_monthly": """
SELECT event_type AS tag, CAST(month(ts) AS INTEGER) AS month, count(event_id) AS n,
       round(avg(extract(hour FROM (ts - CAST(CAST(ts AS DATE) AS TIMESTAMP)))), 6) AS diff
FROM events WHERE lower(event_type) LIKE '%click%' OR lower(event_type) LIKE '%sign%'
GROUP BY 1, 2""",
    "in_list": f"SELECT DISTINCT p_name FROM part WHERE p_brand IN ({_BRANDS})",
    "or_precedence": """
SELECT CAST(ts AS DATE) AS date, count(event_id) AS n FROM events
WHERE ts > TIMESTAMP '2024-01-15' AND lower(event_type) LIKE '%click%' OR lower(event_type) LIKE '%sign%'
GROUP BY 1""",
    "distinct_rows": "SELECT DISTINCT user_id, event_type FROM events WHERE event_type = 'purchase'",
    "payment_counts": """
SELECT o.o_orderpriority AS payment_method, count(c.c_custkey) AS n
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey GROUP BY 1""",
    "semi_flag": """
SELECT o_orderkey, o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AS has_return
FROM orders""",
    "both_status": """
WITH executed AS (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'),
     sent AS (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')
SELECT executed.o_custkey, count(*) AS n_pairs
FROM executed JOIN sent ON sent.o_custkey = executed.o_custkey GROUP BY 1""",
    "status_by_month": """
SELECT CAST(date_part('month', ma.o_orderdate) AS INTEGER) AS datepart, ma.o_orderstatus AS status,
       count(ma.o_orderkey) AS n
FROM part r JOIN lineitem cr ON cr.l_partkey = r.p_partkey JOIN orders ma ON ma.o_orderkey = cr.l_orderkey
WHERE r.p_type = 'ECONOMY'
GROUP BY datepart, status""",
    "month_of_year_compare": with_("opp", "led") + """,
ledger_m AS (SELECT CAST(date_part('month', date_reserved) AS INTEGER) AS month, count(DISTINCT account_id) AS cnt
           FROM led WHERE desks_changed > 0 GROUP BY 1),
crm_m AS (SELECT CAST(date_part('month', close_date) AS INTEGER) AS month, count(DISTINCT account_id) AS cnt
               FROM opp WHERE status_code = 'F' GROUP BY 1)
SELECT crm_m.month, crm_m.cnt AS crm, ledger_m.cnt AS ledger, crm_m.cnt - ledger_m.cnt AS diff
FROM crm_m JOIN ledger_m ON ledger_m.month = crm_m.month""",
    "execution_errors": """
SELECT count(o_orderkey) AS n FROM orders WHERE o_orderstatus <> 'F' OR o_orderstatus IS NULL""",
    "close_durations": """
SELECT o.o_orderkey AS agreement_id, o.o_orderdate AS created_at, o.o_orderdate AS signed_at,
       c.c_name AS account_name, c.c_mktsegment AS segment
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
WHERE o.o_orderstatus = 'F'""",
    "ticket_tags": """
SELECT user_id AS ticket_id, string_agg(DISTINCT event_type, ', ' ORDER BY event_type) AS tags
FROM events GROUP BY user_id""",
    "monthly_accounts": with_("opp") + f"""
SELECT {_M.format(c='close_date')} AS period, count(DISTINCT account_id) AS accounts
FROM opp WHERE status_code = 'F' GROUP BY 1""",
}
