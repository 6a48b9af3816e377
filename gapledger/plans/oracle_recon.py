"""DuckDB / ANSI SQL twins of the reconciliation plans (the correctness gate).

Written independently of the DataFrame code from the same definitions, over
the pre-registered views (orders, lineitem, ...).
"""

from __future__ import annotations

DESKS = "CAST(floor(o_totalprice / 10000) AS BIGINT)"

CTE = {
    "opp": f"""opp AS (
  SELECT o_orderkey AS opp_id, o_custkey AS account_id, o_orderdate AS close_date,
         o_orderstatus AS status_code, o_orderpriority AS type_c, {DESKS} AS desks,
         CASE WHEN o_orderstatus = 'O' THEN -{DESKS} ELSE {DESKS} END AS total_desks_net,
         'R-' || CAST(o_custkey AS VARCHAR) AS reservation_key,
         'C-' || CAST(o_orderkey AS VARCHAR) AS contract_key
  FROM orders)""",
    "led": """led AS (
  SELECT o.o_custkey AS account_id, l.l_orderkey AS reservation_id, l.l_linenumber AS line_no,
         l.l_suppkey AS location_id,
         CASE WHEN l.l_returnflag = 'N' THEN 'Move In' WHEN l.l_returnflag = 'R' THEN 'Move Out'
              WHEN l.l_linestatus = 'F' THEN 'Transfer In' ELSE 'Transfer Out' END AS action_type,
         CASE WHEN l.l_returnflag = 'A' THEN 'Transfer' END AS transfer_type,
         CAST(l.l_quantity AS BIGINT) *
           CASE WHEN l.l_returnflag = 'N' OR (l.l_returnflag = 'A' AND l.l_linestatus = 'F') THEN 1 ELSE -1 END
           AS desks_changed,
         l.l_shipdate AS date_reserved, l.l_shipdate AS date_physical_move,
         CASE WHEN o.o_orderpriority = '1-URGENT' THEN 'HotDesk' ELSE 'Office' END AS reservable_type
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)""",
    "loc": """loc AS (
  SELECT s.s_suppkey AS location_id, s.s_name AS location_name, n.n_name || '/' || CAST(s.s_suppkey % 3 AS VARCHAR) AS city, n.n_name AS market,
         r.r_name || '/' || CAST(n.n_nationkey % 2 AS VARCHAR) AS territory, r.r_name AS region, n.n_name AS country, n.n_nationkey AS country_key,
         'L' || CAST(s.s_suppkey AS VARCHAR) AS code,
         CAST(DATE '1994-01-01' + to_months(n.n_nationkey) AS DATE) AS opened_on,
         s.s_acctbal < 0 AS is_joint_venture
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)""",
    "acc": """acc AS (
  SELECT c.c_custkey AS account_id, c.c_name AS account_name, c.c_mktsegment AS segment, n.n_name AS country,
         n.n_nationkey AS country_key
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)""",
    "reuse": """reuse AS (
  SELECT event_id AS record_id, user_id AS company_id, 'C-' || CAST(event_id AS VARCHAR) AS agreement_uuid,
         event_type AS contract_event_type, props AS contract_event_params,
         CASE WHEN event_type = 'signup' THEN 'New Opportunity : OPP-' || CAST(user_id AS VARCHAR)
              WHEN event_type = 'view' THEN 'Update Opportunity : OPP-' || CAST(user_id AS VARCHAR)
              WHEN event_type = 'click' THEN 'Update Opportunity : OPP-' || CAST(user_id + 1 AS VARCHAR)
              WHEN event_id % 2 = 0 THEN 'New Opportunity : OPP-' || CAST(user_id + 2 AS VARCHAR)
                                         || '; Update Opportunity : OPP-' || CAST(user_id + 1 AS VARCHAR)
              ELSE 'No Action' END AS crm_response,
         CASE WHEN value >= 50 THEN 'OPP-' || CAST(user_id AS VARCHAR) END AS opportunity_id_found,
         ts AS created_at
  FROM events)""",
    # ledger rows resolved to an agreement (D9) and attributed (D3, ledger side)
    "rled": """flags AS (
  SELECT l_orderkey AS reservation_id, l_orderkey AS agreement_id,
         bool_or(l_linestatus = 'F') AS has_start, bool_or(l_returnflag = 'R') AS has_end
  FROM lineitem GROUP BY 1, 2),
rled AS (
  SELECT v.*, ma.agreement_uuid, loc.country, loc.country_key,
         CASE WHEN v.reservable_type = 'HotDesk' AND loc.country NOT IN
                   ('NATION_1','NATION_4','NATION_7','NATION_10','NATION_13','NATION_16','NATION_19','NATION_22')
              THEN 'R-' || CAST(v.account_id AS VARCHAR) ELSE ma.agreement_uuid END AS attributed_key
  FROM led v
  LEFT JOIN flags cr ON v.reservation_id = cr.reservation_id
       AND ((v.action_type IN ('Move In', 'Transfer In') AND cr.has_start)
            OR (v.action_type IN ('Move Out', 'Transfer Out') AND cr.has_end))
  LEFT JOIN (SELECT o_orderkey AS agreement_id, 'C-' || CAST(o_orderkey AS VARCHAR) AS agreement_uuid FROM orders) ma
       ON cr.agreement_id = ma.agreement_id
  LEFT JOIN loc ON v.location_id = loc.location_id)""",
    "copp": """copp AS (
  SELECT opp.*, acc.country, acc.country_key,
         CASE WHEN opp.type_c = '1-URGENT' AND (acc.country NOT IN
                   ('NATION_1','NATION_4','NATION_7','NATION_10','NATION_13','NATION_16','NATION_19','NATION_22')
                   OR acc.country IS NULL)
              THEN opp.reservation_key ELSE opp.contract_key END AS attributed_key
  FROM opp LEFT JOIN acc ON opp.account_id = acc.account_id)""",
    "cgaps": """crm_c AS (
  SELECT account_id, attributed_key, CAST(date_trunc('month', close_date) AS DATE) AS period,
         min(country_key) AS country_key,
         COALESCE(SUM(CASE WHEN status_code = 'F' THEN desks END), 0)
           + COALESCE(SUM(CASE WHEN status_code = 'O' THEN total_desks_net END), 0) AS crm_total
  FROM copp WHERE status_code IN ('F', 'O') GROUP BY 1, 2, 3),
led_c AS (
  SELECT account_id, attributed_key, CAST(date_trunc('month', date_reserved) AS DATE) AS period,
         min(country_key) AS country_key, SUM(desks_changed) AS ledger_total
  FROM rled GROUP BY 1, 2, 3),
cj AS (
  SELECT COALESCE(c.account_id, l.account_id) AS account_id,
         COALESCE(c.attributed_key, l.attributed_key) AS attributed_key,
         COALESCE(c.period, l.period) AS period,
         (SELECT n_name FROM nation WHERE n_nationkey = COALESCE(l.country_key, c.country_key)) AS country,
         CAST(COALESCE(c.crm_total, 0) AS BIGINT) AS crm_total,
         CAST(COALESCE(l.ledger_total, 0) AS BIGINT) AS ledger_total
  FROM crm_c c FULL JOIN led_c l
    ON c.account_id = l.account_id AND c.attributed_key = l.attributed_key AND c.period = l.period),
cgaps AS (
  SELECT *, crm_total - ledger_total AS net_gap, abs(crm_total - ledger_total) AS abs_gap
  FROM cj WHERE crm_total - ledger_total <> 0)""",
    "acct_full": """crm_a AS (
  SELECT account_id, CAST(date_trunc('month', close_date) AS DATE) AS period,
         COALESCE(SUM(CASE WHEN status_code = 'F' THEN desks END), 0)
           + COALESCE(SUM(CASE WHEN status_code = 'O' THEN total_desks_net END), 0) AS crm_total
  FROM opp WHERE status_code IN ('F', 'O') GROUP BY 1, 2),
led_a AS (
  SELECT account_id, CAST(date_trunc('month', date_reserved) AS DATE) AS period,
         SUM(desks_changed) AS ledger_total
  FROM led GROUP BY 1, 2),
acct_full AS (
  SELECT COALESCE(c.account_id, l.account_id) AS account_id, COALESCE(c.period, l.period) AS period,
         CAST(COALESCE(c.crm_total, 0) AS BIGINT) AS crm_total,
         CAST(COALESCE(l.ledger_total, 0) AS BIGINT) AS ledger_total,
         CAST(COALESCE(c.crm_total, 0) - COALESCE(l.ledger_total, 0) AS BIGINT) AS net_gap,
         CAST(abs(COALESCE(c.crm_total, 0) - COALESCE(l.ledger_total, 0)) AS BIGINT) AS abs_gap
  FROM crm_a c FULL JOIN led_a l ON c.account_id = l.account_id AND c.period = l.period)""",
}

# dependencies between the CTE snippets
DEPS = {
    "rled": ["led", "loc"],
    "copp": ["opp", "acc"],
    "cgaps": ["copp", "rled"],
    "acct_full": ["opp", "led"],
}


def with_(*names: str) -> str:
    """``WITH`` clause holding the named snippets and what they depend on."""
    order: list[str] = []

    def add(n):
        for d in DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(CTE[n] for n in order) + "\n"


def rled_sql(start: str | None = None, end: str | None = None) -> str:
    """The resolved ledger with only the rows of a window; requests of the
    window widened by a day on each side."""
    sql = with_("rled")
    if start is None:
        return sql
    sql = sql.replace("FROM lineitem GROUP BY 1, 2)", f"FROM lineitem WHERE l_shipdate >= DATE '{start}' - 1 "
                      f"AND l_shipdate < DATE '{end}' + 1 GROUP BY 1, 2)")
    return sql.replace("  FROM led v\n", f"  FROM (SELECT * FROM led WHERE date_reserved >= DATE '{start}' "
                       f"AND date_reserved < DATE '{end}') v\n")


def _late_sql() -> str:
    return """late AS (
  SELECT key, period FROM (
    SELECT key, period, min_by(m, ord) AS first_m FROM (
      SELECT unnest([reservation_key, contract_key]) AS key,
             CAST(date_trunc('month', close_date) - INTERVAL 1 MONTH AS DATE) AS period,
             {'a': close_date, 'b': opp_id} AS ord, total_desks_net AS m
      FROM opp WHERE total_desks_net < 0) t
    WHERE key IS NOT NULL GROUP BY key, period) s
  WHERE first_m = -1)"""


def _same_day_sql() -> str:
    return """sameday AS (
  SELECT 'C-' || CAST(reservation_id AS VARCHAR) AS key FROM led
  GROUP BY 1 HAVING count(*) = 2 AND min(date_trunc('month', date_reserved)) = max(date_trunc('month', date_reserved)))"""


def _legacy_sql() -> str:
    return """legacy AS (
  SELECT reservation_key AS key, min(close_date) AS first_close FROM opp
  WHERE status_code = 'F' AND reservation_key IS NOT NULL
  GROUP BY 1 HAVING min(close_date) < TIMESTAMP '1995-06-01')"""


SQL = {
    "reconcile_accounts": with_("acct_full") + """
SELECT account_id, period, crm_total, ledger_total, net_gap, abs_gap FROM acct_full WHERE net_gap <> 0""",
    "reconcile_summary": with_("acct_full") + """
SELECT min(period) AS period_from, max(period) AS period_to,
       CAST(SUM(ledger_total) AS BIGINT) AS ledger_total_sum, CAST(SUM(crm_total) AS BIGINT) AS crm_total_sum,
       CAST(SUM(net_gap) AS BIGINT) AS net_gap_sum, CAST(SUM(abs_gap) AS BIGINT) AS abs_gap_sum,
       count(DISTINCT account_id) AS accounts_total,
       count(DISTINCT CASE WHEN net_gap <> 0 THEN account_id END) AS accounts_with_gap
FROM acct_full""",
    "net_outcomes": with_("opp") + """
SELECT account_id,
       CAST(COALESCE(SUM(CASE WHEN status_code = 'F' THEN desks END), 0) AS BIGINT) AS won,
       CAST(COALESCE(SUM(CASE WHEN status_code = 'O' THEN total_desks_net END), 0) AS BIGINT) AS lost,
       CAST(COALESCE(SUM(CASE WHEN status_code = 'F' THEN desks END), 0)
            + COALESCE(SUM(CASE WHEN status_code = 'O' THEN total_desks_net END), 0) AS BIGINT) AS net
FROM opp WHERE status_code IN ('F', 'O') GROUP BY account_id""",
    "attribution_key": with_("copp") + """
SELECT opp_id, account_id, country, attributed_key FROM copp""",
    "resolve_contracts": with_("rled") + """
SELECT account_id, agreement_uuid, CAST(SUM(desks_changed) AS BIGINT) AS desks_changed, count(*) AS n_rows
FROM rled GROUP BY account_id, agreement_uuid""",
    "resolve_contracts_window": rled_sql("1995-01-10", "1996-01-10") + """
SELECT account_id, agreement_uuid, CAST(SUM(desks_changed) AS BIGINT) AS desks_changed, count(*) AS n_rows
FROM rled GROUP BY account_id, agreement_uuid""",
    "resolve_contract_choice": with_("led") + """,
req AS (SELECT l_orderkey AS rid, l_orderkey * 10 + l_linenumber % 3 AS aid, l_shipdate AS ts,
               l_linestatus = 'F' AS s, l_returnflag = 'R' AS e FROM lineitem),
pick AS (
  SELECT rid, 'in' AS side, arg_max(aid, {'a': ts, 'b': aid}) AS aid FROM req WHERE s GROUP BY rid
  UNION ALL SELECT rid, 'out', arg_max(aid, {'a': ts, 'b': aid}) FROM req WHERE e GROUP BY rid)
SELECT v.account_id, 'M-' || CAST(p.aid AS VARCHAR) AS agreement_uuid,
       CAST(SUM(v.desks_changed) AS BIGINT) AS desks_changed, count(*) AS n_rows
FROM led v LEFT JOIN pick p ON v.reservation_id = p.rid
  AND p.side = CASE WHEN v.action_type IN ('Move In', 'Transfer In') THEN 'in' ELSE 'out' END
GROUP BY 1, 2""",
    "resolve_contracts_monthly": with_("led") + """,
req AS (SELECT l_orderkey AS rid, l_orderkey * 10 + l_linenumber % 3 AS aid, l_shipdate AS ts,
               l_linestatus = 'F' AS s, l_returnflag = 'R' AS e FROM lineitem),
months AS (SELECT DISTINCT CAST(date_trunc('month', date_reserved) AS DATE) AS m FROM led),
near AS (SELECT * FROM req JOIN months ON ts >= m - INTERVAL 1 DAY AND ts < m + INTERVAL 1 MONTH + INTERVAL 1 DAY),
pick AS (
  SELECT rid, m, 'in' AS side, arg_max(aid, {'a': ts, 'b': aid}) AS aid FROM near WHERE s GROUP BY rid, m
  UNION ALL SELECT rid, m, 'out', arg_max(aid, {'a': ts, 'b': aid}) FROM near WHERE e GROUP BY rid, m)
SELECT CAST(date_trunc('month', v.date_reserved) AS DATE) AS period, v.account_id,
       'M-' || CAST(p.aid AS VARCHAR) AS agreement_uuid,
       CAST(SUM(v.desks_changed) AS BIGINT) AS desks_changed, count(*) AS n_rows
FROM led v LEFT JOIN pick p ON v.reservation_id = p.rid AND p.m = date_trunc('month', v.date_reserved)
  AND p.side = CASE WHEN v.action_type IN ('Move In', 'Transfer In') THEN 'in' ELSE 'out' END
GROUP BY 1, 2, 3""",
    "reconcile_null_keys": with_("opp", "rled") + """,
c AS (SELECT CASE WHEN type_c <> '2-HIGH' THEN contract_key END AS key, SUM(desks) AS t FROM opp WHERE status_code = 'F' GROUP BY 1),
l AS (SELECT agreement_uuid AS key, SUM(desks_changed) AS t FROM rled GROUP BY 1)
SELECT COALESCE(c.key, l.key) AS key, CAST(COALESCE(c.t, 0) AS BIGINT) AS crm_total,
       CAST(COALESCE(l.t, 0) AS BIGINT) AS ledger_total,
       CAST(COALESCE(c.t, 0) - COALESCE(l.t, 0) AS BIGINT) AS net_gap,
       CAST(abs(COALESCE(c.t, 0) - COALESCE(l.t, 0)) AS BIGINT) AS abs_gap
FROM c FULL JOIN l ON c.key IS NOT DISTINCT FROM l.key WHERE COALESCE(c.t, 0) <> COALESCE(l.t, 0)""",
    "remap_accounts": with_("led", "acc") + """
SELECT 'ORG-' || a.country AS account_id, CAST(SUM(v.desks_changed) AS BIGINT) AS desks
FROM led v JOIN acc a ON v.account_id = a.account_id WHERE a.segment <> 'MACHINERY' GROUP BY 1""",
    "gaps_with_lineage": with_("cgaps") + """,
lin AS (SELECT 'C-' || CAST(ma.o_orderkey AS VARCHAR) AS ma_uuid, r.p_partkey AS reservation_id, r.p_name AS reservable
  FROM lineitem cr JOIN orders ma ON ma.o_orderkey = cr.l_orderkey LEFT JOIN part r ON r.p_partkey = cr.l_partkey
  WHERE cr.l_linenumber = 1 AND ma.o_orderdate IS NOT NULL)
SELECT g.account_id, g.attributed_key, g.period, g.net_gap, lin.reservation_id, lin.reservable
FROM cgaps g LEFT JOIN lin ON g.attributed_key = lin.ma_uuid""",
    "reuse_with_gaps": with_("cgaps", "reuse") + """
SELECT r.record_id, r.agreement_uuid, r.contract_event_type, g.period, g.net_gap
FROM reuse r LEFT JOIN cgaps g ON g.attributed_key = r.agreement_uuid""",
    "reconcile_contracts": with_("cgaps") + """
SELECT account_id, attributed_key, period, country, crm_total, ledger_total, net_gap, abs_gap FROM cgaps""",
    "late_moveouts": with_("opp") + ", " + _late_sql() + "\nSELECT key, period FROM late",
    "same_day_pairs": with_("led") + ", " + _same_day_sql() + "\nSELECT key FROM sameday",
    "legacy_keys": with_("opp") + ", " + _legacy_sql() + "\nSELECT key, first_close FROM legacy",
    "label_gaps": with_("cgaps", "reuse") + ", " + _late_sql() + ", " + _same_day_sql() + ", "
    + _legacy_sql() + """
SELECT g.account_id, a.account_name, g.attributed_key, g.period, g.country, g.crm_total, g.ledger_total,
       g.net_gap, g.abs_gap,
       CASE WHEN contains(a.account_name, 'Customer#00000001') THEN 'own account'
            WHEN g.country = 'NATION_5' AND g.ledger_total < 0 THEN 'China moveout'
            WHEN g.attributed_key IS NULL OR g.attributed_key = '' THEN 'Unable to connect reservation to a membership agreement'
            WHEN g.ledger_total < g.crm_total AND EXISTS (SELECT 1 FROM late WHERE late.key = g.attributed_key AND late.period = g.period)
                 THEN 'HD move out one month late'
            WHEN g.ledger_total = 0 AND g.crm_total = 1 AND EXISTS (SELECT 1 FROM sameday s WHERE s.key = g.attributed_key)
                 THEN 'HD move in and move out at same time'
            WHEN g.ledger_total = -1 AND g.crm_total = 0 AND EXISTS (SELECT 1 FROM legacy x WHERE x.key = g.attributed_key)
                 THEN 'Old HD missing move in and move out'
            WHEN EXISTS (SELECT 1 FROM reuse r WHERE r.agreement_uuid = g.attributed_key)
                 THEN 'Possible issue with reuse logic'
            ELSE '' END AS reason
FROM cgaps g LEFT JOIN acc a ON g.account_id = a.account_id""",
    "enrich_gaps": with_("cgaps", "reuse") + """
SELECT g.account_id, g.attributed_key, g.period, g.net_gap, r.contract_event_type, r.crm_response, r.record_id
FROM cgaps g LEFT JOIN reuse r ON g.attributed_key = r.agreement_uuid AND g.account_id = r.company_id""",
    "missing_keys": """
SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem""",
    "completeness": """
WITH li AS (
  SELECT l_orderkey, min(l_shipdate) AS contract_sent_date,
         min(CASE WHEN l_returnflag = 'R' THEN l_orderkey END) AS contract_id,
         min(CASE WHEN l_linestatus = 'F' THEN l_shipdate END) AS contract_signed_on
  FROM lineitem GROUP BY l_orderkey)
SELECT count(*) AS n_rows,
       count(*) FILTER (WHERE contract_sent_date IS NULL) AS missing_contract_sent_date,
       count(*) FILTER (WHERE contract_id IS NULL) AS missing_contract_id,
       count(*) FILTER (WHERE contract_signed_on IS NULL) AS missing_contract_signed_on
FROM orders o LEFT JOIN li ON o.o_orderkey = li.l_orderkey""",
    "incomplete_rows": """
WITH li AS (
  SELECT l_orderkey, min(l_shipdate) AS contract_sent_date,
         min(CASE WHEN l_returnflag = 'R' THEN l_orderkey END) AS contract_id,
         min(CASE WHEN l_linestatus = 'F' THEN l_shipdate END) AS contract_signed_on
  FROM lineitem GROUP BY l_orderkey)
SELECT o.o_orderkey, contract_sent_date IS NULL AS lacks_contract_sent_date,
       contract_id IS NULL AS lacks_contract_id, contract_signed_on IS NULL AS lacks_contract_signed_on
FROM orders o LEFT JOIN li ON o.o_orderkey = li.l_orderkey
WHERE contract_sent_date IS NULL OR contract_id IS NULL OR contract_signed_on IS NULL""",
    "agreement_lineage": """
SELECT ma.o_custkey AS account_id, ma.o_orderdate AS ma_created, cr.l_shipdate AS cr_created,
       r.p_partkey AS reservation_id, 'C-' || CAST(ma.o_orderkey AS VARCHAR) AS ma_uuid,
       CASE WHEN ma.o_orderstatus = 'F' THEN ma.o_orderdate END AS signed_at,
       CASE WHEN cr.l_linestatus = 'F' THEN CAST(cr.l_shipdate AS DATE) END AS started_on,
       CASE WHEN cr.l_returnflag = 'R' THEN CAST(cr.l_shipdate AS DATE) END AS ended_on,
       r.p_name AS reservable
FROM lineitem cr
FULL JOIN orders ma ON ma.o_orderkey = cr.l_orderkey
FULL JOIN part r ON r.p_partkey = cr.l_partkey
WHERE ma.o_orderdate IS NOT NULL AND cr.l_linenumber = 1""",
}

SQL["distinct_accounts"] = f"""
WITH {CTE["opp"]}, {CTE["led"]},
rows AS (SELECT 'crm' AS "group", account_id, close_date AS day FROM opp UNION ALL SELECT 'ledger', account_id, date_reserved FROM led),
each AS (SELECT * FROM rows UNION ALL SELECT 'all', account_id, day FROM rows),
units AS (SELECT unnest(['month', 'quarter', 'year']) AS unit)
SELECT "group", unit, CAST(date_trunc(unit, day) AS DATE) AS period, count(DISTINCT account_id) AS n_distinct
FROM each, units GROUP BY ALL"""
