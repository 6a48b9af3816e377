"""SQL twins of the net-sales plans."""

from __future__ import annotations

from .oracle_recon import with_

NZ = """nzf AS (
  SELECT l.l_orderkey AS reservation_id, CAST(date_trunc('month', o.o_orderdate) AS DATE) AS period,
         CAST(SUM(CAST(l.l_quantity AS BIGINT)) AS BIGINT) AS net_zero_upgrades,
         CAST(-SUM(CAST(l.l_quantity AS BIGINT)) AS BIGINT) AS net_zero_downgrades
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  WHERE date_trunc('month', o.o_orderdate) = date_trunc('month', l.l_shipdate)
    AND (CASE WHEN l.l_returnflag = 'A' THEN 'Desk Transfer' ELSE 'New' END) ILIKE '%transfer'
    AND (CASE WHEN l.l_linestatus = 'O' THEN 'Office TRANSFER' ELSE 'Churn' END) ILIKE '%transfer'
    AND datediff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) + l.l_partkey % 60 >= 27
  GROUP BY 1, 2)"""

JOINED = """nsj AS (
  SELECT v.*, CAST(date_trunc('month', v.date_reserved) AS DATE) AS period,
         t.location_name AS t_location_name, t.location_id AS t_location_id, t.opened_on, t.code,
         t.city, t.market, t.territory, t.region,
         CASE WHEN v.action_type = 'Transfer In' THEN nz.net_zero_upgrades END AS nz_up,
         CASE WHEN v.action_type = 'Transfer Out' THEN nz.net_zero_downgrades END AS nz_down
  FROM led v
  LEFT JOIN loc t ON v.location_id = t.location_id
  LEFT JOIN nzf nz ON v.reservation_id = nz.reservation_id
       AND CAST(date_trunc('month', v.date_reserved) AS DATE) = nz.period
       AND v.action_type IN ('Transfer In', 'Transfer Out')
  WHERE NOT t.is_joint_venture)"""

ORDER = ["Location", "City", "Market", "Territory", "Region", "Global"]


def detail_sql(level: str, unit: str = "month", jv: bool = False, window: tuple[str, str] | None = None) -> str:
    i = ORDER.index(level)
    joined = JOINED.replace("date_trunc('month'", f"date_trunc('{unit}'")
    if jv:
        joined = joined.replace("  WHERE NOT t.is_joint_venture)", ")")
    if window:
        joined = joined.replace("NOT t.is_joint_venture", "NOT t.is_joint_venture "
                                f"AND date_trunc('{unit}', v.date_reserved) >= DATE '{window[0]}' "
                                f"AND date_trunc('{unit}', v.date_reserved) < DATE '{window[1]}'")
    nz = NZ.replace("date_trunc('month'", f"date_trunc('{unit}'")
    month_no = ("((year(date_reserved) * 12 + month(date_reserved)) "
                "- (year(opened_on) * 12 + month(opened_on)))")
    cols = [
        ("location_name", "t_location_name", "VARCHAR", 0),
        ("location_id", "t_location_id", "BIGINT", 0),
        ("opened_on", "opened_on", "DATE", 0),
        ("month_no", month_no, "BIGINT", 0),
        ("building_short_code", "code", "VARCHAR", 0),
        ("city", "city", "VARCHAR", 1),
        ("market", "market", "VARCHAR", 2),
        ("territory", "territory", "VARCHAR", 3),
        ("region", "region", "VARCHAR", 4),
    ]
    shown = [f"{expr if i <= g else 'CAST(NULL AS ' + ty + ')'} AS {name}" for name, expr, ty, g in cols]
    sel = {"Location": "t_location_name", "City": "city", "Market": "market", "Territory": "territory",
           "Region": "region", "Global": "'Global'"}[level]
    tr = "SUM(CASE WHEN transfer_type IS NOT NULL THEN desks_changed ELSE 0 END)"
    up = "SUM(COALESCE(nz_up, 0))"
    down = "SUM(COALESCE(nz_down, 0))"
    out_l = "CASE WHEN action_type = 'Transfer Out' THEN t_location_name END"
    in_l = "CASE WHEN action_type = 'Transfer In' THEN t_location_name END"
    return (with_("led", "loc") + ", " + nz + ", " + joined + f"""
SELECT '{unit}' AS time_grouping, '{'yes' if jv else 'no'}' AS include_jv_markets, '{level}' AS select_grouping,
       period, account_id, {sel} AS user_selection, {', '.join(shown)},
       CAST(CASE WHEN {tr} > 0 THEN {tr} + {up} ELSE {up} END AS BIGINT) AS upgrades,
       CAST(CASE WHEN {tr} < 0 THEN {tr} + {down} ELSE {down} END AS BIGINT) AS downgrades,
       CAST(SUM(CASE WHEN action_type = 'Move In' THEN desks_changed ELSE 0 END) AS BIGINT) AS new_sales,
       CAST(SUM(CASE WHEN action_type = 'Move Out' THEN desks_changed ELSE 0 END) AS BIGINT) AS churn_notice,
       CAST(date_trunc('month', max(CASE WHEN desks_changed > 0 THEN date_physical_move END)) AS DATE)
         AS last_date_physical_move,
       string_agg(DISTINCT {out_l}, ', ' ORDER BY {out_l}) AS transfer_out_locations,
       string_agg(DISTINCT {in_l}, ', ' ORDER BY {in_l}) AS transfer_in_locations
FROM nsj
GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15""")


SQL = {
    "net_sales_levels": "\nUNION ALL\n".join(f"SELECT * FROM ({detail_sql(level)})" for level in ORDER),
    "net_sales_region": detail_sql("Region"),
    "net_sales_city": detail_sql("City"),
    "net_sales_territory": detail_sql("Territory"),
    "net_sales_jv": detail_sql("Market", jv=True),
    "net_sales_day": detail_sql("Global", unit="day"),
    "net_sales_window": detail_sql("Region", window=("1995-01-10", "1996-02-10")),
    "net_sales_nation": detail_sql("Market"),
    "net_sales_location": detail_sql("Location"),
    "net_zero_transfers": with_("opp") + ", " + NZ + """
SELECT reservation_id, period, net_zero_upgrades, net_zero_downgrades FROM nzf""",
    "net_sales_global": "WITH d AS (" + detail_sql("Global") + """)
SELECT a.account_name, d.account_id, d.period AS close_date,
       CAST(COALESCE(SUM(d.upgrades + d.new_sales), 0) AS BIGINT) AS net_sales
FROM d LEFT JOIN (SELECT c_custkey, c_name AS account_name FROM customer) a ON d.account_id = a.c_custkey
GROUP BY a.account_name, d.account_id, d.period""",
    "net_sales_with_id": "WITH d AS (" + detail_sql("Global") + """)
SELECT a.account_name, d.account_id, d.period AS close_date,
       CAST(COALESCE(SUM(d.upgrades + d.new_sales), 0) AS BIGINT) AS net_sales,
       row_number() OVER (ORDER BY d.period, d.account_id) AS id
FROM d LEFT JOIN (SELECT c_custkey, c_name AS account_name FROM customer) a ON d.account_id = a.c_custkey
GROUP BY a.account_name, d.account_id, d.period""",
    "transfer_locations": "WITH d AS (" + detail_sql("Global") + """)
SELECT period, account_id, transfer_in_locations, transfer_out_locations, last_date_physical_move FROM d""",
}
