"""Name -> (DataFrame builder, SQL twin)."""

from __future__ import annotations

from . import jobs, logs, netsales, recon, reports, statements
from .oracle_reports import SQL as REPORTS_SQL
from .oracle_logs import SQL as LOGS_SQL
from .oracle_netsales import SQL as NETSALES_SQL
from .oracle_recon import SQL as RECON_SQL

QUERIES = {
    "reconcile_accounts": recon.reconcile_accounts,
    "reconcile_summary": recon.reconcile_summary,
    "net_outcomes": recon.net_outcomes,
    "attribution_key": recon.attribution_key,
    "resolve_contracts": recon.resolve_contracts,
    "resolve_contracts_window": recon.resolve_contracts_window,
    "resolve_contracts_monthly": recon.resolve_contracts_monthly,
    "resolve_contract_choice": recon.resolve_contract_choice,
    "reconcile_null_keys": recon.reconcile_null_keys,
    "remap_accounts": recon.remap_accounts,
    "gaps_with_lineage": recon.gaps_with_lineage,
    "reuse_with_gaps": recon.reuse_with_gaps,
    "reconcile_contracts": recon.reconcile_contracts,
    "late_moveouts": recon.late_moveouts,
    "same_day_pairs": recon.same_day_pairs,
    "legacy_keys": recon.legacy_keys,
    "label_gaps": recon.label_gaps,
    "enrich_gaps": recon.enrich_gaps,
    "missing_keys": recon.missing_keys,
    "completeness": recon.completeness,
    "incomplete_rows": recon.incomplete_rows,
    "agreement_lineage": recon.agreement_lineage,
    "net_sales_levels": netsales.net_sales_levels,
    "net_sales_global": netsales.net_sales_global,
    "net_sales_region": netsales.net_sales_region,
    "net_sales_nation": netsales.net_sales_nation,
    "net_sales_location": netsales.net_sales_location,
    "net_sales_city": netsales.net_sales_city,
    "net_sales_territory": netsales.net_sales_territory,
    "net_sales_jv": netsales.net_sales_jv,
    "net_sales_day": netsales.net_sales_day,
    "net_sales_window": netsales.net_sales_window,
    "net_zero_transfers": netsales.net_zero_transfers,
    "transfer_locations": netsales.transfer_locations,
    "net_sales_with_id": netsales.net_sales_with_id,
    "exceptions": logs.exceptions,
    "exception_texts": logs.exception_texts,
    "failed_events": logs.failed_events,
    "failed_event_keys": logs.failed_event_keys,
    "error_rate": logs.error_rate,
    "error_rate_text_ids": logs.error_rate_text_ids,
    "log_kpi": jobs.log_kpi_of_events,
    "log_runs": jobs.log_runs,
    "summary_json": jobs.summary_through_json,
    "resolve_contracts_stored": jobs.resolve_contracts_stored,
    "label_gaps_stored": jobs.label_gaps_stored,
    "net_sales_levels_stored": jobs.net_sales_levels_stored,
    "reconcile_changed": recon.reconcile_changed,
    "distinct_accounts": recon.distinct_accounts,
    "gaps_csv": jobs.gaps_through_csv,
    "clean_text_extras": logs.clean_text_extras,
    "clean_text": logs.clean_text,
    "funnel": reports.funnel,
    "funnel_six_stages": reports.funnel_six_stages,
    "events_in_range": reports.events_in_range,
    "compare_counts": reports.compare_counts,
    "note_share": reports.note_share,
    "durations": reports.durations,
    "segment_volumes": reports.segment_volumes,
    "segment_volumes_month_of_year": reports.segment_volumes_month_of_year,
    "reuse_conflicts": reports.reuse_conflicts,
    "tag_effort": reports.tag_effort,
    "tag_effort_monthly": reports.tag_effort_monthly,
    "in_list": reports.in_list,
    "or_precedence": reports.or_precedence,
    "distinct_rows": reports.distinct_rows,
    "payment_counts": reports.payment_counts,
    "semi_flag": reports.semi_flag,
    "both_status": reports.both_status,
    "status_by_month": reports.status_by_month,
    "monthly_accounts": reports.monthly_accounts,
    "close_durations": reports.close_durations,
    "ticket_tags": reports.ticket_tags,
    "month_of_year_compare": statements.month_of_year_compare,
    "execution_errors": statements.execution_errors,
}

ORACLE = {**RECON_SQL, **NETSALES_SQL, **LOGS_SQL, **REPORTS_SQL,
          "log_kpi": LOGS_SQL["error_rate"], "gaps_csv": RECON_SQL["reconcile_accounts"],
          "reconcile_changed": RECON_SQL["reconcile_accounts"], "summary_json": RECON_SQL["reconcile_summary"],
          **{f"{q}_stored": (RECON_SQL | NETSALES_SQL)[q] for q in ("resolve_contracts", "label_gaps", "net_sales_levels")}}
