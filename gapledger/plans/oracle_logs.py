"""SQL twins of the log plans."""

from __future__ import annotations

from ..functions.text import clean_text_sql, strip_pattern

EXC_LINES = """lines AS (
  SELECT 'ts=' || CAST(event_id AS VARCHAR) || ' exception ' || event_type
         || CASE WHEN event_id % 3 = 0 THEN ' retry' ELSE '' END
         || ' ' || props || ' records: ' || CAST(user_id AS VARCHAR)
         || CASE WHEN event_id % 5 = 0 THEN ' retry' ELSE '' END
         || ' id: ' || CAST(event_id AS VARCHAR) AS value
  FROM events),
exc AS (
  SELECT split_part(split_part(substr(value, strpos(value, 'exception')), 'id:', 1), 'records:', 1) AS exception
  FROM lines WHERE strpos(value, 'exception') > 0),
excf AS (SELECT exception FROM exc WHERE NOT contains(exception, 'retry'))"""

FAILED = """flines AS (
  SELECT 't Failed sending Contract event to SF with {"event_name"=>"' || event_type
         || '", "company_uuid"=>"' || lpad(CAST(user_id AS VARCHAR), 36, '0')
         || '", "membership_agreement_uuid"=>"' || lpad(CAST(event_id AS VARCHAR), 36, '0')
         || '"} exception ' || props || CASE WHEN event_id % 5 = 0 THEN ' retry' ELSE '' END AS value
  FROM events),
fp AS (
  SELECT value AS line,
         CASE WHEN strpos(value, '{') > 0 THEN split_part(substr(value, strpos(value, '{') + 1), '}', 1) END AS payload
  FROM flines WHERE NOT contains(value, 'retry')),
fev AS (
  SELECT """ + clean_text_sql("nullif(regexp_extract(payload, 'event_name\\W+([^\"]*)', 1), '')") + """ AS event,
         CASE WHEN strpos(line, 'exception') > 0 THEN trim(substr(line, strpos(line, 'exception') + 9)) END AS exception,
         """ + clean_text_sql("nullif(regexp_extract(line, 'company_uuid\\W+([^\"]*)', 1), '')") + """ AS company,
         CASE WHEN contains(payload, 'membership_agreement_uuid') THEN
           """ + clean_text_sql("nullif(regexp_extract(line, 'membership_agreement_uuid\\W+([^\"]*)', 1), '')") + """
         END AS contract
  FROM fp WHERE contains(payload, 'event_name'))"""



def extras_round_sql(e: str) -> str:
    """One round with the pairs ee -> e, | -> nothing, the -> T."""
    e = f"regexp_replace({e}, '{strip_pattern('.')}', '', 'g')"
    e = f"regexp_replace(regexp_replace({e}, '[\\n\\r\\t]', ' ', 'g'), ' {{2,}}', ' ', 'g')"
    e = f"replace(replace({e}, '\"', ''), ',', '')"
    return f"replace(replace(regexp_replace({e}, 'e{{2,}}', 'e', 'g'), '|', ''), 'the', 'T')"


SQL = {
    "exceptions": "WITH " + EXC_LINES + """
SELECT count(*) AS total_exceptions, count(DISTINCT exception) AS unique_exceptions FROM excf""",
    "exception_texts": "WITH " + EXC_LINES + "\nSELECT exception FROM excf",
    "failed_events": "WITH " + FAILED + "\nSELECT event, exception, company, contract FROM fev",
    "log_runs": "WITH " + FAILED.replace("SELECT value AS line,", "SELECT value AS line, 'r' || length(value) % 2 AS run,").replace(
        "fev AS (\n  SELECT ", "fev AS (\n  SELECT run, ") + "\nSELECT run, event, exception, company, contract FROM fev",
    "failed_event_keys": "WITH " + FAILED + """
SELECT count(*) AS n_events, count(DISTINCT company) AS n_companies, count(DISTINCT contract) AS n_contracts FROM fev""",
    "error_rate": "WITH " + FAILED + """,
f AS (SELECT count(DISTINCT contract) AS failing_contracts FROM fev),
a AS (SELECT count(o_orderkey) AS agreements_created FROM orders)
SELECT failing_contracts, agreements_created,
       round(100.0 * failing_contracts / nullif(agreements_created, 0), 6) AS error_rate_pct
FROM f, a""",
    "error_rate_text_ids": "WITH " + FAILED + """,
f AS (SELECT count(DISTINCT contract) AS failing_contracts FROM fev),
a AS (SELECT count(*) AS agreements_created FROM orders WHERE o_orderpriority <> '2-HIGH')
SELECT failing_contracts, agreements_created,
       round(100.0 * failing_contracts / nullif(agreements_created, 0), 6) AS error_rate_pct
FROM f, a""",
    "clean_text_extras": """
WITH RECURSIVE t AS (
  SELECT doc_id, text AS a, 0 AS n FROM documents
  UNION ALL SELECT doc_id, """ + extras_round_sql("a") + """, n + 1 FROM t WHERE n < 6)
SELECT doc_id, a AS clean_text FROM t WHERE n = 6""",
    "clean_text": "SELECT doc_id, " + clean_text_sql("text") + " AS clean_text FROM documents",
}
