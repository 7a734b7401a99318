"""Queries of the general record-processing operators: change capture and history."""

from __future__ import annotations

from sheafwork.operators.history import build_log, entity_history, state_at
from sheafwork.operators.incremental import FILING_FIELDS, replay_runs
from sheafwork.plans.registry import Registry, table

DATA = Registry()

_FIELDS = ", ".join(FILING_FIELDS)
_RUNS_SQL = f"""
WITH runs AS (
  SELECT run_id, seen_until, row_number() OVER (ORDER BY started_at, run_id) AS seq
  FROM (SELECT DISTINCT * FROM run_log) WHERE run_status = 'succeeded'),
state AS (
  SELECT r.run_id, r.seq, f.html_index, max(f.modified_at) AS modified_at,
         arg_max(row({_FIELDS}), f.modified_at) AS st, arg_max(f.received_at, f.modified_at) AS received_at
  FROM runs r JOIN (SELECT DISTINCT * FROM filing_index) f ON f.received_at <= r.seen_until
  GROUP BY r.run_id, r.seq, f.html_index),
cases AS (
  SELECT s.*, p.html_index IS NULL AS is_new FROM state s
  LEFT JOIN state p ON p.seq = s.seq - 1 AND p.html_index = s.html_index
  WHERE p.html_index IS NULL OR p.st IS DISTINCT FROM s.st)
"""


@DATA.query(_RUNS_SQL + "SELECT run_id, html_index FROM cases")
def p2_found(spark, sf):
    changes = replay_runs(table(spark, sf, "filing_index"), table(spark, sf, "run_log"))
    return changes.select("run_id", "html_index")


@DATA.query(_RUNS_SQL + "SELECT run_id, html_index, st[6] AS same_key, st[4] AS filing_date, st[14] AS filename, CASE WHEN is_new THEN 'added' ELSE 'changed' END AS change FROM cases")
def p2_changes(spark, sf):
    changes = replay_runs(table(spark, sf, "filing_index"), table(spark, sf, "run_log"))
    return changes.selectExpr("run_id", "html_index", "html_index AS same_key", "filing_date", "filename", "change")


_HISTORY_SQL = """
WITH s AS (
  SELECT regexp_replace(trim(cik), '^0+(.)', '\\1') AS cik, snapshot_date, loaded_at,
    nullif(trim(regexp_replace(company, '\\s+', ' ', 'g')), '') AS company,
    nullif(trim(regexp_replace(sic, '\\s+', ' ', 'g')), '') AS sic,
    nullif(trim(regexp_replace(state_location, '\\s+', ' ', 'g')), '') AS st
  FROM company_snapshots),
l AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY cik, snapshot_date ORDER BY loaded_at DESC) = 1),
k AS (
  SELECT *, lower(company) AS c, regexp_replace(lower(sic), '^0+(.)', '\\1') AS i, lower(st) AS t,
    row_number() OVER w AS n FROM l WINDOW w AS (PARTITION BY cik ORDER BY snapshot_date)),
p AS (
  SELECT *, last_value(c IGNORE NULLS) OVER w AS pc, last_value(i IGNORE NULLS) OVER w AS pi, last_value(t IGNORE NULLS) OVER w AS pt
  FROM k WINDOW w AS (PARTITION BY cik ORDER BY snapshot_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT *, (n = 1 OR coalesce(c <> pc, false) OR coalesce(i <> pi, false) OR coalesce(t <> pt, false)) AS opens FROM p)
"""


@DATA.query(_HISTORY_SQL + "SELECT cik, snapshot_date AS valid_from FROM v WHERE opens")
def p5_found(spark, sf):
    return entity_history(table(spark, sf, "company_snapshots")).select("cik", "valid_from")


@DATA.query(
    _HISTORY_SQL
    + """, g AS (SELECT *, sum(opens::int) OVER (PARTITION BY cik ORDER BY snapshot_date) AS version_no FROM v),
f AS (SELECT cik, version_no, min(snapshot_date) AS valid_from,
        max_by(known_c, snapshot_date) AS company, max_by(known_i, snapshot_date) AS sic, max_by(known_t, snapshot_date) AS state_location
      FROM (SELECT *, coalesce(c, pc, '') AS known_c, coalesce(i, pi, '') AS known_i, coalesce(t, pt, '') AS known_t FROM g)
      GROUP BY cik, version_no)
SELECT cik, company, sic, state_location, valid_from,
  lead(valid_from) OVER (PARTITION BY cik ORDER BY version_no) AS valid_to, version_no::int AS version_no FROM f"""
)
def p5_versions(spark, sf):
    """The versions in the form in which values are compared; the spelling shown is that of the log otherwise."""
    versions = entity_history(table(spark, sf, "company_snapshots"))
    return versions.selectExpr(
        "cik", "coalesce(lower(company), '') AS company", "coalesce(regexp_replace(sic, '^0+(?=.)', ''), '') AS sic",
        "coalesce(lower(state_location), '') AS state_location", "valid_from", "valid_to", "version_no",
    )


@DATA.query(
    _HISTORY_SQL
    + """, d AS (SELECT *, c IS NOT NULL AND (pc IS NULL OR c <> pc) AS dc, i IS NOT NULL AND (pi IS NULL OR i <> pi) AS di, t IS NOT NULL AND (pt IS NULL OR t <> pt) AS dt FROM v WHERE snapshot_date <= '2022-06-30')
SELECT cik, max(snapshot_date) FILTER (n = 1 OR dc OR di OR dt) AS known_since, (count(*) FILTER (n = 1 OR dc OR di OR dt))::int AS seq,
  max_by(company, snapshot_date) FILTER (dc) AS company, max_by(sic, snapshot_date) FILTER (di) AS sic, max_by(st, snapshot_date) FILTER (dt) AS state_location
FROM d GROUP BY cik"""
)
def p5_state_at(spark, sf):
    return state_at(build_log(table(spark, sf, "company_snapshots")), "2022-06-30")
