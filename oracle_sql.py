"""DuckDB twins of the registered queries.

Written from the measure semantics and FIXTURES.md §B, independently of the
Spark code: flat clinical tables (one coding per resource), QUALIFY for the
latest version, TRY_CAST for the safe casts. Tables are the driver's views
(customer, orders, lineitem, ...).
"""

RUN = "DATE '2001-08-01'"

BASE_CTES = """
pat_v AS (
  SELECT 'p-' || c_custkey AS id, vv.v AS v,
         CASE WHEN (c_custkey + vv.v) % 2 = 0 THEN 'female' ELSE 'male' END AS gender,
         CASE WHEN c_custkey % 97 = 0 THEN '1950'
              ELSE strftime(DATE '1921-01-01' + CAST((c_custkey * 37 + vv.v * 400) % 25000 AS INTEGER),
                            '%Y-%m-%d') END AS birth_date
  FROM customer CROSS JOIN (SELECT 0 AS v UNION ALL SELECT 1 AS v) vv
  WHERE vv.v = 0 OR c_custkey % 5 = 0
),
pat AS (
  SELECT * FROM pat_v QUALIFY row_number() OVER (PARTITION BY id ORDER BY v DESC) = 1
),
proc_v AS (
  SELECT 'pr-' || l_orderkey || '-' || l_linenumber AS id,
         'p-' || o_custkey AS patient_id,
         CASE l_partkey % 40 WHEN 0 THEN '71651007' WHEN 1 THEN '73761001'
                             WHEN 2 THEN '444783004' ELSE 'x' END AS code,
         strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') AS performed,
         l_shipdate, l_partkey, l_suppkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
proc AS (
  SELECT * FROM proc_v
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY l_shipdate DESC, l_partkey DESC,
                                                      l_suppkey DESC) = 1
),
obs AS (
  SELECT 'ob-' || o_orderkey AS id, 'p-' || o_custkey AS patient_id,
         CASE WHEN o_orderkey % 10 = 3 THEN 'http://other' ELSE 'http://loinc.org' END AS system,
         CASE o_orderkey % 10 WHEN 0 THEN '4548-4' WHEN 3 THEN '4548-4' WHEN 1 THEN '2335-8'
                              WHEN 2 THEN '57905-2' ELSE 'x' END AS code,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL
              ELSE strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') END AS effective
  FROM orders
),
cond AS (
  SELECT 'co-' || o_orderkey AS id, 'p-' || o_custkey AS patient_id,
         CASE o_orderkey % 12 WHEN 0 THEN '44054006' WHEN 1 THEN '46635009'
                              WHEN 2 THEN '73211009' ELSE 'x' END AS code
  FROM orders
)
"""


def measure_ctes(run: str = RUN, sfx: str = "", pat: str = "pat", proc: str = "proc",
                 obs: str = "obs", cond: str = "cond") -> str:
    """Measure CTEs for one run date over the given tables; names end in ``sfx``."""
    return f"""
pat_age{sfx} AS (
  SELECT id, gender, TRY_CAST(birth_date AS DATE) AS bdate,
         year({run}) - year(TRY_CAST(birth_date AS DATE)) AS age
  FROM {pat}
),
proc_day{sfx} AS (
  SELECT id, patient_id, code, CAST(TRY_CAST(performed AS TIMESTAMP) AS DATE) AS day FROM {proc}
),
obs_day{sfx} AS (
  SELECT id, patient_id, system, code, CAST(TRY_CAST(effective AS TIMESTAMP) AS DATE) AS day FROM {obs}
),
who{sfx} AS (
  SELECT a.id AS patient_id, gender = 'female' AND age BETWEEN 50 AND 74 AS bcs,
         age BETWEEN 18 AND 75 AND a.id IN (
           SELECT patient_id FROM {cond} WHERE code IN ('44054006', '46635009', '73211009')) AS cdc,
         age BETWEEN 45 AND 75 AS col
  FROM pat_age{sfx} a
),
seen{sfx} AS (
  SELECT patient_id,
         max(day) FILTER (WHERE kind = 'p' AND code IN ('241055006', '71651007', '726551006', '24623002')
                            AND day >= {run} - INTERVAL 27 MONTH) AS bcs_day,
         max(day) FILTER (WHERE kind = 'o' AND code = '4548-4' AND day >= {run} - INTERVAL 12 MONTH) AS cdc_day,
         max(day) FILTER (WHERE kind = 'p' AND code IN ('73761001', '444783004')
                            AND day >= {run} - INTERVAL 10 YEAR
                          OR kind = 'o' AND code IN ('2335-8', '57905-2')
                            AND day >= {run} - INTERVAL 1 YEAR) AS col_day
  FROM (SELECT 'p' AS kind, patient_id, code, day FROM proc_day{sfx}
        UNION ALL
        SELECT 'o', patient_id, code, day FROM obs_day{sfx} WHERE system = 'http://loinc.org') f
  WHERE day <= {run} GROUP BY patient_id
),
merged{sfx} AS (SELECT w.*, bcs_day, cdc_day, col_day FROM who{sfx} w LEFT JOIN seen{sfx} USING (patient_id)),
bcs{sfx} AS (
  SELECT patient_id, bcs_day IS NOT NULL AS in_numerator, bcs_day AS last_evidence_date FROM merged{sfx} WHERE bcs
),
cdc{sfx} AS (
  SELECT patient_id, cdc_day IS NOT NULL AS in_numerator, cdc_day AS last_evidence_date FROM merged{sfx} WHERE cdc
),
col{sfx} AS (
  SELECT patient_id, col_day IS NOT NULL AS in_numerator, col_day AS last_evidence_date FROM merged{sfx} WHERE col
),
evals{sfx} AS (
  SELECT 'BCS_MAMMOGRAPHY' AS measure_id, * FROM bcs{sfx}
  UNION ALL SELECT 'CDC_A1C' AS measure_id, * FROM cdc{sfx}
  UNION ALL SELECT 'COL_SCREENING' AS measure_id, * FROM col{sfx}
)
"""


FIXTURE_CTES = BASE_CTES.rstrip() + ",\n" + measure_ctes()


def with_fixtures(body: str) -> str:
    return "WITH " + FIXTURE_CTES.strip() + "\n" + body


ALL_EVALS = with_fixtures("SELECT measure_id, patient_id, in_numerator, last_evidence_date FROM evals")

MEASURES = {
    "measure_bcs": with_fixtures("SELECT * FROM bcs"),
    "measure_cdc": with_fixtures("SELECT * FROM cdc"),
    "measure_col": with_fixtures("SELECT * FROM col"),
    "evaluate_all": ALL_EVALS,
    "evaluate_each": ALL_EVALS,
    "measures_sql_files": ALL_EVALS,
    "patient_latest": with_fixtures(
        "SELECT id, gender, birth_date, printf('%019d', v) AS version_id FROM pat"),
    "procedure_latest": with_fixtures(
        "SELECT id, patient_id, code, performed AS performed_text, "
        "printf('%019d.%019d', l_partkey, l_suppkey) AS version_id FROM proc"),
    "patient_age_band": with_fixtures(
        "SELECT id, bdate AS birth_date, age AS age_years, "
        "coalesce(gender = 'female' AND age BETWEEN 50 AND 74, false) AS in_bcs_population "
        "FROM pat_age"),
    "procedure_evidence": with_fixtures(
        f"SELECT id, patient_id, day AS evidence_date, "
        f"code IN ('241055006', '71651007', '726551006', '24623002') AS is_mammography, "
        f"coalesce(day BETWEEN {RUN} - INTERVAL 27 MONTH AND {RUN}, false) AS in_27_months, "
        f"coalesce(day BETWEEN {RUN} - INTERVAL 10 YEAR AND {RUN}, false) AS in_10_years "
        f"FROM proc_day"),
    "observation_evidence": with_fixtures(
        f"SELECT id, patient_id, day AS evidence_date, "
        f"(system = 'http://loinc.org' AND code = '4548-4') AS is_hba1c, "
        f"(system = 'http://loinc.org' AND code IN ('2335-8', '57905-2')) AS is_stool_test, "
        f"coalesce(day BETWEEN {RUN} - INTERVAL 12 MONTH AND {RUN}, false) AS in_12_months "
        f"FROM obs_day"),
    "diabetic_population": with_fixtures("SELECT patient_id FROM who WHERE cdc"),
    "mammography_numerator": with_fixtures("SELECT patient_id, bcs_day AS last_evidence_date FROM seen WHERE bcs_day IS NOT NULL"),
    "colorectal_numerator": with_fixtures("SELECT patient_id, col_day AS last_evidence_date FROM seen WHERE col_day IS NOT NULL"),
}

# --- many measures, many run dates ------------------------------------------------
MEASURES["catalog_bitset"] = "WITH " + BASE_CTES.strip() + f""",
n AS (SELECT CAST(i AS INTEGER) AS i FROM range(200) t(i)),
spec AS (
  SELECT i, 18 + i * 7 % 45 AS low, 18 + i * 7 % 45 + 5 + i * 11 % 40 AS high,
         ['female', 'male', NULL][i % 3 + 1] AS gender,
         CASE WHEN i % 8 = 4 THEN [['44054006', '46635009', '73211009'][i % 3 + 1],
                                   ['44054006', '46635009', '73211009'][(i + 1) % 3 + 1]]
              WHEN i % 4 = 0 THEN [['44054006', '46635009', '73211009'][i % 3 + 1]] END AS asked
  FROM n
),
clause AS (
  SELECT i, 'p' AS kind, unnest([['71651007', '73761001', '444783004', 'x'][i // 2 % 4 + 1],
                                 ['71651007', '73761001', '444783004', 'x'][i // 8 % 4 + 1]]) AS code,
         CAST(NULL AS VARCHAR) AS system, [6, 12, 27, 60, 120][i % 5 + 1] AS months FROM n WHERE i % 2 = 0
  UNION ALL
  SELECT i, 'o', unnest([['4548-4', '2335-8', '57905-2', 'x'][i // 2 % 4 + 1],
                         ['4548-4', '2335-8', '57905-2', 'x'][i // 8 % 4 + 1]]),
         ['http://loinc.org', 'http://other', NULL][i % 3 + 1], [6, 12, 27, 60, 120][i % 5 + 1] FROM n WHERE i % 2 = 1
  UNION ALL
  SELECT i, 'o', unnest([['4548-4', '2335-8', '57905-2', 'x'][i // 5 % 4 + 1],
                         ['4548-4', '2335-8', '57905-2', 'x'][i // 3 % 4 + 1]]),
         'http://loinc.org', [6, 12, 27, 60, 120][i // 5 % 5 + 1] FROM n WHERE i % 5 = 0
),
facts AS (
  SELECT kind, patient_id, code, system, max(day) AS day FROM (
    SELECT 'p' AS kind, patient_id, code, '' AS system, TRY_CAST(performed AS DATE) AS day FROM proc
    UNION ALL SELECT 'o', patient_id, code, system, TRY_CAST(effective AS DATE) FROM obs)
  WHERE day <= {RUN} GROUP BY ALL
),
hit AS (
  SELECT i, patient_id, max(day) AS day FROM facts f JOIN clause c ON c.kind = f.kind AND c.code = f.code
  WHERE (c.system IS NULL OR c.system = f.system) AND day >= {RUN} - to_months(c.months) GROUP BY i, patient_id
),
who AS (
  SELECT i, p.id AS patient_id FROM pat p JOIN spec s
    ON year({RUN}) - year(TRY_CAST(p.birth_date AS DATE)) BETWEEN s.low AND s.high
   AND (s.gender IS NULL OR s.gender = p.gender)
  WHERE s.asked IS NULL
  UNION
  SELECT i, p.id FROM pat p JOIN spec s
    ON year({RUN}) - year(TRY_CAST(p.birth_date AS DATE)) BETWEEN s.low AND s.high
   AND (s.gender IS NULL OR s.gender = p.gender)
  JOIN cond c ON c.patient_id = p.id AND list_contains(s.asked, c.code)
)
SELECT printf('GEN_%04d', w.i) AS measure_id, w.patient_id, h.day IS NOT NULL AS in_numerator, h.day AS last_evidence_date
FROM who w LEFT JOIN hit h ON h.i = w.i AND h.patient_id = w.patient_id"""

QUARTER_EVALS = BASE_CTES.strip() + """,
run AS (SELECT DISTINCT CAST(date_trunc('quarter', o_orderdate) AS DATE) AS r FROM orders),
person AS (
  SELECT r, id AS patient_id, gender, year(r) - year(TRY_CAST(birth_date AS DATE)) AS age FROM pat, run
),
asked AS (
  SELECT r, 'BCS_MAMMOGRAPHY' AS measure_id, patient_id FROM person WHERE gender = 'female' AND age BETWEEN 50 AND 74
  UNION ALL SELECT r, 'COL_SCREENING', patient_id FROM person WHERE age BETWEEN 45 AND 75
  UNION ALL SELECT r, 'CDC_A1C', patient_id FROM person
  WHERE age BETWEEN 18 AND 75 AND patient_id IN (
    SELECT patient_id FROM cond WHERE code IN ('44054006', '46635009', '73211009'))
),
service AS (
  SELECT patient_id, 'BCS_MAMMOGRAPHY' AS measure_id, 27 AS months, TRY_CAST(performed AS DATE) AS day FROM proc
  WHERE code IN ('241055006', '71651007', '726551006', '24623002')
  UNION ALL SELECT patient_id, 'COL_SCREENING', 120, TRY_CAST(performed AS DATE) FROM proc
  WHERE code IN ('73761001', '444783004')
  UNION ALL SELECT patient_id, CASE code WHEN '4548-4' THEN 'CDC_A1C' ELSE 'COL_SCREENING' END, 12, TRY_CAST(effective AS DATE)
  FROM obs WHERE system = 'http://loinc.org' AND code IN ('4548-4', '2335-8', '57905-2')
),
done AS (
  SELECT r, measure_id, patient_id, max(day) AS day FROM service, run
  WHERE day <= r AND day >= r - to_months(months) GROUP BY ALL
),
quarter_evals AS (
  SELECT r AS run_date, measure_id, patient_id, day IS NOT NULL AS in_numerator, day AS last_evidence_date
  FROM asked LEFT JOIN done USING (r, measure_id, patient_id)
)"""
MEASURES["backfill_dates"] = f"WITH {QUARTER_EVALS} SELECT * FROM quarter_evals"

# --- gap state, run log, checks, serving, issues -------------------------------
RUN1 = "DATE '2000-08-01'"
NOW1 = "TIMESTAMP '2000-08-01 06:00:00'"
NOW2 = "TIMESTAMP '2001-08-01 06:00:00'"

TWO_RUN_CTES = (BASE_CTES.rstrip() + ",\n" + measure_ctes(RUN1, "_1").strip() + ",\n"
                + measure_ctes(RUN, "_2").strip() + f""",
st1 AS (
  SELECT row_number() OVER (ORDER BY measure_id, patient_id) AS id, measure_id, patient_id,
         CASE WHEN in_numerator THEN 'CLOSED' ELSE 'OPEN' END AS status, last_evidence_date,
         {NOW1} AS first_identified_at, {NOW1} AS last_evaluated_at
  FROM evals_1
),
ev2 AS (
  SELECT measure_id, patient_id, CASE WHEN in_numerator THEN 'CLOSED' ELSE 'OPEN' END AS status,
         last_evidence_date
  FROM evals_2
),
st2 AS (
  SELECT s.id, s.measure_id, s.patient_id,
         CASE WHEN e.status IS NULL THEN s.status ELSE e.status END AS status,
         CASE WHEN e.status IS NULL THEN s.last_evidence_date ELSE e.last_evidence_date END
           AS last_evidence_date,
         s.first_identified_at,
         CASE WHEN e.status IS NULL THEN s.last_evaluated_at ELSE {NOW2} END AS last_evaluated_at
  FROM st1 s LEFT JOIN ev2 e ON e.measure_id = s.measure_id AND e.patient_id = s.patient_id
  UNION ALL
  SELECT (SELECT coalesce(max(id), 0) FROM st1)
           + row_number() OVER (ORDER BY e.measure_id, e.patient_id) AS id,
         e.measure_id, e.patient_id, e.status, e.last_evidence_date,
         {NOW2} AS first_identified_at, {NOW2} AS last_evaluated_at
  FROM ev2 e
  WHERE NOT EXISTS (SELECT 1 FROM st1 s WHERE s.measure_id = e.measure_id
                                            AND s.patient_id = e.patient_id)
),
sum_1 AS (
  SELECT count(*) FILTER (WHERE NOT in_numerator) AS gaps_open,
         count(*) FILTER (WHERE in_numerator) AS gaps_closed FROM evals_1
),
sum_2 AS (
  SELECT count(*) FILTER (WHERE NOT in_numerator) AS gaps_open,
         count(*) FILTER (WHERE in_numerator) AS gaps_closed FROM evals_2
),
runs AS (
  SELECT 'run-2000-08-01' AS id, {RUN1} AS run_date, {NOW1} AS started_at,
         {NOW1} + INTERVAL 5 MINUTE AS completed_at, 'SUCCEEDED' AS status,
         CAST(NULL AS VARCHAR) AS error, CAST(gaps_open AS INTEGER) AS gaps_open,
         CAST(gaps_closed AS INTEGER) AS gaps_closed FROM sum_1
  UNION ALL
  SELECT 'run-2001-08-01', {RUN}, {NOW2}, {NOW2} + INTERVAL 5 MINUTE, 'SUCCEEDED', NULL,
         CAST(gaps_open AS INTEGER), CAST(gaps_closed AS INTEGER) FROM sum_2
),
dim AS (
  SELECT * FROM (VALUES ('BCS_MAMMOGRAPHY', 'Breast cancer screening'),
                        ('CDC_A1C', 'Diabetes: HbA1c testing'),
                        ('COL_SCREENING', 'Colorectal cancer screening')) t(id, display_name)
),
summ AS (
  SELECT measure_id, status, count(*) AS gaps FROM st2 GROUP BY measure_id, status
)
""")


def with_two_runs(body: str) -> str:
    return "WITH " + TWO_RUN_CTES.strip() + "\n" + body


GAPS = {
    "gap_status": with_two_runs(
        "SELECT measure_id, patient_id, status, last_evidence_date FROM ev2"),
    "gap_state": with_two_runs("SELECT * FROM st2"),
    "bucketed_gap_state": with_two_runs("SELECT * FROM st2"),
    "gap_batch_dedup": with_two_runs(
        "SELECT measure_id, patient_id, in_numerator, last_evidence_date FROM evals_2 "
        "UNION ALL SELECT measure_id, patient_id, in_numerator, last_evidence_date FROM evals_1 a "
        "WHERE NOT EXISTS (SELECT 1 FROM evals_2 b WHERE b.measure_id = a.measure_id "
        "AND b.patient_id = a.patient_id)"),
    "gap_counts": with_two_runs(
        "SELECT measure_id, CAST(count(*) FILTER (WHERE NOT in_numerator) AS INTEGER) AS gaps_open, "
        "CAST(count(*) FILTER (WHERE in_numerator) AS INTEGER) AS gaps_closed "
        "FROM evals_2 GROUP BY measure_id"),
    "run_summary": with_two_runs(
        "SELECT 3 AS measures_evaluated, CAST(gaps_open AS INTEGER) AS gaps_open, "
        "CAST(gaps_closed AS INTEGER) AS gaps_closed FROM sum_2"),
    "run_log": with_two_runs("SELECT * FROM runs"),
    "constraint_report": with_two_runs("""
SELECT 'care_gap.fk_measure' AS check_name,
       (SELECT count(*) FROM st2 WHERE measure_id NOT IN (SELECT id FROM dim)) AS violations
UNION ALL SELECT 'care_gap.status_domain',
       (SELECT count(*) FROM st2 WHERE status NOT IN ('OPEN', 'CLOSED'))
UNION ALL SELECT 'care_gap.unique_measure_patient',
       (SELECT count(*) FROM (SELECT measure_id, patient_id FROM st2
                              GROUP BY ALL HAVING count(*) > 1) d)
UNION ALL SELECT 'care_gap.unique_id',
       (SELECT count(*) FROM (SELECT id FROM st2 GROUP BY id HAVING count(*) > 1) d)
UNION ALL SELECT 'care_gap.not_null.id', (SELECT count(*) FROM st2 WHERE id IS NULL)
UNION ALL SELECT 'care_gap.not_null.measure_id', (SELECT count(*) FROM st2 WHERE measure_id IS NULL)
UNION ALL SELECT 'care_gap.not_null.patient_id', (SELECT count(*) FROM st2 WHERE patient_id IS NULL)
UNION ALL SELECT 'care_gap.not_null.status', (SELECT count(*) FROM st2 WHERE status IS NULL)
UNION ALL SELECT 'care_gap.not_null.first_identified_at',
       (SELECT count(*) FROM st2 WHERE first_identified_at IS NULL)
UNION ALL SELECT 'care_gap.not_null.last_evaluated_at',
       (SELECT count(*) FROM st2 WHERE last_evaluated_at IS NULL)
UNION ALL SELECT 'measure_run.status_domain',
       (SELECT count(*) FROM runs WHERE status NOT IN ('RUNNING', 'SUCCEEDED', 'FAILED'))
UNION ALL SELECT 'measure_run.unique_id',
       (SELECT count(*) FROM (SELECT id FROM runs GROUP BY id HAVING count(*) > 1) d)
UNION ALL SELECT 'measure_run.not_null.id', (SELECT count(*) FROM runs WHERE id IS NULL)
UNION ALL SELECT 'measure_run.not_null.run_date', (SELECT count(*) FROM runs WHERE run_date IS NULL)
UNION ALL SELECT 'measure_run.not_null.started_at',
       (SELECT count(*) FROM runs WHERE started_at IS NULL)
UNION ALL SELECT 'measure_run.not_null.status', (SELECT count(*) FROM runs WHERE status IS NULL)
UNION ALL SELECT 'measure.unique_id',
       (SELECT count(*) FROM (SELECT id FROM dim GROUP BY id HAVING count(*) > 1) d)
UNION ALL SELECT 'measure.not_null.id', (SELECT count(*) FROM dim WHERE id IS NULL)
UNION ALL SELECT 'measure.not_null.display_name',
       (SELECT count(*) FROM dim WHERE display_name IS NULL)
"""),
    "search_gaps_page": with_two_runs(
        "SELECT * FROM st2 WHERE status = 'OPEN' "
        "ORDER BY last_evaluated_at DESC, id DESC LIMIT 50 OFFSET 50"),
    "search_gaps_keyset": with_two_runs(
        f"SELECT * FROM st2 WHERE status = 'OPEN' AND (last_evaluated_at < {NOW2} "
        f"OR (last_evaluated_at = {NOW2} AND id < 1000)) "
        "ORDER BY last_evaluated_at DESC, id DESC LIMIT 50"),
    "search_gaps_deep": with_two_runs(
        "SELECT * FROM st2 ORDER BY last_evaluated_at DESC, id DESC LIMIT 50 OFFSET 1000"),
    "summary_deltas": with_two_runs("SELECT * FROM summ"),
    "commit_rejects": """
WITH b AS (
  SELECT CASE r WHEN 3 THEN k - 1 WHEN 7 THEN -k ELSE k END AS id, CASE r WHEN 1 THEN 'UNKNOWN' ELSE 'CDC_A1C' END AS m,
         CASE WHEN r <> 4 THEN 'o-' || k END AS p, CASE WHEN r = 2 THEN 'HALF' WHEN r <> 6 THEN 'OPEN' END AS status
  FROM (SELECT o_orderkey AS k, o_orderkey % 10 AS r FROM orders) JOIN (SELECT unnest([1, 2]) AS c) ON c = 1 OR r = 5),
st AS (SELECT o_orderkey AS id, 'CDC_A1C' AS m, 'o-' || o_orderkey AS p FROM orders WHERE o_orderkey % 10 <> 9),
x AS (
  SELECT b.*, count(*) OVER (PARTITION BY b.m, b.p) AS times, (SELECT count(DISTINCT (c.m, c.p)) FROM b c WHERE c.id = b.id) AS owners,
         a.id AS held, s.m AS om, s.p AS op
  FROM b LEFT JOIN st a ON a.m = b.m AND a.p = b.p LEFT JOIN st s ON s.id = b.id)
SELECT check_name, count(*) AS violations, 1::BIGINT AS version FROM (
  SELECT unnest([
    CASE WHEN p IS NULL THEN 'care_gap.not_null.patient_id' END, CASE WHEN status IS NULL THEN 'care_gap.not_null.status' END,
    CASE WHEN status = 'HALF' THEN 'care_gap.status_domain' END, CASE WHEN m = 'UNKNOWN' THEN 'care_gap.fk_measure' END,
    CASE WHEN p IS NOT NULL AND (times > 1 OR held <> id) THEN 'care_gap.unique_measure_patient' END,
    CASE WHEN owners > 1 OR om <> m OR op <> p OR (om IS NOT NULL AND p IS NULL) THEN 'care_gap.unique_id' END])
    AS check_name FROM x) WHERE check_name IS NOT NULL GROUP BY check_name""",
    "page_info": with_two_runs(
        "SELECT count(*) AS total_elements, CAST(ceil(count(*) / 25.0) AS INTEGER) AS total_pages "
        "FROM st2 WHERE status = 'CLOSED' AND measure_id = 'COL_SCREENING'"),
    "gap_summary": with_two_runs("SELECT * FROM summ"),
    "scorecard": with_two_runs("""
SELECT c.measure_id, coalesce(d.display_name, c.measure_id) AS name, c.open, c.closed,
       c.open + c.closed AS total,
       CASE WHEN c.open + c.closed = 0 THEN 0.0
            ELSE 100.0 * c.closed / (c.open + c.closed) END AS closure_rate
FROM (SELECT measure_id,
             CAST(sum(CASE WHEN status = 'OPEN' THEN gaps ELSE 0 END) AS BIGINT) AS open,
             CAST(sum(CASE WHEN status <> 'OPEN' THEN gaps ELSE 0 END) AS BIGINT) AS closed
      FROM summ GROUP BY measure_id) c
LEFT JOIN dim d ON d.id = c.measure_id
"""),
    "recent_runs": with_two_runs("SELECT * FROM runs ORDER BY started_at DESC, id DESC LIMIT 20"),
    "run_freshness": with_two_runs(
        "SELECT id, status, started_at, "
        "CASE WHEN status = 'SUCCEEDED' THEN gaps_open || ' open / ' || gaps_closed || ' closed' "
        "WHEN error IS NOT NULL THEN error END AS detail FROM runs"),
    "patient_gaps": with_two_runs("SELECT * FROM st2 WHERE patient_id = 'p-105'"),
    "issue_documents": with_two_runs("""
SELECT e.measure_id, e.patient_id,
       'caregap-' || replace(lower(e.measure_id), '_', '-') || '-' || e.patient_id AS id,
       'final' AS status, 'urn:gapwise:care-gap-measure' AS code_system, e.measure_id AS code,
       d.display_name AS code_display, '2001-08-01' AS identified,
       'Patient/' || e.patient_id AS patient_reference,
       CASE WHEN e.in_numerator THEN 'Care gap closed: qualifying service on record.'
            ELSE 'Open care gap: no qualifying service found in the measurement window.' END
         AS detail,
       CASE WHEN e.in_numerator THEN 'Qualifying service performed' END AS mitigation_action,
       CASE WHEN e.in_numerator THEN strftime(e.last_evidence_date, '%Y-%m-%dT00:00:00Z') END
         AS mitigation_date
FROM evals_2 e LEFT JOIN dim d ON d.id = e.measure_id
"""),
    "issue_bundles": with_two_runs("""
SELECT measure_id, chunk, count(*)::INTEGER AS entries, 'transaction' AS bundle_type,
       arg_min(id, patient_id) AS first_id, arg_max(id, patient_id) AS last_id,
       string_agg(id, ',' ORDER BY patient_id) AS ids, 'PUT DetectedIssue/' || arg_min(id, patient_id) AS first_request
FROM (SELECT measure_id, patient_id,
             'caregap-' || replace(lower(measure_id), '_', '-') || '-' || patient_id AS id,
             (row_number() OVER (PARTITION BY measure_id ORDER BY patient_id) - 1) // 200 AS chunk FROM evals_2)
GROUP BY measure_id, chunk"""),
    "issue_store": with_two_runs("""
SELECT measure_id, 'caregap-' || replace(lower(measure_id), '_', '-') || '-' || patient_id AS id,
       max(seq) AS seq, CASE max(seq) WHEN 2 THEN '2001-08-01' ELSE '2000-08-01' END AS identified,
       CASE WHEN arg_max(in_numerator, seq) THEN 'Care gap closed: qualifying service on record.'
            ELSE 'Open care gap: no qualifying service found in the measurement window.' END AS detail
FROM (SELECT *, 1::BIGINT AS seq FROM evals_1 UNION ALL SELECT *, 2::BIGINT FROM evals_2)
GROUP BY measure_id, patient_id"""),
    "issue_id_quarantine": """
SELECT * FROM (
  SELECT 'BCS_MAMMOGRAPHY' AS measure_id, pid AS patient_id, 'caregap-bcs-mammography-' || pid AS id
  FROM (SELECT CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN 'p-' || c_custkey
                    ELSE lpad(CAST(c_custkey AS VARCHAR), 60, '0') END AS pid FROM customer))
WHERE NOT regexp_full_match(id, '[A-Za-z0-9.-]+') OR length(id) > 64""",
    "run_history": """
SELECT 'day-' || strftime(d, '%Y-%m-%d') AS id,
       CASE WHEN day(d) % 7 = 0 THEN 'RUNNING' WHEN day(d) % 5 = 0 THEN 'FAILED' ELSE 'SUCCEEDED' END AS status,
       CAST(d AS TIMESTAMP) AS started_at,
       CASE WHEN day(d) % 7 = 0 THEN NULL WHEN day(d) % 5 = 0 THEN 'no data for ' || strftime(d, '%Y-%m-%d')
            ELSE o || ' open / ' || c || ' closed' END AS detail
FROM (SELECT CAST(o_orderdate AS DATE) AS d, count(*) FILTER (WHERE o_orderstatus = 'O') AS o,
             count(*) FILTER (WHERE o_orderstatus <> 'O') AS c FROM orders GROUP BY 1)""",
    "constraint_violations": """
WITH g AS (
  SELECT CASE WHEN r = 3 THEN k - 1 ELSE k END * s AS id, CASE WHEN r = 1 THEN 'UNKNOWN' ELSE 'CDC_A1C' END AS measure_id,
         CASE WHEN r <> 4 THEN 'o-' || k END AS patient_id,
         CASE WHEN r = 2 THEN 'HALF' WHEN r <> 6 THEN 'OPEN' END AS status
  FROM (SELECT o_orderkey AS k, o_orderkey % 10 AS r FROM orders) o
  JOIN (SELECT unnest([1, -1]) AS s) t ON s = 1 OR r = 5),
m AS (
  SELECT CASE WHEN day(d) IN (3, 4) THEN strftime(d, '%Y-%m') ELSE 'day-' || strftime(d, '%Y-%m-%d') END AS id,
         day(d) = 9 AS lost FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders))
SELECT 'care_gap.fk_measure' AS check_name, (SELECT count(*) FROM g WHERE measure_id = 'UNKNOWN') AS violations
UNION ALL SELECT 'care_gap.status_domain', (SELECT count(*) FROM g WHERE status = 'HALF')
UNION ALL SELECT 'care_gap.unique_measure_patient', (SELECT count(*) FROM (
  SELECT 1 FROM g WHERE patient_id IS NOT NULL GROUP BY measure_id, patient_id HAVING count(*) > 1))
UNION ALL SELECT 'care_gap.unique_id', (SELECT count(*) FROM (SELECT 1 FROM g GROUP BY id HAVING count(*) > 1))
UNION ALL SELECT 'care_gap.not_null.patient_id', (SELECT count(*) FROM g WHERE patient_id IS NULL)
UNION ALL SELECT 'care_gap.not_null.status', (SELECT count(*) FROM g WHERE status IS NULL)
UNION ALL SELECT 'measure_run.status_domain', (SELECT count(*) FROM m WHERE lost)
UNION ALL SELECT 'measure_run.unique_id', (SELECT count(*) FROM (SELECT 1 FROM m GROUP BY id HAVING count(*) > 1))
UNION ALL SELECT unnest(['care_gap.not_null.id', 'care_gap.not_null.measure_id',
  'care_gap.not_null.first_identified_at', 'care_gap.not_null.last_evaluated_at', 'measure_run.not_null.id',
  'measure_run.not_null.run_date', 'measure_run.not_null.started_at', 'measure_run.not_null.status',
  'measure.unique_id', 'measure.not_null.id', 'measure.not_null.display_name']), 0""",
    "sql_run_state": with_two_runs(f"""
SELECT row_number() OVER (ORDER BY measure_id, patient_id) AS id, measure_id, patient_id, status, last_evidence_date,
       {NOW2} AS first_identified_at, {NOW2} AS last_evaluated_at FROM ev2"""),
    "invalid_issue_ids": with_two_runs(
        "SELECT measure_id, patient_id, "
        "'caregap-' || replace(lower(measure_id), '_', '-') || '-' || patient_id AS id "
        "FROM evals_2 WHERE NOT regexp_full_match("
        "'caregap-' || replace(lower(measure_id), '_', '-') || '-' || patient_id, '[A-Za-z0-9.-]+') "
        "OR length('caregap-' || replace(lower(measure_id), '_', '-') || '-' || patient_id) > 64"),
}

# --- ingest -------------------------------------------------------------------
BROKEN = "(7, 8, 9, 10, 11)"
INGEST_BASE = BASE_CTES.rstrip() + f""",
ok_orders AS (
  SELECT o_orderkey AS k, o_custkey AS ck FROM orders WHERE o_orderkey % 50 NOT IN {BROKEN}
),
li_obj AS (
  SELECT 'bundles/procedure-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-'
           || l_suppkey || '-' || strftime(CAST(l_shipdate AS DATE), '%Y%m%d') || '.json' AS object_name,
         'pr-' || l_orderkey || '-' || l_linenumber AS pid, 'p-' || o_custkey AS patient
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
entries AS (
  SELECT 'bundles/order-' || k || '.json' AS object_name, 0 AS pos, 'Patient' AS resource_type,
         'urn:uuid:p-' || ck AS full_url, 'p-' || ck AS resource_id, true AS rewritten,
         CAST(NULL AS VARCHAR) AS reference
  FROM ok_orders
  UNION ALL
  SELECT 'bundles/order-' || k || '.json', 1, 'Observation', 'urn:uuid:ob-' || k, 'ob-' || k, true,
         'urn:uuid:p-' || ck
  FROM ok_orders
  UNION ALL
  SELECT 'bundles/order-' || k || '.json', 2, 'Condition', 'urn:uuid:co-' || k, 'co-' || k, true,
         'urn:uuid:p-' || ck
  FROM ok_orders
  UNION ALL
  SELECT object_name, 0, 'Procedure', 'Procedure/' || pid, pid, false, 'Patient/' || patient
  FROM li_obj
),
pat_i AS (SELECT * FROM pat WHERE id IN (SELECT 'p-' || ck FROM ok_orders)),
obs_i AS (SELECT * FROM obs WHERE id IN (SELECT 'ob-' || k FROM ok_orders)),
cond_i AS (SELECT * FROM cond WHERE id IN (SELECT 'co-' || k FROM ok_orders)),
attempts AS (
  SELECT 'bundles/order-' || l_orderkey || '.json' AS object_name, l_linenumber, l_partkey,
         l_suppkey, l_shipdate,
         CASE l_partkey % 8 WHEN 0 THEN 200 WHEN 1 THEN 200 WHEN 2 THEN 200 WHEN 3 THEN 503
              WHEN 4 THEN 429 WHEN 5 THEN 400 WHEN 6 THEN 500 END AS status_code,
         l_partkey % 8 = 7 AS connection_error
  FROM lineitem
),
classified AS (
  SELECT *, CASE WHEN connection_error THEN 'transient'
                 WHEN status_code BETWEEN 200 AND 299 THEN 'success'
                 WHEN status_code IN (429, 500, 502, 503, 504) THEN 'transient'
                 ELSE 'permanent' END AS outcome
  FROM attempts
),
disp AS (
  SELECT object_name, count(*) AS attempts,
         arg_max(outcome, (l_linenumber, l_partkey, l_suppkey, l_shipdate)) AS last_outcome
  FROM classified GROUP BY object_name
),
disp2 AS (
  SELECT *, CASE WHEN last_outcome <> 'transient' THEN 'ack'
                 WHEN attempts >= 5 THEN 'redeliver' ELSE 'retry' END AS disposition
  FROM disp
),
events AS (
  SELECT o_orderkey AS k, 'bundles/order-' || o_orderkey
           || CASE WHEN o_orderkey % 13 = 8 THEN '.txt' ELSE '.json' END AS name,
         CASE WHEN o_orderkey % 13 = 6 THEN NULL WHEN o_orderkey % 13 = 7 THEN 'elsewhere'
              ELSE 'clinical-landing' END AS bucket,
         CASE WHEN o_orderkey % 13 = 5 THEN 'google.cloud.storage.object.v1.deleted'
              WHEN o_orderkey % 13 = 9 THEN NULL
              ELSE 'google.cloud.storage.object.v1.finalized' END AS event_type,
         CASE WHEN o_orderkey % 13 = 5 THEN 'ignored: unexpected event type'
              WHEN o_orderkey % 13 = 6 THEN 'ignored: malformed event'
              WHEN o_orderkey % 13 = 7 THEN 'ignored: unexpected bucket'
              WHEN o_orderkey % 13 = 8 THEN 'ignored: not a .json object' END AS reason
  FROM orders
)
"""


def with_ingest(body: str, extra: str = "") -> str:
    return "WITH " + INGEST_BASE.strip() + extra + "\n" + body


VISIT_CTES = """
visit AS (
  SELECT k, ck, 'visits/order-' || k || '.json' AS object_name, pos, strftime(CAST(d AS DATE), '%Y-%m-%d') AS day,
         CASE pos WHEN 0 THEN 'Patient' WHEN 1 THEN 'Organization' WHEN 2 THEN 'Encounter' WHEN 3 THEN 'Observation'
                  WHEN 4 THEN 'Condition' END AS resource_type,
         CASE pos WHEN 0 THEN 'p-' || ck
                  WHEN 1 THEN 'new-' || substr(sha256('visits/order-' || k || '.json:1'), 1, 32)
                  WHEN 2 THEN 'en-' || k WHEN 3 THEN CASE WHEN k % 11 = 0 THEN 'en-' ELSE 'ov-' END || k
                  WHEN 4 THEN 'cv-' || k END AS id,
         CASE WHEN pos = 2 AND k % 5 = 0 THEN 'urn:uuid:gone-' || k
              WHEN pos = 2 AND k % 5 = 1 THEN 'https://h/fhir/Patient/p-' || ck || '/_history/3'
              WHEN pos = 3 AND k % 3 = 0 THEN 'Group/g1'
              WHEN pos IN (2, 3, 4) THEN 'Patient/p-' || ck END AS subject,
         CASE WHEN pos = 3 THEN 'Encounter/en-' || k END AS encounter
  FROM (SELECT o_orderkey AS k, o_custkey AS ck, o_orderdate AS d FROM orders WHERE o_orderkey % 50 <> 7) o
  CROSS JOIN (SELECT unnest([0, 1, 2, 3, 4, 5]) AS pos) n
)
"""


def with_visits(body: str) -> str:
    return "WITH " + VISIT_CTES.strip() + "\n" + body


INGEST = {
    "object_admission": with_ingest("SELECT name, bucket, event_type, reason FROM events"),
    "bundle_validation": with_ingest(f"""
SELECT 'bundles/order-' || o_orderkey || '.json' AS object_name,
       CASE o_orderkey % 50 WHEN 7 THEN 'malformed JSON' WHEN 8 THEN 'not a transaction or batch bundle'
            WHEN 9 THEN 'no entries' WHEN 10 THEN 'not a Bundle' WHEN 11 THEN 'unknown element' END
         AS reason,
       CASE o_orderkey % 50 WHEN 8 THEN 'searchset' WHEN 10 THEN 'Patient'
            WHEN 11 THEN 'Patient.favouriteColour' END AS detail
FROM orders WHERE o_orderkey % 50 IN {BROKEN}"""),
    "bundle_entries": with_ingest(
        "SELECT object_name, pos, 'transaction' AS bundle_type, resource_type, full_url, "
        "'PUT' AS method, resource_type || '/' || resource_id AS url, resource_id, rewritten "
        "FROM entries"),
    "rewrite_stats": with_ingest(
        "SELECT object_name, count(*) AS entries, count(*) FILTER (WHERE rewritten) AS rewritten, "
        "count(*) FILTER (WHERE NOT rewritten) AS left_as_is FROM entries GROUP BY object_name"),
    "resolved_references": with_ingest(
        "SELECT object_name, pos, reference, "
        "CASE WHEN reference LIKE 'urn:uuid:%' THEN 'Patient/' || substr(reference, 10) "
        "ELSE reference END AS resolved_reference, false AS unresolved "
        "FROM entries WHERE reference IS NOT NULL"),
    "ingested_patients": with_ingest(
        "SELECT id, gender, birth_date, printf('%019d', v) AS version_id FROM pat_i"),
    "ingested_observations": with_ingest(
        "SELECT id, patient_id, system, code, effective AS effective_text FROM obs_i"),
    "ingested_procedures": with_ingest(
        "SELECT id, patient_id, code, performed AS performed_text, "
        "printf('%019d.%019d', l_partkey, l_suppkey) AS version_id FROM proc"),
    "ingest_round_trip": with_ingest(
        "SELECT measure_id, patient_id, in_numerator, last_evidence_date FROM evals_i",
        ",\n" + measure_ctes(RUN, "_i", pat="pat_i", obs="obs_i", cond="cond_i").strip()),
    "resource_counts": with_ingest(
        "SELECT resource_type, count(DISTINCT resource_id) AS resources FROM entries "
        "GROUP BY resource_type"),
    "ingest_results": with_ingest(
        "SELECT object_name, count(*) AS resource_count FROM entries GROUP BY object_name"),
    "outcome_classification": with_ingest(
        "SELECT object_name, l_linenumber AS line_number, l_partkey AS part_key, status_code, "
        "connection_error, outcome FROM classified"),
    "dispositions": with_ingest(
        "SELECT object_name, attempts, last_outcome, disposition FROM disp2"),
    "ingest_report": with_ingest(f"""
SELECT status, count(*) AS objects FROM (
  SELECT CASE WHEN reason IS NOT NULL OR k % 50 IN {BROKEN} OR d.last_outcome = 'permanent' THEN 'skipped'
              WHEN d.last_outcome = 'success' THEN 'ingested'
              WHEN d.disposition = 'redeliver' THEN 'failed' ELSE 'pending' END AS status
  FROM events e LEFT JOIN disp2 d ON d.object_name = e.name
  UNION ALL
  SELECT CASE WHEN l_orderkey % 17 = 0 THEN 'skipped' ELSE 'pending' END FROM lineitem
) s GROUP BY status"""),
    "stored_versions": with_visits("""
SELECT resource_type, id, object_name, pos, id AS document_id, subject, encounter FROM visit WHERE pos < 5"""),
    "stored_observations": with_visits("""
SELECT id, CASE WHEN subject LIKE 'Patient/%' THEN substr(subject, 9) END AS patient_id, day AS effective_text
FROM visit WHERE pos = 3"""),
    "document_references": with_visits("""
SELECT object_name, pos, 'urn:uuid:p-' || ck AS reference, 'Patient/p-' || ck AS target, false AS unresolved
FROM visit WHERE pos = 4 OR (pos = 2 AND k % 5 > 1) OR (pos = 3 AND k % 3 <> 0)
UNION ALL SELECT object_name, pos, 'urn:uuid:gone-' || k, NULL, true FROM visit WHERE pos = 2 AND k % 5 = 0
UNION ALL SELECT object_name, pos, 'urn:uuid:en-' || k, 'Encounter/en-' || k, false FROM visit WHERE pos = 3"""),
    "quarantine": """
SELECT 'visits/order-' || o_orderkey || '.json' AS object_name, 'malformed JSON' AS reason,
       CAST(NULL AS VARCHAR) AS detail FROM orders WHERE o_orderkey % 50 = 7""",
    "visit_rewrites": """
SELECT 'visits/order-' || o_orderkey || '.json' AS object_name, 6 AS entries, 3 AS rewritten, 3 AS left_as_is,
       1 AS created, 1 AS without_resource FROM orders WHERE o_orderkey % 50 <> 7""",
    "bundle_files": """
SELECT 'census_group-' || (c_custkey // 50) || '.json' AS object_name, count(*) AS resource_count
FROM customer GROUP BY 1""",
    "split_bundle_entries": """
SELECT 'census_group-' || (c_custkey // 50) || '.json' AS object_name,
       (row_number() OVER (PARTITION BY c_custkey // 50 ORDER BY c_custkey || '"') - 1)::INTEGER AS pos,
       'urn:uuid:c-' || c_custkey AS full_url, 'Patient' AS resource_type,
       CASE WHEN c_custkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender
FROM customer""",
    "request_runs": f"""
WITH {QUARTER_EVALS},
asked_for AS (SELECT r, 0 AS again FROM run UNION ALL SELECT max(r), 1 FROM run),
numbered AS (SELECT r, row_number() OVER (ORDER BY again, r DESC) AS k FROM asked_for)
SELECT 'b0-' || k AS id, r AS run_date, TIMESTAMP '2001-09-01' + to_minutes(k - 1) AS started_at, 'SUCCEEDED' AS status,
       CAST(coalesce(n_open, 0) AS INTEGER) AS gaps_open, CAST(coalesce(n_closed, 0) AS INTEGER) AS gaps_closed
FROM numbered LEFT JOIN (
  SELECT run_date, count(*) FILTER (WHERE NOT in_numerator) AS n_open, count(*) FILTER (WHERE in_numerator) AS n_closed
  FROM quarter_evals GROUP BY run_date) ON run_date = r""",
    "document_rewrite": """
SELECT 'rosters/group-' || g || '.json' AS object_name, count(*)::INTEGER AS members,
       count(*) FILTER (WHERE known)::INTEGER AS resolved, arg_min(ref, k) AS managing, string_agg(ref, ',' ORDER BY k) AS refs
FROM (SELECT c_custkey AS k, c_custkey // 50 AS g, c_custkey % 7 <> 0 AS known,
             CASE WHEN c_custkey % 7 <> 0 THEN 'Patient/r-' ELSE 'urn:uuid:r-' END || c_custkey AS ref FROM customer)
GROUP BY g""",
    "unknown_paths": """
SELECT 'nested/order-' || o_orderkey || '.json' AS object_name,
       CASE o_orderkey % 6 WHEN 1 THEN 'Condition.code.coding[1].colour' WHEN 2 THEN 'Condition.subject.identifier.number'
                           WHEN 3 THEN 'Condition.evidence[0].found' END AS path
FROM orders WHERE o_orderkey % 6 IN (1, 2, 3)""",
    "latest_incremental": """
SELECT 'p-' || o_custkey AS id, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS status,
       printf('%019d', arg_max(o_orderkey, (o_orderdate, o_orderkey))) AS version_id FROM orders GROUP BY o_custkey""",
    "replay_filter": with_visits("""
SELECT resource_type, id, object_name, pos, 'first' AS batch,
       CASE pos WHEN 2 THEN 'finished' WHEN 3 THEN 'final' END AS status FROM visit WHERE pos < 5
UNION ALL SELECT resource_type, id, object_name, pos, 'second', 'amended' FROM visit WHERE pos = 3 AND k % 7 = 0"""),
    "streamed_patients": """
SELECT 'c-' || c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender
FROM customer""",
    "run_requests": """
SELECT CAST(o_orderkey AS VARCHAR) AS request_id,
       CASE WHEN o_orderkey % 9 IN (1, 2, 7) THEN DATE '2001-08-01'
            WHEN o_orderkey % 9 IN (3, 4, 5, 6) THEN NULL
            ELSE CAST(o_orderdate AS DATE) END AS run_date,
       CASE WHEN o_orderkey % 9 IN (3, 4, 5, 6) THEN 'ignored' ELSE 'run' END AS outcome,
       CASE o_orderkey % 9 WHEN 1 THEN 'default: no data' WHEN 7 THEN 'default: no data'
            WHEN 2 THEN 'default: no runDate' WHEN 3 THEN 'ignored: malformed base64'
            WHEN 4 THEN 'ignored: malformed JSON' WHEN 5 THEN 'ignored: invalid runDate'
            WHEN 6 THEN 'ignored: null request' END AS reason
FROM orders""",
}
