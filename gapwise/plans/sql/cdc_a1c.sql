-- CDC_A1C: HbA1c testing in diabetes.
-- Population: calendar-year age 18..75 at :run_date with a diabetes condition.
-- Evidence: a LOINC HbA1c observation within 12 months up to :run_date.
-- The current version of a resource is the one with the greatest order key;
-- whatever a rule needs from it is reduced to flags and days before that pick.
-- Parameters: :dataset (validated, quoted namespace), :run_date (DATE).
WITH adults AS (
  SELECT id AS patient_id
  FROM (SELECT id, struct(meta.lastUpdated, meta.versionId) AS version,
               year(:run_date) - year(
                 CASE WHEN trim(birthDate) RLIKE '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$'
                      THEN try_cast(trim(birthDate) AS DATE) END) BETWEEN 18 AND 75 AS fits
        FROM IDENTIFIER(:dataset || '.Patient'))
  GROUP BY id
  HAVING max_by(fits, version)
),
diabetes AS (
  SELECT id, max_by(IF(diabetic, patient_id, NULL), version) AS patient_id
  FROM (SELECT id, subject.patientId AS patient_id, struct(meta.lastUpdated, meta.versionId) AS version,
               exists(code.coding, x -> x.code IN ('44054006', '46635009', '73211009')) AS diabetic
        FROM IDENTIFIER(:dataset || '.Condition'))
  GROUP BY id
),
a1c AS (
  SELECT id, max_by(fact, version) AS fact
  FROM (SELECT id, struct(meta.lastUpdated, meta.versionId) AS version,
               struct(subject.patientId AS patient_id,
                      exists(code.coding, x -> x.system = 'http://loinc.org' AND x.code = '4548-4') AS counts,
                      to_date(CASE WHEN trim(effective.dateTime) RLIKE
                        '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([Tt ][0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}([.][0-9]{1,9})?([Zz]|[+-][0-9]{2}(:?[0-9]{2})?)?)?$'
                        THEN try_cast(trim(effective.dateTime) AS TIMESTAMP) END) AS day) AS fact
        FROM IDENTIFIER(:dataset || '.Observation'))
  GROUP BY id
)
SELECT patient_id, count(day) > 0 AS in_numerator, max(day) AS last_evidence_date
FROM adults
LEFT SEMI JOIN diabetes USING (patient_id)
LEFT JOIN (SELECT fact.patient_id, max(fact.day) AS day FROM a1c
           WHERE fact.counts AND fact.day BETWEEN add_months(:run_date, -12) AND :run_date
           GROUP BY fact.patient_id) USING (patient_id)
GROUP BY patient_id
