-- BCS_MAMMOGRAPHY: breast cancer screening.
-- Population: women of calendar-year age 50..74 at :run_date.
-- Evidence: a mammography procedure within 27 months up to :run_date.
-- The current version of a resource is the one with the greatest order key;
-- whatever a rule needs from it is reduced to flags and days before that pick.
-- Parameters: :dataset (validated, quoted namespace), :run_date (DATE).
WITH women AS (
  SELECT id AS patient_id
  FROM (SELECT id, struct(meta.lastUpdated, meta.versionId) AS version,
               gender = 'female' AND year(:run_date) - year(
                 CASE WHEN trim(birthDate) RLIKE '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$'
                      THEN try_cast(trim(birthDate) AS DATE) END) BETWEEN 50 AND 74 AS fits
        FROM IDENTIFIER(:dataset || '.Patient'))
  GROUP BY id
  HAVING max_by(fits, version)
),
mammography AS (
  SELECT id, max_by(fact, version) AS fact
  FROM (SELECT id, struct(meta.lastUpdated, meta.versionId) AS version,
               struct(subject.patientId AS patient_id,
                      exists(code.coding, x -> x.code IN ('241055006', '71651007', '726551006', '24623002'))
                        AS counts,
                      to_date(CASE WHEN trim(performed.dateTime) RLIKE
                        '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([Tt ][0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}([.][0-9]{1,9})?([Zz]|[+-][0-9]{2}(:?[0-9]{2})?)?)?$'
                        THEN try_cast(trim(performed.dateTime) AS TIMESTAMP) END) AS day) AS fact
        FROM IDENTIFIER(:dataset || '.Procedure'))
  GROUP BY id
)
SELECT patient_id, count(day) > 0 AS in_numerator, max(day) AS last_evidence_date
FROM women
LEFT JOIN (SELECT fact.patient_id, max(fact.day) AS day FROM mammography
           WHERE fact.counts AND fact.day BETWEEN add_months(:run_date, -27) AND :run_date
           GROUP BY fact.patient_id) USING (patient_id)
GROUP BY patient_id
