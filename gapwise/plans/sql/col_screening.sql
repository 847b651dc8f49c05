-- COL_SCREENING: colorectal cancer screening.
-- Population: calendar-year age 45..75 at :run_date.
-- Evidence: a colonoscopy within 120 months or a LOINC stool blood test within
-- 12 months, up to :run_date; both kinds of fact go through one aggregation.
-- The current version of a resource is the one with the greatest order key;
-- whatever a rule needs from it is reduced to flags and days before that pick.
-- Parameters: :dataset (validated, quoted namespace), :run_date (DATE).
WITH due AS (
  SELECT id AS patient_id
  FROM (SELECT id, struct(meta.lastUpdated, meta.versionId) AS version,
               year(:run_date) - year(
                 CASE WHEN trim(birthDate) RLIKE '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$'
                      THEN try_cast(trim(birthDate) AS DATE) END) BETWEEN 45 AND 75 AS fits
        FROM IDENTIFIER(:dataset || '.Patient'))
  GROUP BY id
  HAVING max_by(fits, version)
),
fact AS (
  SELECT kind, id, max_by(struct(patient_id, text, months), version) AS f
  FROM (SELECT 'procedure' AS kind, id, struct(meta.lastUpdated, meta.versionId) AS version,
               subject.patientId AS patient_id, trim(performed.dateTime) AS text,
               IF(exists(code.coding, x -> x.code IN ('73761001', '444783004')), 120, NULL) AS months
        FROM IDENTIFIER(:dataset || '.Procedure')
        UNION ALL
        SELECT 'observation', id, struct(meta.lastUpdated, meta.versionId),
               subject.patientId, trim(effective.dateTime),
               IF(exists(code.coding, x -> x.system = 'http://loinc.org' AND x.code IN ('2335-8', '57905-2')),
                  12, NULL)
        FROM IDENTIFIER(:dataset || '.Observation'))
  GROUP BY kind, id
),
dated AS (
  SELECT f.patient_id, f.months,
         to_date(CASE WHEN f.text RLIKE
           '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([Tt ][0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}([.][0-9]{1,9})?([Zz]|[+-][0-9]{2}(:?[0-9]{2})?)?)?$'
           THEN try_cast(f.text AS TIMESTAMP) END) AS day
  FROM fact WHERE f.months IS NOT NULL
)
SELECT patient_id, count(day) > 0 AS in_numerator, max(day) AS last_evidence_date
FROM due
LEFT JOIN (SELECT patient_id, max(day) AS day FROM dated
           WHERE day BETWEEN add_months(:run_date, -months) AND :run_date
           GROUP BY patient_id) USING (patient_id)
GROUP BY patient_id
