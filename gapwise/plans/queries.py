"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the driver's star tables (through the clinical mapping of
``gapwise.sources.fixtures``) over whole tables; none runs on literal input
alone. Result columns are aliased to match the DuckDB twins in
``oracle_sql.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapwise.functions.expr import (has_code, in_lookback, safe_date, safe_ts, utc_date,
                                    year_diff)
from gapwise.operators.versions import version_rank
from gapwise.plans.backfill import evaluate_dates
from gapwise.plans.measures import (BCS_PROCEDURE_CODES, CDC_OBSERVATION_CODES,
                                    COL_OBSERVATION_CODES, LOINC, Evidence, MeasureSpec, MeasureTables,
                                    build_measure, catalog_by_id, denominator,
                                    evaluate_all, evaluate_each, numerator)
from gapwise.plans.sqlfiles import evaluate_sql_catalog, register_dataset
from gapwise.plans.valuesets import evaluate_catalog
from gapwise.sources.fixtures import CONDITION_CODES, OTHER_SYSTEM, PROCEDURE_CODES, RUN_DATE, star_clinical_tables
from gapwise.sources.tables import read_table


def tables(spark: SparkSession, sf_dir: str) -> MeasureTables:
    return MeasureTables.of(star_clinical_tables(spark, sf_dir))


# --- measures -----------------------------------------------------------------
def measure_bcs(spark, sf_dir) -> DataFrame:
    return build_measure(catalog_by_id()["BCS_MAMMOGRAPHY"], tables(spark, sf_dir), RUN_DATE)


def measure_cdc(spark, sf_dir) -> DataFrame:
    return build_measure(catalog_by_id()["CDC_A1C"], tables(spark, sf_dir), RUN_DATE)


def measure_col(spark, sf_dir) -> DataFrame:
    return build_measure(catalog_by_id()["COL_SCREENING"], tables(spark, sf_dir), RUN_DATE)


def q_evaluate_all(spark, sf_dir) -> DataFrame:
    return evaluate_all(tables(spark, sf_dir), RUN_DATE)


def q_evaluate_each(spark, sf_dir) -> DataFrame:
    return evaluate_each(tables(spark, sf_dir), RUN_DATE)


def measures_sql_files(spark, sf_dir) -> DataFrame:
    ds = register_dataset(star_clinical_tables(spark, sf_dir))
    return evaluate_sql_catalog(spark, ds, RUN_DATE)


# --- relational operators and scalar functions ----------------------------------
def patient_latest(spark, sf_dir) -> DataFrame:
    # Q1, Q2 (``p.*, rn``), Q23 (derived table filtered on rn).
    ranked = version_rank(star_clinical_tables(spark, sf_dir).patient)
    return ranked.where(F.col("rn") == 1).select(
        "id", "gender", F.col("birthDate").alias("birth_date"),
        F.col("meta.versionId").alias("version_id"))


def procedure_latest(spark, sf_dir) -> DataFrame:
    t = tables(spark, sf_dir)
    return t.latest("Procedure").select(
        "id", F.col("subject.patientId").alias("patient_id"),
        F.element_at("code.coding", 1)["code"].alias("code"),
        F.col("performed.dateTime").alias("performed_text"),
        F.col("meta.versionId").alias("version_id"))


def patient_age_band(spark, sf_dir) -> DataFrame:
    # Q3 equality, Q4 inclusive range, Q6 year difference, Q8 safe date.
    p = tables(spark, sf_dir).latest("Patient")
    birth = safe_date(F.col("birthDate"))
    age = year_diff(F.lit(RUN_DATE), birth)
    return p.select(
        "id", birth.alias("birth_date"), age.alias("age_years"),
        F.coalesce((F.col("gender") == "female") & age.between(50, 74),
                   F.lit(False)).alias("in_bcs_population"))


def procedure_evidence(spark, sf_dir) -> DataFrame:
    # Q5 window, Q7 months before, Q9 safe timestamp, Q10 UTC date, Q11 nested
    # fields, Q12/Q13 array-any code membership.
    pr = tables(spark, sf_dir).latest("Procedure")
    day = utc_date(safe_ts(F.col("performed.dateTime")))
    return pr.select(
        "id", F.col("subject.patientId").alias("patient_id"), day.alias("evidence_date"),
        has_code(F.col("code.coding"), BCS_PROCEDURE_CODES).alias("is_mammography"),
        F.coalesce(in_lookback(day, RUN_DATE, 27), F.lit(False)).alias("in_27_months"),
        F.coalesce(in_lookback(day, RUN_DATE, 120), F.lit(False)).alias("in_10_years"))


def observation_evidence(spark, sf_dir) -> DataFrame:
    # Q14 system-qualified membership.
    ob = tables(spark, sf_dir).latest("Observation")
    day = utc_date(safe_ts(F.col("effective.dateTime")))
    return ob.select(
        "id", F.col("subject.patientId").alias("patient_id"), day.alias("evidence_date"),
        has_code(F.col("code.coding"), CDC_OBSERVATION_CODES, LOINC).alias("is_hba1c"),
        has_code(F.col("code.coding"), COL_OBSERVATION_CODES, LOINC).alias("is_stool_test"),
        F.coalesce(in_lookback(day, RUN_DATE, 12), F.lit(False)).alias("in_12_months"))


def diabetic_population(spark, sf_dir) -> DataFrame:
    # Q15 join with conditions, Q16 distinct patients, Q22 named steps.
    return denominator(catalog_by_id()["CDC_A1C"], tables(spark, sf_dir), RUN_DATE)


def mammography_numerator(spark, sf_dir) -> DataFrame:
    # Q17 grouped max.
    return numerator(catalog_by_id()["BCS_MAMMOGRAPHY"], tables(spark, sf_dir), RUN_DATE)


def colorectal_numerator(spark, sf_dir) -> DataFrame:
    # Q18 bag union, Q19 re-aggregation.
    return numerator(catalog_by_id()["COL_SCREENING"], tables(spark, sf_dir), RUN_DATE)


# --- catalogs of many measures, many run dates ------------------------------------
def generated_catalog(measures: int = 200) -> list[MeasureSpec]:
    """Measures by rule: age band, gender, conditions and one or two evidence clauses from the number."""
    codes = {"Procedure": [*PROCEDURE_CODES.values(), "x"], "Observation": ["4548-4", "2335-8", "57905-2", "x"]}
    conditions, months = list(CONDITION_CODES.values()), (6, 12, 27, 60, 120)
    out = []
    for i in range(measures):
        resource = "Procedure" if i % 2 == 0 else "Observation"
        system = None if resource == "Procedure" else (LOINC, OTHER_SYSTEM, None)[i % 3]
        clauses = [Evidence(resource, (codes[resource][i // 2 % 4], codes[resource][i // 8 % 4]), months[i % 5], system)]
        if i % 5 == 0:
            clauses.append(Evidence("Observation", (codes["Observation"][i // 5 % 4], codes["Observation"][i // 3 % 4]),
                                    months[i // 5 % 5], LOINC))
        asked = [conditions[i % 3]] * (i % 4 == 0) + [conditions[(i + 1) % 3]] * (i % 8 == 4)
        low = 18 + i * 7 % 45
        out.append(MeasureSpec(f"GEN_{i:04d}", f"Generated {i}", low, low + 5 + i * 11 % 40, tuple(clauses),
                               ("female", "male", None)[i % 3], tuple(asked)))
    return out


def catalog_bitset(spark, sf_dir) -> DataFrame:
    """200 measures through the value-set indexes, in a plan as wide as that for one (M5)."""
    return evaluate_catalog(tables(spark, sf_dir), RUN_DATE, generated_catalog(), spark)


def backfill_dates(spark, sf_dir) -> DataFrame:
    """All measures as of the first day of every quarter in which there is an order (M4)."""
    quarter = F.to_date(F.date_trunc("quarter", "o_orderdate")).alias("d")
    days = [r["d"] for r in read_table(spark, sf_dir, "orders", "o_orderdate").select(quarter).distinct().collect()]
    return evaluate_dates(tables(spark, sf_dir), days, spark)


MEASURE_QUERIES = {
    "measure_bcs": measure_bcs,
    "measure_cdc": measure_cdc,
    "measure_col": measure_col,
    "evaluate_all": q_evaluate_all,
    "evaluate_each": q_evaluate_each,
    "measures_sql_files": measures_sql_files,
    "patient_latest": patient_latest,
    "procedure_latest": procedure_latest,
    "patient_age_band": patient_age_band,
    "procedure_evidence": procedure_evidence,
    "observation_evidence": observation_evidence,
    "diabetic_population": diabetic_population,
    "mammography_numerator": mammography_numerator,
    "colorectal_numerator": colorectal_numerator,
    "catalog_bitset": catalog_bitset,
    "backfill_dates": backfill_dates,
}
