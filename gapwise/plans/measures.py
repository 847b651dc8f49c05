"""Quality measures as DataFrame plans (M1–M6).

A measure is data: a population filter (age band as a calendar-year
difference, optional gender, optional qualifying condition codes) and a list
of evidence clauses (resource type, codes, optional code system, look-back in
months). ``build_measure`` turns a spec into one plan over the latest-version
tables, with the result contract
``patient_id STRING, in_numerator BOOLEAN, last_evidence_date DATE``.

Plan notes (checked with ``explain``):
* filters on anything but the id must follow the latest-version ranking, but
  expressions need not: code flags, evidence days and birth years are computed
  before the ranking, so only ``(id, order key, patient, flags, day)`` is
  shuffled for it and never the ``code`` arrays or texts;
* ``evaluate_all`` ranks each table once for the whole catalog, or reads tables
  ranked once for several run dates (``rank_tables``);
* evidence is aggregated per patient with partial (map-side) aggregation, and
  a qualifying-condition side is de-duplicated before its join, so a patient
  with a very large number of rows never reaches one task as a raw group;
* population and evidence are joined on ``patient_id``, both sides key-unique;
  AQE picks broadcast or sort-merge from measured sizes.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapwise.functions.expr import (as_date_lit, has_code, in_lookback, safe_date, safe_ts,
                                    utc_date, year_diff)
from gapwise.operators.versions import latest

# --- fixed values: measure catalog -----------------------------------------
LOINC = "http://loinc.org"
BCS_PROCEDURE_CODES = ("241055006", "71651007", "726551006", "24623002")
CDC_CONDITION_CODES = ("44054006", "46635009", "73211009")
CDC_OBSERVATION_CODES = ("4548-4",)
COL_PROCEDURE_CODES = ("73761001", "444783004")
COL_OBSERVATION_CODES = ("2335-8", "57905-2")
DISPLAY_NAMES = {
    "CDC_A1C": "Diabetes: HbA1c testing",
    "BCS_MAMMOGRAPHY": "Breast cancer screening",
    "COL_SCREENING": "Colorectal cancer screening",
}

# Where the evidence date of each resource type lives.
DATE_FIELD = {"Procedure": "performed.dateTime", "Observation": "effective.dateTime"}
# Columns each measure reads from each resource type (one projection per type,
# shared by all measures so their plans coincide).
PROJECTION = {
    "Patient": ("id", "meta", "gender", "birthDate"),
    "Condition": ("id", "meta", "subject", "code"),
    "Observation": ("id", "meta", "subject", "code", "effective"),
    "Procedure": ("id", "meta", "subject", "code", "performed"),
}

RESULT_SCHEMA = T.StructType([
    T.StructField("patient_id", T.StringType()),
    T.StructField("in_numerator", T.BooleanType()),
    T.StructField("last_evidence_date", T.DateType()),
])


@dataclass(frozen=True)
class Evidence:
    resource: str                 # "Procedure" | "Observation"
    codes: tuple[str, ...]
    months: int                   # look-back, closed at both ends
    system: str | None = None     # code system the code must carry, if any

    def __post_init__(self):
        if self.resource not in DATE_FIELD:
            raise ValueError(f"unsupported evidence resource {self.resource!r}")
        if self.months < 0:
            raise ValueError("look-back must be non-negative")


@dataclass(frozen=True)
class MeasureSpec:
    id: str
    display_name: str
    min_age: int
    max_age: int
    evidence: tuple[Evidence, ...]
    gender: str | None = None
    condition_codes: tuple[str, ...] = field(default_factory=tuple)

    def __post_init__(self):
        if not self.evidence:
            raise ValueError("a measure needs at least one evidence clause")
        if self.min_age > self.max_age:
            raise ValueError("min_age > max_age")


CATALOG: tuple[MeasureSpec, ...] = (
    MeasureSpec("BCS_MAMMOGRAPHY", DISPLAY_NAMES["BCS_MAMMOGRAPHY"], 50, 74,
                (Evidence("Procedure", BCS_PROCEDURE_CODES, 27),), gender="female"),
    MeasureSpec("CDC_A1C", DISPLAY_NAMES["CDC_A1C"], 18, 75,
                (Evidence("Observation", CDC_OBSERVATION_CODES, 12, LOINC),),
                condition_codes=CDC_CONDITION_CODES),
    MeasureSpec("COL_SCREENING", DISPLAY_NAMES["COL_SCREENING"], 45, 75,
                (Evidence("Procedure", COL_PROCEDURE_CODES, 10 * 12),
                 Evidence("Observation", COL_OBSERVATION_CODES, 12, LOINC))),
)


def catalog_by_id() -> dict[str, MeasureSpec]:
    return {m.id: m for m in CATALOG}


class MeasureTables:
    """Version tables of one run, from which measures take ranked, narrow views."""

    def __init__(self, versions: dict[str, DataFrame]):
        self._versions = versions

    @classmethod
    def of(cls, clinical) -> "MeasureTables":
        return cls(clinical.by_type())

    def latest(self, resource: str, *columns: Column) -> DataFrame:
        """Newest version of every resource. With ``columns`` (expressions over a
        version row) only those, ``id`` and the order key are ranked and shuffled."""
        df = self._versions[resource]
        if not columns:
            return latest(df.select(*PROJECTION[resource]))
        narrow = df.select("id", F.struct("meta.lastUpdated", "meta.versionId").alias("meta"), *columns)
        return latest(narrow).drop("meta")


def _birth() -> Column:
    return safe_date(F.col("birthDate")).alias("birth")


def _patient() -> Column:
    return F.col("subject.patientId").alias("patient_id")


def _day(resource: str) -> Column:
    return utc_date(safe_ts(F.col(DATE_FIELD[resource]))).alias("day")


def denominator(spec: MeasureSpec, tables: MeasureTables, run_date) -> DataFrame:
    rd = as_date_lit(run_date)
    p = tables.latest("Patient", F.col("gender"), _birth())
    cond = year_diff(rd, F.col("birth")).between(spec.min_age, spec.max_age)
    if spec.gender is not None:
        cond = (F.col("gender") == F.lit(spec.gender)) & cond
    d = p.where(cond).select(F.col("id").alias("patient_id"))
    if spec.condition_codes:
        # Q15/Q16: patients with at least one qualifying condition; the
        # condition side is made key-unique first (partial aggregation).
        flag = has_code(F.col("code.coding"), spec.condition_codes).alias("hit")
        c = tables.latest("Condition", _patient(), flag).where("hit").select("patient_id").distinct()
        d = d.join(c, "patient_id", "left_semi")
    return d


def evidence_dates(ev: Evidence, tables: MeasureTables, run_date) -> DataFrame:
    """Newest qualifying evidence date per patient for one clause (Q5, Q9–Q14, Q17)."""
    flag = has_code(F.col("code.coding"), ev.codes, ev.system).alias("hit")
    return (tables.latest(ev.resource, _patient(), _day(ev.resource), flag)
            .where(F.col("hit") & in_lookback(F.col("day"), run_date, ev.months))
            .groupBy("patient_id").agg(F.max("day").alias("last_evidence_date")))


def numerator(spec: MeasureSpec, tables: MeasureTables, run_date) -> DataFrame:
    parts = [evidence_dates(ev, tables, run_date) for ev in spec.evidence]
    if len(parts) == 1:
        return parts[0]
    # Q18/Q19: bag union of the clauses, then the best date per patient.
    u = reduce(DataFrame.unionByName, parts)
    return u.groupBy("patient_id").agg(F.max("last_evidence_date").alias("last_evidence_date"))


def build_measure(spec: MeasureSpec, tables: MeasureTables, run_date) -> DataFrame:
    """One measure's evaluation rows: every denominator patient exactly once."""
    d = denominator(spec, tables, run_date)
    n = numerator(spec, tables, run_date).withColumn("_hit", F.lit(True))
    out = d.join(n, "patient_id", "left").select(
        F.col("patient_id"),
        F.col("_hit").isNotNull().alias("in_numerator"),
        F.col("last_evidence_date"),
    )
    return out


def evaluate_each(tables: MeasureTables, run_date, catalog=CATALOG) -> DataFrame:
    """Union of the per-measure plans, in measure-id order (reference shape)."""
    parts = [build_measure(m, tables, run_date).select(F.lit(m.id).alias("measure_id"), "*")
             for m in sorted(catalog, key=lambda m: m.id)]
    return reduce(DataFrame.unionByName, parts)


@dataclass(frozen=True)
class RankedTables:
    """What a catalog needs of the newest versions, whatever the run date (:func:`rank_tables`)."""

    patients: DataFrame   # patient_id, gender, birth, a flag per measure with conditions
    evidence: DataFrame   # patient_id, day, a flag per evidence clause
    catalog: tuple[MeasureSpec, ...]

    def kept(self, path: str) -> "RankedTables":
        """The same rows written under the shared folder ``path``, so that several run dates rank once."""
        out = {}
        for name in ("patients", "evidence"):
            df = getattr(self, name)
            df.write.parquet(f"{path}/{name}")
            out[name] = df.sparkSession.read.schema(df.schema).parquet(f"{path}/{name}")
        return replace(self, **out)


def rank_tables(tables: MeasureTables, catalog=CATALOG) -> RankedTables:
    """Every resource table ranked once; of the evidence only the rows with a code of the catalog stay.

    A version without such a code is ranked with the others, as it may be the newest of its id, but
    its patient and day are not shuffled.
    """
    specs = tuple(sorted(catalog, key=lambda m: m.id))
    p = tables.latest("Patient", F.col("gender"), _birth()).withColumnRenamed("id", "patient_id")
    cond_specs = [s for s in specs if s.condition_codes]
    if cond_specs:
        names = [f"_c{specs.index(s)}" for s in cond_specs]
        flags = [has_code(F.col("code.coding"), s.condition_codes).alias(n) for s, n in zip(cond_specs, names)]
        c = (tables.latest("Condition", _patient(), *flags)
             .where(reduce(lambda a, b: a | b, [F.col(n) for n in names]))
             .groupBy("patient_id").agg(*[F.bool_or(n).alias(n) for n in names]))
        p = p.join(c, "patient_id", "left")

    parts, clauses = [], [ev for s in specs for ev in s.evidence]
    for resource in DATE_FIELD:
        own = {k: has_code(F.col("code.coding"), ev.codes, ev.system) for k, ev in enumerate(clauses)
               if ev.resource == resource}
        if not own:
            continue
        hit = reduce(lambda a, b: a | b, own.values())
        rows = tables.latest(resource, F.when(hit, F.struct(
            _patient(), _day(resource), *[(own[k] if k in own else F.lit(False)).alias(f"_f{k}")
                                          for k in range(len(clauses))])).alias("_row"))
        parts.append(rows.where(F.col("_row.day").isNotNull()).select("_row.*"))
    return RankedTables(p, reduce(DataFrame.unionByName, parts), specs)


def evaluate_all(tables: MeasureTables | RankedTables, run_date, catalog=CATALOG) -> DataFrame:
    """All catalog measures in one plan, tagged with ``measure_id`` (M4).

    Same rows as :func:`evaluate_each`, but every resource table is ranked
    once, its evidence is aggregated once per patient with one conditional
    maximum per measure, and population and evidence meet on ``patient_id``.
    The measures become rows only after that join. Tables that are ranked
    already serve any run date.
    """
    ranked = tables if isinstance(tables, RankedTables) else rank_tables(tables, catalog)
    specs = sorted(catalog, key=lambda m: m.id)
    if list(ranked.catalog) != specs:
        raise ValueError("the tables were ranked for another catalog")
    rd = as_date_lit(run_date)

    clauses = [(i, ev) for i, s in enumerate(specs) for ev in s.evidence]
    days = []
    for i in range(len(specs)):
        hits = [F.col(f"_f{k}") & in_lookback(F.col("day"), rd, ev.months) for k, (m, ev) in enumerate(clauses) if m == i]
        days.append(F.when(reduce(lambda a, b: a | b, hits), F.col("day")).alias(f"_d{i}"))
    ev = (ranked.evidence.select("patient_id", *days)
          .where(F.coalesce(*[F.col(f"_d{i}") for i in range(len(specs))]).isNotNull())
          .groupBy("patient_id").agg(*[F.max(f"_d{i}").alias(f"_d{i}") for i in range(len(specs))]))

    age = year_diff(rd, F.col("birth"))

    def in_population(i: int, s: MeasureSpec) -> Column:
        cond = age.between(s.min_age, s.max_age)
        if s.gender is not None:
            cond = (F.col("gender") == F.lit(s.gender)) & cond
        if s.condition_codes:
            cond = cond & F.col(f"_c{i}")
        return F.when(cond, F.struct(F.lit(s.id).alias("measure_id"), F.col(f"_d{i}").alias("last_evidence_date")))

    return (ranked.patients.join(ev, "patient_id", "left")
            .select("patient_id", F.explode(F.filter(
                F.array(*[in_population(i, s) for i, s in enumerate(specs)]),
                lambda x: x.isNotNull())).alias("_m"))
            .select("_m.measure_id", "patient_id",
                    F.col("_m.last_evidence_date").isNotNull().alias("in_numerator"), "_m.last_evidence_date"))


def assert_contract(df: DataFrame) -> DataFrame:
    """Fail unless the three contract columns exist with their types (M6)."""
    got = {f.name: f.dataType for f in df.schema.fields}
    for f in RESULT_SCHEMA.fields:
        if f.name not in got:
            raise ValueError(f"measure result lacks column {f.name!r}")
        if got[f.name] != f.dataType:
            raise ValueError(f"column {f.name!r} is {got[f.name].simpleString()}, "
                             f"expected {f.dataType.simpleString()}")
    return df


def run_date_of(value) -> dt.date:
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))
