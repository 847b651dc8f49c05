"""A whole catalog through inverted value-set indexes (M5, Q12–Q14 for many measures).

``evaluate_all`` has a few columns for every measure, which is the fastest plan
for a handful and no plan at all for hundreds. Here a measure is one bit of a
64-bit word and the catalog is data: small tables that say, for a code (and
system and look-back), for a condition code, and for an age and gender, which
measures they speak for. The plan has the same nodes and columns for one
measure and for a thousand; more measures are more rows of these tables.

* evidence: newest version of every resource, its codings meet the code index;
  the bits of one patient and day are OR-ed (partial aggregation), and of a
  patient's days, newest first, each keeps the bits that no later day has. So
  every measure's last evidence date comes from one running OR, and at most 64
  days of a patient and word survive it;
* population: the bits of the patient's age and gender, minus those of measures
  that ask for a condition which none of the patient's conditions names;
* both meet on (patient, word); only then do bits become rows.

The index tables come from the catalog, whose size is known here; they are
broadcast up to ``MAX_BROADCAST_ROWS`` rows and joined by shuffle beyond.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gapwise.functions.expr import as_date_lit, safe_date, safe_ts, utc_date, year_diff
from gapwise.plans.measures import DATE_FIELD, MeasureSpec, MeasureTables

WORD = 64
MAX_BROADCAST_ROWS = 100_000


def signed(bits: int) -> int:
    """A 64-bit pattern as the BIGINT that has it."""
    return bits - (1 << 64) if bits >> 63 else bits


def _index(spark: SparkSession, entries: Iterable[tuple[tuple, int]], ddl: str) -> DataFrame:
    """One row per (key, word) with the bits of all measures listed under the key."""
    words: dict[tuple, int] = defaultdict(int)
    for key, measure in entries:
        words[(*key, measure // WORD)] |= 1 << (measure % WORD)
    rows = [(*key, signed(bits)) for key, bits in sorted(words.items(), key=repr)]
    table = spark.createDataFrame(rows, ", ".join(filter(None, [ddl, "word INT, bits BIGINT"])))
    return F.broadcast(table) if len(rows) <= MAX_BROADCAST_ROWS else table


class ValueSetIndex:
    """The index tables of a catalog; bit n stands for ``measures[n]``."""

    def __init__(self, spark: SparkSession, catalog: Sequence[MeasureSpec]):
        self.measures = sorted(catalog, key=lambda m: m.id)
        if len({m.id for m in self.measures}) != len(self.measures):
            raise ValueError("measure ids must be unique")
        numbered = list(enumerate(self.measures))
        #: A NULL system stands for any.
        self.evidence = _index(
            spark, (((ev.resource, code, ev.system, ev.months), n)
                    for n, m in numbered for ev in m.evidence for code in ev.codes),
            "resource STRING, code STRING, system STRING, months INT")
        self.conditions = _index(
            spark, (((code,), n) for n, m in numbered for code in m.condition_codes), "code STRING")
        self.conditional = _index(
            spark, (((), n) for n, m in numbered if m.condition_codes), "").select(
                "word", F.col("bits").alias("conditional"))
        #: A NULL gender stands for any.
        self.population = _index(
            spark, (((age, m.gender), n) for n, m in numbered for age in range(m.min_age, m.max_age + 1)),
            "age INT, gender STRING")
        names = spark.createDataFrame([(n // WORD, n % WORD, m.id) for n, m in numbered],
                                      "word INT, bit INT, measure_id STRING")
        self.names = F.broadcast(names) if len(numbered) <= MAX_BROADCAST_ROWS else names
        self.resources = sorted({ev.resource for m in self.measures for ev in m.evidence})
        self.longest = max(ev.months for m in self.measures for ev in m.evidence)


def _codings() -> Column:
    return F.col("code.coding").alias("coding")


def _patient() -> Column:
    return F.col("subject.patientId").alias("patient_id")


def evidence_rows(tables: MeasureTables, index: ValueSetIndex) -> DataFrame:
    """(patient_id, day, months, word, bits): one row per coding that an index row names."""
    out = None
    for resource in index.resources:
        day = utc_date(safe_ts(F.col(DATE_FIELD[resource]))).alias("day")
        rows = (tables.latest(resource, _patient(), day, _codings()).where("day IS NOT NULL")
                .select("patient_id", "day", F.explode("coding").alias("c"))
                .select("patient_id", "day", F.col("c.system").alias("own"), "c.code", F.lit(resource).alias("resource")))
        out = rows if out is None else out.unionByName(rows)
    return (out.join(index.evidence, ["resource", "code"])
            .where(F.col("system").isNull() | (F.col("system") == F.col("own")))
            .select("patient_id", "day", "months", "word", "bits"))


def last_days(evidence: DataFrame, run_date) -> DataFrame:
    """(patient_id, word, days): for every bit the newest day in its look-back, as
    ``days`` of (day, bits) in which each bit occurs once."""
    rd = as_date_lit(run_date)
    within = (evidence.where((F.col("day") <= rd) & (F.col("day") >= F.add_months(rd, -F.col("months"))))
              .groupBy("patient_id", "word", "day").agg(F.bit_or("bits").alias("bits")))
    newer = (Window.partitionBy("patient_id", "word").orderBy(F.desc("day"))
             .rowsBetween(Window.unboundedPreceding, -1))
    seen = F.coalesce(F.bit_or("bits").over(newer), F.lit(0).cast("bigint"))
    first = within.withColumn("bits", F.col("bits").bitwiseAND(F.bitwise_not(seen))).where("bits <> 0")
    return first.groupBy("patient_id", "word").agg(F.collect_list(F.struct("day", "bits")).alias("days"))


def population_bits(tables: MeasureTables, index: ValueSetIndex, run_date) -> DataFrame:
    """(patient_id, word, bits): the measures whose population a patient belongs to."""
    birth = safe_date(F.col("birthDate")).alias("birth")
    people = (tables.latest("Patient", F.col("gender").alias("own"), birth)
              .select(F.col("id").alias("patient_id"), "own",
                      year_diff(as_date_lit(run_date), F.col("birth")).alias("age")))
    by_age = (people.join(index.population, "age")
              .where(F.col("gender").isNull() | (F.col("gender") == F.col("own")))
              .groupBy("patient_id", "word").agg(F.bit_or("bits").alias("bits")))
    if not any(m.condition_codes for m in index.measures):
        return by_age
    met = (tables.latest("Condition", _patient(), _codings())
           .select("patient_id", F.explode("coding.code").alias("code"))
           .join(index.conditions, "code")
           .groupBy("patient_id", "word").agg(F.bit_or("bits").alias("met")))
    zero = F.lit(0).cast("bigint")
    unmet = F.coalesce("conditional", zero).bitwiseAND(F.bitwise_not(F.coalesce("met", zero)))
    return (by_age.join(met, ["patient_id", "word"], "left").join(index.conditional, "word", "left")
            .select("patient_id", "word", F.col("bits").bitwiseAND(F.bitwise_not(unmet)).alias("bits"))
            .where("bits <> 0"))


def _has_bit(bits: Column, bit: Column) -> Column:
    return F.getbit(bits, bit) == 1


def evaluate_catalog(tables: MeasureTables, run_date, catalog: Sequence[MeasureSpec],
                     spark: SparkSession) -> DataFrame:
    """The rows of ``evaluate_each`` for a catalog of any size."""
    index = ValueSetIndex(spark, catalog)
    people = population_bits(tables, index, run_date)
    days = last_days(evidence_rows(tables, index), run_date)
    members = (people.join(days, ["patient_id", "word"], "left")
               .select("patient_id", "word", "days", F.explode(F.filter(
                   F.sequence(F.lit(0), F.lit(WORD - 1)), lambda b: _has_bit(F.col("bits"), b))).alias("bit")))
    day = F.try_element_at(F.filter("days", lambda d: _has_bit(d["bits"], F.col("bit"))), F.lit(1))["day"]
    return (members.withColumn("last_evidence_date", day).join(index.names, ["word", "bit"])
            .select("measure_id", "patient_id", F.col("last_evidence_date").isNotNull().alias("in_numerator"),
                    "last_evidence_date"))
