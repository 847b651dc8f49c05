"""Measures as SQL files.

Adding a measure is a SQL file plus a catalog row. Files are read once when
the catalog is loaded, so a missing file fails before any job runs. The SQL
takes two named parameters: ``:dataset``, the namespace holding the resource
tables (validated, then quoted and resolved with ``IDENTIFIER``), and
``:run_date``, a DATE.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from importlib import resources
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapwise.plans.measures import DISPLAY_NAMES, assert_contract, run_date_of

# --- fixed values ------------------------------------------------------------
MEASURE_FILES = {
    "CDC_A1C": "cdc_a1c.sql",
    "BCS_MAMMOGRAPHY": "bcs_mammography.sql",
    "COL_SCREENING": "col_screening.sql",
}
SAFE_DATASET = r"[A-Za-z0-9_.-]+"
RESOURCE_TYPES = ("Patient", "Condition", "Observation", "Procedure")


@dataclass(frozen=True)
class MeasureDefinition:
    id: str
    display_name: str
    sql: str


def load_measures(directory: str | None = None,
                  files: dict[str, str] | None = None) -> list[MeasureDefinition]:
    """Read every catalog file, ordered by measure id; a missing file raises."""
    files = files or MEASURE_FILES
    out = []
    for mid, name in files.items():
        if directory is None:
            ref = resources.files("gapwise.plans").joinpath("sql", name)
            if not ref.is_file():
                raise FileNotFoundError(f"measure SQL missing: {name}")
            text = ref.read_text(encoding="utf-8")
        else:
            p = Path(directory) / name
            if not p.is_file():
                raise FileNotFoundError(f"measure SQL missing: {p}")
            text = p.read_text(encoding="utf-8")
        out.append(MeasureDefinition(mid, DISPLAY_NAMES.get(mid, mid), text))
    return sorted(out, key=lambda m: m.id)


def bind_dataset(dataset: str) -> str:
    """Validate a dataset reference and return it as a quoted multi-part name."""
    if not isinstance(dataset, str) or not re.fullmatch(SAFE_DATASET, dataset):
        raise ValueError(f"unsafe dataset reference: {dataset!r}")
    parts = dataset.split(".")
    if any(p == "" for p in parts):
        raise ValueError(f"unsafe dataset reference: {dataset!r}")
    return ".".join(f"`{p}`" for p in parts)


def register_dataset(clinical, dataset: str = "global_temp") -> str:
    """Expose resource version tables under ``dataset`` (global temp views by default)."""
    if dataset != "global_temp":
        raise ValueError("only the global_temp namespace can be registered from DataFrames; "
                         "other datasets must already exist in the catalog")
    for name, df in clinical.by_type().items():
        df.createOrReplaceGlobalTempView(name)
    return dataset


def run_measure_sql(spark: SparkSession, measure: MeasureDefinition, dataset: str,
                    run_date) -> DataFrame:
    df = spark.sql(measure.sql, args={"dataset": bind_dataset(dataset),
                                      "run_date": run_date_of(run_date)})
    return assert_contract(df)


def evaluate_sql_catalog(spark: SparkSession, dataset: str, run_date,
                         measures: list[MeasureDefinition] | None = None) -> DataFrame:
    measures = measures or load_measures()
    parts = [run_measure_sql(spark, m, dataset, run_date)
             .select(F.lit(m.id).alias("measure_id"), "patient_id", "in_numerator",
                     "last_evidence_date") for m in measures]
    return reduce(DataFrame.unionByName, parts)
