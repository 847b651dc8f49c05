"""Column expressions used by the measures, gaps and issue documents.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none is a Python UDF.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: accepted text shapes ---------------------------------------
# A calendar date must be complete (FHIR allows the partial forms YYYY and YYYY-MM,
# which a safe cast must turn into NULL instead of a first-of-period date).
DATE_TEXT = r"^\d{4}-\d{1,2}-\d{1,2}$"
# A timestamp is a complete date, optionally followed by a time with seconds and
# an optional zone (Z or +hh:mm / -hh:mm / +hh).
TIMESTAMP_TEXT = (r"^\d{4}-\d{1,2}-\d{1,2}"
                  r"([Tt ]\d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,9})?"
                  r"([Zz]|[+-]\d{2}(:?\d{2})?)?)?$")
# FHIR id alphabet and length.
FHIR_ID_TEXT = r"^[A-Za-z0-9.-]+$"
FHIR_ID_MAX_LEN = 64


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, (dt.date, dt.datetime)):
        return F.lit(x)
    return F.col(x)


def as_date_lit(d) -> Column:
    """A run date given as ``date`` or ``'YYYY-MM-DD'`` as a DATE literal."""
    if isinstance(d, Column):
        return d
    if isinstance(d, str):
        d = dt.date.fromisoformat(d)
    return F.lit(d)


def safe_date(c) -> Column:
    """String → DATE; anything but a complete calendar date gives NULL (Q8)."""
    c = F.trim(_c(c))
    return F.when(c.rlike(DATE_TEXT), c.try_cast("date"))


def safe_ts(c) -> Column:
    """String → TIMESTAMP; partial or malformed text gives NULL (Q9).

    Zone-less text is read in the session zone, which ``gapwise.session`` pins
    to UTC.
    """
    c = F.trim(_c(c))
    return F.when(c.rlike(TIMESTAMP_TEXT), c.try_cast("timestamp"))


def utc_date(ts) -> Column:
    """TIMESTAMP → DATE in UTC (Q10); relies on the UTC session zone."""
    return F.to_date(_c(ts))


def year_diff(end, start) -> Column:
    """Calendar-year difference, i.e. year boundaries crossed (Q6).

    Not completed years: 1976-12-31 → 2026-01-01 is 50.
    """
    return F.year(_c(end)) - F.year(_c(start))


def months_before(d, months: int) -> Column:
    """``d`` minus ``months`` calendar months, clamped to month end (Q7)."""
    return F.add_months(_c(d), -int(months))


def in_lookback(d, run_date, months: int) -> Column:
    """Closed window ``[run_date - months, run_date]`` (Q5)."""
    rd = as_date_lit(run_date)
    return _c(d).between(months_before(rd, months), rd)


def has_code(coding, codes: Iterable[str], system: str | None = None) -> Column:
    """True when any element of a coding array has one of ``codes``
    (and ``system`` when given); a NULL or empty array gives False (Q12–Q14)."""
    codes = list(codes)

    def pred(x: Column) -> Column:
        p = x["code"].isin(codes)
        if system is not None:
            p = (x["system"] == F.lit(system)) & p
        return F.coalesce(p, F.lit(False))

    return F.coalesce(F.exists(_c(coding), pred), F.lit(False))


def gap_status(in_numerator) -> Column:
    """``CLOSED`` when the patient is in the numerator, else ``OPEN`` (G1)."""
    return F.when(_c(in_numerator), F.lit("CLOSED")).otherwise(F.lit("OPEN"))


def issue_id(measure_id, patient_id) -> Column:
    """``caregap-<measure, lower case, _→->-<patient>``."""
    return F.concat(F.lit("caregap-"),
                    F.translate(F.lower(_c(measure_id)), "_", "-"),
                    F.lit("-"), _c(patient_id))


def is_valid_fhir_id(c) -> Column:
    c = _c(c)
    return F.coalesce(c.rlike(FHIR_ID_TEXT) & (F.length(c) <= FHIR_ID_MAX_LEN), F.lit(False))
