from gapwise.functions.expr import (  # noqa: F401
    as_date_lit, gap_status, has_code, in_lookback, is_valid_fhir_id, issue_id,
    months_before, safe_date, safe_ts, utc_date, year_diff,
)
