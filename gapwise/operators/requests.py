"""Run-request envelopes → run dates.

Envelope ``{"message": {"data": <base64>, "messageId": ...}, "subscription": ...}``;
``data`` decodes to ``{"runDate": "YYYY-MM-DD"}``. A null or blank value at
any level means "today"; anything that cannot be decoded is ignored with a
reason. Unlike the reference, the JSON text ``null`` is treated as malformed
(it would otherwise fail the call outright).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwise.functions.expr import as_date_lit

# --- fixed values ------------------------------------------------------------
ENVELOPE_DDL = "message STRUCT<data: STRING, messageId: STRING>, subscription STRING"
BASE64_TEXT = r"^[A-Za-z0-9+/]*={0,2}$"
ISO_DATE_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
R_BAD_ENVELOPE = "ignored: malformed envelope"
R_NO_DATA = "default: no data"
R_BLANK_JSON = "default: blank payload"
R_BLANK_DATE = "default: no runDate"
R_BAD_BASE64 = "ignored: malformed base64"
R_BAD_JSON = "ignored: malformed JSON"
R_NULL_JSON = "ignored: null request"
R_BAD_DATE = "ignored: invalid runDate"


def parse_run_requests(envelopes: DataFrame, today, col: str = "value") -> DataFrame:
    """Add ``run_date`` (NULL when ignored), ``outcome`` (run / ignored) and ``reason``."""
    env = F.from_json(F.col(col), ENVELOPE_DDL)
    df = envelopes.withColumn("_env", env)
    data = F.col("_env.message.data")
    blank_data = data.isNull() | (F.trim(data) == "")
    b64_ok = data.rlike(BASE64_TEXT) & (F.length(data) % 4 != 1)
    raw = F.when(b64_ok, F.try_to_binary(data, F.lit("base64")))
    text = F.decode(raw, "UTF-8")
    df = df.withColumn("_raw", raw).withColumn("_text", text)
    v = F.try_parse_json(F.col("_text"))
    df = df.withColumn("_v", v)
    is_obj = F.coalesce(F.schema_of_variant(F.col("_v")).startswith("OBJECT"), F.lit(False))
    rd_text = F.try_variant_get(F.col("_v"), "$.runDate", "string")
    rd_blank = rd_text.isNull() | (F.trim(rd_text) == "")
    rd = F.when(rd_text.rlike(ISO_DATE_TEXT), F.try_to_date(rd_text, "yyyy-MM-dd"))
    envelope_ok = F.coalesce(F.schema_of_variant(F.try_parse_json(F.col(col)))
                             .startswith("OBJECT"), F.lit(False))
    reason = (F.when(~envelope_ok, F.lit(R_BAD_ENVELOPE))
              .when(blank_data, F.lit(R_NO_DATA))
              .when(F.col("_raw").isNull(), F.lit(R_BAD_BASE64))
              .when(F.trim(F.col("_text")) == "", F.lit(R_BLANK_JSON))
              .when(F.col("_v").isNull(), F.lit(R_BAD_JSON))
              .when(F.is_variant_null(F.col("_v")), F.lit(R_NULL_JSON))
              .when(~is_obj, F.lit(R_BAD_JSON))
              .when(rd_blank, F.lit(R_BLANK_DATE))
              .when(rd.isNull(), F.lit(R_BAD_DATE)))
    today_c = as_date_lit(today)
    run_date = (F.when(reason.isNull(), rd)
                .when(reason.startswith("default"), today_c))
    return (df.withColumn("run_date", run_date)
            .withColumn("outcome", F.when(F.col("run_date").isNotNull(), F.lit("run"))
                        .otherwise(F.lit("ignored")))
            .withColumn("reason", reason)
            .drop("_env", "_raw", "_text", "_v"))


def run_dates_in_order(requests: DataFrame) -> DataFrame:
    """Distinct requested run dates, ascending (one whole-population run each)."""
    return (requests.where(F.col("outcome") == "run").select("run_date").distinct()
            .orderBy("run_date"))
