"""Seeded measure dimension (S9): one row per catalog measure."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gapwise.plans.measures import CATALOG

MEASURE_SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("display_name", T.StringType(), False),
])


def measure_dim(spark: SparkSession, catalog=CATALOG) -> DataFrame:
    """Its size is the catalog size, which bounds any broadcast of it."""
    return spark.createDataFrame([(m.id, m.display_name) for m in catalog], MEASURE_SCHEMA)
