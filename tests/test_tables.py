"""A randomized check of the safe date cast."""
import datetime as dt
import random
import re

from pyspark.sql import functions as F

from gapwise.functions.expr import safe_date


def _model(s):
    """Complete calendar dates only (``yyyy-m-d``, surrounding spaces allowed)."""
    t = s.strip()
    if not re.fullmatch(r"\d{4}-\d{1,2}-\d{1,2}", t):
        return None
    y, m, d = (int(x) for x in t.split("-"))
    try:
        return dt.date(y, m, d)
    except ValueError:
        return None


def test_safe_date_matches_model_on_random_text(spark):
    rng = random.Random(7)
    parts = ["1970", "2001", "0999", "12", "1", "02", "29", "30", "31", "00", "13", "-", " ", "T", "Z",
             "10:00:00", "x", ""]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 6))) for _ in range(3000)]
    texts += [f"{rng.randint(1000, 2999)}-{rng.randint(0, 13)}-{rng.randint(0, 32)}" for _ in range(3000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = {r.i: r.d for r in df.select("i", safe_date(F.col("s")).alias("d")).collect()}
    bad = [(texts[i], got[i], _model(texts[i])) for i in range(len(texts)) if got[i] != _model(texts[i])]
    assert bad == []
