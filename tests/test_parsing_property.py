import math
import random
from datetime import datetime

from pyspark.sql import functions as F

from settleline.functions.parsing import parse_double, parse_timestamp, python_float_text

ALPHABET = "0123456789._eE+- "


def _python_float(s):
    try:
        v = float(s)
    except ValueError:
        return None
    return v


def test_number_grammar_matches_python_float(spark):
    rng = random.Random(42)
    samples = {"".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 8))) for _ in range(3000)}
    samples |= {"1_000", "1__0", "_1", "1_", "1e5", "1E+05", ".5", "5.", ".", "e5", "1e", "+-1", " 7 ", "1_0.0_1",
                "1e1_0", "0.1e-2", "00012", "-0", "+.5e-3"}
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = {r["s"]: r["v"] for r in df.select("s", parse_double(F.col("s")).alias("v")).collect()}
    for s in samples:
        expected = _python_float(s)
        if expected is not None and math.isfinite(expected):
            assert got[s] is not None and got[s] == expected, s
        elif expected is None:
            assert got[s] is None, s


def test_python_float_text_matches_repr(spark):
    rng = random.Random(7)
    values = [-50.0, 0.0, 150000.0, 15000000.0, 1e16, 123456789.125, 1e-5, 0.0001, -2.5e-7, 1e22, 99999.99,
              float("inf"), float("-inf")]
    values += [rng.uniform(-1e9, 1e9) for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for r in df.select("v", python_float_text(F.col("v")).alias("t")).collect():
        assert r["t"] == repr(r["v"]), (r["v"], r["t"])


def test_iso_grammar_matches_python_subset(spark):
    rng = random.Random(3)
    samples = set()
    for _ in range(400):
        y, mo, d = rng.randint(1, 9999), rng.randint(0, 13), rng.randint(0, 32)
        h, mi, sec = rng.randint(0, 25), rng.randint(0, 61), rng.randint(0, 61)
        base = f"{y:04d}-{mo:02d}-{d:02d}"
        samples |= {base, f"{base}T{h:02d}", f"{base} {h:02d}:{mi:02d}", f"{base}T{h:02d}:{mi:02d}:{sec:02d}",
                    f"{base}T{h:02d}:{mi:02d}:{sec:02d}.{rng.randint(0, 999999):06d}"}
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = {r["s"]: r["t"] for r in df.select("s", parse_timestamp(F.col("s")).alias("t")).collect()}
    for s in samples:
        try:
            expected = datetime.fromisoformat(s)
        except ValueError:
            expected = None
        assert got[s] == expected, s
