"""Property check of the exact half-even rounding helpers against Fraction."""

import random
from decimal import ROUND_HALF_EVEN, Decimal
from fractions import Fraction

from pyspark.sql import functions as F

from bankscope.functions import exprs as X


def half_even(fr: Fraction, dp: int) -> float:
    scaled = fr * 10 ** dp
    floor = scaled.numerator // scaled.denominator
    rem = scaled - floor
    if rem > Fraction(1, 2) or (rem == Fraction(1, 2) and floor % 2 == 1):
        floor += 1
    return float(Decimal(floor).scaleb(-dp).quantize(Decimal(1).scaleb(-dp), rounding=ROUND_HALF_EVEN))


def test_round_ratio_matches_exact_arithmetic(spark):
    rng = random.Random(11)
    rows = []
    for _ in range(3000):
        den = rng.choice([2, 4, 8, 16, 3, 7, 40, 1000, rng.randint(1, 10 ** 9)])
        num = rng.randint(-10 ** 12, 10 ** 12)
        rows.append((num, den))
    for k in range(500):  # exact ties at 2 dp: (2j+1) / 200
        rows.append(((2 * k + 1) * 5, 1000))
    df = spark.createDataFrame(rows, "n long, d long")
    for dp in (0, 1, 2, 4):
        got = df.select("n", "d", X.round_ratio(F.col("n"), F.col("d"), dp).alias("r")).collect()
        for r in got:
            assert r["r"] == half_even(Fraction(r["n"], r["d"]), dp), (r, dp)


def test_round_avg_matches_exact_arithmetic(spark):
    rng = random.Random(12)
    rows = [(Decimal(rng.randint(-10 ** 9, 10 ** 9)).scaleb(-2), rng.randint(1, 5000)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "s decimal(18,2), n long")
    got = df.select("s", "n", X.round_avg(F.col("s"), F.col("n"), 2, 2).alias("r")).collect()
    for r in got:
        assert r["r"] == half_even(Fraction(r["s"]) / r["n"], 2)
