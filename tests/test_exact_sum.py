"""Exact sums of doubles against math.fsum, and their use in the marts."""

from __future__ import annotations

import math
import random
import struct

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripmart.operators.exact_sum import exact_sums, limbs, totals


def expected(values):
    """fsum of scaled integers: unlike math.fsum it has no overflow on the way."""
    values = [v for v in values if v is not None]
    if not values:
        return None
    if any(not math.isfinite(v) for v in values):
        return sum(v for v in values if not math.isfinite(v))  # as SQL: an infinity, or NaN
    from fractions import Fraction

    total = sum(map(Fraction, values))
    try:
        return float(total)
    except OverflowError:
        return math.inf if total > 0 else -math.inf


def same(a, b):
    return a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


def check(spark, groups, parts=5):
    rows = [(g, x, 0.5 if i % 2 else None) for g, v in enumerate(groups) for i, x in enumerate(v)]
    random.Random(len(rows)).shuffle(rows)
    df = spark.createDataFrame(rows, "g int, x double, half double").repartition(parts)
    found = exact_sums(df, ["g"], {"x": F.col("x"), "half": F.col("half")}, {"n": F.count(F.lit(1))}).collect()
    assert len(found) == sum(1 for v in groups if v)
    for r in found:
        v = groups[r["g"]]
        assert same(r["x"], expected(v)), (v, r["x"])
        assert (r["n"], r["x_n"]) == (len(v), sum(x is not None for x in v))
        assert r["half"] == (len(v) // 2 / 2 or None)


def test_chosen_values(spark):
    rng = random.Random(4)
    inf, nan = math.inf, math.nan
    check(spark, [
        [2e10, 1.0, 0.123456789], [0.1] * 10, [1e16, 1.0, -1e16], [1.0, 2.0**-53], [1.0, 2.0**-53, 2.0**-106],
        [1e308, 1e308, -1e308, 1e-310], [1e308] * 5, [-1e308] * 5, [5e-324] * 3, [0.0, -0.0], [-0.1] * 9,
        [2.0**28, -2.0**28, 2.0**-69], [-(2.0**28), 2.0**28 - 2.0**-24, 1e-30], [nan, 1.0], [inf, 1.0], [-inf, 1e300],
        [inf, -inf], [inf, nan], [None, None], [None, 3.5], [1.7976931348623157e308, 9.979201547673599e291],
        [rng.uniform(0, 500) for _ in range(3000)],
        [rng.uniform(-1, 1) * 10.0 ** rng.randint(-300, 300) for _ in range(200)],
    ])


def test_the_order_of_rows_does_not_matter(spark):
    rng = random.Random(9)
    values = [rng.uniform(-1, 1) * 10.0 ** rng.randint(-20, 20) for _ in range(400)]
    got = {exact_sums(spark.createDataFrame([(1, v) for v in rng.sample(values, 400)], "g int, x double").repartition(n),
                      ["g"], {"x": F.col("x")}, {}).first()["x"] for n in (1, 3, 8)}
    assert got == {math.fsum(values)}


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=12), min_size=1, max_size=30))
def test_any_finite_doubles(spark, groups):
    check(spark, groups, 3)


def test_random_bit_patterns(spark):
    rng = random.Random(8)

    def any_double():
        x = struct.unpack("d", struct.pack("Q", rng.getrandbits(64)))[0]
        return x if math.isfinite(x) else 1.5

    check(spark, [[any_double() for _ in range(rng.randint(1, 9))] for _ in range(150)])


def test_partial_sums_meet_under_other_keys(spark):
    rng = random.Random(2)
    rows = [(i % 7, rng.choice([rng.uniform(0, 9), 1e200, -1e200, 1e-40])) for i in range(500)]
    df = spark.createDataFrame(rows, "g int, x double").repartition(4)
    parts = limbs(df, ["g"], {"x": F.col("x")}, {}).withColumn("odd", F.col("g") % 2).drop("g")
    got = {r["odd"]: r["x"] for r in totals(parts, ["odd"]).collect()}
    assert got == {o: math.fsum(x for g, x in rows if g % 2 == o) for o in (0, 1)}


def test_the_usual_sum_is_planned_with_partial_aggregates_only(spark):
    """A hot group is one row a task before the shuffle, and no Python runs."""
    df = spark.range(1000).select(F.lit(1).alias("g"), (F.col("id") / 4).alias("x"))
    plan = exact_sums(df, ["g"], {"x": F.col("x")}, {})._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "Python" not in plan
    assert plan.index("partial_sum") > plan.index("Exchange")


def test_large_and_fine_amounts_count_in_the_daily_mart(spark):
    import datetime as dt

    from tripmart.operators import core, marts
    from tripmart.schemas import FLAGS, MONEY
    from tripmart.sources import seeds

    at = dt.datetime(2025, 3, 1, 10)
    fares = [2e10, 1.0, 0.123456789, 1e300, -1e300]
    rows = [("k", at, 1.0, 60, *[f if m == "base_passenger_fare" else 0.0 for m in MONEY], *[False for _ in FLAGS])
            for f in fares]
    schema = ("trip_id string, pickup_datetime timestamp_ntz, trip_miles double, trip_time long, "
              + ", ".join(f"{m} double" for m in MONEY) + ", " + ", ".join(f"{f} boolean" for f in FLAGS))
    stg = spark.createDataFrame(rows, schema)
    from tripmart.functions.keys import surrogate_key

    fact = stg.withColumn("trip_flags_id", surrogate_key(*FLAGS)).drop(*FLAGS)
    dims = core.build_dim_datetime(stg, seeds.holidays(spark)), core.build_dim_trip_flags(spark)
    assert marts.build_daily(fact, *dims).first()["passenger_total_spend"] == 20000000001.12345679 == math.fsum(fares)
    both = marts.build_date_marts(fact, *dims)
    assert both["bi_daily_metrics"].first()["platform_gross_revenue"] == math.fsum(fares)
    both["_cache"].unpersist()
