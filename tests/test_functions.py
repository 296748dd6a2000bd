import math

import pytest
from pyspark.sql import functions as F

from tempora.functions import (
    REFERENCE_PERIODS,
    decade,
    first_element,
    kelvin_to_celsius,
    mean,
    ms_to_kmh,
    period,
    wind_bearing,
    wind_speed,
)


def test_mean_reference_and_exact(spark):
    df = spark.createDataFrame([(0.125,), (None,)], "v double")
    row = df.agg(mean("v").alias("ref"), mean("v", exact=True).alias("exact"),
                 mean("v", decimals=None).alias("raw")).first()
    assert row.ref == 0.13 and row.exact == 0.13 and row.raw == 0.125


def test_exact_mean_negative_rounds_away_from_zero(spark):
    df = spark.createDataFrame([(-0.12,), (-0.13,)], "v double")
    assert df.agg(mean("v", exact=True).alias("m")).first().m == -0.13


def test_exact_mean_independent_of_partitioning(spark):
    rows = [(i * 0.01 + 1000.37,) for i in range(2000)]
    df = spark.createDataFrame(rows, "v double")
    a = df.agg(mean("v", exact=True).alias("m")).first().m
    b = df.repartition(7).agg(mean("v", exact=True).alias("m")).first().m
    assert a == b


def test_decade_truncates_toward_zero(spark):
    df = spark.createDataFrame([(1999,), (2000,), (-5,)], "y int")
    got = [r.d for r in df.select(decade("y").alias("d")).collect()]
    assert got == [1990, 2000, 0]


def test_period_half_open_buckets(spark):
    years = [1899, 1900, 1949, 1950, 1999, 2000]
    df = spark.createDataFrame([(y,) for y in years], "y int")
    got = [r.p for r in df.select(period("y", REFERENCE_PERIODS).alias("p")).collect()]
    assert got == [None, "1900-1949", "1900-1949", "1950-1999", "1950-1999", "2000+"]


@pytest.mark.parametrize(
    "u,v,speed,bearing",
    [(0.0, 4.0, 14.4, 180), (0.0, 0.0, 0.0, 0), (3.0, 4.0, 18.0, 216), (None, 4.0, None, None)],
)
def test_wind(spark, u, v, speed, bearing):
    df = spark.createDataFrame([(u, v)], "u double, v double")
    r = df.select(ms_to_kmh(wind_speed("u", "v")).alias("s"), wind_bearing("u", "v").alias("b")).first()
    assert r.s == speed and r.b == bearing


def test_kelvin_zero_celsius_is_not_null(spark):
    df = spark.createDataFrame([([273.15],), ([],), (None,)], "a array<double>")
    got = [r.c for r in df.select(kelvin_to_celsius(first_element("a")).alias("c")).collect()]
    assert got == [0.0, None, None]


def test_no_python_udf_in_expressions(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "u double, v double")
    plan = df.select(wind_bearing("u", "v"), wind_speed("u", "v"))._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert math.isclose(df.select(F.degrees(F.atan2("u", "v"))).first()[0], 26.565051177077994)


def test_exact_mean_survives_long_overflow_of_units(spark):
    # 3 × 4e18 cents exceeds the long range; the split sums stay exact
    df = spark.createDataFrame([(4e16,), (4e16,), (4e16,), (None,)], "v double")
    assert df.agg(mean("v", exact=True).alias("m")).first().m == 4e16


def test_exact_mean_of_empty_group_is_null(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert df.agg(mean("v", exact=True).alias("m")).first().m is None


def test_default_for_missing_field(spark):
    from tempora.functions import default

    df = spark.createDataFrame([(None,), (2.5,)], "v double")
    assert [r.d for r in df.select(default("v", 0.0).alias("d")).collect()] == [0.0, 2.5]


def test_exact_mean_with_wider_scale(spark):
    # three-decimal inputs: units of 0.001, result still rounded HALF_UP to 2 dp
    df = spark.createDataFrame([(12.345,), (12.344,), (None,)], "v double")
    row = df.agg(mean("v", exact=True, scale=3).alias("m"), mean("v", decimals=None, exact=True, scale=3).alias("u"))
    r = row.first()
    assert r.m == 12.34 and abs(r.u - 12.3445) < 1e-12  # 12.3445 → 12.34 (only 4 decimals matter)
    with pytest.raises(ValueError):
        mean("v", decimals=3, exact=True, scale=2)


def test_exact_mean_never_alters_its_inputs(spark):
    """More decimals than the scale, NaN, infinities and huge values: the plain mean's figure."""
    from tempora.functions.means import mean

    inf, nan = float("inf"), float("nan")
    groups = {"long": [1.005, 1.005], "nan": [nan, 10.0], "inf": [inf, 1.0], "huge": [1e300, 1e300], "fine": [0.1, 0.2, None], "none": [None]}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, v double")
    out = {r["k"]: (r["a"], r["b"]) for r in df.groupBy("k").agg(mean("v", exact=True).alias("a"), mean("v").alias("b")).collect()}
    for k in ("long", "nan", "inf", "huge", "none"):
        assert repr(out[k][0]) == repr(out[k][1]), k
    assert out["fine"][0] == 0.15 and out["long"][0] == 1.01


def test_shared_folder_is_required_on_a_cluster(monkeypatch):
    import pytest

    from tempora import session

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})()
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="checkpoint"):
        session.shared_dir(Session())
