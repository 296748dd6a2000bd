import datetime as dt

import pytest

from tempora.operators.clean import table_shape
from tempora.operators.series import duration_seconds
from tempora.sinks.files import show
from tempora.sources.cities import cities
from tempora.streaming import windows as sw


@pytest.mark.parametrize("text,seconds", [("1 minute", 60), ("2 minutes", 120), ("1 day", 86400),
                                          ("10 seconds", 10), ("3 hours", 10800), ("1 week", 604800)])
def test_duration_seconds(text, seconds):
    assert duration_seconds(text) == seconds


def test_unified_with_grain_and_weighted_mean(spark):
    rows = [(dt.datetime(2024, 1, 1, 10, 0, s), "Paris", "France", float(t)) for s, t in [(1, 10), (2, 20), (3, 30)]]
    rows.append((dt.datetime(2024, 1, 1, 10, 1, 0), "Paris", "France", 100.0))
    df = spark.createDataFrame(rows, "event_time timestamp, city string, country string, temperature_celsius double")
    df = df.withColumns({"wind_speed_kmh": df.temperature_celsius, "humidity_percent": df.temperature_celsius,
                         "pressure_hpa": df.temperature_celsius})
    u = sw.to_unified(sw.windowed_measures(df, watermark=None), with_grain=True)
    got = sorted((r.n, r.temperature_moyenne) for r in u.collect())
    assert got == [(1, 100.0), (3, 20.0)]
    from tempora.operators.unified import weighted_mean_by

    w = weighted_mean_by(u, ["City"]).first().temp_moy_ponderee
    assert w == pytest.approx((3 * 20.0 + 100.0) / 4)


def test_table_shape_and_city_dimension(spark, capsys):
    c = cities(spark)
    assert table_shape(c)["columns"] == 4 and c.count() == 5
    show(c, 2)
    assert "Paris" in capsys.readouterr().out
