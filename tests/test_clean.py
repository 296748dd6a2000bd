import os

import pytest
from pyspark.sql import functions as F

from tempora.operators import analysis, clean
from tempora.sources.history import read_history_csv
from tempora.sinks.report import run_report
from tests.conftest import write_text

HEADER = "dt,AverageTemperature,AverageTemperatureUncertainty,City,Country,Latitude,Longitude\n"
ROWS = [
    "1900-01-01,10.5,0.5,Paris,France,48.85N,2.35E",  # ok
    "1900-02-01,,0.5,Paris,France,48.85N,2.35E",  # empty temperature
    "1900-03-01,11.0,0.5,,France,48.85N,2.35E",  # empty city
    "1900-04-01,11.0,0.5,Paris,,48.85N,2.35E",  # empty country
    "1900-13-45,11.0,0.5,Paris,France,48.85N,2.35E",  # bad date
    "1900-05-01,warm,0.5,Paris,France,48.85N,2.35E",  # non-numeric temperature
    "1900-06-01,12.5,,Paris,France,48.85N,2.35E",  # empty uncertainty: kept
    "1950-01-01,-20,0.1,Oslo,Norway,59.91N,10.75E",  # exactly -20: not extreme
    "2000-07-01,40,0.1,Dubai,UAE,25.2N,55.27E",  # exactly 40: not extreme
    "2000-08-01,40.01,0.1,Dubai,UAE,25.2N,55.27E",  # extreme
]


@pytest.fixture()
def raw(spark, tmp_path):
    path = write_text(str(tmp_path / "hist" / "part.csv"), HEADER + "\n".join(ROWS) + "\n")
    return read_history_csv(spark, os.path.dirname(path))


def test_bad_rows_dropped_and_counted(raw):
    counts = clean.clean_counts(raw).first()
    assert (counts.rows_before, counts.rows_after, counts.rows_removed) == (10, 5, 5)
    assert counts.removal_pct == 50.0
    kept = clean.clean_history(raw)
    assert kept.columns == ["date", "year", "month", "temperature", "uncertainty", "city", "country",
                            "latitude", "longitude"]
    assert kept.count() == 5


def test_empty_uncertainty_kept_and_skipped_by_mean(raw):
    paris = clean.clean_history(raw).filter(F.col("city") == "Paris")
    r = analysis.mean_by_country(paris).first()
    assert r.num_records == 2 and r.avg_temperature == 11.5 and r.avg_uncertainty == 0.5


def test_strict_extreme_bounds(raw):
    c = clean.clean_history(raw)
    assert [r.temperature for r in analysis.extremes(c).collect()] == [40.01]
    assert analysis.global_stats(c).first().extreme_observations == 1


def test_observation_counts_during_write(raw, tmp_path):
    kept, obs = clean.observed_clean(raw)
    kept.write.parquet(str(tmp_path / "out"))
    assert obs.get == {"rows_before": 10, "rows_after": 5}


def test_null_profile(raw):
    r = clean.null_profile(raw).first().asDict()
    assert r["AverageTemperature"] == 1 and r["City"] == 1 and r["Country"] == 1
    assert r["AverageTemperatureUncertainty"] == 1 and r["dt"] == 0


def test_reordered_header_fails(spark, tmp_path):
    bad = "City,dt,AverageTemperature,AverageTemperatureUncertainty,Country,Latitude,Longitude\nParis,1900-01-01,1,1,F,a,b\n"
    path = write_text(str(tmp_path / "bad" / "x.csv"), bad)
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_history_csv(spark, os.path.dirname(path)).collect()


def test_city_threshold_is_strict(spark):
    rows = [("A", "X", 1.0)] * 100 + [("B", "X", 2.0)] * 101
    df = spark.createDataFrame(rows, "city string, country string, temperature double")
    got = [r.city for r in analysis.city_means(df).collect()]
    assert got == ["B"]


def test_top_k_ties_ordered_by_keys(spark):
    rows = [("C", "X", 5.0), ("A", "X", 5.0), ("B", "X", 5.0), ("D", "X", 1.0)]
    df = spark.createDataFrame(rows, "city string, country string, temperature double")
    means = analysis.city_means(df, min_records=0)
    assert [r.city for r in analysis.hottest(means, 2).collect()] == ["A", "B"]
    assert [r.city for r in analysis.coldest(means, 2).collect()] == ["D", "A"]


def test_report_one_row(raw):
    r = run_report(raw).first()
    assert r.rows_extracted == 10 and r.rows_after_cleaning == 5 and r.extreme_observations == 1
    assert r.global_max_temperature == 40.01 and r.columns == 7 and r.removal_percentage == 50.0


def test_clean_is_idempotent(raw):
    once = clean.clean_history(raw)
    twice = once.filter(clean.is_valid("city", "country"))
    assert sorted(once.collect()) == sorted(twice.collect())


def test_percentage_of_int_counts_needs_no_int_products(spark):
    rows = [(55_000, 150_000), (107_375, 900_000), (1_073_741_824, 2_147_483_647), (1, 20_000), (0, 2_147_483_647), (0, 0)]
    for kind in ("int", "long"):
        df = spark.createDataFrame(rows, f"part {kind}, whole {kind}")
        found = [r.pct for r in df.select(clean.half_up_percent("part", "whole").alias("pct")).collect()]
        assert found == [36.67, 11.93, 50.0, 0.01, 0.0, None]
