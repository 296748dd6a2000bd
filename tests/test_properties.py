"""Seeded property tests (hypothesis) over generated historical tables."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tempora.operators import analysis, clean

ROW = st.tuples(
    st.one_of(st.none(), st.dates(dt.date(1890, 1, 1), dt.date(2020, 12, 31)).map(str), st.just("bad")),
    st.one_of(st.none(), st.integers(-6000, 6000).map(lambda c: str(c / 100)), st.just("x")),
    st.one_of(st.none(), st.sampled_from(["0.1", "0.25", ""])),
    st.one_of(st.none(), st.sampled_from(["Paris", "Oslo", "Lima"])),
    st.one_of(st.none(), st.sampled_from(["France", "Norway", "Peru"])),
)
SCHEMA = ("dt string, AverageTemperature string, AverageTemperatureUncertainty string, City string, "
          "Country string")
COMMON = dict(max_examples=15, deadline=None, derandomize=True,
              suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumn("Latitude", df.City).withColumn("Longitude", df.Country)


@settings(**COMMON)
@given(rows=st.lists(ROW, max_size=60))
def test_counts_add_up_and_clean_is_idempotent(spark, rows):
    raw = frame(spark, rows)
    c = clean.clean_counts(raw).first()
    assert c.rows_before == len(rows) and c.rows_removed + c.rows_after == c.rows_before
    kept = clean.clean_history(raw)
    assert kept.count() == c.rows_after
    again = kept.filter(clean.is_valid("city", "country"))
    assert sorted(again.collect()) == sorted(kept.collect())
    by_year = analysis.mean_by_year(kept, exact=True).collect()
    assert sum(r.num_records for r in by_year) == c.rows_after


@settings(**COMMON)
@given(rows=st.lists(ROW, min_size=1, max_size=60), n=st.integers(1, 7))
def test_results_unchanged_by_partitioning(spark, rows, n):
    kept = clean.clean_history(frame(spark, rows))
    a = analysis.mean_by_decade(kept, exact=True).collect()
    b = analysis.mean_by_decade(kept.repartition(n), exact=True).collect()
    assert a == b


@settings(**COMMON)
@given(rows=st.lists(ROW, min_size=1, max_size=60))
def test_hottest_is_coldest_reversed_when_k_covers_all(spark, rows):
    means = analysis.city_means(clean.clean_history(frame(spark, rows)), min_records=0, exact=True)
    hot = [(r.city, r.country, r.avg_temperature) for r in analysis.hottest(means, 100).collect()]
    cold = [(r.city, r.country, r.avg_temperature) for r in analysis.coldest(means, 100).collect()]
    assert sorted(hot) == sorted(cold)
    assert [t for *_, t in hot] == sorted((t for *_, t in cold), reverse=True)
