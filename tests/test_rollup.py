"""The mergeable pre-aggregate and versioned tables."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tempora.operators import analysis, rollup
from tempora.schemas import RECORD
from tempora.sinks import landing, versions
from tempora.sources.stream import read_record_csv_stream
from tempora.streaming import queries as sq
from tempora.streaming import windows as sw

SCHEMA = "date date, year int, month int, temperature double, uncertainty double, city string, country string, latitude string, longitude string"


@pytest.fixture(scope="module")
def clean(spark):
    rows = []
    for i in range(3000):
        d = dt.date(1895 + i % 120, 1 + i % 12, 1 + i % 28)
        t = [round(-30 + (i * 37 % 8000) / 100, 2), 1 / 3 + i][i % 97 == 0]  # some values the exact mean can't hold
        rows.append((d, d.year, d.month, t, None if i % 5 == 0 else i % 7 / 4, f"c{i % 41}", f"k{i % 6}", "x", "y"))
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.mark.parametrize("exact", [True, False])
def test_summaries_equal_those_of_the_rows(clean, exact):
    pre = rollup.preaggregate(clean)
    cases = [
        (rollup.mean_by_country(pre, exact=exact), analysis.mean_by_country(clean, exact=exact)),
        (rollup.mean_by_year(pre, exact=exact), analysis.mean_by_year(clean, exact=exact)),
        (rollup.mean_by_month(pre, exact=exact), analysis.mean_by_month(clean, exact=exact)),
        (rollup.mean_by_decade(pre, exact=exact), analysis.mean_by_decade(clean, exact=exact)),
        (rollup.mean_by_period(pre, exact=exact), analysis.mean_by_period(clean, exact=exact)),
        (rollup.city_means(pre, 10, exact=exact), analysis.city_means(clean, 10, exact=exact)),
        (rollup.global_stats(pre, exact=exact), analysis.global_stats(clean, exact=exact)),
        (rollup.yearly_means(pre, exact=exact, with_grain=True),
         analysis.yearly_means(clean, exact=exact, city="city", country="country", with_grain=True)),
    ]
    for got, want in cases:
        assert [c.lower() for c in got.columns] == [c.lower() for c in want.columns]
        a, b = (sorted([tuple(round(x, 1) if isinstance(x, float) and not exact else x for x in r) for r in df.collect()], key=repr) for df in (got, want))
        if exact:  # groups that fall back to the plain mean may differ in the order of their sums
            assert len(a) == len(b) and all(x == y or all(p == q or abs(p - q) < 0.011 for p, q in zip(x, y)) for x, y in zip(a, b))
        else:
            assert len(a) == len(b)


def test_merging_any_split_gives_the_whole(clean):
    whole = sorted(rollup.preaggregate(clean).drop("temperature_sum", "uncertainty_sum").collect(), key=repr)
    parts = [clean.where(F.pmod(F.xxhash64("date", "city"), F.lit(3)) == k) for k in range(3)]
    union = rollup.preaggregate(parts[0])
    for p in parts[1:]:
        union = union.unionByName(rollup.preaggregate(p))
    assert sorted(rollup.merge(union).drop("temperature_sum", "uncertainty_sum").collect(), key=repr) == whole
    twice = rollup.merge(rollup.merge(union, ["city", "country", "year"]), ["country"])
    assert sorted(twice.select("country", "n_rows").collect()) == sorted(rollup.merge(union, ["country"]).select("country", "n_rows").collect())


def test_slices_are_the_preaggregates_of_their_keys(clean):
    sets = {"calendar": ("country", "year", "month"), "city": ("city", "country")}
    found = rollup.slices(clean, sets)
    for name, keys in sets.items():
        got = found.where(F.col("slice") == name).select(*keys, "n_rows", "n_extreme", "temperature_hi", "temperature_lo", "temperature_max")
        want = rollup.preaggregate(clean, keys).select(*got.columns)
        assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr)


def test_increments_are_applied_once(spark, clean, tmp_path):
    root = str(tmp_path / "agg")
    halves = [clean.where("year < 1950"), clean.where("year >= 1950")]
    assert rollup.apply_increment(spark, root, rollup.preaggregate(halves[0]), "old")
    first = versions.read_current(spark, root)
    assert not rollup.apply_increment(spark, root, rollup.preaggregate(halves[0]), "old")  # a retry
    assert rollup.apply_increment(spark, root, rollup.preaggregate(halves[1]), "new")
    pick = ["city", "country", "year", "month", "n_rows", "temperature_hi", "temperature_lo"]
    assert sorted(versions.read_current(spark, root).select(*pick).collect(), key=repr) == sorted(rollup.preaggregate(clean).select(*pick).collect(), key=repr)
    assert first.agg(F.sum("n_rows")).first()[0] == halves[0].count()  # a read that began earlier goes on
    assert versions.current(spark, root).notes == {"applied": ["old", "new"]}


def test_only_one_writer_wins(spark, tmp_path):
    root = str(tmp_path / "v")
    assert versions.current(spark, root) is None and versions.read_current(spark, root) is None
    base = versions.publish(spark.range(3).toDF("x"), root)
    versions.publish(spark.range(4).toDF("x"), root, after=base)
    with pytest.raises(versions.Conflict):
        versions.publish(spark.range(9).toDF("x"), root, after=base)
    assert versions.read_current(spark, root).count() == 4
    for k in range(3):
        versions.publish(spark.range(k).toDF("x"), root, after=versions.current(spark, root))
    versions.expire(spark, root, keep=2)
    assert versions.read_current(spark, root).count() == 2 and versions.current(spark, root).number == 4
    assert len([n for n in os.listdir(root) if n.startswith("data-") and not n.endswith(".json")]) == 2


def test_reads_agree_before_during_and_after_compaction(spark, tmp_path):
    where, out, target, ckpt = (str(tmp_path / x) for x in ("in", "out", "small", "c"))
    rows = [((dt.datetime(2024, 1, 1) + dt.timedelta(seconds=30 * i)).isoformat(), "Paris", "France", 1.0, 2.0, float(i), 5.0, 90, 50.0, 1010.0, "s") for i in range(400)]
    staged = landing.stage_in_order(spark.createDataFrame(rows, RECORD), str(tmp_path / "s"), least=6)

    def run():
        windows = sw.flatten_window(sw.windowed_measures(sw.enrich(read_record_csv_stream(spark, where)), exact=True))
        sq.run_to_completion(sq.start_parquet_append(windows, out, ckpt, available_now=True))

    def both():
        a, b = sorted(spark.read.parquet(out).collect()), sorted(versions.read_compacted(spark, out, target).collect())
        assert a == b
        return len(a)

    landing.publish(spark, staged[:2], where)
    run()
    sizes = [both()]
    before = versions.read_compacted(spark, out, target)  # planned before the compaction, run after it
    versions.compact_stream(spark, out, target)
    assert sorted(before.collect()) == sorted(versions.read_compacted(spark, out, target).collect())
    sizes.append(both())
    landing.publish(spark, staged[2:4], where)
    run()  # the stream goes on
    sizes.append(both())
    versions.compact_stream(spark, out, target)
    landing.publish(spark, staged[4:], where)
    run()
    sizes.append(both())
    assert sizes[0] == sizes[1] < sizes[2] < sizes[3]
    small = versions.current(spark, target)
    assert len(small.notes["files"]) > len(spark.read.parquet(small.path).inputFiles())
