"""Total order with positions, sketches, state that expires, reruns, jobs without a valid row."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tempora.operators import ordering, series, sketches
from tempora.plans import jobs
from tempora.sinks import landing
from tempora.sources.stream import read_parquet_stream
from tempora.streaming import queries as sq
from tests.conftest import write_text

HEADER = "dt,AverageTemperature,AverageTemperatureUncertainty,City,Country,Latitude,Longitude\n"


@pytest.mark.parametrize("ranges", [1, 4, None])
def test_positions_are_those_of_a_global_sort(spark, tmp_path, ranges):
    rows = [(None if i % 50 == 0 else f"k{i * 7 % 13}", i * 31 % 997) for i in range(3000)]
    df = spark.createDataFrame(rows, "a string, b int").repartition(6)
    ordering.write_ordered(df, str(tmp_path / "o"), ["a", "b"], ranges)
    got = ordering.read_ordered(spark, str(tmp_path / "o")).collect()
    assert sorted(r["position"] for r in got) == list(range(1, 3001))
    in_order = [(r["a"], r["b"]) for r in sorted(got, key=lambda r: r["position"])]
    assert in_order == sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))  # nulls first
    assert ordering.read_ordered(spark, str(tmp_path / "o")).columns == ["a", "b", "position"]


def test_positions_of_an_empty_table(spark, tmp_path):
    ordering.write_ordered(spark.range(0).toDF("x"), str(tmp_path / "o"), ["x"])
    assert ordering.read_ordered(spark, str(tmp_path / "o")).count() == 0


def test_merged_sketches_estimate_the_union(spark, tmp_path):
    """Whatever the split: the sketches of parts, written and merged, against the exact count."""
    rows = spark.range(60_000).select(
        F.concat(F.lit("c"), F.pmod(F.xxhash64("id"), F.lit(20_000)).cast("string")).alias("City"), (F.col("id") % 7).cast("string").alias("Country"),
        F.when(F.col("id") % 3 == 0, "batch").otherwise("streaming").alias("source"), (1990 + F.col("id") % 11).cast("int").alias("year"),
    )
    path = str(tmp_path / "s")
    for part in ("batch", "streaming"):  # two roots, one table of sketches
        sketches.distinct_sketches(rows.where(F.col("source") == part)).write.mode("append").parquet(path)
    kept = spark.read.parquet(path)
    exact = rows.agg(F.count_distinct("City"), F.count_distinct("Country")).first()
    merged, direct = sketches.estimates(kept).first(), sketches.estimates(sketches.distinct_sketches(rows, [])).first()
    by_year = sketches.estimates(sketches.merge_sketches(kept, ["year"])).first()
    assert merged == by_year and kept.count() == 22
    for got, near, want in zip(merged, direct, exact):
        assert abs(got - want) <= max(1, 4 * sketches.relative_error() * want) and abs(got - near) <= max(1, 4 * sketches.relative_error() * want)
    empty = sketches.distinct_sketches(rows.limit(0))
    assert sketches.estimates(kept.unionByName(empty)).first() == merged


def test_state_expires_and_nothing_is_lost(spark, tmp_path):
    """Every user is seen on one day only: state for all of them would grow without end."""
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(days=i // 50, seconds=i), f"u{i // 5}", float(i)) for i in range(600)]
    df = spark.createDataFrame(rows, "ts timestamp, user string, value double")
    where = str(tmp_path / "in")
    landing.publish(spark, landing.stage_in_order(df, str(tmp_path / "s"), least=12, by="ts", as_parquet=True), where)

    def run(of, name):
        path = str(tmp_path / name)
        stream = read_parquet_stream(spark, where, df.schema, max_files_per_trigger=1)
        query = sq.run_to_completion(sq.start_update_table(of(stream), path, f"{path}-ckpt", available_now=True))
        held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
        return spark.read.option("basePath", path).parquet(path).drop("batch_id"), held

    updates, held = run(lambda s: series.latest_in_spans(s, ["user"], "ts"), "latest")
    assert len(held) >= 12 and max(held) <= 40  # two days of ten users each at most, and not 120
    latest = series.fold_latest(updates.drop("_batch_id"), ["user"], "ts")
    assert sorted(latest.collect()) == sorted(series.latest_per_key(df, ["user"], "ts").select(latest.columns).collect())

    updates, held = run(lambda s: series.stats_in_spans(s, ["user"], "ts", "value"), "stats")
    assert max(held) <= 40
    values = [c for c in updates.columns if c not in ("span", "user", "_batch_id")]
    last = updates.groupBy("span", "user").agg(F.max_by(F.struct(*values), "_batch_id").alias("v")).select("span", "user", "v.*")
    got = series.fold_stats(last, ["user"], "value", exact=True)
    assert sorted(got.collect()) == sorted(series.stats_per_key(df, ["user"], "value", exact=True).collect())


def test_jobs_without_a_valid_row(spark, tmp_path):
    source = str(tmp_path / "csv")
    write_text(os.path.join(source, "a.csv"), HEADER + "not a date,1.0,,Paris,France,1N,1E\n2000-01-01,,,Oslo,Norway,1N,1E\n")
    counts = jobs.batch_job(spark, source, str(tmp_path / "base"))
    assert counts == {"rows_before": 2, "rows_after": 0, "rows_removed": 2}


def test_ordered_batch_root(spark, tmp_path):
    source, base = str(tmp_path / "csv"), str(tmp_path / "base")
    lines = [f"{1990 + i % 4}-0{1 + i % 9}-01,{i}.5,,c{i % 3},k{i % 2},1N,1E\n" for i in range(40)]
    write_text(os.path.join(source, "a.csv"), HEADER + "".join(lines))
    jobs.batch_job(spark, source, base, ordered_path=f"{base}/ordered")
    got = sorted(ordering.read_ordered(spark, f"{base}/ordered").collect(), key=lambda r: r["position"])
    keys = [(r["Country"], r["City"], r["year"]) for r in got]
    assert keys == sorted(keys) and [r["position"] for r in got] == list(range(1, len(got) + 1)) and len(got) == spark.read.parquet(f"{base}/batch").count()
