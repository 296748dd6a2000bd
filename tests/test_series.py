import datetime as dt

from tempora.operators import series


def test_latest_stats_evolution_rank(spark):
    t = dt.datetime
    rows = [("Paris", t(2024, 1, 1, 10), 10.0), ("Paris", t(2024, 1, 2, 10), 14.0), ("Paris", t(2024, 1, 2, 12), 16.0),
            ("Oslo", t(2024, 1, 1, 9), -3.0), ("Oslo", t(2024, 1, 1, 9), -1.0)]
    df = spark.createDataFrame(rows, "city string, ts timestamp_ntz, value double")
    latest = {r.city: r.value for r in series.latest_per_key(df, ["city"], "ts").collect()}
    assert latest == {"Paris": 16.0, "Oslo": -1.0}  # tie on ts broken by the other columns
    stats = {r.city: (r.mean_value, r.max_value, r.min_value, r.n) for r in
             series.stats_per_key(df, ["city"], "value", exact=True).collect()}
    assert stats == {"Paris": (13.33, 16.0, 10.0, 3), "Oslo": (-2.0, -1.0, -3.0, 2)}
    evo = series.evolution(df, ["city"], "ts", "value").filter("city = 'Paris'").orderBy("window_start").collect()
    assert [(r.mean_value, r.change) for r in evo] == [(10.0, None), (15.0, 5.0)]
    ranks = {r.city: r.rank for r in series.rank_by_mean(df, ["city"], "value").collect()}
    assert ranks == {"Paris": 1, "Oslo": 2}


def test_evolution_chunks_match_single_pass(spark):
    t = dt.datetime
    days = [0, 1, 2, 4, 5, 9, 10, 11, 15]  # gaps cross chunk borders
    rows = [(k, t(2024, 1, 1 + d, 6), float(d * 3 + i)) for i, k in enumerate(["a", "b", None]) for d in days]
    df = spark.createDataFrame(rows, "city string, ts timestamp, value double")
    small = series.evolution(df, ["city"], "ts", "value", chunk_windows=2, exact=True)
    whole = series.evolution(df, ["city"], "ts", "value", chunk_windows=10_000, exact=True)
    assert sorted(small.collect(), key=str) == sorted(whole.collect(), key=str)
    a = small.filter("city = 'a'").orderBy("window_start").collect()
    assert [r.change for r in a] == [None] + [3.0 * (d2 - d1) for d1, d2 in zip(days, days[1:])]


def test_rank_ties_and_nulls(spark):
    rows = [("a", 1.0), ("b", 3.0), ("c", 3.0), ("d", None), ("e", 2.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.rank for r in series.rank_by_mean(df, ["k"], "v").collect()}
    assert got == {"b": 1, "c": 1, "e": 3, "a": 4, "d": 5}


def test_latest_per_key_on_a_stream(spark, tmp_path):
    from tempora.sources.stream import read_record_csv_stream
    from tempora.streaming import queries as sq
    from tempora.streaming import windows as sw
    from tests.test_stream import land, rec

    landing = str(tmp_path / "in")
    land(landing, "1.csv", [rec("2024-01-01T10:00:30", temp=10.0), rec("2024-01-01T10:00:40", city="Oslo", temp=1.0)])
    land(landing, "2.csv", [rec("2024-01-01T10:02:00", temp=12.0)])
    enriched = sw.enrich(read_record_csv_stream(spark, landing, max_files_per_trigger=1))
    latest = series.latest_per_key(enriched.select("city", "event_time", "temperature_celsius"), ["city"],
                                   "event_time")
    path, ckpt = str(tmp_path / "upd"), str(tmp_path / "ckpt")
    sq.run_to_completion(sq.start_update_table(latest, path, ckpt, available_now=True))
    got = {r.city: r.temperature_celsius for r in sq.latest_updates(spark, path, ["city"]).collect()}
    assert got == {"Paris": 12.0, "Oslo": 1.0}


def test_rank_over_many_ranges(spark):
    from tempora.operators.series import rank_by_mean

    df = spark.range(3000).selectExpr("id as k", "cast(id % 700 as double) as v").repartition(7)
    got = {r["k"]: r["rank"] for r in rank_by_mean(df, ["k"], "v").collect()}
    values = sorted((k % 700 for k in range(3000)), reverse=True)
    first = {}
    for place, v in enumerate(values, 1):
        first.setdefault(v, place)
    assert got == {k: first[k % 700] for k in range(3000)}
