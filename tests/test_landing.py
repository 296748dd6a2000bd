"""Landing in event-time order, and the accounts of streaming queries."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tempora.schemas import RECORD
from tempora.sinks import landing
from tempora.sources.stream import read_record_csv_stream
from tempora.streaming import accounting
from tempora.streaming import queries as sq
from tempora.streaming import windows as sw

START = dt.datetime(2024, 1, 1)


def records(spark, seconds, partitions=5):
    """One record for each number of seconds after START (None: no event time), in no order."""
    rows = [(None if s is None else (START + dt.timedelta(seconds=s)).isoformat(), "Paris", "France", 1.0, 2.0, float(i), 5.0, 90, 50.0, 1010.0, "s")
            for i, s in enumerate(seconds)]
    return spark.createDataFrame(rows, RECORD).repartition(partitions, "temperature_celsius")


def staged_times(spark, folders):
    return [sorted(r["timestamp"] or "" for r in spark.read.schema(RECORD).option("header", True).csv(f).collect()) for f in folders]


def in_modification_order(where):
    names = [n for n in os.listdir(where) if n.endswith(".csv")]
    return sorted(names, key=lambda n: os.stat(os.path.join(where, n)).st_mtime_ns)


def test_files_follow_one_another_in_event_time(spark, tmp_path):
    df = records(spark, [(i * 7919) % 3600 for i in range(2000)])
    folders = landing.stage_in_order(df, str(tmp_path / "s"), rows_per_file=250)
    times = staged_times(spark, folders)
    assert len(folders) == 8 and sum(map(len, times)) == 2000
    assert all(a[-1] <= b[0] for a, b in zip(times, times[1:]))  # ranges don't overlap
    assert all(150 < len(t) < 350 for t in times)  # as large as asked for
    assert all(len([n for n in os.listdir(f) if n.endswith(".csv")]) == 1 for f in folders)


def test_a_frequent_event_time_is_dealt_out(spark, tmp_path):
    """A third of the rows at one instant, and rows without a time."""
    seconds = [i for i in range(600)] + [300] * 400 + [None] * 200
    folders = landing.stage_in_order(records(spark, seconds), str(tmp_path / "s"), rows_per_file=100)
    times = staged_times(spark, folders)
    known = [[t for t in own if t] for own in times]
    assert sum(map(len, times)) == 1200 and all(a[-1] <= b[0] for a, b in zip(known, known[1:]))
    assert max(map(len, known)) < 250 and sum(t == "" for t in times[0]) == 200


def test_nothing_to_land(spark, tmp_path):
    empty = records(spark, [1]).limit(0)
    where = str(tmp_path / "in")
    assert landing.land_in_order(empty, where, str(tmp_path / "s"), least=4) == 0 and os.listdir(where) == []
    no_time = landing.stage_in_order(records(spark, [None, None]), str(tmp_path / "t"), least=4)
    assert len(no_time) == 1


def test_published_files_are_newer_than_those_before(spark, tmp_path):
    where = str(tmp_path / "in")
    staged = landing.stage_in_order(records(spark, range(400)), str(tmp_path / "s"), least=6)
    landing.publish(spark, staged[:2], where)
    first = in_modification_order(where)
    landing.publish(spark, staged[2:], where)
    every = in_modification_order(where)
    assert len(every) == 6 and every[:2] == first and every == sorted(every)


def test_border_search_equals_counting(spark):
    borders = [3, 5, 5, 5, 9]
    values = spark.createDataFrame([(v,) for v in [None, 0, 3, 4, 5, 6, 9, 10]], "v long")
    for salt in range(5):
        got = {r["v"]: r["n"] for r in values.select("v", landing.file_number(F.col("v"), borders, F.lit(salt)).alias("n")).collect()}
        for v, n in got.items():
            lo, hi = (0, 0) if v is None else (sum(b < v for b in borders), sum(b <= v for b in borders))
            assert n == lo + salt % (hi - lo + 1)


def append(spark, where, out, ckpt, **kwargs):
    windows = sw.flatten_window(sw.windowed_measures(sw.enrich(read_record_csv_stream(spark, where)), exact=True))
    return sq.start_parquet_append(windows, out, ckpt, **kwargs)


def land_nine(spark, tmp_path):
    """Nine files in order but for some rows of the first one, which come with the fifth."""
    where = str(tmp_path / "in")
    staged = landing.stage_in_order(records(spark, [20 * i for i in range(900)]), str(tmp_path / "s"), least=9)
    late = landing.stage_in_order(records(spark, [5, 65, 66]), str(tmp_path / "l"))
    landing.publish(spark, staged[:4] + late + staged[4:], where)
    return where


def test_a_loss_in_an_early_batch_is_found(spark, tmp_path):
    """However few progress records the query keeps."""
    where, key = land_nine(spark, tmp_path), "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(key)
    spark.conf.set(key, "2")
    try:
        query = append(spark, where, str(tmp_path / "o"), str(tmp_path / "c"), available_now=True)
        with pytest.raises(sq.LateRows, match="2 rows or groups"):
            sq.run_to_completion(query)
        assert sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"]) == 0  # not to be seen there
        with pytest.raises(sq.LateRows):
            sq.await_all([query], allow_late=False)
    finally:
        spark.conf.set(key, before)
    kept = accounting.account(spark, str(tmp_path / "c"))
    assert (kept.rows, kept.dropped, kept.complete) == (903, 2, True) and kept.batches >= 10


def test_an_account_outlives_the_query(spark, tmp_path):
    where, out, ckpt = (str(tmp_path / x) for x in ("in", "o", "c"))
    staged = landing.stage_in_order(records(spark, [20 * i for i in range(300)]), str(tmp_path / "s"), least=4)
    landing.publish(spark, staged[:2], where)
    sq.run_to_completion(append(spark, where, out, ckpt, available_now=True))
    half = accounting.account(spark, ckpt)
    sq.run_to_completion(append(spark, where, out, ckpt, available_now=True))  # nothing new
    assert accounting.account(spark, ckpt) == half and 0 < half.rows < 300
    landing.publish(spark, staged[2:], where)
    query = sq.run_to_completion(append(spark, where, out, ckpt, available_now=True))
    run, total = accounting.settled(spark, query)
    assert total.rows == 300 and run.rows == 300 - half.rows and total.complete and total == accounting.account(spark, ckpt)


def test_batches_are_counted_once_and_gaps_are_told():
    a = accounting.Account().add(0, 10, 1).add(1, 10, 0).add(1, 10, 5)
    assert (a.rows, a.dropped, a.complete) == (20, 1, True)
    assert a.add(4, 1, 0) == accounting.Account(3, 21, 1, 4, 2) and not a.add(4, 1, 0).complete


def test_a_broken_account_file_is_passed_over(spark, tmp_path):
    store = accounting._Store(spark, str(tmp_path / "a"))
    for k in range(4):
        store.write(accounting.Account(k + 1, 10 * k, k, k))
    names = sorted(n for n in os.listdir(tmp_path / "a") if not n.startswith("."))
    assert names == ["2.json", "3.json"]  # few files, however long the query runs
    for name in ("3.json", ".3.json.crc"):
        open(tmp_path / "a" / name, "w").close()
    assert store.read() == accounting.Account(3, 20, 2, 2)


def test_a_trigger_runs_a_number_of_batches(spark, tmp_path):
    where, out, ckpt = (str(tmp_path / x) for x in ("in", "o", "c"))
    landing.publish(spark, landing.stage_in_order(records(spark, [20 * i for i in range(300)]), str(tmp_path / "s"), least=4), where)
    query = append(spark, where, out, ckpt, processing_time="100 milliseconds")
    run = sq.run_batches(query, 2, timeout=120)
    assert run.batches >= 2 and not query.isActive
    query = append(spark, where, out, ckpt, processing_time="100 milliseconds")
    with pytest.raises(TimeoutError):
        sq.run_batches(query, 10_000, timeout=5)
    assert not query.isActive


def test_lateness_of_each_batch(spark, tmp_path):
    where, path = str(tmp_path / "in"), str(tmp_path / "late")
    staged = landing.stage_in_order(records(spark, [*[20 * i for i in range(300)], None]), str(tmp_path / "s"), least=3)
    landing.publish(spark, staged, where)
    sq.run_to_completion(sq.start_lateness_table(sw.enrich(read_record_csv_stream(spark, where)), path, str(tmp_path / "c"), available_now=True))
    rows = spark.read.parquet(path).orderBy("batch").collect()
    assert len(rows) == 3 and sum(r["n_rows"] for r in rows) == 301 and [r["no_event_time"] for r in rows] == [1, 0, 0]
    assert all(r["one_clock"] for r in rows)
    assert all(a["processing_time"] < b["processing_time"] for a, b in zip(rows, rows[1:]))
    for r in rows:
        spread = (r["last_event"] - r["first_event"]).total_seconds() * 1e6
        assert r["greatest_us"] - r["least_us"] == spread and r["least_us"] <= r["shares_us"][0] <= r["shares_us"][1] <= r["greatest_us"]


def test_the_consumer_command_can_fail_on_losses(spark, tmp_path):
    from tempora import cli

    where = land_nine(spark, tmp_path)

    def consume(name, *flags):
        cli.main(["consumer", "--base", str(tmp_path / name), "--checkpoints", str(tmp_path / f"{name}-c"), "--input", where, "--available-now", "--no-console", *flags])

    consume("a")
    with pytest.raises(sq.LateRows):
        consume("b", "--fail-late")
    assert spark.read.parquet(str(tmp_path / "a" / "streaming")).count() == spark.read.parquet(str(tmp_path / "b" / "streaming")).count() > 0
