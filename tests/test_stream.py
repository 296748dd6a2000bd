import os
import time

import pytest
from pyspark.sql import functions as F

from tempora.sinks.files import land_records_csv
from tempora.sources.stream import decode_json, read_record_csv_stream
from tempora.schemas import RECORD, RECORD_COLUMNS
from tempora.streaming import queries as sq
from tempora.streaming import windows as sw
from tests.conftest import write_text

HEADER = ",".join(RECORD_COLUMNS) + "\n"


def rec(ts, city="Paris", temp=10.0, wind="5.0", deg="90", hum="50.0", pres="1010.0"):
    return f"{ts},{city},France,48.85,2.35,{temp},{wind},{deg},{hum},{pres},sim\n"


def land(directory, name, lines, header=HEADER):
    write_text(os.path.join(directory, name), header + "".join(lines))
    time.sleep(0.05)  # distinct modification times keep file order


def windowed_query(spark, landing, out, ckpt, allow_late=False):
    stream = read_record_csv_stream(spark, landing, max_files_per_trigger=1)
    flat = sw.flatten_window(sw.windowed_measures(sw.enrich(stream), exact=True))
    return sq.run_to_completion(sq.start_parquet_append(flat, out, ckpt, available_now=True), allow_late=allow_late)


def test_csv_record_parsing(spark, tmp_path):
    landing = str(tmp_path / "in")
    lines = [
        "2024-01-01T10:00:00,Paris,France,48.85,2.35,None,5.0,90,50.0,1010.0,sim\n",  # None text in a number
        '2024-01-01T10:00:01,"Washington, D.C.",USA,38.9,-77.0,12.0,5.0,90,50.0,1010.0,sim\n',  # quoted comma
        "2024-01-01T10:00:02,Oslo,Norway\n",  # short row
        "2024-01-01T10:00:03,Rome,Italy,41.9,12.5,20.0,5.0,12.7,50.0,1010.0,sim\n",  # fraction in int
    ]
    land(landing, "a.csv", lines)
    rows = spark.read.schema(RECORD).option("header", True).csv(landing).orderBy("timestamp").collect()
    assert rows[0].temperature_celsius is None
    assert rows[1].city == "Washington, D.C." and rows[1].temperature_celsius == 12.0
    assert rows[2].lat is None and rows[2].source is None
    assert rows[3].wind_direction_deg is None and rows[3].temperature_celsius == 20.0


def test_reordered_header_stops_stream(spark, tmp_path):
    landing = str(tmp_path / "in")
    header = "city," + ",".join(c for c in RECORD_COLUMNS if c != "city") + "\n"
    land(landing, "a.csv", ["Paris,2024-01-01T10:00:00,France,1,1,1,1,1,1,1,s\n"], header=header)
    with pytest.raises(Exception):
        windowed_query(spark, landing, str(tmp_path / "out"), str(tmp_path / "ckpt"))


def test_windows_late_data_and_emission(spark, tmp_path):
    landing, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    # batch 0: same-batch late row (10:00:50 after 10:05:10) is kept; an empty timestamp is not aggregated
    land(landing, "1.csv", [rec("2024-01-01T10:00:30", temp=10.0), rec("2024-01-01T10:05:10", temp=30.0),
                            rec("2024-01-01T10:00:50", temp=20.0), rec("", temp=99.0)])
    land(landing, "2.csv", [rec("2024-01-01T10:06:00", temp=1.0)])
    # batch 2: 10:01:20 is behind the watermark that late rows are checked against (10:03:10) → dropped
    land(landing, "3.csv", [rec("2024-01-01T10:01:20", temp=50.0), rec("2024-01-01T10:09:00", temp=2.0)])
    q = windowed_query(spark, landing, out, ckpt, allow_late=True)
    dropped = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0) for p in q.recentProgress
                  if p.get("stateOperators"))
    assert dropped == 1
    final_state = q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]
    assert final_state == 1  # only the open 10:09 window is still held: state is bounded by the watermark
    got = spark.read.parquet(out).orderBy("window_start").collect()
    # final watermark 10:07:00 closes the 10:00, 10:05 and 10:06 windows; 10:09 stays open
    assert [(str(r.window_start), r.nb_mesures, r.temperature_moyenne) for r in got] == [
        ("2024-01-01 10:00:00", 2, 15.0),
        ("2024-01-01 10:05:00", 1, 30.0),
        ("2024-01-01 10:06:00", 1, 1.0),
    ]
    assert got[0].temp_max == 20.0 and got[0].vent_moyen_kmh == 5.0


def test_restart_same_checkpoint_no_duplicates(spark, tmp_path):
    landing, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    land(landing, "1.csv", [rec("2024-01-01T10:00:30"), rec("2024-01-01T10:04:00")])
    windowed_query(spark, landing, out, ckpt)
    first = spark.read.parquet(out).count()
    windowed_query(spark, landing, out, ckpt)  # nothing new
    assert spark.read.parquet(out).count() == first == 1
    land(landing, "2.csv", [rec("2024-01-01T10:20:00")])
    windowed_query(spark, landing, out, ckpt)
    starts = [str(r.window_start) for r in spark.read.parquet(out).orderBy("window_start").collect()]
    assert starts == ["2024-01-01 10:00:00", "2024-01-01 10:04:00"]


def test_landing_writer_feeds_stream(spark, tmp_path):
    landing, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    rows = [("2024-01-01T10:00:30", "Paris", "France", 1.0, 2.0, 10.0, 5.0, 90, 50.0, 1010.0, "s"),
            ("2024-01-01T10:10:00", "Paris", "France", 1.0, 2.0, 12.0, 5.0, 90, 50.0, 1010.0, "s")]
    land_records_csv(spark.createDataFrame(rows, RECORD), landing)
    # one writer job lands several part files in no particular order: read them as one batch
    stream = read_record_csv_stream(spark, landing, max_files_per_trigger=None)
    flat = sw.flatten_window(sw.windowed_measures(sw.enrich(stream), exact=True))
    sq.run_to_completion(sq.start_parquet_append(flat, out, ckpt, available_now=True))
    got = spark.read.parquet(out).collect()
    assert [(str(r.window_start), r.temperature_moyenne) for r in got] == [("2024-01-01 10:00:00", 10.0)]


def test_update_mode_table_and_memory_sink(spark, tmp_path):
    landing = str(tmp_path / "in")
    land(landing, "1.csv", [rec("2024-01-01T10:00:30", temp=10.0), rec("2024-01-01T10:00:40", temp=20.0)])
    land(landing, "2.csv", [rec("2024-01-01T10:00:50", temp=30.0)])
    stream = read_record_csv_stream(spark, landing, max_files_per_trigger=1)
    flat = sw.flatten_window(sw.windowed_measures(sw.enrich(stream), exact=True))
    path, ckpt = str(tmp_path / "upd"), str(tmp_path / "ckpt")
    sq.run_to_completion(sq.start_update_table(flat, path, ckpt, available_now=True))
    latest = sq.latest_updates(spark, path, ["window_start", "window_end", "city", "country"]).collect()
    assert len(latest) == 1 and latest[0].nb_mesures == 3 and latest[0].temperature_moyenne == 20.0
    q = (flat.writeStream.outputMode("update").format("memory").queryName("upd_mem")
         .option("checkpointLocation", str(tmp_path / "ckpt2")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert [r.nb_mesures for r in spark.sql("SELECT nb_mesures FROM upd_mem ORDER BY nb_mesures").collect()] == [2, 3]


def test_two_queries_one_input(spark, tmp_path):
    landing = str(tmp_path / "in")
    land(landing, "1.csv", [rec("2024-01-01T10:00:30"), rec("2024-01-01T10:05:00")])
    stream = read_record_csv_stream(spark, landing, max_files_per_trigger=1)
    windowed = sw.windowed_measures(sw.enrich(stream))
    q1 = sq.start_parquet_append(sw.to_unified(windowed), str(tmp_path / "out"), str(tmp_path / "c1"),
                                 available_now=True)
    q2 = sq.start_console_update(windowed, available_now=True, checkpoint=str(tmp_path / "c2"))
    sq.run_to_completion(q1)
    sq.run_to_completion(q2)
    sq.stop_all([q1, q2])
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(r.City, r.year, r.source) for r in got] == [("Paris", 2024, "streaming")]


def test_json_decoding_rules(spark):
    values = [
        '{"timestamp":"2024-01-01T10:00:00","city":"Paris","temperature_celsius":"hot","lat":48.8}',  # bad field
        "garbage",
        "{}",
        '{"city":"Rome","wind_direction_deg":210.0}',  # fraction-less float in an int
    ]
    df = spark.createDataFrame([(v.encode(),) for v in values], "value binary")
    rows = decode_json(df).collect()
    assert rows[0].city == "Paris" and rows[0].lat == 48.8 and rows[0].temperature_celsius is None
    assert all(v is None for v in rows[1].asDict().values())
    assert all(v is None for v in rows[2].asDict().values())
    assert rows[3].city == "Rome" and rows[3].wind_direction_deg is None


def test_kafka_shaped_rows_round_trip(spark):
    from tempora.sinks.kafka import to_kafka_rows
    from tempora.sources.stream import kafka_options

    rows = [("2024-01-01T10:00:00", "Paris", "France", 1.0, 2.0, 10.0, 5.0, 90, 50.0, 1010.0, "s")]
    kafka = to_kafka_rows(spark.createDataFrame(rows, RECORD), key="city")
    assert kafka.columns == ["key", "value"]
    back = decode_json(kafka.select(F.col("value").cast("binary").alias("value")))
    assert back.first().asDict() == dict(zip(RECORD_COLUMNS, rows[0]))
    assert kafka_options("broker:9092", "weather")["subscribe"] == "weather"


def test_quality_metrics_count_unaggregatable_rows(spark, tmp_path):
    landing = str(tmp_path / "in")
    land(landing, "1.csv", [rec("2024-01-01T10:00:30"), rec("", temp=1.0), rec("not a time"),
                            "2024-01-01T10:00:40,Paris,France,1,1,None,1,1,1,1,s\n"])
    stream = sw.with_quality_metrics(sw.enrich(read_record_csv_stream(spark, landing)))
    q = sq.start_parquet_append(sw.flatten_window(sw.windowed_measures(stream)), str(tmp_path / "o"),
                                str(tmp_path / "c"), available_now=True)
    sq.run_to_completion(q)
    metrics = [p["observedMetrics"]["record_quality"] for p in q.recentProgress if p.get("observedMetrics")]
    assert metrics[0].asDict() == {"rows": 4, "no_event_time": 2, "no_temperature": 1}


def test_json_rejects_observed(spark, tmp_path):
    from tempora.sources.stream import with_json_rejects

    src = str(tmp_path / "json")
    spark.createDataFrame([('{"city": "Paris"}',), ("garbage",), ("{}",)], "value string").write.text(src)
    stream = spark.readStream.schema("value string").text(src)
    decoded = with_json_rejects(decode_json(stream), RECORD_COLUMNS)
    q = (decoded.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c"))
         .trigger(availableNow=True).start())
    sq.run_to_completion(q)
    m = [p["observedMetrics"]["json_rejects"] for p in q.recentProgress if p.get("observedMetrics")][0]
    assert m.asDict() == {"rows": 3, "all_null": 2}


def test_a_failure_stops_all(spark, tmp_path):
    landing = str(tmp_path / "in")
    land(landing, "1.csv", [rec("2024-01-01T10:00:30")])
    w = sw.to_unified(sw.windowed_measures(sw.enrich(read_record_csv_stream(spark, landing))))

    def fail(batch, batch_id):
        raise ValueError("no")

    q1 = w.writeStream.outputMode("append").option("checkpointLocation", str(tmp_path / "c1")).foreachBatch(fail).trigger(availableNow=True).start()
    q2 = sq.start_parquet_append(w, str(tmp_path / "o2"), str(tmp_path / "c2"), processing_time="1 second")
    with pytest.raises(Exception, match="no"):
        sq.await_all([q1, q2])
    assert not q1.isActive and not q2.isActive


def test_rocksdb_state_store(spark, tmp_path):
    landing = str(tmp_path / "in")
    land(landing, "1.csv", [rec("2024-01-01T10:00:30"), rec("2024-01-01T10:09:00")])
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    sq.use_rocksdb_state(spark)
    try:
        windowed_query(spark, landing, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_batch_and_stream_agree_on_closed_windows(spark):
    from tempora.plans import catalog, tables
    from tests.conftest import SF_SMALL

    streamed = catalog.stream_windows(spark, SF_SMALL)
    ev = tables.table(spark, SF_SMALL, "events")
    batch = sw.flatten_window(sw.windowed_measures(sw.enrich(tables.events_as_records(ev)), watermark=None,
                                                   exact=True))
    horizon = ev.agg(F.max("ts")).first()[0]
    import datetime as dt
    closed = batch.filter(F.col("window_end") <= F.lit(horizon - dt.timedelta(minutes=2)))
    assert sorted(streamed.collect()) == sorted(closed.collect())


def test_compaction_keeps_every_row(spark, tmp_path):
    landing, out = str(tmp_path / "in"), str(tmp_path / "o")
    for k in range(8):
        land(landing, f"{k}.csv", [rec(f"2024-01-01T1{k}:00:30"), rec(f"2024-01-01T1{k}:09:00")])
    windowed_query(spark, landing, out, str(tmp_path / "c"))
    rows = sorted(spark.read.parquet(out).collect())
    assert len(rows) == 15  # all windows but the last are closed
    sq.compact(spark, out, str(tmp_path / "small"))
    assert sorted(spark.read.parquet(str(tmp_path / "small")).collect()) == rows == sorted(spark.read.parquet(out).collect())


def test_unexpected_late_rows_are_an_error(spark, tmp_path):
    landing = str(tmp_path / "in")
    for k, minute in enumerate((0, 30, 45, 10)):  # the last file is out of order
        land(landing, f"{k}.csv", [rec(f"2024-01-01T10:{minute:02d}:30")])
    with pytest.raises(sq.LateRows):
        windowed_query(spark, landing, str(tmp_path / "o"), str(tmp_path / "c"))


@pytest.mark.parametrize("state_partitions", [1, 2])
def test_both_sinks_drain(spark, tmp_path, state_partitions):
    from tempora import cli

    landing = str(tmp_path / "in")
    for k in range(12):
        land(landing, f"{k:02d}.csv", [rec(f"2024-01-01T10:{4 * k:02d}:30")])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    cli.main(["consumer", "--base", str(tmp_path / "u"), "--checkpoints", str(tmp_path / "c"), "--input", landing,
              "--available-now", "--state-partitions", str(state_partitions)])
    assert spark.read.parquet(str(tmp_path / "u" / "streaming")).count() == 11
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_event_stream_from_file_or_folder(spark, tmp_path):
    from tempora.plans import catalog
    from tests.conftest import SF_SMALL

    folder = str(tmp_path / "sf")
    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(8, "event_id").write.parquet(f"{folder}/events.parquet")
    a = sorted(catalog.stream_windows(spark, SF_SMALL).collect())
    b = sorted(catalog.stream_windows(spark, folder).collect())
    assert a == b and len(a) > 0
