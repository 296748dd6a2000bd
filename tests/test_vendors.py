import json

from tempora.operators import vendors

CTX = "timestamp string, city string, country string, lat double, lon double, vendor string, payload string"


def frame(spark, vendor, payloads):
    rows = [("2024-01-01T10:00:00", "Paris", "France", 48.8, 2.3, vendor, json.dumps(p) if isinstance(p, dict) else p)
            for p in payloads]
    return spark.createDataFrame(rows, CTX)


def test_point_payload(spark):
    payloads = [
        {"temp-surface": [273.15], "wind_u-surface": [0.0], "wind_v-surface": [4.0], "rh-surface": [55.55],
         "pressure-surface": [101325.0]},
        {"temp-surface": [], "wind_u-surface": [0.0], "wind_v-surface": [0.0]},
        {"temp-surface": [280.0]},
    ]
    rows = vendors.normalise_point(frame(spark, "point", payloads)).collect()
    assert rows[0].temperature_celsius == 0.0 and rows[0].wind_speed_kmh == 14.4
    assert rows[0].wind_direction_deg == 180 and rows[0].pressure_hpa == 1013.3 and rows[0].humidity_percent == 55.6
    assert rows[1].temperature_celsius is None and rows[1].wind_speed_kmh == 0.0 and rows[1].wind_direction_deg == 0
    assert rows[2].wind_speed_kmh is None and rows[2].temperature_celsius == 6.85
    filled = vendors.normalise_point(frame(spark, "point", payloads[2:]), fill_zero=True).first()
    assert filled.wind_speed_kmh == 0.0 and filled.wind_direction_deg == 0


def test_current_and_main_payloads(spark):
    cur = {"current": {"temperature_2m": 0.0, "relative_humidity_2m": 0.0, "pressure_msl": 1000.0,
                       "wind_speed_10m": 3.0, "wind_direction_10m": 210.7}}
    r = vendors.normalise_current(frame(spark, "current", [cur])).first()
    assert r.temperature_celsius == 0.0 and r.humidity_percent == 0.0 and r.wind_direction_deg == 210
    main = {"main": {"temp": 12.345, "humidity": 80.0, "pressure": 1012.25}, "wind": {"speed": 2.5, "deg": 270}}
    r = vendors.normalise_main(frame(spark, "main_wind", [main, {"main": {}}])).collect()
    assert (r[0].temperature_celsius, r[0].wind_speed_kmh, r[0].wind_direction_deg, r[0].pressure_hpa) == (
        12.35, 9.0, 270, 1012.3)
    assert r[1].temperature_celsius is None and r[1].wind_speed_kmh is None
    z = vendors.normalise_main(frame(spark, "main_wind", [{"main": {}}]), fill_zero=True).first()
    assert z.temperature_celsius == 0.0 and z.wind_direction_deg == 0


def test_router_and_rejects(spark):
    rows = [("2024-01-01T10:00:00", "P", "F", None, None, v, p) for v, p in [
        ("point", json.dumps({"temp-surface": [274.15]})),
        ("current", json.dumps({"current": {"temperature_2m": 5.0}})),
        ("main_wind", json.dumps({"main": {"temp": 7.0}})),
        ("mystery", "{}"),
        (None, "{}"),
    ]]
    df = spark.createDataFrame(rows, CTX)
    got = sorted((r.source, r.temperature_celsius) for r in vendors.normalise(df).collect())
    assert got == [("current", 5.0), ("main_wind", 7.0), ("point", 1.0)]
    assert vendors.rejects(df).count() == 2


def test_both_sides_of_the_route(spark):
    """Every row is on one side, whatever its payload."""
    payloads = ['{"main": {"temp": 7.0}} ', ' \n{"main": {"temp": "8.5"}}', '{"main": {"temp": true}}', '{"main": {"temp": "x"}}', '{"main": 3}', "{}",
                '[{"main": {"temp": 1}}]', '{"main": {"temp": 1}', "garbage", "", None, '"{}"', "null", '{"main": {}, "main": {}}', "{'main': {}}"]
    rows = [("2024-01-01T10:00:00", "P", "F", None, None, v, p) for p in payloads for v in ("main_wind", None, "mystery")]
    df = spark.createDataFrame(rows, CTX)
    good = vendors.normalise(df, keep=["payload"]).collect()
    assert [r.payload for r in good] == payloads[:6] and [r.temperature_celsius for r in good] == [7.0, 8.5, 1.0, None, None, None]
    bad = vendors.rejects(df)
    assert bad.columns == df.columns and bad.count() == len(rows) - len(good)
    assert sorted((r.payload for r in bad.where("vendor = 'main_wind'").collect()), key=str) == sorted(payloads[6:], key=str)


def test_one_parse(spark):
    """Neither side parses a payload twice, or builds it twice."""
    from pyspark.sql import functions as F

    df = frame(spark, "point", ["{}"] * 3).withColumn("payload", F.to_json(F.struct(F.col("city").alias("temp-surface"))))
    for side in (vendors.normalise(df), vendors.rejects(df), vendors.normalise_point(df)):
        plan = side._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parseJson(") == 1 and plan.count("StructsToJsonEvaluator(") == 1, plan


def test_normalise_on_a_stream(spark, tmp_path):
    from pyspark.sql import functions as F

    src = str(tmp_path / "payloads")
    spark.createDataFrame([(json.dumps({"temp-surface": [274.15]}),)], "value string").write.text(src)
    stream = spark.readStream.schema("value string").text(src).select(
        F.lit("2024-01-01T10:00:00").alias("timestamp"), F.lit("Paris").alias("city"), F.lit("France").alias("country"),
        F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"),
        F.lit("point").alias("vendor"), F.col("value").alias("payload"))
    out = vendors.normalise(stream)
    q = (out.writeStream.format("memory").queryName("norm_stream").option("checkpointLocation", str(tmp_path / "c"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert [r.temperature_celsius for r in spark.sql("SELECT * FROM norm_stream").collect()] == [1.0]
