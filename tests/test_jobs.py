import os

from pyspark.sql import functions as F

from tempora.plans import jobs
from tempora.sinks import files
from tempora.sources.stream import read_record_csv_stream
from tempora.streaming import queries as sq
from tests.conftest import write_text
from tests.test_clean import HEADER, ROWS
from tests.test_stream import HEADER as REC_HEADER
from tests.test_stream import rec


def history_csv(tmp_path):
    path = write_text(str(tmp_path / "hist" / "part.csv"), HEADER + "\n".join(ROWS) + "\n")
    return os.path.dirname(path)


def test_batch_job_counts_and_rerun(spark, tmp_path):
    csv, base = history_csv(tmp_path), str(tmp_path / "u")
    counts = jobs.batch_job(spark, csv, base)
    assert counts == {"rows_before": 10, "rows_after": 5, "rows_removed": 5}
    first = sorted(spark.read.parquet(f"{base}/batch").collect())
    jobs.batch_job(spark, csv, base)
    assert sorted(spark.read.parquet(f"{base}/batch").collect()) == first
    # avg(40, 40.01) is 40.004999... in doubles: the reference formula gives 40.0, the exact form 40.01
    assert {(r.City, r.year, r.temperature_moyenne) for r in first} == {
        ("Paris", 1900, 11.5), ("Oslo", 1950, -20.0), ("Dubai", 2000, 40.0)}
    jobs.batch_job(spark, csv, base, exact=True)
    exact = {r.City: r.temperature_moyenne for r in spark.read.parquet(f"{base}/batch").collect()}
    assert exact["Dubai"] == 40.01


def test_notebook_job_writes_datasets_and_report(spark, tmp_path):
    out = str(tmp_path / "out")
    report = jobs.notebook_job(spark, history_csv(tmp_path), out, min_records=0)
    assert report["rows_before_cleaning"] == 10 and report["rows_after_cleaning"] == 5
    assert report["removal_percentage"] == 50.0 and report["extreme_observations"] == 1
    assert report["datasets_saved"] == 7
    assert spark.read.parquet(f"{out}/temperature_cleaned_parquet").count() == 5
    assert spark.read.json(f"{out}/hottest_cities").first().city == "Dubai"
    assert spark.read.json(f"{out}/coldest_cities").first().city == "Oslo"
    assert len([f for f in os.listdir(f"{out}/decade_trend") if f.endswith(".csv")]) == 1


def test_notebook_job_reports_more_rows_than_int_products_hold(spark, tmp_path):
    n, bad = 130_000, 108_000  # 2 * 108,000 * 10,000 is more than an int holds
    csv, out = str(tmp_path / "many"), str(tmp_path / "out")
    i = F.col("id")
    raw = spark.range(n).select(
        F.when(i < bad, F.lit("not-a-date")).otherwise(F.lit("2001-05-06")).alias("dt"), (i % 7).alias("AverageTemperature"),
        F.lit(None).cast("double").alias("AverageTemperatureUncertainty"), F.lit("Oslo").alias("City"), F.lit("Norway").alias("Country"),
        F.lit("59N").alias("Latitude"), F.lit("10E").alias("Longitude"))
    files.write_history_csv(raw, csv)
    report = jobs.notebook_job(spark, csv, out, exact=True)
    assert (report["rows_before_cleaning"], report["rows_after_cleaning"], report["rows_removed"]) == (n, n - bad, bad)
    assert report["removal_percentage"] == 83.08  # 83.0769...
    assert spark.read.parquet(f"{out}/temperature_cleaned_parquet").count() == n - bad


def test_consumer_and_reader(spark, tmp_path):
    landing = str(tmp_path / "in")
    write_text(f"{landing}/1.csv", REC_HEADER + rec("2024-01-01T10:00:30") + rec("2024-01-01T10:05:00"))
    base = str(tmp_path / "u")
    started = jobs.consumer_job(read_record_csv_stream(spark, landing), base, str(tmp_path / "ckpt"),
                                available_now=True)
    for q in started:
        sq.run_to_completion(q)
    jobs.batch_job(spark, history_csv(tmp_path), base)
    r = jobs.reader_job(spark, base, since=1900)
    assert {x.source: x.nb_lignes for x in r["stats"].collect()} == {"batch": 3, "streaming": 1}
    assert r["compare"].count() == 2 and r["streaming"].count() == 1


def test_grain_carried_to_weighted_means(spark, tmp_path):
    landing = str(tmp_path / "in")
    write_text(f"{landing}/1.csv", REC_HEADER + rec("2024-01-01T10:00:10", temp=10.0) + rec("2024-01-01T10:00:20", temp=20.0)
               + rec("2024-01-01T10:00:30", temp=30.0) + rec("2024-01-01T10:01:10", temp=100.0)
               + rec("2024-01-01T10:09:00", temp=0.0))
    base = str(tmp_path / "u")
    for q in jobs.consumer_job(read_record_csv_stream(spark, landing), base, str(tmp_path / "ckpt"),
                               console=False, available_now=True, with_grain=True):
        sq.run_to_completion(q)
    jobs.batch_job(spark, history_csv(tmp_path), base, with_grain=True)
    r = jobs.reader_job(spark, base, since=1900, with_grain=True)
    weighted = {x.source: x.temp_moy_ponderee for x in r["weighted"].collect()}
    # streaming: windows (3 rows, mean 20) and (1 row, 100) → (3·20 + 100) / 4 = 40, the mean of the 4 raw rows
    assert weighted["streaming"] == 40.0
    plain = {x.source: x.temp_moyenne_globale for x in r["compare"].collect()}
    assert plain["streaming"] == 60.0  # the reference's unweighted mean of means
    assert r["table"].columns[-2:] == ["window_start", "n"]
