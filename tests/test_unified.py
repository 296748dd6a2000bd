from pyspark.sql import functions as F

from tempora.operators import unified as U
from tempora.schemas import UNIFIED
from tempora.sinks.files import write_yearly
from tempora.sources.unified import read_unified


def batch_rows(spark):
    rows = [("Paris", "France", 2010, 11.0, "batch"), ("Paris", "France", 2011, 12.0, "batch"),
            ("Oslo", "Norway", 2009, 2.0, "batch")]
    return spark.createDataFrame(rows, UNIFIED)


def stream_rows(spark):
    return spark.createDataFrame([("Paris", "France", 2024, 14.0, "streaming")], UNIFIED)


def test_batch_before_and_after_stream_both_visible(spark, tmp_path):
    base = str(tmp_path / "u")
    write_yearly(batch_rows(spark), f"{base}/batch")
    stream_rows(spark).write.parquet(f"{base}/streaming")
    assert sorted(r.source for r in U.distinct_values(read_unified(spark, base)).collect()) == ["batch", "streaming"]
    write_yearly(batch_rows(spark), f"{base}/batch")  # batch again, after the stream
    u = read_unified(spark, base)
    assert u.count() == 4  # a rerun replaces, never duplicates
    stats = {r.source: (r.nb_lignes, r.annee_min, r.annee_max) for r in U.source_stats(u).collect()}
    assert stats == {"batch": (3, 2009, 2011), "streaming": (1, 2024, 2024)}


def test_dynamic_rerun_of_some_years(spark, tmp_path):
    base = str(tmp_path / "u")
    write_yearly(batch_rows(spark), f"{base}/batch")
    redo = spark.createDataFrame([("Paris", "France", 2011, 99.0, "batch")], UNIFIED)
    write_yearly(redo, f"{base}/batch", rerun_years_only=True)
    got = sorted((r.year, r.temperature_moyenne) for r in read_unified(spark, base).collect())
    assert got == [(2009, 2.0), (2010, 11.0), (2011, 99.0)]


def test_missing_roots_and_fallback(spark, tmp_path):
    empty = read_unified(spark, str(tmp_path / "none"))
    assert empty.count() == 0 and empty.schema == UNIFIED
    old = str(tmp_path / "old")
    stream_rows(spark).write.parquet(f"{old}/streaming")
    assert read_unified(spark, str(tmp_path / "none"), fallbacks=[old]).count() == 1


def test_reports(spark):
    u = batch_rows(spark).unionByName(stream_rows(spark))
    top = U.recent_top(u, since=2010, k=5).collect()
    assert [(r.City, r.temp_moy) for r in top] == [("Paris", 37.0 / 3)]
    d = U.distinct_counts(u).first()
    assert (d.nb_villes, d.nb_pays) == (2, 2)
    assert U.source_compare(batch_rows(spark)).count() == 0  # one source: no comparison
    cmp = {r.source: r.nb_enregistrements for r in U.source_compare(u).collect()}
    assert cmp == {"batch": 3, "streaming": 1}
    assert U.select_source(u, "streaming").count() == 1
    approx = U.distinct_counts(u, approx=True).first()
    assert approx.nb_villes == 2
    w = U.weighted_mean_by(u.withColumn("n", F.lit(2)), ["City"]).filter("City = 'Oslo'").first()
    assert w.temp_moy_ponderee == 2.0


def test_total_order_before_write(spark):
    from tempora.sinks.files import ordered

    df = batch_rows(spark).unionByName(stream_rows(spark))
    rows = [(r.Country, r.City, r.year) for r in ordered(df).collect()]
    assert rows == sorted(rows)


def test_emptied_batch_root_is_an_error(spark, tmp_path):
    import pytest

    base = str(tmp_path / "u")
    stream_rows(spark).write.parquet(f"{base}/streaming")
    (tmp_path / "u" / "batch").mkdir()
    with pytest.raises(Exception, match="UNABLE_TO_INFER_SCHEMA"):
        read_unified(spark, base)
