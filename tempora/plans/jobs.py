"""End-to-end jobs: the batch job, the analysis notebook, the stream consumer
and the unified-table reader, each as a plan of library operators.

Jobs take the caller's ``spark`` and paths; nothing is collected except
one-row summaries (observation metrics, the report)."""

from __future__ import annotations

import datetime
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tempora.operators import analysis, clean, ordering, rollup, unified
from tempora.sinks import files
from tempora.sinks.report import write_report
from tempora.sources.history import read_history_csv
from tempora.sources.unified import BATCH, STREAMING, read_unified, root_of
from tempora.streaming import queries as sq
from tempora.streaming import windows as sw


def batch_job(spark: SparkSession, csv_path: str, base: str, exact: bool = False,
              rerun_years_only: bool = False, with_grain: bool = False, ordered_path: str | None = None) -> dict:
    """CSV → parse → mean per (City, Country, year) → the batch root.

    One scan of the input: explicit schema (no inference pass), and row counts
    come from an observation on the written plan. Returns those counts.
    ``ordered_path`` also writes the whole batch root in the total order
    (Country, City, year), to be read with positions (``ordering.read_ordered``)."""
    obs = Observation("batch_job")
    parsed = clean.parse_history(read_history_csv(spark, csv_path))
    metrics = clean.row_metrics()
    observed = parsed.observe(obs, *metrics)
    yearly = analysis.yearly_means(observed, exact=exact, with_grain=with_grain)
    files.write_yearly(yearly, root_of(base, BATCH), rerun_years_only)
    if ordered_path:
        ordering.write_ordered(spark.read.parquet(root_of(base, BATCH)), ordered_path, ["Country", "City", "year"])
    counts = clean.observed_counts(obs, parsed, metrics)
    counts["rows_removed"] = counts["rows_before"] - counts["rows_after"]
    return counts


OUTPUTS = {
    "clean": "temperature_cleaned_parquet",
    "by_country": "temperature_by_country",
    "by_year": "temperature_by_year",
    "hottest": "hottest_cities",
    "coldest": "coldest_cities",
    "extremes": "extreme_temperatures",
    "by_decade": "decade_trend",
    "by_month": "temperature_by_month",
    "by_period": "temperature_by_period",
    "nulls": "null_profile",
    "aggregate": "temperature_aggregate",
    "report": "etl_report",
}


DATASETS = ("clean", "by_country", "by_year", "hottest", "coldest", "extremes", "by_decade")  # those that the report counts
PIPELINE = "historical temperatures"


def run_concurrently(actions, max_workers: int = 4) -> None:
    """Submit independent Spark actions from a few driver threads so that small
    jobs (bounded summaries) share the executors instead of queueing one after
    another. Re-raises the first failure."""
    with ThreadPoolExecutor(max_workers=max_workers) as pool:
        for future in [pool.submit(a) for a in actions]:
            future.result()


def notebook_job(spark: SparkSession, csv_path: str, out_dir: str, exact: bool = False,
                 low: float = analysis.EXTREME_LOW, high: float = analysis.EXTREME_HIGH,
                 min_records: int = analysis.MIN_CITY_RECORDS) -> dict:
    """Profile, clean and analyse the historical table; write the seven datasets
    of the reference, the tables that it only prints (null profile, months,
    periods) and a one-row report (counts, statistics, run information and
    wall-clock phase durations). Returns the report as a dict.

    The raw table is read once: row counts and null profile are observed while
    the clean table is written. The clean table is read twice, for the extremes
    and for a pre-aggregate in two slices (by country, year and month, and by
    city), which is written and from which all summaries roll up. Summaries are bounded
    (countries, years, decades, top-k) and written as single files, as
    concurrent jobs."""
    t_start = time.perf_counter()
    raw = read_history_csv(spark, csv_path)
    shape = clean.table_shape(raw)
    t_extract = time.perf_counter()
    clean_df, obs = clean.observed_clean(raw, with_nulls=True)
    out = {k: f"{out_dir}/{v}" for k, v in OUTPUTS.items()}
    # Lineage is cut at written tables, and nothing the size of the input is cached.
    files.write_clean(clean_df, out["clean"])  # also fills the cleaning observation
    counts = clean.observed_counts(obs, clean.parse_history(raw), clean.row_metrics(raw.columns))
    c = spark.read.parquet(out["clean"])
    t_transform = time.perf_counter()

    def summaries() -> None:
        sets = {"calendar": ("country", "year", "month"), "city": ("city", "country")}
        files.write_partitioned(rollup.slices(c, sets, low=low, high=high), out["aggregate"], "slice")
        calendar, cities = aggregate("calendar"), rollup.city_means(aggregate("city"), min_records, exact=exact)
        run_concurrently([
            lambda: files.write_single_csv(rollup.mean_by_country(calendar, exact=exact), out["by_country"]),
            lambda: files.write_single_csv(rollup.mean_by_year(calendar, exact=exact), out["by_year"]),
            lambda: files.write_single_json(analysis.hottest(cities), out["hottest"]),
            lambda: files.write_single_json(analysis.coldest(cities), out["coldest"]),
            lambda: files.write_single_csv(rollup.mean_by_decade(calendar, exact=exact), out["by_decade"]),
            lambda: files.write_single_csv(rollup.mean_by_month(calendar, exact=exact), out["by_month"]),
            lambda: files.write_single_csv(rollup.mean_by_period(calendar, exact=exact), out["by_period"]),
        ])

    def aggregate(name: str) -> DataFrame:
        return spark.read.parquet(out["aggregate"]).where(F.col("slice") == name)

    run_concurrently([
        summaries,
        lambda: files.write_parquet(analysis.extremes(c, low, high), out["extremes"]),
        lambda: files.write_single_json(clean.observed_nulls(raw, counts), out["nulls"]),
    ])
    stats = rollup.global_stats(aggregate("calendar"), exact=exact)
    t_load = time.perf_counter()
    before, after = counts["rows_before"], counts["rows_after"]
    report = stats.select(
        F.lit(before).alias("rows_before_cleaning"),
        F.lit(after).alias("rows_after_cleaning"),
        F.lit(before - after).alias("rows_removed"),
        F.lit(len(raw.columns)).alias("columns"),
        F.col("global_mean_temperature"),
        F.round("global_min_temperature", 2).alias("global_min_temperature"),
        F.round("global_max_temperature", 2).alias("global_max_temperature"),
        F.col("extreme_observations"),
        F.lit(len(DATASETS)).alias("datasets_saved"),
        F.lit(shape["partitions"]).alias("partitions"),
        F.lit(spark.version).alias("spark_version"),
        F.lit(datetime.datetime.now(datetime.timezone.utc).isoformat()).alias("execution_date"),
        F.lit(out_dir).alias("output_directory"),
        F.array(*[F.lit(f) for f in ("parquet", "csv", "json")]).alias("formats"),
        F.lit(PIPELINE).alias("pipeline"),
        F.lit(round(t_extract - t_start, 2)).alias("extract_seconds"),
        F.lit(round(t_transform - t_extract, 2)).alias("transform_seconds"),
        F.lit(round(t_load - t_transform, 2)).alias("load_seconds"),
        F.lit(round(t_load - t_start, 2)).alias("total_seconds"),
    ).withColumn("removal_percentage", clean.half_up_percent("rows_removed", "rows_before_cleaning"))
    write_report(report, out["report"])
    return spark.read.json(out["report"]).first().asDict()


def consumer_job(stream: DataFrame, base: str, checkpoint_base: str, console: bool = True, parquet: bool = True,
                 processing_time: str = sw.TRIGGER, available_now: bool = False, window: str = sw.WINDOW,
                 watermark: str = sw.WATERMARK, state_partitions: int | None = None,
                 with_grain: bool = False) -> list:
    """Windowed measures of a record stream (CSV files, Parquet or Kafka — any
    streaming DataFrame with the record columns), written by two queries with
    their own checkpoints: console/update and Parquet/append to the streaming root.
    Rows without event time or temperature are counted per batch
    (``observedMetrics["record_quality"]``).

    ``with_grain`` also writes ``window_start`` and ``n`` with every row.
    ``state_partitions`` sets the number of state partitions for checkpoints
    created now (a checkpoint keeps its count for life, whatever the session
    says later); size it for the largest expected key set."""
    conf, key = stream.sparkSession.conf, "spark.sql.shuffle.partitions"
    before = conf.get(key)
    if state_partitions:
        conf.set(key, str(state_partitions))
    enriched = sw.with_quality_metrics(sw.enrich(stream))
    windowed = sw.windowed_measures(enriched, window, watermark)
    started = []
    try:
        if console:
            started.append(sq.start_console_update(windowed, processing_time, available_now,
                                                   checkpoint=f"{checkpoint_base}/console"))
        if parquet:
            rows = sw.to_unified(windowed, with_grain=with_grain)
            started.append(sq.start_parquet_append(rows, root_of(base, STREAMING), f"{checkpoint_base}/parquet",
                                                   processing_time, available_now, partition_by=["year"]))
    finally:  # a query keeps the session's settings of its start
        conf.set(key, before)
    return started


def reader_job(spark: SparkSession, base: str, since: int = unified.RECENT_SINCE, k: int = unified.RECENT_TOP,
               fallbacks=(), with_grain: bool = False) -> dict[str, DataFrame]:
    """The unified table's reports, as DataFrames (nothing is collected).

    ``with_grain`` adds ``weighted``: the mean per source weighted by the
    number of measurements behind each row (roots written with grain)."""
    u = read_unified(spark, base, fallbacks=fallbacks, with_grain=with_grain)
    extra = {"weighted": unified.weighted_mean_by(u, ["source"])} if with_grain else {}
    return extra | {
        "table": u,
        "stats": unified.source_stats(u),
        "distinct": unified.distinct_counts(u),
        "recent_top": unified.recent_top(u, since, k),
        "compare": unified.source_compare(u),
        "batch": unified.select_source(u, BATCH),
        "streaming": unified.select_source(u, STREAMING),
    }
