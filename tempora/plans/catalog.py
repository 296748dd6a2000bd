"""Query catalog: each entry takes ``(spark, sf_dir)`` and returns a DataFrame.

Every entry reads whole driver tables (or tables Spark derives from them and
writes under the shared folder). Means use the exact decimal form so that the
SQL oracle can match them to the cent; ranking cuts carry key tiebreaks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempora.operators import analysis, clean, ordering, rollup, series, sketches, unified, vendors
from tempora.operators.partitioning import spread
from tempora.plans import jobs, tables
from tempora.session import scratch_path
from tempora.sinks import files, landing, versions
from tempora.sinks.report import run_report as build_report
from tempora.sources.stream import decode_json, read_parquet_stream, read_record_csv_stream
from tempora.sources.unified import BATCH, STREAMING, read_unified, root_of
from tempora.streaming import accounting
from tempora.streaming import queries as sq
from tempora.streaming import windows as sw

# Parameters of the driver-table queries.
ORDER_PERIODS = [(1996, 1998, "1996-1997"), (1998, 2000, "1998-1999"), (2000, None, "2000+")]
LINE_MIN_RECORDS = 10
EVENT_LOW = 0.1
EVENT_HIGH = 200.0
ORDER_LOW = 5000.0
ORDER_HIGH = 495000.0
RECENT_SINCE = 2000
EVOLUTION_WINDOW = "1 day"
STREAM_FILES = 4  # files of a landing at least (more where its size needs them), one micro-batch each


# ---------------------------------------------------------------- historical

def _clean_orders(spark, sf_dir, faults=False) -> DataFrame:
    return clean.clean_history(tables.history_from_orders(spark, sf_dir, faults))


def _clean_lineitem(spark, sf_dir) -> DataFrame:
    return clean.clean_history(tables.history_from_lineitem(spark, sf_dir))


def _clean_events(spark, sf_dir) -> DataFrame:
    return clean.clean_history(tables.history_from_events(spark, sf_dir))


def null_profile(spark, sf_dir):
    return clean.null_profile(tables.history_from_orders(spark, sf_dir, faults=True))


def clean_counts(spark, sf_dir):
    return clean.clean_counts(tables.history_from_orders(spark, sf_dir, faults=True))


def clean_rows(spark, sf_dir):
    return _clean_orders(spark, sf_dir, faults=True)


def mean_by_country(spark, sf_dir):
    return analysis.mean_by_country(_clean_lineitem(spark, sf_dir), exact=True)


def mean_by_country_many(spark, sf_dir):
    """Suppliers as countries: more groups than the ten that are reported."""
    raw = tables.history_from_lineitem(spark, sf_dir, country="l_suppkey")
    return analysis.mean_by_country(clean.clean_history(raw), exact=True)


def mean_by_country_ref(spark, sf_dir):
    """With the reference's own mean, round(avg, 2)."""
    return analysis.mean_by_country(_clean_lineitem(spark, sf_dir))


def mean_by_year(spark, sf_dir):
    return analysis.mean_by_year(_clean_orders(spark, sf_dir), exact=True)


def mean_by_year_ref(spark, sf_dir):
    """With the reference's own mean, round(avg, 2)."""
    return analysis.mean_by_year(_clean_orders(spark, sf_dir))


def _mean_by_year_month(spark, sf_dir):
    """Year and month in the place of the year: more groups than are reported."""
    months = _clean_orders(spark, sf_dir).withColumn("year", F.col("year") * 100 + F.col("month"))
    return analysis.mean_by_year(months, exact=True)


def first_months(spark, sf_dir):
    return analysis.first_years(_mean_by_year_month(spark, sf_dir))


def last_months(spark, sf_dir):
    return analysis.last_years(_mean_by_year_month(spark, sf_dir))


def first_years(spark, sf_dir):
    return analysis.first_years(mean_by_year(spark, sf_dir))


def last_years(spark, sf_dir):
    return analysis.last_years(mean_by_year(spark, sf_dir))


def _line_city_means(spark, sf_dir):
    return analysis.city_means(_clean_lineitem(spark, sf_dir), min_records=LINE_MIN_RECORDS, exact=True)


def hottest(spark, sf_dir):
    return analysis.hottest(_line_city_means(spark, sf_dir))


def coldest(spark, sf_dir):
    return analysis.coldest(_line_city_means(spark, sf_dir))


def _supplier_city_means(spark, sf_dir):
    """Suppliers as cities, with the reference's own threshold (more than 100 rows)."""
    raw = tables.history_from_lineitem(spark, sf_dir, city="l_suppkey")
    return analysis.city_means(clean.clean_history(raw), exact=True)


def hottest_ref(spark, sf_dir):
    return analysis.hottest(_supplier_city_means(spark, sf_dir))


def coldest_ref(spark, sf_dir):
    return analysis.coldest(_supplier_city_means(spark, sf_dir))


def mean_by_month(spark, sf_dir):
    return analysis.mean_by_month(_clean_orders(spark, sf_dir), exact=True)


def global_stats(spark, sf_dir):
    return analysis.global_stats(_clean_events(spark, sf_dir), EVENT_LOW, EVENT_HIGH, exact=True)


def global_stats_ref(spark, sf_dir):
    """Global stats with the reference's own extreme bounds (strictly below -20 or above 40)."""
    return analysis.global_stats(_clean_events(spark, sf_dir), exact=True)


def extremes(spark, sf_dir):
    return analysis.extremes(_clean_events(spark, sf_dir), EVENT_LOW, EVENT_HIGH)


def extremes_high(spark, sf_dir):
    return analysis.extremes_high(_clean_events(spark, sf_dir), 10, EVENT_LOW, EVENT_HIGH)


def extremes_low(spark, sf_dir):
    return analysis.extremes_low(_clean_events(spark, sf_dir), 10, EVENT_LOW, EVENT_HIGH)


def mean_by_period(spark, sf_dir):
    return analysis.mean_by_period(_clean_orders(spark, sf_dir), ORDER_PERIODS, exact=True)


def mean_by_period_ref(spark, sf_dir):
    """The reference's own three periods (1900-1949, 1950-1999, 2000+) over orders."""
    return analysis.mean_by_period(_clean_orders(spark, sf_dir), exact=True)


def mean_by_decade(spark, sf_dir):
    return analysis.mean_by_decade(_clean_orders(spark, sf_dir), exact=True)


def yearly_mean(spark, sf_dir):
    parsed = clean.parse_history(tables.history_from_orders(spark, sf_dir))
    return analysis.yearly_means(parsed, exact=True)


def run_report(spark, sf_dir):
    raw = tables.history_from_orders(spark, sf_dir, faults=True)
    return build_report(raw, ORDER_LOW, ORDER_HIGH, exact=True)


def _landed_orders_csv(spark, sf_dir) -> str:
    """Orders (with injected defects) landed as header CSV text under the shared folder."""
    where = scratch_path(spark, "history-csv")
    files.write_history_csv(spread(tables.history_from_orders(spark, sf_dir, faults=True)), where)
    return where


def batch_job_csv(spark, sf_dir):
    """The batch job end to end: CSV scan (explicit schema) → clean → yearly means → batch root."""
    base = scratch_path(spark, "batch-job")
    jobs.batch_job(spark, _landed_orders_csv(spark, sf_dir), base, exact=True)
    return spark.read.parquet(root_of(base, BATCH))


def batch_ordered(spark, sf_dir):
    """The batch job's result in total order, with positions."""
    base = scratch_path(spark, "batch-ordered")
    jobs.batch_job(spark, _landed_orders_csv(spark, sf_dir), base, exact=True, ordered_path=f"{base}/ordered")
    return ordering.read_ordered(spark, f"{base}/ordered")


RERUN_YEAR = 1997


def batch_rerun(spark, sf_dir):
    """The batch job over all orders, then again over one year, whose orders with
    an odd key are gone by then: that year is replaced, the others stay."""
    base, whole, part = (scratch_path(spark, f"batch-rerun{x}") for x in ("", "-all", "-year"))
    orders = tables.history_from_orders(spark, sf_dir).withColumn("dt", F.date_format("dt", "yyyy-MM-dd"))
    files.write_history_csv(orders, whole)
    files.write_history_csv(orders.where((F.col("Longitude").cast("long") % 2 == 0) & F.col("dt").startswith(str(RERUN_YEAR))), part)
    jobs.batch_job(spark, whole, base, exact=True)
    jobs.batch_job(spark, part, base, exact=True, rerun_years_only=True)
    return spark.read.parquet(root_of(base, BATCH))


REPORT_FIELDS = ["rows_before_cleaning", "rows_after_cleaning", "rows_removed", "columns", "removal_percentage",
                 "global_mean_temperature", "global_min_temperature", "global_max_temperature",
                 "extreme_observations", "datasets_saved"]


def notebook_report(spark, sf_dir):
    """The analysis notebook end to end (clean, cache, seven datasets, report);
    returns the report's deterministic fields."""
    out = scratch_path(spark, "notebook")
    jobs.notebook_job(spark, _landed_orders_csv(spark, sf_dir), out, exact=True, low=ORDER_LOW, high=ORDER_HIGH,
                      min_records=LINE_MIN_RECORDS)
    return spark.read.json(f"{out}/{jobs.OUTPUTS['report']}").select(*REPORT_FIELDS)


def preaggregate(spark, sf_dir):
    """The pre-aggregate by city, country, year and month: counts, means and extremes of each."""
    pre = rollup.preaggregate(_clean_lineitem(spark, sf_dir))
    return pre.select(*rollup.KEYS, F.col("n_rows").alias("num_records"), rollup.mean_of("temperature", exact=True).alias("avg_temperature"),
                      rollup.mean_of("uncertainty", exact=True).alias("avg_uncertainty"), "temperature_min", "temperature_max")


def _incremental(spark, sf_dir) -> DataFrame:
    """The pre-aggregate of orders, built year by year; every increment comes twice."""
    root = scratch_path(spark, "aggregate")
    c = _clean_orders(spark, sf_dir)
    lo, hi = c.agg(F.min("year"), F.max("year")).first()
    for year in range(lo, hi + 1) if lo is not None else []:
        for _ in range(2):
            rollup.apply_increment(spark, root, rollup.preaggregate(c.where(F.col("year") == year), low=ORDER_LOW, high=ORDER_HIGH), str(year))
    return versions.read_current(spark, root) if lo is not None else rollup.preaggregate(c)


def rollup_incremental(spark, sf_dir):
    """Yearly means of every city, rolled up from increments."""
    return rollup.yearly_means(_incremental(spark, sf_dir), exact=True, with_grain=True)


def rollup_summaries(spark, sf_dir):
    """All bounded summaries from one pre-aggregate, as (summary, key, mean, rows)."""
    path = scratch_path(spark, "aggregate")
    files.write_parquet(rollup.preaggregate(_clean_orders(spark, sf_dir), low=ORDER_LOW, high=ORDER_HIGH), path)
    pre = spark.read.parquet(path)
    parts = {
        "country": rollup.means(pre, ["country"], exact=True), "year": rollup.mean_by_year(pre, exact=True),
        "month": rollup.mean_by_month(pre, exact=True), "decade": rollup.mean_by_decade(pre, exact=True),
        "period": rollup.mean_by_period(pre, ORDER_PERIODS, exact=True),
    }
    rows = [df.select(F.lit(name).alias("summary"), F.col(name).cast("string").alias("key"), "avg_temperature", "num_records") for name, df in parts.items()]
    stats = rollup.global_stats(pre, exact=True)
    rows.append(stats.select(F.lit("extreme").alias("summary"), F.lit("all").alias("key"), F.col("global_mean_temperature").alias("avg_temperature"), F.col("extreme_observations").alias("num_records")))
    out = rows[0]
    for df in rows[1:]:
        out = out.unionByName(df)
    return out


# ------------------------------------------------------------------ streaming

def _events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` landed as Parquet files in event-time order, as many as its size
    needs, and read as a file stream, a few files per micro-batch. (Streamed as
    they are, files in no order would have to be one micro-batch.)"""
    events, where = _events(spark, sf_dir), scratch_path(spark, "events")
    staged = landing.stage_in_order(events, f"{where}-staged", by="ts", as_parquet=True)
    landing.publish(spark, staged, where)
    return read_parquet_stream(spark, where, events.schema, max_files_per_trigger=STREAM_FILES)


def _event_windows(spark, sf_dir) -> DataFrame:
    records = tables.events_as_records(_events_stream(spark, sf_dir))
    return sw.windowed_measures(sw.enrich(records), exact=True)


def _run_append(spark, df: DataFrame, name: str, allow_late: bool = False) -> str:
    out = scratch_path(spark, f"{name}-out")
    ckpt = scratch_path(spark, f"{name}-ckpt")
    sq.run_to_completion(sq.start_parquet_append(df, out, ckpt, available_now=True), allow_late=allow_late)
    return out


def _stage(spark, records: DataFrame, least: int = STREAM_FILES) -> list[str]:
    """Records staged as CSV files in event-time order, ``least`` at least."""
    return landing.stage_in_order(records, scratch_path(spark, "staging"), least=least)


def _land(spark, records: DataFrame) -> str:
    where = scratch_path(spark, "landing")
    landing.publish(spark, _stage(spark, records), where)
    return where


def _landed_windows(spark, where: str, exact: bool = True) -> DataFrame:
    """Windows of a landing folder, read one file per trigger as the reference does."""
    return sw.flatten_window(sw.windowed_measures(sw.enrich(read_record_csv_stream(spark, where)), exact=exact))


def stream_windows(spark, sf_dir):
    out = _run_append(spark, sw.flatten_window(_event_windows(spark, sf_dir)), "stream-windows")
    return spark.read.parquet(out)


def _event_records(spark, sf_dir) -> DataFrame:
    return tables.events_as_records(_events(spark, sf_dir))


def stream_csv_windows(spark, sf_dir):
    """Events landed as CSV record files in event-time order, then read back as
    a CSV file stream, one file per trigger."""
    where = _land(spark, _event_records(spark, sf_dir))
    return spark.read.parquet(_run_append(spark, _landed_windows(spark, where), "stream-csv"))


def _land_late(spark, sf_dir) -> str:
    """Every tenth event of the first quarter of the time range is landed after all others."""
    events = _events(spark, sf_dir)
    at = F.unix_seconds(F.col("ts").cast("timestamp"))
    lo, hi = events.agg(F.min(at), F.max(at)).first()
    held = F.lit(False)
    if lo is not None:
        first = (at - F.lit(lo)) * F.lit(4) / F.lit(max(1, hi - lo + 1)) < 1
        held = F.coalesce((F.col("event_id") % 10 == 0) & first, F.lit(False))
    events = events.withColumn("_held", held)
    where = scratch_path(spark, "landing")
    for late, least in ((False, STREAM_FILES), (True, 1)):
        rows = tables.events_as_records(events.where(F.col("_held") == late))
        landing.publish(spark, _stage(spark, rows, least), where)
    return where


def _late_run(spark, sf_dir) -> tuple[str, str]:
    """Output and checkpoint of a stream whose last files come behind the watermark."""
    out, ckpt = (scratch_path(spark, f"stream-late-{x}") for x in ("out", "ckpt"))
    windows = _landed_windows(spark, _land_late(spark, sf_dir))
    sq.run_to_completion(sq.start_parquet_append(windows, out, ckpt, available_now=True), allow_late=True)
    return out, ckpt


def stream_late(spark, sf_dir):
    """Rows that come behind the watermark are dropped."""
    return spark.read.parquet(_late_run(spark, sf_dir)[0])


def stream_late_account(spark, sf_dir):
    """The account kept beside the checkpoint of that stream: rows read, groups
    (window and keys within a batch) dropped, and whether every batch was counted."""
    account = accounting.account(spark, _late_run(spark, sf_dir)[1])
    columns = "n_read long, groups_dropped long, complete boolean"
    return spark.createDataFrame([(account.rows, account.dropped, account.complete)], columns)


def stream_null_time(spark, sf_dir):
    """Every ninth event has no time: it belongs to no window."""
    events = _events(spark, sf_dir).withColumn("ts", F.when(F.col("event_id") % 9 != 0, F.col("ts")))
    where = _land(spark, tables.events_as_records(events))
    return spark.read.parquet(_run_append(spark, _landed_windows(spark, where), "stream-null-time"))


def stream_restart(spark, sf_dir):
    """The stream is run on half of the landed files, then started again with
    the same checkpoint on all of them: as if it had never stopped."""
    where, out, ckpt = (scratch_path(spark, f"restart-{x}") for x in ("in", "out", "ckpt"))
    staged = _stage(spark, _event_records(spark, sf_dir))
    half = len(staged) // 2
    for part in (staged[:half], staged[half:]):
        landing.publish(spark, part, where)
        sq.run_to_completion(sq.start_parquet_append(_landed_windows(spark, where), out, ckpt, available_now=True))
    return spark.read.parquet(out)


def stream_trigger(spark, sf_dir):
    """A processing-time trigger, one file each: run until every file and the
    batch that closes the last windows have been processed, then stopped."""
    staged, where = _stage(spark, _event_records(spark, sf_dir)), scratch_path(spark, "landing")
    landing.publish(spark, staged, where)
    out, ckpt = (scratch_path(spark, f"stream-trigger-{x}") for x in ("out", "ckpt"))
    query = sq.start_parquet_append(_landed_windows(spark, where), out, ckpt, processing_time="200 milliseconds")
    sq.run_batches(query, len(staged) + 1)
    return spark.read.parquet(out)


WINDOW_KEYS = ["window_start", "window_end", "city", "country"]


def stream_update_batches(spark, sf_dir):
    """Update mode over several micro-batches, folded and compacted: the latest
    figures of every window, open ones included."""
    where = _land(spark, _event_records(spark, sf_dir))
    path, ckpt, small = (scratch_path(spark, f"update-batches-{x}") for x in ("out", "ckpt", "compact"))
    sq.run_to_completion(sq.start_update_table(_landed_windows(spark, where), path, ckpt, available_now=True))
    sq.compact_updates(spark, path, small, WINDOW_KEYS)
    return sq.latest_updates(spark, small, WINDOW_KEYS)


def stream_two_queries(spark, sf_dir):
    """One landing feeds two queries at once, each with its own checkpoint: update
    mode into an update table, append mode into Parquet. Every window of the
    first, whether the second has closed it, and whether both agree on it."""
    where = _land(spark, _event_records(spark, sf_dir))
    updates, closed = (scratch_path(spark, f"two-queries-{x}") for x in ("updates", "closed"))
    windows = _landed_windows(spark, where)
    sq.await_all([
        sq.start_update_table(windows, updates, f"{updates}-ckpt", available_now=True),
        sq.start_parquet_append(windows, closed, f"{closed}-ckpt", available_now=True),
    ], allow_late=False)
    measures = ["nb_mesures", "temperature_moyenne", "temp_max", "temp_min", "vent_moyen_kmh", "humidite_moyenne", "pression_moyenne"]
    open_too = sq.latest_updates(spark, updates, WINDOW_KEYS).select(*WINDOW_KEYS, F.struct(*measures).alias("updated"))
    emitted = spark.read.parquet(closed).select(*WINDOW_KEYS, F.struct(*measures).alias("emitted"))
    both = open_too.join(emitted, WINDOW_KEYS, "full")
    agree = F.col("emitted").isNull() | F.col("emitted").eqNullSafe(F.col("updated"))
    return both.select(*WINDOW_KEYS, "updated.nb_mesures", "updated.temperature_moyenne",
                       F.col("emitted").isNotNull().alias("closed"), agree.alias("agree"))


def stream_lateness(spark, sf_dir):
    """Processing time kept in the output: the distribution of each batch's
    lateness. It depends on the clock; what must hold on any day is returned:
    one processing time for a batch, later for each batch, and a lateness that
    spans the batch's event times."""
    where = _land(spark, _event_records(spark, sf_dir))
    path = scratch_path(spark, "lateness")
    stream = sw.enrich(read_record_csv_stream(spark, where))
    sq.run_to_completion(sq.start_lateness_table(stream, path, f"{path}-ckpt", available_now=True))
    found = spark.read.parquet(path)
    spans = F.col("greatest_us") - F.col("least_us") == F.unix_micros("last_event") - F.unix_micros("first_event")
    ordered = (F.col("least_us") <= F.col("shares_us")[0]) & (F.col("shares_us")[2] <= F.col("greatest_us"))
    return found.agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("no_event_time").alias("no_event_time"),
        (F.count(F.lit(1)) >= STREAM_FILES).alias("several_batches"),
        F.bool_and("one_clock").alias("one_clock_per_batch"),
        (F.count_distinct("processing_time") == F.count(F.lit(1))).alias("clock_of_each_batch"),
        F.bool_and(spans & ordered).alias("spans_the_events"),
    )


def stream_compacted(spark, sf_dir):
    """A stream whose output is compacted halfway and goes on: its rows are read
    through the compacted version and the files since."""
    where, out, ckpt, small = (scratch_path(spark, f"compacted-{x}") for x in ("in", "out", "ckpt", "small"))
    staged = _stage(spark, _event_records(spark, sf_dir))
    half = len(staged) // 2
    for part in (staged[:half], staged[half:]):
        landing.publish(spark, part, where)
        sq.run_to_completion(sq.start_parquet_append(_landed_windows(spark, where), out, ckpt, available_now=True))
        if part and versions.current(spark, small) is None:
            versions.compact_stream(spark, out, small)
    return versions.read_compacted(spark, out, small)


def _expiring(spark, sf_dir, of, name: str) -> DataFrame:
    """The update table of ``of`` over events landed in order, a file per batch."""
    events = _events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    where, path = (scratch_path(spark, f"{name}-{x}") for x in ("in", "out"))
    landing.publish(spark, landing.stage_in_order(events, f"{where}-staged", least=STREAM_FILES, by="ts", as_parquet=True), where)
    stream = read_parquet_stream(spark, where, events.schema, max_files_per_trigger=1)
    sq.run_to_completion(sq.start_update_table(of(stream), path, f"{path}-ckpt", available_now=True))
    return spark.read.option("basePath", path).parquet(path)


def stream_latest_expiring(spark, sf_dir):
    """Latest event per user from a stream whose state expires, span by span."""
    updates = _expiring(spark, sf_dir, lambda s: series.latest_in_spans(s, ["user_id"], "ts"), "latest-expiring")
    latest = series.fold_latest(updates.drop("batch_id", "_batch_id"), ["user_id"], "ts")
    return latest.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def stream_stats_expiring(spark, sf_dir):
    """Mean, max, min and count per event type from a stream whose state expires:
    the last update of each span, added up."""
    updates = _expiring(spark, sf_dir, lambda s: series.stats_in_spans(s, ["event_type"], "ts", "value"), "stats-expiring")
    values = [c for c in updates.columns if c not in ("span", "event_type", "batch_id", "_batch_id")]
    last = updates.groupBy("span", "event_type").agg(F.max_by(F.struct(*values), "_batch_id").alias("v")).select("span", "event_type", "v.*")
    return series.fold_stats(last, ["event_type"], "value", exact=True)


def stream_unified(spark, sf_dir):
    out = _run_append(spark, sw.to_unified(_event_windows(spark, sf_dir)), "stream-unified")
    return spark.read.parquet(out)


def stream_update(spark, sf_dir):
    path = scratch_path(spark, "stream-update-out")
    ckpt = scratch_path(spark, "stream-update-ckpt")
    flat = sw.flatten_window(_event_windows(spark, sf_dir))
    sq.run_to_completion(sq.start_update_table(flat, path, ckpt, available_now=True))
    return sq.latest_updates(spark, path, WINDOW_KEYS)


def stream_latest_per_key(spark, sf_dir):
    """Latest event per user maintained by a stream (update mode, one state row
    per key), folded back from the update table."""
    latest = series.latest_per_key(_events_stream(spark, sf_dir), ["user_id"], "ts")
    path = scratch_path(spark, "stream-latest-out")
    ckpt = scratch_path(spark, "stream-latest-ckpt")
    sq.run_to_completion(sq.start_update_table(latest, path, ckpt, available_now=True))
    return sq.latest_updates(spark, path, ["user_id"])


def stream_stats_per_key(spark, sf_dir):
    """Mean (2 dp, exact), max, min and count per event type maintained by a
    stream (update mode), folded back from the update table."""
    stats = series.stats_per_key(_events_stream(spark, sf_dir), ["event_type"], "value", exact=True)
    path = scratch_path(spark, "stream-stats-out")
    ckpt = scratch_path(spark, "stream-stats-ckpt")
    sq.run_to_completion(sq.start_update_table(stats, path, ckpt, available_now=True))
    return sq.latest_updates(spark, path, ["event_type"])


# -------------------------------------------------------------------- unified

# The unified roots (batch yearly means + the stream's rows) are built once per
# Spark application and state of the source files (names, sizes, times), then
# shared by the queries that report on them. They are written tables under the
# shared folder, so every report reads durable data rather than recomputing the
# stream.
_UNIFIED_BASES: dict[tuple, str] = {}


def build_unified(spark: SparkSession, sf_dir: str) -> str:
    """Write batch yearly means and the stream's unified rows to two roots."""
    base = scratch_path(spark, "unified")
    files.write_yearly(yearly_mean(spark, sf_dir), root_of(base, BATCH))
    ckpt = scratch_path(spark, "unified-stream-ckpt")
    stream = sw.to_unified(_event_windows(spark, sf_dir))
    sq.run_to_completion(sq.start_parquet_append(stream, root_of(base, STREAMING), ckpt, available_now=True,
                                                 partition_by=["year"]))
    return base


def _state_of(spark: SparkSession, sf_dir: str, name: str) -> tuple:
    """Number, total size and latest time of a table's files, from its listing."""
    jvm, path = spark.sparkContext._jvm, f"{sf_dir}/{name}.parquet"
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, size, latest, n = fs.listFiles(root, True), 0, 0, 0
    while found.hasNext():
        f = found.next()
        size, latest, n = size + f.getLen(), max(latest, f.getModificationTime()), n + 1
    return n, size, latest


def _unified_base(spark: SparkSession, sf_dir: str) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, *(_state_of(spark, sf_dir, t) for t in ("orders", "events")))
    if key not in _UNIFIED_BASES:
        _UNIFIED_BASES[key] = build_unified(spark, sf_dir)
    return _UNIFIED_BASES[key]


def unified_table(spark, sf_dir):
    return read_unified(spark, _unified_base(spark, sf_dir))


def source_stats(spark, sf_dir):
    return unified.source_stats(unified_table(spark, sf_dir))


def source_filter(spark, sf_dir):
    return unified.select_source(unified_table(spark, sf_dir), STREAMING)


def distinct_counts(spark, sf_dir):
    return unified.distinct_counts(unified_table(spark, sf_dir))


def distinct_sketches(spark, sf_dir):
    """Distinct cities and countries, exact, and whether the estimates from sketches
    kept per source and year (written, then merged over both roots, at once and
    by way of the sources) are within four standard errors of them and agree."""
    u, path = unified_table(spark, sf_dir), scratch_path(spark, "sketches")
    files.write_parquet(sketches.distinct_sketches(u), path)
    kept = spark.read.parquet(path)
    by_source = sketches.merge_sketches(kept, ["source"])
    parts = {"exact": unified.distinct_counts(u), "merged": sketches.estimates(kept), "again": sketches.estimates(by_source)}
    rows = None
    for name, df in parts.items():  # a row each
        tagged = df.select(F.lit(name).alias("of"), "nb_villes", "nb_pays")
        rows = tagged if rows is None else rows.unionByName(tagged)

    def count(of: str, c: str):
        return F.max(F.when(F.col("of") == of, F.col(c)))

    def near(c: str):
        bound = F.greatest(F.lit(1.0), count("exact", c) * F.lit(4 * sketches.relative_error()))
        return F.abs(count("merged", c) - count("exact", c)) <= bound

    agree = (count("merged", "nb_villes") == count("again", "nb_villes")) & (count("merged", "nb_pays") == count("again", "nb_pays"))
    return rows.agg(count("exact", "nb_villes").alias("nb_villes"), count("exact", "nb_pays").alias("nb_pays"),
                    near("nb_villes").alias("cities_near"), near("nb_pays").alias("countries_near"), agree.alias("merges_agree"))


def distinct_sources(spark, sf_dir):
    return unified.distinct_values(unified_table(spark, sf_dir), "source")


def recent_top5(spark, sf_dir):
    return unified.recent_top(unified_table(spark, sf_dir), since=RECENT_SINCE, k=5, decimals=2, exact=True)


def source_compare(spark, sf_dir):
    return unified.source_compare(unified_table(spark, sf_dir), decimals=2, exact=True)


def source_compare_one(spark, sf_dir):
    """Only one source: there is nothing to compare, so no row."""
    return unified.source_compare(unified.select_source(unified_table(spark, sf_dir), BATCH), decimals=2, exact=True)


def recent_top5_ref(spark, sf_dir):
    """Unrounded, as the reference reports it."""
    return unified.recent_top(unified_table(spark, sf_dir), since=RECENT_SINCE, k=5, exact=True)


def source_compare_ref(spark, sf_dir):
    """Unrounded, as the reference reports it."""
    return unified.source_compare(unified_table(spark, sf_dir), exact=True)


# --------------------------------------------------------------- per-key series

def _events(spark, sf_dir):
    return tables.table(spark, sf_dir, "events")


def latest_per_key(spark, sf_dir):
    return series.latest_per_key(_events(spark, sf_dir), ["user_id"], "ts")


def stats_per_key(spark, sf_dir):
    return series.stats_per_key(_events(spark, sf_dir), ["event_type"], "value", exact=True)


def evolution(spark, sf_dir):
    return series.evolution(_events(spark, sf_dir), ["event_type"], "ts", "value", EVOLUTION_WINDOW, exact=True)


def rank_by_mean(spark, sf_dir):
    return series.rank_by_mean(_events(spark, sf_dir), ["event_type"], "value", exact=True)


# ------------------------------------------------------------ payloads / JSON

def json_payload(spark, sf_dir):
    ev = _events(spark, sf_dir).select("event_id", F.col("props").cast("binary").alias("value"))
    schema = T.StructType([T.StructField("k", T.IntegerType(), True)])
    return decode_json(ev, schema, keep=["event_id"])


def normalise_point(spark, sf_dir):
    return vendors.normalise_point(tables.payloads_from_lineitem(spark, sf_dir, "point"), keep=["record_id"])


def normalise_current(spark, sf_dir):
    return vendors.normalise_current(tables.payloads_from_lineitem(spark, sf_dir, "current"), keep=["record_id"])


def normalise_main(spark, sf_dir):
    return vendors.normalise_main(tables.payloads_from_lineitem(spark, sf_dir, "main_wind"), keep=["record_id"])


def normalise_routed(spark, sf_dir):
    return vendors.normalise(tables.payloads_from_lineitem(spark, sf_dir), keep=["record_id"])


def normalise_point_zero(spark, sf_dir):
    """With the reference's zero defaults for missing values."""
    return vendors.normalise_point(tables.payloads_from_lineitem(spark, sf_dir, "point"), keep=["record_id"], fill_zero=True)


def normalise_rejects(spark, sf_dir):
    """Rows the router cannot normalise (unknown vendor): kept whole, not dropped."""
    return vendors.rejects(tables.payloads_from_lineitem(spark, sf_dir)).select("record_id", "vendor", "payload")


def normalise_broken(spark, sf_dir):
    """Payloads of known vendors that don't decode are rejects, not empty records."""
    return vendors.rejects(tables.payloads_from_lineitem(spark, sf_dir, faults=True)).select("record_id", "vendor", "payload")


def normalise_routed_broken(spark, sf_dir):
    """The records of all payloads that do decode."""
    return vendors.normalise(tables.payloads_from_lineitem(spark, sf_dir, faults=True), keep=["record_id"])


# ---------------------------------------------------------------- round trips

def roundtrip_parquet(spark, sf_dir):
    path = scratch_path(spark, "clean-parquet")
    files.write_clean(_clean_orders(spark, sf_dir), path)
    return spark.read.parquet(path)


def roundtrip_csv(spark, sf_dir):
    path = scratch_path(spark, "by-year-csv")
    files.write_single_csv(mean_by_year(spark, sf_dir), path)
    schema = "year int, avg_temperature double, num_records long"
    return spark.read.schema(schema).option("header", True).csv(path)


def roundtrip_json(spark, sf_dir):
    path = scratch_path(spark, "hottest-json")
    files.write_single_json(hottest(spark, sf_dir), path)
    schema = "city long, country string, avg_temperature double, num_records long"
    return spark.read.schema(schema).json(path)


def roundtrip_extremes(spark, sf_dir):
    path = scratch_path(spark, "extremes-parquet")
    files.write_parquet(extremes(spark, sf_dir), path)
    return spark.read.parquet(path)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "null_profile": null_profile,
    "clean_counts": clean_counts,
    "clean_rows": clean_rows,
    "mean_by_country": mean_by_country,
    "mean_by_country_many": mean_by_country_many,
    "mean_by_country_ref": mean_by_country_ref,
    "mean_by_year": mean_by_year,
    "mean_by_year_ref": mean_by_year_ref,
    "first_months": first_months,
    "last_months": last_months,
    "first_years": first_years,
    "last_years": last_years,
    "hottest": hottest,
    "coldest": coldest,
    "hottest_ref": hottest_ref,
    "coldest_ref": coldest_ref,
    "mean_by_month": mean_by_month,
    "global_stats": global_stats,
    "global_stats_ref": global_stats_ref,
    "extremes": extremes,
    "extremes_high": extremes_high,
    "extremes_low": extremes_low,
    "mean_by_period": mean_by_period,
    "mean_by_period_ref": mean_by_period_ref,
    "mean_by_decade": mean_by_decade,
    "yearly_mean": yearly_mean,
    "run_report": run_report,
    "batch_job_csv": batch_job_csv,
    "batch_ordered": batch_ordered,
    "batch_rerun": batch_rerun,
    "notebook_report": notebook_report,
    "preaggregate": preaggregate,
    "rollup_incremental": rollup_incremental,
    "rollup_summaries": rollup_summaries,
    "stream_windows": stream_windows,
    "stream_csv_windows": stream_csv_windows,
    "stream_late": stream_late,
    "stream_null_time": stream_null_time,
    "stream_restart": stream_restart,
    "stream_update_batches": stream_update_batches,
    "stream_late_account": stream_late_account,
    "stream_trigger": stream_trigger,
    "stream_two_queries": stream_two_queries,
    "stream_lateness": stream_lateness,
    "stream_compacted": stream_compacted,
    "stream_latest_expiring": stream_latest_expiring,
    "stream_stats_expiring": stream_stats_expiring,
    "stream_unified": stream_unified,
    "stream_update": stream_update,
    "stream_latest_per_key": stream_latest_per_key,
    "stream_stats_per_key": stream_stats_per_key,
    "unified": unified_table,
    "source_stats": source_stats,
    "source_filter": source_filter,
    "distinct_counts": distinct_counts,
    "distinct_sketches": distinct_sketches,
    "distinct_sources": distinct_sources,
    "recent_top5": recent_top5,
    "source_compare": source_compare,
    "source_compare_one": source_compare_one,
    "source_compare_ref": source_compare_ref,
    "recent_top5_ref": recent_top5_ref,
    "latest_per_key": latest_per_key,
    "stats_per_key": stats_per_key,
    "evolution": evolution,
    "rank_by_mean": rank_by_mean,
    "json_payload": json_payload,
    "normalise_point": normalise_point,
    "normalise_current": normalise_current,
    "normalise_main": normalise_main,
    "normalise_routed": normalise_routed,
    "normalise_rejects": normalise_rejects,
    "normalise_point_zero": normalise_point_zero,
    "normalise_broken": normalise_broken,
    "normalise_routed_broken": normalise_routed_broken,
    "roundtrip_parquet": roundtrip_parquet,
    "roundtrip_csv": roundtrip_csv,
    "roundtrip_json": roundtrip_json,
    "roundtrip_extremes": roundtrip_extremes,
}
