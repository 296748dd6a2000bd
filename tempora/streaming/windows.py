"""Event-time windowed measures over the record stream (or a batch table:
the same functions run on both)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.functions.means import mean
from tempora.functions.parsing import parse_timestamp

# The reference's stream settings.
WINDOW = "1 minute"
WATERMARK = "2 minutes"
TRIGGER = "10 seconds"
KEYS = ("city", "country")


def enrich(records: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Add ``event_time`` (parsed, null on bad text) and ``processing_time``."""
    return records.withColumns(
        {
            "event_time": parse_timestamp(ts, records.schema[ts].dataType),
            "processing_time": F.current_timestamp(),
        }
    )


def with_quality_metrics(enriched: DataFrame, name: str = "record_quality") -> DataFrame:
    """Count, per micro-batch (or per batch job), the rows read and those that
    cannot be aggregated: no event time (bad or empty timestamp) or no
    temperature. Reported in ``query.lastProgress["observedMetrics"][name]``
    (streams) or by an ``Observation`` named ``name`` (batch)."""
    return enriched.observe(
        name,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("event_time").isNull()).alias("no_event_time"),
        F.count_if(F.col("temperature_celsius").isNull()).alias("no_temperature"),
    )


def lateness(enriched: DataFrame) -> DataFrame:
    """The enriched rows with ``lateness_us``, how long after its event time a row
    was processed (null without an event time). ``processing_time`` is one
    instant for all rows of a micro-batch."""
    return enriched.withColumn("lateness_us", F.unix_micros("processing_time") - F.unix_micros("event_time"))


#: Shares of a batch's rows whose lateness is kept.
LATENESS_SHARES = (0.5, 0.9, 0.99)


def lateness_by(late: DataFrame, *keys: str) -> DataFrame:
    """Distribution of the lateness: rows, rows without an event time, the number
    of processing times and the latest, least, greatest and (approximate) shares
    of the lateness, and the range of event times. Partial aggregates only."""
    shares = F.percentile_approx("lateness_us", list(LATENESS_SHARES), 10_000)
    return late.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("event_time").isNull()).alias("no_event_time"),
        (F.min("processing_time") == F.max("processing_time")).alias("one_clock"),
        F.max("processing_time").alias("processing_time"),
        F.min("lateness_us").alias("least_us"),
        F.max("lateness_us").alias("greatest_us"),
        shares.alias("shares_us"),
        F.min("event_time").alias("first_event"),
        F.max("event_time").alias("last_event"),
    )


def windowed_measures(enriched: DataFrame, window: str = WINDOW, watermark: str | None = WATERMARK,
                      keys=KEYS, exact: bool = False) -> DataFrame:
    """Per (window, keys): rows, mean temperature (2 dp), max, min and the
    unrounded means of wind, humidity and pressure.

    With a watermark the state is bounded: a window is emitted (append mode)
    and its state dropped once the watermark passes its end. A row is dropped
    as late when it is behind the watermark of the previous micro-batch (Spark
    4 semantics; rows behind only the current one are still aggregated). Rows
    without an event time belong to no window."""
    src = enriched.withWatermark("event_time", watermark) if watermark else enriched
    return src.groupBy(F.window("event_time", window), *keys).agg(
        F.count(F.lit(1)).alias("nb_mesures"),
        mean("temperature_celsius", exact=exact).alias("temperature_moyenne"),
        F.max("temperature_celsius").alias("temp_max"),
        F.min("temperature_celsius").alias("temp_min"),
        F.avg("wind_speed_kmh").alias("vent_moyen_kmh"),
        F.avg("humidity_percent").alias("humidite_moyenne"),
        F.avg("pressure_hpa").alias("pression_moyenne"),
    )


def flatten_window(windowed: DataFrame, ntz: bool = True) -> DataFrame:
    """``window`` struct → ``window_start``, ``window_end`` (wall clock when ``ntz``)."""
    kind = "timestamp_ntz" if ntz else "timestamp"
    rest = [c for c in windowed.columns if c != "window"]
    return windowed.select(
        F.col("window.start").cast(kind).alias("window_start"),
        F.col("window.end").cast(kind).alias("window_end"),
        *rest,
    )


def to_unified(windowed: DataFrame, city: str = "city", country: str = "country", with_grain: bool = False) -> DataFrame:
    """Shape to the unified 5-column table (``source = 'streaming'``).

    ``with_grain`` also keeps ``window_start`` and ``n`` so that weighted means
    over the mixed-grain unified table are possible."""
    cols = [
        F.col(city).cast("string").alias("City"),
        F.col(country).cast("string").alias("Country"),
        F.year(F.col("window.start")).alias("year"),
        F.col("temperature_moyenne"),
        F.lit("streaming").alias("source"),
    ]
    if with_grain:
        cols += [F.col("window.start").alias("window_start"), F.col("nb_mesures").alias("n")]
    return windowed.select(*cols)
