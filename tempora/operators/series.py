"""Per-key analyses of measurements over time: latest value, stats,
evolution between windows, ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempora.functions.means import mean
from tempora.operators import rollup
from tempora.session import scratch_path


def latest_per_key(df: DataFrame, keys: list[str], ts: str, columns: list[str] | None = None) -> DataFrame:
    """Row with the greatest ``ts`` per key; ties broken by the other columns
    in order (greatest wins).

    ``max(struct(ts, ...))`` is an ordinary aggregate: partial per map task,
    so a hot key never lands whole in one task, and no per-key sort runs."""
    others = [c for c in (columns or df.columns) if c not in keys and c != ts]
    latest = F.max(F.struct(F.col(ts), *[F.col(c) for c in others])).alias("_latest")
    return df.groupBy(*keys).agg(latest).select(*keys, *[F.col(f"_latest.{c}") for c in [ts, *others]])


def stats_per_key(df: DataFrame, keys: list[str], value: str, exact: bool = False) -> DataFrame:
    """Mean (2 dp), max, min and count per key over the whole period."""
    return df.groupBy(*keys).agg(
        mean(value, exact=exact).alias("mean_value"),
        F.max(value).alias("max_value"),
        F.min(value).alias("min_value"),
        F.count(F.lit(1)).alias("n"),
    )


SPAN = "1 day"  # of event time that a streaming state row covers
SPAN_WATERMARK = "1 hour"


def latest_in_spans(df: DataFrame, keys: list[str], ts: str, span: str = SPAN, watermark: str | None = SPAN_WATERMARK) -> DataFrame:
    """``latest_per_key`` within each span of event time. On a stream the state
    of a span is dropped once the watermark has passed it, so the state holds
    the keys of the open spans and not all keys ever seen; ``fold_latest`` over
    the update table gives the latest of all spans. ``ts`` must be a timestamp."""
    src = df.withWatermark(ts, watermark) if watermark else df
    others = [c for c in df.columns if c not in keys and c != ts]
    latest = F.max(F.struct(F.col(ts), *[F.col(c) for c in others])).alias("_latest")
    found = src.groupBy(F.window(ts, span), *keys).agg(latest)
    return found.select(F.col("window.start").alias("span"), *keys, *[F.col(f"_latest.{c}") for c in [ts, *others]])


def fold_latest(spans: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """The latest row per key of ``latest_in_spans``."""
    return latest_per_key(spans.drop("span"), keys, ts)


def stats_in_spans(df: DataFrame, keys: list[str], ts: str, value: str, span: str = SPAN, watermark: str | None = SPAN_WATERMARK) -> DataFrame:
    """The mergeable state of ``stats_per_key`` within each span of event time;
    expires as that of ``latest_in_spans``."""
    src = df.withWatermark(ts, watermark) if watermark else df
    found = src.groupBy(F.window(ts, span), *keys).agg(F.count(F.lit(1)).alias("n_rows"), *rollup.value_state(value))
    return found.withColumn("span", F.col("window.start")).drop("window")


def fold_stats(spans: DataFrame, keys: list[str], value: str, exact: bool = False) -> DataFrame:
    """``stats_per_key`` from the states of all spans."""
    return rollup.merge(spans, keys).select(
        *keys, rollup.mean_of(value, exact).alias("mean_value"), F.col(f"{value}_max").alias("max_value"),
        F.col(f"{value}_min").alias("min_value"), F.col("n_rows").alias("n"),
    )


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def duration_seconds(duration: str) -> int:
    """Seconds in a fixed window duration such as ``"1 day"`` or ``"10 minutes"``."""
    n, unit = duration.split()
    return int(n) * _UNIT_SECONDS[unit.lower().rstrip("s")]


def evolution(df: DataFrame, keys: list[str], ts: str, value: str, duration: str = "1 day",
              exact: bool = False, chunk_windows: int = 1024) -> DataFrame:
    """Mean per key and tumbling window, and its change from the key's previous
    (non-empty) window.

    The ``lag`` runs over aggregated rows, within chunks of ``chunk_windows``
    consecutive window periods per key, so a key with a very long history is
    spread over many tasks. The first row of a chunk takes its predecessor from
    the last row of the key's previous non-empty chunk (a table of one row per
    key and chunk)."""
    per_window = df.groupBy(F.window(ts, duration).alias("w"), *keys).agg(
        mean(value, exact=exact).alias("mean_value"), F.count(F.lit(1)).alias("n")
    )
    span = duration_seconds(duration) * chunk_windows
    flat = per_window.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "mean_value", "n",
        F.floor(F.unix_seconds(F.col("w.start").cast("timestamp")) / F.lit(span)).alias("_chunk"),
    )
    in_chunk = Window.partitionBy(*keys, "_chunk").orderBy("window_start")
    flat = flat.withColumns({"_prev": F.lag("mean_value").over(in_chunk), "_pos": F.row_number().over(in_chunk)})
    # Same columns as the main branch, so both read one reused shuffle of the aggregate.
    last = flat.groupBy(*keys, "_chunk").agg(
        F.max(F.struct("window_start", "window_end", "mean_value", "n")).alias("_last")
    )
    by_chunk = Window.partitionBy(*keys).orderBy("_chunk")
    carry = last.select(*keys, "_chunk", F.lag(F.col("_last.mean_value")).over(by_chunk).alias("_carry"))
    carry = carry.select(*[F.col(c).alias(f"_c_{c}") for c in [*keys, "_chunk"]], "_carry")
    joined = flat.join(carry, _null_safe_on(flat, carry, [*keys, "_chunk"]), "left")
    prev = F.when(F.col("_pos") == 1, F.col("_carry")).otherwise(F.col("_prev"))
    change = (F.col("mean_value").cast("decimal(20,2)") - prev.cast("decimal(20,2)")).cast("double")
    return joined.select("window_start", "window_end", *keys, "mean_value", "n", change.alias("change"))


def _null_safe_on(flat: DataFrame, carry: DataFrame, cols: list[str]):
    cond = None
    for c in cols:
        eq = flat[c].eqNullSafe(carry[f"_c_{c}"])
        cond = eq if cond is None else cond & eq
    return cond


def rank_by_mean(df: DataFrame, keys: list[str], value: str, exact: bool = False,
                 decimals: int | None = 2) -> DataFrame:
    """Keys ranked by mean, highest first, with ``rank`` semantics (ties share
    a rank, nulls last).

    The rank of a mean is 1 + the number of keys with a greater mean. The
    keys are split into ranges of their means and written, which runs a job
    while the plan is built; the input is read by that job alone. Over the
    written table (one row per key) a running count of the distinct means within
    each range is added to the counts of the ranges before it (one row per
    range), and the ranks are joined back. No task holds all keys or all means."""
    means = df.groupBy(*keys).agg(mean(value, decimals=decimals, exact=exact).alias("mean_value"))
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "means")
    ranges = means.repartitionByRange(F.desc_nulls_last("mean_value")).withColumn("_range", F.spark_partition_id())
    ranges.write.parquet(path)  # the split into ranges is fixed here
    means = spark.read.schema(ranges.schema).parquet(path)
    levels = means.groupBy("_range", "mean_value").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    start = levels.groupBy("_range").agg(F.sum("_n").alias("_in")).select("_range", F.coalesce(F.sum("_in").over(before), F.lit(0)).alias("_before"))
    higher = Window.partitionBy("_range").orderBy(F.desc_nulls_last("mean_value")).rowsBetween(Window.unboundedPreceding, -1)
    levels = levels.withColumn("_here", F.coalesce(F.sum("_n").over(higher), F.lit(0))).join(start, "_range")
    levels = levels.select(F.col("mean_value").alias("_level"), (F.col("_before") + F.col("_here") + 1).cast("int").alias("rank"))
    joined = means.drop("_range").join(levels, F.col("mean_value").eqNullSafe(F.col("_level")), "inner")
    return joined.select(*keys, "mean_value", "rank")
