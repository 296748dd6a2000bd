"""Starting, running and stopping streaming queries.

Each query has its own checkpoint (under the shared folder), so a restart
resumes from its committed offsets and state without duplicating output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tempora.streaming import accounting
from tempora.streaming.windows import TRIGGER, lateness, lateness_by


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB (off-heap, on local disk, snapshotted to
    the checkpoint) instead of JVM memory: for large key sets. Applies to
    queries started afterwards; an existing checkpoint keeps its provider."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)


def _start(spark: SparkSession, writer, processing_time: str | None, available_now: bool, checkpoint: str | None) -> StreamingQuery:
    """Start with the trigger, under the session's ledger; with a checkpoint the account is kept beside it."""
    accounting.ledger(spark)  # sees the queries that start after it
    if available_now:
        query = writer.trigger(availableNow=True).start()
    else:
        query = writer.trigger(processingTime=processing_time or TRIGGER).start()
    return accounting.follow(spark, query, checkpoint) if checkpoint else query


def start_parquet_append(df: DataFrame, path: str, checkpoint: str, processing_time: str | None = TRIGGER,
                         available_now: bool = False, name: str | None = None,
                         partition_by: list[str] | None = None) -> StreamingQuery:
    """Append-mode Parquet sink: each window is written once, after the
    watermark closes it. ``partition_by`` lays the output out in folders
    (e.g. ``year``) so that readers prune it. The sink's metadata log lists
    every file ever written; ``compact`` moves a long-lived root's rows to a
    table of few files."""
    writer = (
        df.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    return _start(df.sparkSession, writer, processing_time, available_now, checkpoint)


def start_console_update(df: DataFrame, processing_time: str | None = TRIGGER, available_now: bool = False,
                         checkpoint: str | None = None) -> StreamingQuery:
    """Update-mode console sink (changed rows per trigger, untruncated)."""
    writer = df.writeStream.outputMode("update").format("console").option("truncate", "false")
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return _start(df.sparkSession, writer, processing_time, available_now, checkpoint)


def start_update_table(df: DataFrame, path: str, checkpoint: str, processing_time: str | None = TRIGGER,
                       available_now: bool = False) -> StreamingQuery:
    """Update-mode changes appended to a Parquet table with their batch id.

    A file sink only supports append, so each micro-batch's updated rows are
    written by ``foreachBatch``; ``latest_updates`` folds them back to the
    current value per key. Each batch overwrites its own ``batch_id=`` folder,
    so a batch replayed after a failure replaces its partial output instead of
    adding duplicates."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = df.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write_batch)
    return _start(df.sparkSession, writer, processing_time, available_now, checkpoint)


def start_lateness_table(enriched: DataFrame, path: str, checkpoint: str, processing_time: str | None = TRIGGER,
                         available_now: bool = False) -> StreamingQuery:
    """The distribution of the lateness of each micro-batch, a row each, in a
    folder of its own (a replayed batch overwrites it)."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        found = lateness_by(lateness(batch)).withColumn("batch", F.lit(batch_id))
        found.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = enriched.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write_batch)
    return _start(enriched.sparkSession, writer, processing_time, available_now, checkpoint)


def latest_updates(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Current value per key from an update table (latest batch wins). Reads
    every update ever written: ``compact_updates`` folds them."""
    updates = spark.read.option("basePath", path).parquet(path).drop("batch_id")
    values = [c for c in updates.columns if c not in keys and c != "_batch_id"]
    latest = F.max_by(F.struct(*[F.col(c) for c in values]), F.col("_batch_id")).alias("_v")
    return updates.groupBy(*keys).agg(latest).select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values])


def compact_updates(spark: SparkSession, path: str, target: str, keys: list[str]) -> None:
    """The current value per key of the update table at ``path``, written as the
    first batch of a new one at ``target``."""
    latest_updates(spark, path, keys).withColumn("_batch_id", F.lit(-1).cast("long")).write.parquet(f"{target}/batch_id=-1")


def compact(spark: SparkSession, root: str, target: str, partition_by: str | None = None) -> None:
    """Every committed row of a streaming root, written to a new table of few files."""
    rows = spark.read.parquet(root)
    writer = rows.hint("rebalance", *[partition_by] if partition_by else []).write.mode("errorifexists")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(target)


class LateRows(RuntimeError):
    """A stream dropped rows behind its watermark although none were expected."""


def check_late(spark: SparkSession, query: StreamingQuery, allow_late: bool = False) -> None:
    """Wait for the account of an ended query. Raise if this run of it has
    dropped rows that were not expected, or if a batch was never reported, so
    that nobody can tell."""
    run, _ = accounting.settled(spark, query)
    if allow_late:
        return
    if run.dropped:
        raise LateRows(f"{run.dropped} rows or groups came behind the watermark and were dropped")
    if not run.complete:
        raise LateRows(f"{run.missing} batches were not reported: what they dropped is not known")


def run_to_completion(query: StreamingQuery, timeout: float | None = None, allow_late: bool = False) -> StreamingQuery:
    """Block until an ``availableNow`` query has drained its input. Raises if it
    has dropped late rows in any of its batches, unless they are expected."""
    query.awaitTermination(timeout)
    if query.exception() is not None:
        raise query.exception()
    if not query.isActive:
        check_late(SparkSession.active(), query, allow_late)
    return query


def run_batches(query: StreamingQuery, n: int, timeout: float | None = None) -> accounting.Account:
    """Let a query with a processing-time trigger run until it has ended ``n``
    batches, then stop it. Returns the run's account."""
    spark = SparkSession.active()
    try:
        accounting.await_batches(spark, query, n, timeout)
    finally:
        query.stop()
    return accounting.settled(spark, query)[0]


def await_all(queries: list[StreamingQuery], poll: float = 0.5, allow_late: bool = True) -> None:
    """Wait until all of ``queries`` have ended. If one fails, or the wait is
    interrupted, the others are stopped and the failure is raised; one that has
    drained its input leaves the others running. With ``allow_late=False``
    dropped rows are a failure too, once all have ended."""
    try:
        while active := [q for q in queries if q.isActive]:
            if any(q.exception() is not None for q in queries if not q.isActive):
                break
            active[0].awaitTermination(poll)
    finally:
        stop_all(queries)
    for q in queries:
        if q.exception() is not None:
            raise q.exception()
    for q in queries:
        check_late(SparkSession.active(), q, allow_late)


def stop_all(queries: list[StreamingQuery]) -> None:
    for q in queries:
        if q.isActive:
            q.stop()
