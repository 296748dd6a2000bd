"""Accounts of streaming queries: what every micro-batch read and dropped, over a query's whole life.

A query's own progress keeps only the latest records, so a loss in an early
batch is gone from it later. A listener sees the progress of every batch. It
adds up the rows read and the rows (or groups, after Spark's partial
aggregation) dropped behind the watermark, and keeps the sum beside the
query's checkpoint, so that a restarted query goes on counting.

Batches carry consecutive numbers. A batch that was counted is not counted
again, and one that never came (Spark may drop events when its queue is full,
and a driver can die between commit and event) is counted as missing: the
account then says that it is not complete.
"""

from __future__ import annotations

import json
import threading
from dataclasses import asdict, dataclass, replace

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

SETTLE_SECONDS = 60.0


@dataclass(frozen=True)
class Account:
    """Sums over the batches of a query: ``last`` is the number of the latest,
    ``missing`` counts those that were never reported."""

    batches: int = 0
    rows: int = 0
    dropped: int = 0
    last: int = -1
    missing: int = 0

    def add(self, batch: int, rows: int, dropped: int) -> Account:
        if batch <= self.last:  # counted before
            return self
        return Account(self.batches + 1, self.rows + rows, self.dropped + dropped, batch, self.missing + batch - self.last - 1)

    @property
    def complete(self) -> bool:
        return self.missing == 0


def account_path(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-account"


class _Store:
    """The latest accounts of one checkpoint, one small file each, named by the
    batch. The newest that can be read counts: a file that was cut off by a
    failure is passed over, and the one before it says less, never more."""

    KEPT = 2

    def __init__(self, spark: SparkSession, path: str):
        sc = spark.sparkContext
        self.path = sc._jvm.org.apache.hadoop.fs.Path
        self.root = self.path(path)
        self.fs = self.root.getFileSystem(sc._jsc.hadoopConfiguration())
        self.text = sc._jvm.org.apache.commons.io.IOUtils

    def _files(self) -> list:
        if not self.fs.exists(self.root):
            return []
        names = [f.getPath() for f in self.fs.listStatus(self.root)]
        return sorted((p for p in names if p.getName().endswith(".json")), key=lambda p: int(p.getName()[:-5]), reverse=True)

    def read(self) -> Account:
        for p in self._files():
            stream = self.fs.open(p)
            try:
                return Account(**json.loads(self.text.toString(stream, "UTF-8")))
            except (ValueError, TypeError):
                continue
            finally:
                stream.close()
        return Account()

    def write(self, account: Account) -> None:
        stream = self.fs.create(self.path(self.root, f"{account.last}.json"), True)
        try:
            stream.write(bytearray(json.dumps(asdict(account)).encode()))
        finally:
            stream.close()
        for old in self._files()[self.KEPT :]:
            self.fs.delete(old, False)


class _Run:
    """One run of a query: its own account, and the stored one once the checkpoint is known."""

    def __init__(self) -> None:
        self.account, self.pending, self.store, self.total = Account(), [], None, None
        self.changed, self.ended = threading.Condition(), False

    def add(self, batch: int, rows: int, dropped: int) -> None:
        with self.changed:
            if self.account.batches == 0:  # a restarted query goes on with a later number
                self.account = replace(self.account, last=batch - 1)
            self.account = self.account.add(batch, rows, dropped)
            self.pending.append((batch, rows, dropped))
            self._flush()
            self.changed.notify_all()

    def follow(self, store: _Store) -> None:
        with self.changed:
            self.store, self.total = store, store.read()
            self._flush()

    def _flush(self) -> None:
        if self.store is None or not self.pending:
            return
        before = self.total
        for batch in self.pending:
            self.total = self.total.add(*batch)
        self.pending = []
        if self.total != before:
            self.store.write(self.total)

    def end(self) -> None:
        with self.changed:
            self.ended = True
            self.changed.notify_all()


class Ledger(StreamingQueryListener):
    """The accounts of all queries of a session."""

    def __init__(self) -> None:
        self.runs: dict[str, _Run] = {}

    def run_of(self, run_id) -> _Run:
        return self.runs.setdefault(str(run_id), _Run())

    def onQueryStarted(self, event) -> None:
        self.run_of(event.runId)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if "addBatch" in p.durationMs:  # a trigger without a batch repeats the next batch's number
            self.run_of(p.runId).add(p.batchId, p.numInputRows, sum(s.numRowsDroppedByWatermark for s in p.stateOperators))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.run_of(event.runId).end()


_LEDGERS: dict[str, Ledger] = {}


def ledger(spark: SparkSession) -> Ledger:
    """The session's ledger; the first call registers it. Only queries started afterwards are seen."""
    key = spark._jsparkSession.sessionUUID()
    if key not in _LEDGERS:
        _LEDGERS[key] = Ledger()
        spark.streams.addListener(_LEDGERS[key])
    return _LEDGERS[key]


def follow(spark: SparkSession, query: StreamingQuery, checkpoint: str) -> StreamingQuery:
    """Keep the account of a started query beside its checkpoint."""
    ledger(spark).run_of(query.runId).follow(_Store(spark, account_path(checkpoint)))
    return query


def settled(spark: SparkSession, query: StreamingQuery, timeout: float = SETTLE_SECONDS) -> tuple[Account, Account | None]:
    """The account of this run of an ended query and, if it is followed, of its
    whole life. Events come late: waits for the one that ends the run."""
    run = ledger(spark).run_of(query.runId)
    with run.changed:
        if not run.changed.wait_for(lambda: run.ended, timeout):
            raise TimeoutError(f"no end of query {query.id} was reported in {timeout} s")
        return run.account, run.total


def account(spark: SparkSession, checkpoint: str) -> Account:
    """The stored account of a checkpoint (empty if there is none)."""
    return _Store(spark, account_path(checkpoint)).read()


def await_batches(spark: SparkSession, query: StreamingQuery, n: int, timeout: float | None = None) -> Account:
    """Wait until this run of the query has ended ``n`` batches. Raises the
    query's failure, or TimeoutError."""
    run = ledger(spark).run_of(query.runId)
    with run.changed:
        reached = run.changed.wait_for(lambda: run.account.batches >= n or run.ended, timeout)
    if query.exception() is not None:
        raise query.exception()
    if not reached or run.account.batches < n:
        raise TimeoutError(f"query {query.id} ended {run.account.batches} of {n} batches")
    return run.account
