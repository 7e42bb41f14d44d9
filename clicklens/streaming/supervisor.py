"""Keep a job's queries running together: stop all if one fails, start all again, report progress."""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


@dataclass
class Progress:
    """What a query has done since the supervisor began, over all its restarts.

    ``lag`` is the newest reading of how far its sources are behind, by what they report (for
    Kafka the offsets not read yet); None if they report nothing.
    """

    batches: int = 0
    rows: int = 0
    rows_per_second: float = 0.0
    lag: int | None = None
    state_rows: int = 0


@dataclass
class Failure:
    query: str
    reason: str


@dataclass
class Report:
    """How a run ended: ``failures`` in their order, ``restarts`` made, progress by query name."""

    restarts: int = 0
    failures: list[Failure] = field(default_factory=list)
    progress: dict[str, Progress] = field(default_factory=dict)


class JobFailed(RuntimeError):
    """A query failed more often than it may; ``report`` tells what happened."""

    def __init__(self, report: Report):
        last = report.failures[-1]
        super().__init__(f"{last.query} failed after {report.restarts} restarts: {last.reason}")
        self.report = report


class _Watch(StreamingQueryListener):
    """Collects the progress of the queries it is told of. Others in the session are left out."""

    def __init__(self, progress: dict[str, Progress]):
        self._names: dict[str, str] = {}
        self._early: dict[str, list] = {}
        self._progress = progress
        self._lock = threading.Lock()

    def follow(self, name: str, query: StreamingQuery) -> None:
        """Progress may come in before the query's start has returned, so it is kept until then."""
        with self._lock:
            self._names[str(query.runId)] = name
            for progress in self._early.pop(str(query.runId), []):
                self._add(name, progress)

    def followed(self) -> None:
        """All queries of this start are known: what else came in is of others."""
        with self._lock:
            self._early.clear()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        with self._lock:
            name = self._names.get(run)
            if name is None:
                self._early.setdefault(run, []).append(event.progress)
            else:
                self._add(name, event.progress)

    def onQueryTerminated(self, event) -> None:
        pass

    def _add(self, name: str, progress) -> None:
        total = self._progress.setdefault(name, Progress())
        total.batches += 1
        total.rows += progress.numInputRows
        total.rows_per_second = progress.processedRowsPerSecond
        total.state_rows = sum(op.numRowsTotal for op in progress.stateOperators)
        behind = [lag for source in progress.sources if (lag := _lag(source.metrics)) is not None]
        total.lag = sum(behind) if behind else None


def _lag(metrics: dict[str, str]) -> int | None:
    """A Kafka source names the offsets it is behind, a file source the files or bytes."""
    for name in ("maxOffsetsBehindLatest", "numFilesOutstanding"):
        if name in metrics:
            return int(float(metrics[name]))
    return None


class Supervisor:
    """Runs queries that need each other as one job.

    ``start`` starts them all from their checkpoints and returns them by name; it is called
    again after a failure. Then the others are stopped first, so that none goes on alone. So
    are, if it raises, the queries that the session has gained; start no others meanwhile.
    After ``max_restarts`` restarts in a row without a batch in between, the next failure
    ends the job with ``JobFailed``; a start after which every query has finished a batch
    sets the count back. Before each restart it waits ``pause`` seconds, twice as long each
    time, ``longest_pause`` at most.
    """

    def __init__(
        self,
        spark: SparkSession,
        start: Callable[[], dict[str, StreamingQuery]],
        max_restarts: int = 3,
        pause: float = 5.0,
        longest_pause: float = 300.0,
    ):
        self._spark = spark
        self._start = start
        self._max_restarts = max_restarts
        self._pause = pause
        self._longest_pause = longest_pause
        self._stopped = threading.Event()
        self._names: list[str] = []  # of the queries that the last start has begun
        self.report = Report()

    def run(self, timeout: float | None = None) -> Report:
        """Until all queries have ended by themselves, ``stop`` is called or the time is up."""
        end = None if timeout is None else time.monotonic() + timeout
        watch = _Watch(self.report.progress)
        self._spark.streams.addListener(watch)
        in_row = 0
        try:
            while True:
                done_before = {name: p.batches for name, p in self.report.progress.items()}
                failed = self._once(watch, end)
                if failed is None:
                    return self.report
                self.report.failures.append(failed)
                progress = self.report.progress
                if self._names and all(
                    name in progress and progress[name].batches > done_before.get(name, 0)
                    for name in self._names
                ):
                    in_row = 0
                if in_row >= self._max_restarts:
                    raise JobFailed(self.report)
                if self._stopped.wait(min(self._pause * 2 ** in_row, self._longest_pause)):
                    return self.report
                in_row += 1
                self.report.restarts += 1
        finally:
            self._spark.streams.removeListener(watch)

    def stop(self) -> None:
        """End ``run`` from another thread; the queries are stopped, not waited for."""
        self._stopped.set()

    def _once(self, watch: _Watch, end: float | None) -> Failure | None:
        """Start all and wait; None if all ended well."""
        before = {query.runId for query in self._spark.streams.active}
        self._names = []
        try:
            queries = self._start()
        except Exception as error:  # a query that cannot start is a failure like any other
            for query in self._spark.streams.active:
                if query.runId not in before:
                    query.stop()
            return Failure("start", str(error))
        self._names = list(queries)
        try:
            for name, query in queries.items():
                watch.follow(name, query)
            watch.followed()
            while any(query.isActive for query in queries.values()):
                failed = _failed(queries)
                if failed is not None:
                    return failed
                if self._stopped.wait(0.1) or (end is not None and time.monotonic() > end):
                    return None
            return _failed(queries)
        finally:
            for query in queries.values():
                query.stop()


def _failed(queries: dict[str, StreamingQuery]) -> Failure | None:
    for name, query in queries.items():
        if not query.isActive and (error := query.exception()) is not None:
            return Failure(name, str(error))
    return None
