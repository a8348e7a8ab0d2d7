"""Ending a stream between two batches.

The engine's ``stop()`` interrupts the batch that is running. Here a marker in the folder
of the checkpoint asks for the end, from any process that sees the folder. Every batch
passes a gate before it does anything; while the marker is there it waits. The process that
owns the stream stops it once nothing is past the gate: the last batch let through stands in
the commit log of the checkpoint. A batch that waits has written nothing; it is the first
to run after a restart.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from edgelog.sinks.writers import found

Handler = Callable[[DataFrame, int], None]
_WAIT_MS = 200
_INTERRUPTED = "py4j.protocol.Py4JJavaError: An error occurred while calling sleep: java.lang.InterruptedException"
#: Turns at the gate in which the engine's own interrupt should have come.
_TURNS = 5


def _marker(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}/drain"


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def request_stop(spark: SparkSession, checkpoint: str) -> None:
    """Ask the stream of ``checkpoint`` to end after the batch that is running."""
    files, path = _fs(spark, _marker(checkpoint))
    files.mkdirs(path)


def withdraw_stop(spark: SparkSession, checkpoint: str) -> None:
    """Take the request back; a stream that waits goes on."""
    files, path = _fs(spark, _marker(checkpoint))
    files.delete(path, True)


def stop_requested(spark: SparkSession, checkpoint: str) -> bool:
    return found(spark, _marker(checkpoint))


class Gate:
    """What a stream's batches pass one by one."""

    def __init__(self, checkpoint: str):
        self.checkpoint = checkpoint.rstrip("/")
        self.last: int | None = None
        self.waiting = self.stopping = False

    def through(self, handler: Handler) -> Handler:
        def run(df: DataFrame, batch: int) -> None:
            spark = df.sparkSession
            # set before the marker is read, so that is_clear never misses a batch let through
            self.waiting, self.last = False, batch
            try:
                self._wait(spark)
            except Py4JJavaError as error:
                if "Interrupt" not in str(error):
                    raise
                # the engine tells an interrupt from a fault by this text, and must not get the long original
                raise InterruptedError(_INTERRUPTED) from None
            handler(df, batch)

        return run

    def _wait(self, spark: SparkSession) -> None:
        """Hold the thread of the stream, where an interrupt ends it without an error, while the marker is there."""
        thread, turns = spark._jvm.java.lang.Thread, 0
        while stop_requested(spark, self.checkpoint):
            self.waiting = True
            turns += self.stopping
            if turns > _TURNS:  # the planning of the batch took the interrupt of stop() for its own
                thread.currentThread().interrupt()
            thread.sleep(_WAIT_MS)
        self.waiting = False

    def is_clear(self, spark: SparkSession) -> bool:
        """Whether no batch is being handled; holds on while the marker is there."""
        return self.waiting or self.last is None or found(spark, f"{self.checkpoint}/commits/{self.last}")


_GATES: dict[str, Gate] = {}


def new_gate(checkpoint: str) -> Gate:
    gate = Gate(checkpoint)
    _GATES[gate.checkpoint] = gate
    return gate


def drain(spark: SparkSession, query: StreamingQuery, checkpoint: str, timeout: float | None = None) -> bool:
    """Let the running batch of a stream of this process finish, then stop it.

    False where the batch took longer than ``timeout`` seconds: the stream then goes on. The
    marker is gone afterwards, so the stream can be started again.
    """
    gate = _GATES[checkpoint.rstrip("/")]
    until = None if timeout is None else time.monotonic() + timeout
    request_stop(spark, checkpoint)
    try:
        while query.isActive:
            if gate.is_clear(spark):
                gate.stopping = True
                query.stop()
                return True
            if until is not None and time.monotonic() > until:
                return False
            time.sleep(_WAIT_MS / 1000)
        return True
    finally:
        withdraw_stop(spark, checkpoint)


class Idleness(StreamingQueryListener):
    """Since when streams have found no input, by query id."""

    def __init__(self) -> None:
        self.since: dict[str, float] = {}

    def onQueryStarted(self, event) -> None:
        self.since.pop(str(event.id), None)

    def onQueryProgress(self, event) -> None:
        if event.progress.numInputRows:
            self.since.pop(str(event.progress.id), None)

    def onQueryIdle(self, event) -> None:
        self.since.setdefault(str(event.id), time.monotonic())

    def onQueryTerminated(self, event) -> None:
        self.since.pop(str(event.id), None)

    def seconds(self, query: StreamingQuery) -> float:
        since = self.since.get(str(query.id))
        return 0.0 if since is None else time.monotonic() - since


def supervise_all(
    spark: SparkSession, queries: dict[str, StreamingQuery], marker: str, poll: float = 1.0, idle: float | None = None,
) -> None:
    """Wait for the end of streams of this process, by checkpoint, and end all where a marker asks for that.

    The marker is that of the folder ``marker``. With ``idle`` they also end once each had no
    input for so many seconds. An error of a stream is raised, after the others have ended.
    """
    watch = Idleness()
    spark.streams.addListener(watch)
    try:
        while any(q.isActive for q in queries.values()):
            done = [q for q in queries.values() if not q.isActive]
            quiet = idle is not None and all(watch.seconds(q) >= idle for q in queries.values() if q.isActive)
            if quiet or stop_requested(spark, marker) or any(q.exception() for q in done):
                for checkpoint, query in queries.items():
                    drain(spark, query, checkpoint)
            else:
                time.sleep(poll)
        for query in queries.values():
            query.awaitTermination()
    finally:
        spark.streams.removeListener(watch)
        withdraw_stop(spark, marker)


def supervise(spark: SparkSession, query: StreamingQuery, checkpoint: str, poll: float = 1.0, idle: float | None = None) -> None:
    """:func:`supervise_all` of one stream, whose own checkpoint holds the marker."""
    supervise_all(spark, {checkpoint: query}, checkpoint, poll, idle)
