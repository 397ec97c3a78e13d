"""How far a streamed run is: cancelling, and sums over all micro-batches."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener


class Cancelled(RuntimeError):
    """The operation was told to stop."""


@dataclass
class Token:
    """Tells operations to stop; callbacks run once; a token made from others is cancelled with them."""

    parents: list[Token] = field(default_factory=list)
    callbacks: list[Callable[[], None]] = field(default_factory=list)
    _on: bool = False

    def cancel(self) -> None:
        if not self._on:
            self._on = True
            for f in self.callbacks:
                f()

    @property
    def cancelled(self) -> bool:
        return self._on or any(p.cancelled for p in self.parents)

    def check(self) -> None:
        if self.cancelled:
            raise Cancelled


@dataclass
class Progress:
    """What a run has done: micro-batches, rows, bytes, seconds, and how it ended (idle, running, done, cancelled, failed).
    `chunks` has (rows, bytes, seconds) of every micro-batch that held rows."""

    state: str = "idle"
    batches: int = 0
    rows: int = 0
    bytes: int = 0
    seconds: float = 0.0
    warnings: list[str] = field(default_factory=list)
    chunks: list[tuple[int, int, float]] = field(default_factory=list)

    @property
    def rows_per_second(self) -> float:
        return self.rows / self.seconds if self.seconds else 0.0

    @property
    def mb_per_second(self) -> float:
        return self.bytes / (1 << 20) / self.seconds if self.seconds else 0.0

    def chunk_rates(self) -> list[float]:
        """Rows a second of each micro-batch."""
        return [n / s if s else 0.0 for n, _, s in self.chunks]

    def add(self, rows: int, size: int, seconds: float) -> None:
        self.batches += 1
        self.rows += rows
        self.bytes += size
        if rows:
            self.chunks.append((rows, size, seconds))

    @contextmanager
    def listening(self, spark: SparkSession, query: StreamingQuery, *, rows: bool = True) -> Iterator[None]:
        """While open, sums up what the engine tells of every micro-batch of one query: seconds, and rows that its sources gave.
        What the query itself keeps is the last hundred micro-batches only."""
        ended, run = threading.Event(), str(query.runId)
        told: dict[int, tuple[int, float]] = {}

        class Listener(StreamingQueryListener):
            def onQueryStarted(self, event) -> None:
                pass

            def onQueryProgress(self, event) -> None:
                x = event.progress
                if str(x.runId) == run:
                    told[x.batchId] = (x.numInputRows, x.batchDuration / 1000)

            def onQueryIdle(self, event) -> None:
                pass

            def onQueryTerminated(self, event) -> None:
                if str(event.runId) == run:
                    ended.set()

        listener = Listener()
        # What came before the listener is among the last hundred still.
        spark.streams.addListener(listener)
        try:
            yield
        finally:
            if not query.isActive:
                ended.wait(30)
            spark.streams.removeListener(listener)
            for x in query.recentProgress:
                told.setdefault(x.batchId, (x.numInputRows, x.batchDuration / 1000))
            self.seconds += sum(s for _, s in told.values())
            if rows:
                self.rows += sum(n for n, _ in told.values())
                self.chunks += [(n, 0, s) for _, (n, s) in sorted(told.items()) if n]
