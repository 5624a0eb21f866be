"""Trends that follow the jobs table instead of the source.

The jobs table takes each event once, and keeps in which batch it came. A follower counts, batch by batch,
the rows that the table took, and stores them in its trend under the same batch id. So trends count events
and not deliveries, late ones too, without a state or a watermark of their own, and a follower that is
started again goes on where its trend ends.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.util import inheritable_thread_target

from hiretide.streaming.tables import JobsTable, TrendTable

TRIES = 3


def catch_up(jobs: JobsTable, trend: TrendTable, count: Callable[[DataFrame], DataFrame],
             merge_every: int = 100) -> int:
    """Store the counts of the batches of ``jobs`` that ``trend`` does not have; how many there were."""
    behind = range(trend.last_batch() + 1, jobs.last_batch() + 1)
    for n in behind:
        trend.append_batch(count(jobs.brought(n)), n)
        if (n + 1) % merge_every == 0:
            trend.merge()
    return len(behind)


class Follower:
    """A thread that keeps a trend up to date as long as ``leader``, the query that fills the jobs table,
    runs. To be waited for and stopped like a streaming query; what fails in it is raised by the wait."""

    def __init__(self, spark: SparkSession, leader: StreamingQuery, name: str, step: Callable[[], int],
                 every: float = 0.5):
        self.name, self._leader, self._step, self._every = name, leader, step, every
        self._stopped, self._failed = threading.Event(), None
        run = inheritable_thread_target(spark)(self._run)
        self._thread = threading.Thread(target=run, name=name, daemon=True)
        self._thread.start()

    def _run(self) -> None:
        failed = 0
        while not self._stopped.is_set():
            last = not self._leader.isActive  # asked first: what came before its end is still done
            try:
                self._step()
                failed = 0
            except Exception as error:
                # A step that was overtaken by two merges finds its folders gone, and finds the rows
                # where they are now when it is done again: what it stored it does not store twice.
                failed += 1
                if failed == TRIES:
                    self._failed = error  # told to whoever waits
                    return
            if last and not failed:
                return
            self._stopped.wait(self._every)

    @property
    def isActive(self) -> bool:
        return self._thread.is_alive()

    def awaitTermination(self, timeout: float | None = None) -> bool:
        self._thread.join(timeout)
        if self._failed is not None:
            raise self._failed
        return not self._thread.is_alive()

    def stop(self) -> None:
        self._stopped.set()
        self._thread.join()
