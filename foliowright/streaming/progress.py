"""Progress of a run over pages: done, rate and time left after each micro-batch."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


class Progress(StreamingQueryListener):
    """Rows of progress of the streaming query named `name`, as they come: pages, seconds, pages_per_second and seconds_left.

    Pages are counted on the way by the query's own observation `pages`, so that they are those
    that were processed. total: how many pages there are, if that is known; else seconds_left
    is None. told: called with each row.
    """

    def __init__(self, name: str, total: int | None = None, told: Callable[[dict], None] | None = None):
        self.name, self.total, self.told = name, total, told
        self.rows: list[dict] = []
        self.began, self.pages, self.ended = time.time(), 0, threading.Event()
        self.id = None

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.id = event.id

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name != self.name or "pages" not in p.observedMetrics:
            return
        n = p.observedMetrics["pages"].n
        if not n:
            return
        self.pages += n
        seconds = time.time() - self.began
        rate = self.pages / seconds if seconds else 0.0
        left = None if self.total is None or not rate else max(self.total - self.pages, 0) / rate
        row = {"pages": self.pages, "seconds": seconds, "pages_per_second": rate, "seconds_left": left}
        self.rows.append(row)
        if self.told:
            self.told(row)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.id == self.id:
            self.ended.set()


def run(spark: SparkSession, pages: DataFrame, step: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, name: str = "pages", total: int | None = None, told: Callable[[dict], None] | None = None) -> list[dict]:
    """Runs step over a stream of pages until all that is there is done, writes its rows to path as JSON lines, and returns the rows of progress.

    A run that was broken off goes on from its checkpoint, and counts from there.
    """
    seen = Progress(name, total, told)
    spark.streams.addListener(seen)
    try:
        counted = pages.observe("pages", F.count(F.lit(1)).alias("n"))
        writer = step(counted).writeStream.queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True)
        writer.format("json").option("path", path).start().awaitTermination()
        seen.ended.wait(30)
    finally:
        spark.streams.removeListener(seen)
    return seen.rows
