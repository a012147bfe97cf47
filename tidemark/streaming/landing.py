"""Any table as a composable stream: batches land as Parquet, a file stream reads them.

A Python stream reader cannot use JVM drivers, and a feed hands out batch DataFrames.
Landing joins the two: the feed writes each batch natively, and Spark's own file
source turns the folder into a stream for watermarks, windows and joins.
"""

from __future__ import annotations

import threading
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tidemark.streaming.feed import Delivered, IncrementalFeed, Table

_ANY_AGE = "36500d"


class Landing:
    """A table being landed on every trigger, in the background, until ``stop``."""

    def __init__(self, land, seconds: float) -> None:
        self._land, self._seconds = land, seconds
        self._wake, self._over = threading.Event(), False
        self._done = threading.Condition()
        self.polls, self.error = 0, None
        self._thread = threading.Thread(target=self._run, daemon=True)
        self._thread.start()

    def _run(self) -> None:
        while not self._over:
            try:
                self._land()
            except Exception as failure:  # noqa: BLE001  told to whoever waits
                self.error = failure
                self._over = True
            with self._done:
                self.polls += 1
                self._done.notify_all()
            self._wake.wait(self._seconds)
            self._wake.clear()

    def poll(self, timeout: float = 600.0) -> None:
        """Trigger now, and wait until a poll that began afterwards is over."""
        with self._done:
            # One that is under way may have looked before the call.
            wanted = self.polls + 2
        while self.polls < wanted and not self._over:
            self._wake.set()
            with self._done:
                if self.polls < wanted and not self._done.wait(min(timeout, 1.0)):
                    timeout -= 1.0
                    if timeout <= 0:
                        raise TimeoutError("The table was not polled in time.")
        self._raise()

    def stop(self) -> None:
        """End after the poll under way; raises what ended it before."""
        self._over = True
        self._wake.set()
        self._thread.join()
        self._raise()

    def _raise(self) -> None:
        if self.error is not None:
            raise self.error


class LandedStream:
    """Lands a table below ``folder`` and reads it back as a stream.

    A batch is written aside and then renamed into place as a whole, so the stream
    sees all of it or nothing; one that was already in place when a run broke off is
    not landed again. The rename is atomic on HDFS and the like; on a plain object
    store use a committer or table format that makes it so.
    """

    def __init__(
        self,
        spark: SparkSession,
        table: Table,
        options: Mapping[str, str],
        folder: str,
        rows_per_batch: int | None = None,
    ) -> None:
        self._spark = spark
        self._schema = table.schema
        self._folder = folder.rstrip("/")
        files = spark._jvm.org.apache.hadoop.fs
        self._path = lambda name: files.Path(f"{self._folder}/{name}")
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())
        for name in ("staged", "landed"):
            self._fs.mkdirs(self._path(name))
        log = f"{self._folder}/log"
        self.feed = IncrementalFeed(spark, table, options, log, rows_per_batch)

    def land_available(self) -> list[Delivered]:
        """Land what is there now; call it again, on any schedule, as the table grows."""
        return self.feed.run_available(self._land)

    def start(self, seconds: float = 10.0) -> Landing:
        """Pull the table every ``seconds`` in the background, so that it is one running stream with
        ``load``; ``stop`` of the result ends it."""
        return Landing(self.land_available, seconds)

    def _land(self, batch: DataFrame, batch_id: int) -> None:
        landed = self._path(f"landed/batch-{batch_id}")
        if self._fs.exists(landed):
            return
        staged = f"{self._folder}/staged/batch-{batch_id}"
        batch.write.mode("overwrite").parquet(staged)
        if not self._fs.rename(self._path(f"staged/batch-{batch_id}"), landed):
            raise RuntimeError(f"Batch {batch_id} could not be moved into {landed}.")

    def load(self, **options: str) -> DataFrame:
        """The streaming DataFrame; ``options`` go to Spark's file source.

        Left alone, that source passes over files a week older than the newest one: a query
        that was down for long would lose batches, so age is no reason here.
        """
        reader = self._spark.readStream.schema(self._schema)
        reader = reader.options(**{"maxFileAge": _ANY_AGE, **options})
        return reader.option("recursiveFileLookup", "true").parquet(f"{self._folder}/landed")
