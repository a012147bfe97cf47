"""One runner at a time: a lease beside a log, with an owner and an epoch.

Each holder creates ``lease/<epoch>``, one above the last. Creating a file that must be new decides
between two that try at once, on file systems that do so in one step (HDFS, local disks). On an object
store those who try agree on the owner of the epoch (``agreement.py``). A holder renews its file while it
runs and marks it when done; a file that was not renewed for ``seconds`` is a holder that died, and the
next epoch may begin.
"""

from __future__ import annotations

import threading
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from tidemark.streaming.agreement import Agreement, HadoopStore

_DONE = ".done"


class LeaseTaken(RuntimeError):
    """Another runner holds the log."""


class Lease:
    def __init__(self, spark: SparkSession, folder: str, seconds: float = 120.0, agreed: bool | None = None) -> None:
        self.owner = uuid.uuid4().hex
        self._seconds = seconds
        self._files = spark._jvm.org.apache.hadoop.fs
        self._folder = f"{folder.rstrip('/')}/lease"
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(""))
        self._store = HadoopStore(spark, folder)
        self._agreed = self._store.is_object_store if agreed is None else agreed
        self._agreement = Agreement(self._store, self.owner)
        self._epoch: int | None = None
        self._stop = threading.Event()

    @property
    def epoch(self) -> int:
        """The number of this holding; later holders have larger ones."""
        if self._epoch is None:
            raise LeaseTaken(f"{self._folder} is not held.")
        return self._epoch

    def _path(self, name: str):
        return self._files.Path(f"{self._folder}/{name}" if name else self._folder)

    def _last(self) -> tuple[int, bool, float]:
        """The last epoch, whether its holder is done, and the seconds since it was renewed."""
        files = {s.getPath().getName(): s for s in self._fs.listStatus(self._path(""))}
        epochs = [int(n) for n in files if n.isdigit()]
        if not epochs:
            return -1, True, 0.0
        last = max(epochs)
        age = time.time() - files[str(last)].getModificationTime() / 1000
        return last, f"{last}{_DONE}" in files, age

    def __enter__(self) -> Lease:
        last, done, age = self._last()
        if not done and age < self._seconds:
            raise LeaseTaken(f"Another runner holds {self._folder} (epoch {last}).")
        if not self._taken(last + 1):
            raise LeaseTaken(f"Another runner has just taken {self._folder}.")
        self._epoch = last + 1
        self._stop.clear()
        threading.Thread(target=self._renew, daemon=True).start()
        return self

    def _taken(self, epoch: int) -> bool:
        """Begin an epoch, if nobody else does."""
        if self._agreed:
            # Whoever finds out writes the file down, so that the time of an owner that died at once runs too.
            owner = self._agreement.decide(f"lease/{epoch}", self.owner)
            self._store.put(f"lease/{epoch}", owner)
            return owner == self.owner and self._last()[0] == epoch
        try:
            out = self._fs.create(self._path(str(epoch)), False)
        except Py4JJavaError:
            return False
        out.write(bytearray(self.owner, "utf-8"))
        out.close()
        return True

    def _renew(self) -> None:
        while not self._stop.wait(self._seconds / 4):
            try:
                if self._agreed:  # objects have no other time than that of their writing
                    self._store.put(f"lease/{self._epoch}", self.owner)
                else:
                    self._fs.setTimes(self._path(str(self._epoch)), int(time.time() * 1000), -1)
            except Exception:  # noqa: BLE001  the check before each step tells whether the lease still holds
                return

    def check(self) -> None:
        """Raise if a later epoch has begun, because this runner seemed dead."""
        last, _, _ = self._last()
        if self._epoch is None or last != self._epoch:
            raise LeaseTaken(f"{self._folder} went over to another runner (epoch {last}).")

    def _passed(self) -> list[int]:
        names = {s.getPath().getName().removesuffix(_DONE) for s in self._fs.listStatus(self._path(""))}
        return sorted(int(n) for n in names if n.isdigit() and int(n) < self._epoch)

    def __exit__(self, *_: object) -> None:
        self._stop.set()
        if self._last()[0] == self._epoch:
            self._fs.create(self._path(f"{self._epoch}{_DONE}"), True).close()
            for old in self._passed():
                for name in (str(old), f"{old}{_DONE}"):
                    self._fs.delete(self._path(name), False)
                if self._agreed:
                    # Whoever still wins one of these finds a later epoch.
                    self._agreement.forget(f"lease/{old}")
        self._epoch = None
