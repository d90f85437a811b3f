"""Publishing several tables at once: all of a snapshot is written first, then one pointer names it."""

from __future__ import annotations

import json
import os
import shutil
import time
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from quire.sources.layout import atomic_json, or_empty

POINTER, WRITING, READY, LOCK = "current.json", ".writing", ".ready", ".lock"


class Store:
    """Snapshots of named tables below a folder that driver and executors share.

    A reader sees the last published snapshot, never part of one.  One writer at a time.
    """

    def __init__(self, root: str) -> None:
        self.root = Path(root)

    def current(self) -> dict[str, str]:
        """Where each table's published data lie; empty before the first publication."""
        try:
            return json.loads((self.root / POINTER).read_text(encoding="utf-8"))["tables"]
        except FileNotFoundError:
            return {}

    def read(self, spark: SparkSession, name: str) -> DataFrame | None:
        at = self.current().get(name)
        return spark.read.parquet(str(self.root / at)) if at else None

    def table(self, spark: SparkSession, name: str, schema: StructType) -> DataFrame:
        """A published table, an empty one of this schema before the first publication."""
        at = self.current().get(name)
        return or_empty(spark, str(self.root / at), schema) if at else spark.createDataFrame([], schema)

    def publish(self, tables: dict[str, DataFrame], batch: str, partition_by: dict[str, list[str]] | None = None) -> None:
        """Write the tables as one snapshot and point to it; tables not given stay as published."""
        now = self.current()
        with self.writing():
            new = {}
            for name, df in tables.items():
                new[name] = f"snapshots/{batch}/{name}"
                df.write.mode("overwrite").partitionBy(*(partition_by or {}).get(name, [])).parquet(str(self.root / new[name]))
            atomic_json(self.root / POINTER, {"batch": batch, "tables": now | new})

    def drop(self) -> None:
        """Forget all tables; their files stay until swept."""
        atomic_json(self.root / POINTER, {"batch": "", "tables": {}})

    def stale(self) -> list[Path]:
        """Snapshot folders that no published table lies in."""
        used = {str(self.root / p) for p in self.current().values()}
        return sorted(p for p in self.root.glob("snapshots/*/*") if str(p) not in used)

    def sweep(self) -> int:
        """Delete the data that no published table lies in; how many folders went.  Not while readers of an older
        snapshot are at work."""
        with lock(self.root / LOCK):
            old = self.stale()
            for p in old:
                shutil.rmtree(p)
        return len(old)

    @contextmanager
    def writing(self) -> Iterator[None]:
        """Marks for readers outside: .writing while a run is on, .ready after it with how it ended."""
        with lock(self.root / LOCK):
            self.root.mkdir(parents=True, exist_ok=True)
            (self.root / READY).unlink(missing_ok=True)
            atomic_json(self.root / WRITING, {"pid": os.getpid()})
            status = "error"
            try:
                yield
                status = "ready"
            finally:
                (self.root / WRITING).unlink(missing_ok=True)
                atomic_json(self.root / READY, {"status": status, "completed_at": datetime.now(timezone.utc).isoformat(), "pid": os.getpid()})

    def ready(self) -> bool:
        try:
            return json.loads((self.root / READY).read_text())["status"] == "ready" and not (self.root / WRITING).exists()
        except FileNotFoundError:
            return False

    def wait(self, seconds: float, pause: float = 1.0) -> bool:
        """Until the store is ready, or so many seconds are over."""
        until = time.monotonic() + seconds
        while not self.ready():
            if time.monotonic() >= until:
                return False
            time.sleep(min(pause, max(0.0, until - time.monotonic())))
        return True


@contextmanager
def lock(path: str | os.PathLike) -> Iterator[None]:
    """One holder at a time on this driver's machine; a second raises instead of waiting."""
    import fcntl

    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(path, "a+") as f:
        try:
            fcntl.flock(f, fcntl.LOCK_EX | fcntl.LOCK_NB)
        except OSError as e:
            raise RuntimeError(f"{path} is held by another run") from e
        f.truncate(0)
        f.write(json.dumps({"pid": os.getpid(), "start_time": datetime.now(timezone.utc).isoformat()}))
        f.flush()
        yield
