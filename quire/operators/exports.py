"""Exporting documents of a remote service to files, many at a time."""

from __future__ import annotations

import os
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.plans.retry import retried

#: Seconds before the first question, between two and in all that a task is polled for; tries of a download.
FIRST, PAUSE, POLL_SECONDS, TRIES = 5.0, 3.0, 300.0, 3


class ExportClient(Protocol):
    """A service that exports documents: create a task, ask after it, fetch its file.  Each call is tried again after
    errors of the connection."""

    def create(self, token: str, doc_type: str, ext: str) -> str: ...

    def ask(self, task: str) -> str:
        """done, pending or failed."""

    def fetch(self, task: str) -> bytes: ...


def one(client: ExportClient, token: str, doc_type: str, ext: str, path: str, seconds: float = POLL_SECONDS, first: float = FIRST, pause: float = PAUSE, sleep: Callable[[float], None] = time.sleep) -> tuple[str, str | None]:
    """(status, error) of one document: downloaded, failed or timed out.  The file is there in full or not at all."""
    try:
        task = retried(lambda: client.create(token, doc_type, ext), TRIES, sleep=sleep)
        waited, said = first, "pending"
        sleep(first)
        while (said := retried(lambda: client.ask(task), TRIES, sleep=sleep)) == "pending":
            if waited >= seconds:
                return "timed out", None
            sleep(pause)
            waited += pause
        if said != "done":
            return "failed", said
        content = retried(lambda: client.fetch(task), TRIES, sleep=sleep)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(f"{path}.part", "wb") as f:
            f.write(content)
        os.replace(f"{path}.part", path)
    except Exception as e:  # noqa: BLE001  one document ends no run
        return "failed", repr(e)[:200]
    return "downloaded", None


def exported(entries: DataFrame, load: Callable[[], ExportClient], folder: str, **timing: float) -> DataFrame:
    """entries (token, doc_type, ext, name, url, space_id, obj_edit_time) with file_path, status and error.

    Each task makes a client and exports its entries one after the other, so there are as many exports under way as
    tasks; `folder` is one that all executors share.
    """
    name = F.concat(T.safe_filename("name", "token"), F.lit("."), F.coalesce("ext", F.lit("docx")))
    have = lambda c: F.col(c) if c in entries.columns else F.lit(None).cast("string")
    e = entries.select("token", "doc_type", "ext", "name", have("url").alias("source_url"), have("space_id").alias("space_id"), have("obj_edit_time").alias("obj_edit_time"), F.concat(F.lit(folder.rstrip("/") + "/"), name).alias("file_path"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = load()
        for b in batches:
            said = [one(client, t, k, x, p, **timing) for t, k, x, p in zip(b["token"], b["doc_type"], b["ext"], b["file_path"])]
            yield b.assign(status=[s for s, _ in said], error=[x for _, x in said])

    return e.mapInPandas(run, "token string, doc_type string, ext string, name string, source_url string, space_id string, obj_edit_time string, file_path string, status string, error string")


def summary(done: DataFrame) -> DataFrame:
    return done.groupBy("status").agg(F.count("*").alias("n"))
