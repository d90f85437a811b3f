"""Names for images through a model client, with the rule as fallback."""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.core.tidying import NAME_LENGTH
from quire.functions import text as T
from quire.plans.retry import retried

Client = Callable[[str], str]


def tidy(answer: str | None, length: int) -> str:
    """A model's answer as a name: ideographs, letters and digits of its first line, cut to `length`."""
    first = (answer or "").strip().split("\n")[0]
    return re.sub(r"[^\w一-鿿]|_", "", first)[:length]


def named(images: DataFrame, load: Callable[[], Client] | None = None, length: int = NAME_LENGTH) -> DataFrame:
    """images (context, context_before, context_after ...) with `name`.

    The client of `load` is made once per task and asked once for each context, again after errors of the connection;
    where there is none, it fails, or less than two characters of its answer are left, the rule names the image.
    """
    ruled = images.drop("name").withColumn("name", T.image_name(F.col("context_before"), F.col("context_after"), length))
    if load is None:
        return ruled

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = load()

        @functools.lru_cache(maxsize=10_000)
        def asked(context: str) -> str:
            try:
                return tidy(retried(lambda: client(context)), length)
            except Exception:  # noqa: BLE001  the rule takes over
                return ""

        for b in batches:
            yield b.assign(name=[said if len(said := asked(c)) > 1 else rule for c, rule in zip(b["context"], b["name"])])

    return ruled.mapInPandas(run, ruled.schema)
