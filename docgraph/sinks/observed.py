"""Counts that come out of a write itself: rows by source, kind or note, without a second scan.

    df, counts = observed(df, {"kind": (F.col("kind"), ["class", "enum"])})
    df.write.parquet(path)
    counts()                      # {"rows": 12, "kind=class": 7, "kind=enum": 3, "kind=*": 2}

An axis is a column with the values that are counted one by one; other values, and nulls, are `*`. Spark's observed metrics hold them: they
are sums of each task and reach the driver with its end, so that their size depends on the axes alone. counts() waits for the first action on
df, and is of that action. A stream reports the metrics of each micro-batch to its listeners; Listener adds them up by name.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

Axes = dict[str, tuple[Column, list[str]]]


def metrics(axes: Axes) -> list[Column]:
    out = [F.count(F.lit(1)).alias("rows")]
    for axis, (column, values) in axes.items():
        out += [F.count_if(column == v).alias(f"{axis}={v}") for v in values]
        out.append(F.count_if(~F.coalesce(column.isin(*values), F.lit(False))).alias(f"{axis}=*"))
    return out


def observed(df: DataFrame, axes: Axes) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """df, and a function that gives the counts of the first action on it."""
    seen = Observation()
    return df.observe(seen, *metrics(axes)), lambda: dict(seen.get)


class Listener(StreamingQueryListener):
    """Adds up the metrics of streams that observe under a name, batch by batch; a batch that is reported again counts once."""

    def __init__(self, name: str):
        self.name, self.batches, self._lock = name, {}, threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is not None:
            with self._lock:
                self.batches[event.progress.id, event.progress.batchId] = row.asDict()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def counts(self) -> dict[str, int]:
        out: dict[str, int] = {}
        with self._lock:
            for row in self.batches.values():
                for k, v in row.items():
                    out[k] = out.get(k, 0) + v
        return out
