"""The crawl as one stateful stream: what is known of a url is its state, and what it sends to others comes back as input.

Messages arrive as Parquet files in a folder, in any order and more than once:

* link: the page `url` links to `to`
* reach: `url` is a seed, or a page that was reached links to it; `seq` is when
* hint: a hint about `url`, given at `seq`

State for each url, in RocksDB: its links, when it was reached, and hints by the time they were given. When a url is reached, or a
reached one gets a new link, it sends a reach to the other end. A micro-batch writes these messages back to the folder, so that
batches go on until nothing is sent any more: that is the fixpoint, however the input was split. Of hints the last one
before the first visit counts; of those at one time the largest. Later ones are ignored, earlier ones that come late correct it, and so does
an earlier visit. With `patience` a timer looks at a url so many milliseconds after its first hint: one that was visited keeps only the hint
that counts, one that was not is given up and reported, and its hints are dropped.

Every message is idempotent, and a batch writes to a folder of its own number, so a batch that is repeated after a failure changes
nothing. A run that starts again from the checkpoint goes on where the last one ended.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

MESSAGE = "url string, kind string, to string, hint string, seq long"
EVENT = "url string, event string, to string, hint string, seq long"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Url(StatefulProcessor):
    """State and messages of one url."""

    def __init__(self, patience: int | None = None):
        self.patience = patience

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.links = handle.getMapState("links", "to string", "known boolean")
        self.reached = handle.getValueState("reached", "seq long")
        self.hints = handle.getMapState("hints", "seq long", "hint string")

    def _best(self) -> tuple | None:
        """The hint that counts now."""
        visit = self.reached.get()[0] if self.reached.exists() else None
        return max(((k[0], v[0]) for k, v in self.hints.iterator() if visit is None or k[0] < visit), default=None)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        url, out = key[0], []
        before = self._best()
        for part in rows:
            part = part.astype(object).where(part.notna(), None)
            for kind, to, hint, seq in zip(part["kind"], part["to"], part["hint"], part["seq"], strict=True):
                if kind == "link" and not self.links.containsKey((to,)):
                    self.links.updateValue((to,), (True,))
                    if self.reached.exists():
                        out.append((url, "send", to, None, None))
                elif kind == "reach":
                    self._reach(url, int(seq) if seq is not None else None, out)
                elif kind == "hint":
                    self._hint(hint, int(seq))
        now = self._best()
        if now != before and now is not None:
            out.append((url, "hint", None, now[1], now[0]))
        elif before is not None and now is None:
            out.append((url, "hint", None, None, None))
        if self.patience is not None and now is not None and before is None:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.patience)
        if out:
            yield pd.DataFrame(out, columns=[c.split()[0] for c in EVENT.split(", ")])

    def _reach(self, url: str, seq: int | None, out: list) -> None:
        """The first visit counts: one without a time is after all hints."""
        seq = (1 << 62) if seq is None else seq
        new = not self.reached.exists()
        if not new and self.reached.get()[0] <= seq:
            return
        self.reached.update((seq,))
        for k in [k for k in self.hints.keys() if k[0] >= seq]:
            self.hints.removeKey(k)
        if new:
            out.append((url, "reached", None, None, seq))
            out.extend((url, "send", k[0], None, None) for k in self.links.keys())

    def _hint(self, hint: str, seq: int) -> None:
        if self.reached.exists() and seq >= self.reached.get()[0]:
            return
        if not self.hints.containsKey((seq,)) or self.hints.getValue((seq,))[0] < hint:
            self.hints.updateValue((seq,), (hint,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        best = self._best()
        if best is None:
            return
        self.hints.clear()
        if self.reached.exists():
            self.hints.updateValue((best[0],), (best[1],))
        else:
            yield pd.DataFrame([(key[0], "given_up", None, None, None)], columns=[c.split()[0] for c in EVENT.split(", ")])

    def close(self) -> None:
        pass


def put(messages: DataFrame, inbox: str) -> None:
    """Adds messages; columns that are not there are null."""
    names = [c.split() for c in MESSAGE.split(", ")]
    messages.select(*[(F.col(n) if n in messages.columns else F.lit(None)).cast(t).alias(n) for n, t in names]).write.mode("append").parquet(f"{inbox}/part=in")


def _once(spark: SparkSession, inbox: str, checkpoint: str, events: str, patience: int | None) -> int:
    """One run over what is there; how many messages it sent."""
    sent = []

    def batch(rows: DataFrame, epoch: int) -> None:
        path = f"{events}/epoch={epoch}"
        rows.write.mode("overwrite").parquet(path)
        send = spark.read.schema(EVENT).parquet(path).where("event = 'send'").select(F.col("to").alias("url"), F.lit("reach").alias("kind")).distinct()
        n = send.count()
        if n:
            send.select("url", "kind", *[F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in MESSAGE.split(", ")[2:])]).write.mode("overwrite").parquet(f"{inbox}/part=sent-{epoch}")
        sent.append(n)

    arriving = spark.readStream.schema(MESSAGE).parquet(inbox).drop("part")
    state = arriving.groupBy("url").transformWithStateInPandas(statefulProcessor=Url(patience), outputStructType=EVENT, outputMode="Update", timeMode="ProcessingTime" if patience is not None else "None")
    query = state.writeStream.foreachBatch(batch).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(sent)


def run(spark: SparkSession, inbox: str, checkpoint: str, events: str, patience: int | None = None) -> None:
    """Runs over the messages that are there, and those that are sent meanwhile, until none is."""
    # timers are looked at when messages come: batches without any would follow one another for ever
    own = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    old = {k: spark.conf.get(k) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        while _once(spark, inbox, checkpoint, events, patience):
            pass
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def _events(spark: SparkSession, events: str) -> DataFrame:
    return spark.read.schema(f"{EVENT}, epoch long").parquet(events)


def reached(spark: SparkSession, events: str) -> DataFrame:
    """The urls that were reached."""
    return _events(spark, events).where("event = 'reached'").select("url").distinct()


def hints(spark: SparkSession, events: str) -> DataFrame:
    """url and the hint that counts, as the last batch that changed it says."""
    last = _events(spark, events).where("event = 'hint'").groupBy("url").agg(F.max_by("hint", "epoch").alias("hint"))
    return last.where("hint is not null")
