"""Progress of a crawl as windows over its log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import share


def rates(log: DataFrame, key: list[str] | None = None, order: str = "seq", elapsed: str = "elapsed", pages: str = "pages", lag: int = 6) -> DataFrame:
    """Trailing and overall pages a second. The trailing one looks `lag` samples back, or at the start (0 pages, 0 s).

    Where no time has passed the rate is 0.
    """
    w = (Window.partitionBy(*key) if key else Window.partitionBy(F.lit(0))).orderBy(order)
    back = lambda c: F.coalesce(F.lag(c, lag).over(w), F.lit(0))
    dt, dp = F.col(elapsed) - back(elapsed), F.col(pages) - back(pages)
    return log.withColumn("trailing_rate", F.when(dt > 0, dp / dt).otherwise(0.0)).withColumn("overall_rate", F.when(F.col(elapsed) > 0, F.col(pages) / F.col(elapsed)).otherwise(0.0))


def trailing_mean(log: DataFrame, value: str, key: list[str], order: str = "seq", last: int = 50, fallback: float | None = None, ranges: int = 64) -> DataFrame:
    """Mean of the last `last` values of the row's key; the fallback where there is none.

    The order is cut into `ranges` ranges, and each range of a key gets the last values of the key before it, so that
    keys of few values and very many rows are not one task each.
    """
    share = [k / ranges for k in range(1, ranges)]
    bounds = log.agg(F.percentile_approx(order, F.array(*map(F.lit, share)), F.lit(1000)).alias("b")).first().b or []
    rows = log.withColumn("_range", F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < F.col(order))) if bounds else F.lit(0))
    place = Window.partitionBy(*key, "_range").orderBy(F.desc(order))
    ends = rows.select(*key, "_range", order, value, F.row_number().over(place).alias("_n")).where(F.col("_n") < last)
    ends = ends.groupBy(*key, "_range").agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v")))).alias("tail"))
    # of a key at most `ranges` lists of less than `last` values
    tails = ends.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("_range", "tail"))).alias("all")).withColumn("own", F.explode("all"))
    before = F.flatten(F.transform(F.filter("all", lambda x: x["_range"] < F.col("own._range")), lambda x: x["tail"]))
    carried_in = tails.select(*key, F.col("own._range").alias("_range"), F.explode(F.slice(before, F.greatest(F.size(before) - (last - 2), F.lit(1)), last - 1)).alias("x")).select(*key, "_range", F.col("x.o").alias(order), F.col("x.v").alias(value), F.lit(False).alias("_own"))
    w = Window.partitionBy(*key, "_range").orderBy(order, "_own").rowsBetween(1 - last, 0)
    both = rows.withColumn("_own", F.lit(True)).unionByName(carried_in, allowMissingColumns=True)
    return both.withColumn("trailing_mean", F.coalesce(F.avg(value).over(w), F.lit(fallback))).where("_own").drop("_own", "_range")


def carried(rows: DataFrame, value, key: list[str], order: str, as_: str, default: str | None = None) -> DataFrame:
    """The last value so far that is not null, such as the heading above a row."""
    w = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(as_, F.coalesce(F.last(value, True).over(w), F.lit(default)))


def regions(starts: DataFrame, key: list[str], start: str = "start", end: str = "length") -> DataFrame:
    """Each start with the next one of its key, or the end."""
    return starts.withColumn("stop", F.coalesce(F.lead(start).over(Window.partitionBy(*key).orderBy(start)), F.col(end)))


def due(log: DataFrame, every: int = 25, gap: float = 30.0) -> DataFrame:
    """Rows at which a checkpoint by count alone is due: each multiple of `every` pages, kept if `gap` seconds passed
    since the last kept one. The fold is sequential over one run's own few samples."""
    rows = log.where(F.col("pages") % every == 0).groupBy("run").agg(F.array_sort(F.collect_list(F.struct("elapsed", "pages"))).alias("s"))
    start = F.struct(F.lit(None).cast("double").alias("at"), F.array().cast("array<struct<elapsed:double,pages:bigint>>").alias("kept"))
    ok = lambda a, x: a["at"].isNull() | (x["elapsed"] - a["at"] >= gap)
    fold = F.aggregate("s", start, lambda a, x: F.struct(F.when(ok(a, x), x["elapsed"]).otherwise(a["at"]).alias("at"), F.when(ok(a, x), F.array_append(a["kept"], x)).otherwise(a["kept"]).alias("kept")))
    return rows.select("run", F.explode(fold["kept"]).alias("k")).select("run", "k.*")


__all__ = ["rates", "trailing_mean", "carried", "regions", "due", "share"]
