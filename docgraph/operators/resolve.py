"""Two-pass name resolution: the whole name, else the short name if only one has it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import short_name


def two_pass(left: DataFrame, name: str, known: DataFrame, full: str, short: str, *, allow_short: bool = True, dotted: bool = False, as_: str = "resolved") -> DataFrame:
    """left with as_ (the known full name or null) and as_ + "_how": exact, short_name_fallback, external or none.

    known: rows with a full and a short name. A short name is ambiguous when two rows have it, equal ones too. Both
    joins are equi-joins on aggregated sides, so no row of left is multiplied; Spark picks their strategy by size.
    """
    key: Column = F.replace(F.col(full), F.lit("+"), F.lit(".")) if dotted else F.col(full)
    exact = known.where(F.col(full).isNotNull()).groupBy(key.alias("_key")).agg(F.max(full).alias("_exact"))
    out = left.join(exact, F.col(name) == F.col("_key"), "left").drop("_key")
    if allow_short:
        alone = known.where(F.col(short).isNotNull()).groupBy(F.col(short).alias("_short")).agg(F.count("*").alias("_n"), F.first(full).alias("_by_short")).where("_n = 1").drop("_n")
        out = out.withColumn("_s", short_name(F.col(name))).join(alone, F.col("_s") == F.col("_short"), "left").drop("_s", "_short")
    else:
        out = out.withColumn("_by_short", F.lit(None).cast("string"))
    how = F.when(F.coalesce(F.col(name), F.lit("")) == "", "none").when(F.col("_exact").isNotNull(), "exact").when(F.col("_by_short").isNotNull(), "short_name_fallback").otherwise("external")
    found = F.when(F.coalesce(F.col(name), F.lit("")) != "", F.coalesce("_exact", "_by_short"))
    return out.withColumn(as_, found).withColumn(f"{as_}_how", how).drop("_exact", "_by_short")
