"""The resolved graph kept up to date by signed deltas: a batch costs what it changes, not what there is.

A batch adds nodes and edges, or takes them away with negative counts. How a target name resolves (`resolve.two_pass`) depends on the nodes of
that whole name and of its short name alone, so a batch can only change names that share a short name with one of its nodes: one that
becomes known, a short name that gets its only node, or one that becomes ambiguous because a second node has it. Of these names the edges are
taken back from where they pointed and added where they point now.

Three tables of signed counts, appended to and never rewritten, hold everything: nodes (full and short name), edges by source and target name,
and the result, edges by source and resolved target. The first two lie in folders by a hash of the short name, the third by that of the
source; a batch reads only the folders of its short names. Each batch has a number, and writes folders of that number: a batch that is repeated
after a failure replaces what it had written, and what later batches read is summed, so their order does not matter for counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import short_name
from .lineage import cut
from .resolve import two_pass

NODES = "full string, short string, n long, epoch long, bucket int"
EDGES = "source string, target string, tier string, n long, epoch long, bucket int"
RESOLVED = "source string, target string, tier string, how string, n long, epoch long, bucket int"


class Maintained:
    """The tables in a folder; buckets: folders of each."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 256):
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets

    def _bucket(self, name: Column) -> Column:
        return F.pmod(F.xxhash64(F.coalesce(name, F.lit(""))), F.lit(self.buckets)).cast("int")

    def _write(self, df: DataFrame, table: str, by: Column, epoch: int) -> None:
        df.withColumn("bucket", self._bucket(by)).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/{table}/epoch={epoch}")

    def read(self, table: str, schema: str, below: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """Rows of the batches before `below`, of some buckets."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{table}")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], schema)
        df = self.spark.read.schema(schema).parquet(f"{self.folder}/{table}")
        df = df.where(F.col("epoch") < below) if below is not None else df
        return df.where(F.col("bucket").isin(buckets)) if buckets is not None else df

    @staticmethod
    def _known(rows: DataFrame) -> DataFrame:
        """A row for each node that is there, as often as it is."""
        left = rows.groupBy("full", "short").agg(F.sum("n").alias("n")).where("n > 0")
        # two_pass asks whether one node alone has a name: a second row tells as much as many
        return left.select("full", "short", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(2)).cast("int"))).alias("_")).drop("_")

    @staticmethod
    def _resolved(names: DataFrame, known: DataFrame) -> DataFrame:
        """target, end and how of distinct target names."""
        out = two_pass(names, "target", known, "full", "short", as_="t")
        return out.select("target", F.when(F.col("t_how") != "none", F.coalesce("t", "target")).alias("end"), F.col("t_how").alias("how"))

    def apply(self, nodes: DataFrame, edges: DataFrame, epoch: int) -> DataFrame:
        """Takes in nodes (full, short, n) and edges (source, target, tier, n) as batch `epoch`; returns the signed changes of the result."""
        nodes = cut(nodes.groupBy("full", "short").agg(F.sum("n").alias("n")).where("n <> 0"))
        edges = cut(edges.groupBy("source", "target", "tier").agg(F.sum("n").alias("n")).where("n <> 0"))
        of = lambda df, c: [r[0] for r in df.select(self._bucket(c)).distinct().toLocalIterator()]  # noqa: E731  at most `buckets` numbers
        touched = of(nodes, F.col("short"))
        old_nodes = self.read("nodes", NODES, epoch, sorted({*touched, *of(edges, short_name(F.col("target")))})).select("full", "short", "n")
        before, after = self._known(old_nodes), self._known(old_nodes.union(nodes))
        old_edges = self.read("edges", EDGES, epoch, sorted(touched)).select("source", "target", "tier", "n", short_name(F.col("target")).alias("short"))
        at_risk = old_edges.join(nodes.select("short").distinct(), "short", "left_semi").groupBy("source", "target", "tier").agg(F.sum("n").alias("n")).where("n <> 0")
        at_risk = cut(at_risk)
        names = at_risk.select("target").distinct()
        was, now = self._resolved(names, before), self._resolved(names, after).withColumnsRenamed({"end": "to", "how": "to_how"})
        moved = cut(was.join(now, "target").where("not (end <=> to) or how <> to_how"))
        back = at_risk.join(moved, "target").select("source", "tier", "n", F.explode(F.array(F.struct(F.col("end").alias("target"), F.col("how"), F.lit(-1).alias("sign")), F.struct(F.col("to").alias("target"), F.col("to_how").alias("how"), F.lit(1).alias("sign")))).alias("x"))
        back = back.select("source", "x.target", "tier", "x.how", (F.col("n") * F.col("x.sign")).alias("n"))
        fresh = edges.withColumn("key", F.coalesce("target", F.lit("")))
        ends = self._resolved(fresh.select(F.col("key").alias("target")).distinct(), after).withColumnRenamed("target", "key")
        added = fresh.join(ends, "key").select("source", F.col("end").alias("target"), "tier", "how", "n")
        changes = cut(back.union(added).groupBy("source", "target", "tier", "how").agg(F.sum("n").alias("n")).where("n <> 0"))
        self._write(changes, "resolved", F.col("source"), epoch)
        self._write(edges, "edges", short_name(F.col("target")), epoch)
        self._write(nodes, "nodes", F.col("short"), epoch)
        return changes

    def result(self) -> DataFrame:
        """source, target, tier, how and n of the edges as they are now."""
        return self.read("resolved", RESOLVED).groupBy("source", "target", "tier", "how").agg(F.sum("n").alias("n")).where("n <> 0")

    def projection(self, tier: str | None = None) -> DataFrame:
        """Undirected edges a < b with their multiplicity."""
        e = self.result().where("source <> target")
        e = e.where(F.col("tier") == tier) if tier else e
        return e.groupBy(F.least("source", "target").alias("a"), F.greatest("source", "target").alias("b")).agg(F.sum("n").alias("weight"))

    def stubs(self) -> DataFrame:
        """Ends of edges that are no known node."""
        e = self.result()
        known = self._known(self.read("nodes", NODES).select("full", "short", "n"))
        return e.select(F.col("source").alias("id")).union(e.select("target")).where("id <> ''").distinct().join(known.select(F.col("full").alias("id")), "id", "left_anti")
