"""What the operators share: tables, the shared folder, Arrow stages, connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Bytes of an Arrow batch between Spark and Python: a batch of long texts must not fill a worker.
ARROW_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder; Arrow batches of the session are held to ARROW_BYTES."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a temporary folder in local mode
    (tests) and an error on a cluster, whose machines share none."""
    if at := spark.conf.get("spark.checkpoint.dir", None):
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{tempfile.gettempdir()}/docgraph-shared"


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of Hadoop for a path of any scheme."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def scratch(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder; it is deleted when the driver ends."""
    path = f"{shared_dir(spark)}/docgraph/{what}-{uuid.uuid4().hex}"
    fs, p = hadoop_path(spark, path)
    fs.deleteOnExit(p)
    return path


def cut(df: DataFrame, what: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back: later work does not depend on executors that are lost."""
    path = scratch(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, df: DataFrame) -> None:
    """Deletes the table behind a cut() that nothing reads any more."""
    for f in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        fs, p = hadoop_path(spark, f)
        fs.delete(p, True)


#: Files whose names are sent to the executors; a name has some hundred bytes.
FILES = 50_000


def _scan_of_files(df: DataFrame) -> bool:
    """Whether the rows of df are rows of stored files, projected and filtered at most."""
    plan = df._jdf.queryExecution().analyzed()
    if not plan.deterministic():
        return False
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    return plan.nodeName() == "LogicalRelation"


def free_name(df: DataFrame, name: str) -> str:
    """A name like `name` that no column of df has."""
    taken = {c.lower() for c in df.columns}
    return next(x for k in range(len(taken) + 1) if (x := f"{name}{k or ''}") not in taken)


def numbered(df: DataFrame, rid: str = "rid", what: str = "rows") -> DataFrame:
    """df with a number `rid` for each row, which stays that row's own in all later jobs.

    A number by partition would not: how files are split follows the size of the cluster when they are read. Rows of Parquet
    files are numbered by file and place in it; all others, and those of more than FILES files, are numbered once and written
    with their numbers.
    """
    file, row = free_name(df, "_file"), free_name(df, "_row")
    files = sorted(df.inputFiles()) if _scan_of_files(df) else []
    if 0 < len(files) <= FILES:
        try:
            at = df.metadataColumn("_metadata")
            placed = df.select("*", at["file_path"].alias(file), at["row_index"].alias(row))
        except AnalysisException:  # of another format
            return cut(df.withColumn(rid, F.monotonically_increasing_id()), what)
        path = F.regexp_replace("f", "^file:/+", "file:/").alias(file)
        number = df.sparkSession.createDataFrame(list(enumerate(files)), "k long, f string").select(path, F.col("k").alias(k := free_name(df, "_k")))
        own = F.shiftleft(k, 40).bitwiseOR(F.col(row))
        of = F.when(F.col(k).isNull(), F.raise_error(F.concat(F.lit("not among the files of the table: "), file))).otherwise(own)
        return placed.join(F.broadcast(number), file, "left").select(*[f"`{c}`" for c in df.columns], of.alias(rid))
    return cut(df.withColumn(rid, F.monotonically_increasing_id()), what)


def held_out(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string").cast("binary")) % 4 == 2


def by_bytes(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have about `most` bytes together; one row at least."""
    import pyarrow.compute as pc

    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    k, n = 0, batch.num_rows
    while k < n:
        j = max(k + 1, int(np.searchsorted(size, (size[k - 1] if k else 0) + most, "right")))
        yield batch.slice(k, j - k)
        k = j


def arrow_map(df: DataFrame, f: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, text: str | None = None) -> DataFrame:
    """df.mapInArrow with f for each batch, cut to a few MB of the column `text`."""

    def run(batches):
        for batch in batches:
            for part in by_bytes(batch, text) if text else [batch]:
                if part.num_rows and (out := f(part)) is not None:
                    yield out

    return df.mapInArrow(run, schema)


#: Parts to which the rows of one key are dealt where they are joined.
PARTS = 32


def _salted(df: DataFrame, by: str) -> DataFrame:
    return df.withColumn("_part", F.pmod(F.xxhash64(by), F.lit(PARTS)).cast("int"))


def _mask():
    """The parts that have rows, as bits of a long."""
    return F.expr("bit_or(shiftleft(1L, _part))").alias("_parts")


def _each():
    """A row for each of these parts."""
    return F.expr(f"explode(filter(sequence(0, {PARTS - 1}), i -> (shiftright(_parts, i) & 1L) = 1L))").alias("_part")


def join_hot(rows: DataFrame, per_key: DataFrame, keys: list[str], by: str, how: str = "inner") -> DataFrame:
    """rows joined with per_key on keys, where one key may have any share of the rows.

    They are dealt by the column `by` to PARTS parts; what per_key has for a key is sent to the parts that have rows of it.
    """
    own = _salted(rows, by)
    there = own.groupBy(*keys).agg(_mask())
    sent = per_key.join(there, keys).select(*per_key.columns, _each())
    return own.join(sent, [*keys, "_part"], how).drop("_part")


def _stars(batches):
    """The edges (u, v) of a partition as stars: every node with the smallest node that the partition links it with."""
    got = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if not got:
        return
    u, v = (np.concatenate(x) for x in zip(*got, strict=True))
    ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    u, v = at[: len(u)], at[len(u) :]
    root = np.arange(len(ids))
    while len(u):
        a, b = root[u], root[v]
        apart = a != b
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        to = np.arange(len(ids))
        np.minimum.at(to, np.maximum(a, b), np.minimum(a, b))  # a larger root hooks onto a smaller one
        while (to[to] != to).any():
            to = to[to]
        root = to[root]
    own = np.flatnonzero(root != np.arange(len(ids)))
    yield pa.RecordBatch.from_arrays([pa.array(ids[root[own]]), pa.array(ids[own])], ["u", "v"])


#: Edges that one task contracts to the end.
FEW = 1 << 14


def components(edges: DataFrame, a: str = "a", b: str = "b", what: str = "cc", few: int = FEW) -> DataFrame:
    """Connected components of undirected edges: (node, component = smallest reachable node).

    Edges are contracted within each partition first. Then alternating large-star and small-star rounds; every round is
    cut to the shared folder, and where at most `few` edges are left one task ends it. Edges only shrink in number, the
    edges of a hub are dealt to parts, nothing comes to the driver but a signature of each round. Nodes without edges are
    not returned; loops and nulls are ignored.
    """
    spark = edges.sparkSession
    e = edges.select(F.least(a, b).cast("long").alias("u"), F.greatest(a, b).cast("long").alias("v")).where("u is not null and v is not null and u <> v")
    e = cut(e.mapInArrow(_stars, "u long, v long"), what)
    sign = lambda e: tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v") % 1000003)).first())
    last = sign(e)
    while last[0] > few:
        both = _salted(e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v"))), "v")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), _mask())
        # large star: neighbours above u go to the smallest neighbour of u
        large = _salted(e, "v").join(low.select("u", "m", _each()), ["u", "_part"]).select(F.col("m").alias("u"), "v").where("u <> v")
        # small star: u and its smaller neighbours go to the smallest of them
        large = _salted(large.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).union(low.where("m <> u").select(F.col("m").alias("u"), F.col("u").alias("v"))), "u")
        least = large.groupBy("v").agg(F.min("u").alias("m"), _mask())
        small = large.join(least.select("v", "m", _each()), ["v", "_part"]).select(F.col("m").alias("u"), F.col("u").alias("v")).where("u <> v").union(least.select(F.col("m").alias("u"), F.col("v"))).distinct()
        new = cut(small, what)
        forget(spark, e)
        e, before, last = new, last, sign(new)
        if last == before:
            break
    else:
        e = cut(e.coalesce(1).mapInArrow(_stars, "u long, v long"), what)
    return e.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("component")).union(e.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())


def named(nodes: DataFrame, group: DataFrame, node: str, name: str) -> DataFrame:
    """nodes with `_least`, the smallest `name` of all nodes of their component.

    nodes: a row for each node; group: (node, component) of components(), without lone nodes.
    """
    of = nodes.join(group.select(F.col("node").alias(node), "component"), node, "left").withColumn("_of", F.coalesce("component", node))
    return join_hot(of, of.groupBy("_of").agg(F.min(name).alias("_least")), ["_of"], node).drop("_of", "component")
