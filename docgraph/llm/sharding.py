"""Sharding with size-tiered compaction and an atomically committed, versioned manifest. DataFrame operations only.

A store is a folder: data/ holds immutable Parquet shards, tables/ the manifests (one row for each live shard),
commits/ one small file for each version that names its manifest table. A version exists from the moment its commit
file is renamed into place, which fails if another writer was first; then the work is planned again on the newer
version. Readers see one version whole; a lost executor or driver leaves at most files that no version names.

append() writes arrivals as small shards. compact() puts shards into tiers by size, each `fan_in` times as large as the
one below; a tier with `fan_in` shards or more is merged into files of about `target` bytes (of the tier's whole size,
if that is less). Similarly sized shards are merged by reading several to a task: no row is shuffled. Shards of half
the target or more are left alone, so every row is rewritten a logarithmic number of times.

A later arrival may have further columns: the schema of the store grows, and older rows read them as null. A column that comes
back with another type, or with the same name in other letters, is refused.

vacuum() deletes what only expired versions name, file by file, and these versions. Files that no version names may belong to a
writer that has not committed yet: they go only when they are older than `age`. A writer whose base version expires while it
works plans again on the newest one; a reader of an expired version must start again.

Commits need a file system whose rename fails if the target exists (HDFS, local disks, stores with a hierarchical name space);
on object stores without that, two writers at once are not safe.

Nulls, empty texts, very long texts, repeated rows and further columns of any name are kept as they are; a column
without a type becomes string. Ties have no effect. An empty table adds no shard, and reads back as empty with its columns.
The order of rows is not kept. Sizes and paths of shards, not rows, are what comes to the driver.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from . import common

TARGET, FAN_IN, LEAST, ROWS = 128 << 20, 4, 64 << 10, 4000
#: Seconds for which files that no version names are kept, for writers that have not committed yet.
AGE = 7 * 24 * 3600
MANIFEST = "path string, bytes long, rows long, tier int, added long"


def grown(old: StructType | None, new: StructType) -> StructType:
    """The columns of old, and those that new has besides; ValueError if they contradict each other."""
    if old is None:
        return new
    known = {f.name.lower(): f for f in old}
    more = []
    for f in new:
        own = known.setdefault(f.name.lower(), f)
        if own is f:
            more.append(f)
        elif own.name != f.name or own.dataType.simpleString() != f.dataType.simpleString():
            raise ValueError(f"column {f.name} of {f.dataType.simpleString()} against {own.name} of {own.dataType.simpleString()}")
    return StructType([StructField(f.name, f.dataType, True) for f in [*old, *more]])


class Store:
    def __init__(self, spark: SparkSession, root: str, target: int = TARGET, fan_in: int = FAN_IN, least: int = LEAST):
        self.spark, self.root, self.target, self.fan_in, self.least = spark, root.rstrip("/"), target, fan_in, least
        self.fs, _ = common.hadoop_path(spark, self.root)

    def path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    # versions

    def versions(self) -> list[int]:
        """All versions that have not expired, in order."""
        at = self.path("commits")
        names = [x.getPath().getName() for x in self.fs.listStatus(at)] if self.fs.exists(at) else []
        return sorted(int(x[1:9]) for x in names if x.endswith(".json") and not x.startswith("."))

    def version(self) -> int:
        """The newest version, 0 for a new store."""
        return max(self.versions(), default=0)

    def _commit_file(self, version: int) -> dict:
        text = self.spark.read.text("/".join([self.root, "commits", f"v{version:08d}.json"]), wholetext=True).first()[0]
        return json.loads(text)

    def manifest(self, version: int | None = None) -> DataFrame:
        """The live shards of a version."""
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet("/".join([self.root, self._commit_file(version)["table"]]))

    def schema(self, version: int | None = None) -> StructType | None:
        version = self.version() if version is None else version
        return StructType.fromJson(self._commit_file(version)["schema"]) if version else None

    def read(self, version: int | None = None) -> DataFrame | None:
        """The rows of a version; None for a store without one."""
        schema = self.schema(version)
        if schema is None:
            return None
        paths = [r.path for r in self.manifest(version).select("path").collect()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def commit(self, shards: DataFrame, schema, base: int) -> int:
        """Makes `shards` the version base + 1. FileExistsError if there is one already."""
        table = f"tables/{uuid.uuid4().hex}"
        shards.select("path", "bytes", "rows", "tier", "added").coalesce(1).write.parquet(f"{self.root}/{table}")
        name, draft = f"v{base + 1:08d}.json", f".{uuid.uuid4().hex}"
        self.fs.mkdirs(self.path("commits"))
        out = self.fs.create(self.path("commits", draft), False)
        out.write(json.dumps({"version": base + 1, "table": table, "schema": json.loads(schema.json())}).encode())
        out.close()
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path("commits").toUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(context.makeQualified(self.path("commits", draft)), context.makeQualified(self.path("commits", name)), none)
        except Exception as e:
            self.fs.delete(self.path("commits", draft), False)
            if self.fs.exists(self.path("commits", name)):
                raise FileExistsError(name) from e
            raise
        return base + 1

    # shards

    def _written(self, rows: DataFrame, version: int, most_rows: int = 0) -> DataFrame:
        """Writes rows as shards; their manifest rows."""
        at = f"{self.root}/data/{uuid.uuid4().hex}"
        (rows.write.option("maxRecordsPerFile", most_rows) if most_rows else rows.write).parquet(at)
        sizes = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(at).select("path", F.col("length").alias("bytes"))
        counts = self.spark.read.schema(rows.schema).parquet(at).groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("rows"))
        name = lambda c: F.substring_index(c, "/", -1)
        return sizes.join(counts, name(F.col("path")) == name(F.col("file"))).select("path", "bytes", "rows", self.tier(F.col("bytes")).alias("tier"), F.lit(version).cast("long").alias("added"))

    def tier(self, bytes_):
        return F.floor(F.log(F.greatest(bytes_ / self.least, F.lit(1.0))) / F.log(F.lit(float(self.fan_in)))).cast("int")

    def append(self, rows: DataFrame, most_rows: int = ROWS) -> int:
        """Adds rows as small shards; the new version."""
        rows = rows.select(*[F.col(f"`{c}`").cast("string") if t == "void" else F.col(f"`{c}`") for c, t in rows.dtypes])
        base = self.version()
        grown(self.schema(base), rows.schema)  # refused before anything is written
        new = common.cut(self._written(rows, base + 1, most_rows), "shards-new")
        while True:
            try:
                return self.commit(self.manifest(base).union(new), grown(self.schema(base), rows.schema), base)
            except Exception as e:
                base = self._newer_than(base, e)

    def _newer_than(self, base: int, error: Exception) -> int:
        """The newest version; the error if there is none newer, so that another writer can't be its reason."""
        if (now := self.version()) <= base:
            raise error
        return now

    def compact(self) -> int:
        """Merges one tier, the lowest that has enough shards; the new version, or the same one if there is nothing to do."""
        while True:
            base = self.version()
            try:
                return self._compacted(base)
            except Exception as e:
                self._newer_than(base, e)

    def _compacted(self, base: int) -> int:
        small = self.manifest(base).where(F.col("bytes") < self.target // 2)
        tiers = small.groupBy("tier").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).where(F.col("n") >= self.fan_in)
        full = tiers.where(F.greatest(F.lit(1), F.round(F.col("bytes") / self.target)) < F.col("n")).orderBy("tier").first()
        if full is None:
            return base
        old = small.where(F.col("tier") == full.tier)
        paths = [r.path for r in old.select("path").orderBy("path").collect()]
        files = max(1, round(full.bytes / self.target))
        merged = self._written(self.spark.read.schema(self.schema(base)).parquet(*paths).coalesce(files), base + 1)
        kept = self.manifest(base).join(old.select("path"), "path", "left_anti").select("path", "bytes", "rows", "tier", "added")
        return self.commit(kept.union(merged), self.schema(base), base)

    def settle(self) -> int:
        """Compacts until no tier has enough shards, deleting what older versions alone used."""
        last, done = self.version(), -1
        while last != done:
            done, last = last, self.compact()
            self.vacuum()
        return last

    def vacuum(self, keep: int = 1, age: float = AGE) -> int:
        """Deletes all versions but the last `keep`, data files that only those name, and files of no version that are older
        than `age` seconds; how many data files."""
        versions = self.versions()
        old, kept = versions[: max(0, len(versions) - keep)], versions[max(0, len(versions) - keep) :]
        named = lambda vs: {"/".join(r.path.rsplit("/", 2)[-2:]) for v in vs for r in self.manifest(v).select("path").collect()}
        live = named(kept)
        dead, n, before = named(old) - live, 0, (time.time() - age) * 1000
        tables = {self._commit_file(v)["table"].rsplit("/", 1)[-1] for v in kept}
        expired = {self._commit_file(v)["table"].rsplit("/", 1)[-1] for v in old}
        for v in old:
            self.fs.delete(self.path("commits", f"v{v:08d}.json"), False)
        for folder in self.fs.listStatus(self.path("tables")) if versions else []:
            name = folder.getPath().getName()
            if name in expired or name not in tables and folder.getModificationTime() < before:
                self.fs.delete(folder.getPath(), True)
        for folder in self.fs.listStatus(self.path("data")) if self.fs.exists(self.path("data")) else []:
            files = [x for x in self.fs.listStatus(folder.getPath())]
            shards = [x for x in files if x.getPath().getName().endswith(".parquet")]
            gone = [x for x in shards if (name := f"{folder.getPath().getName()}/{x.getPath().getName()}") in dead or name not in live and x.getModificationTime() < before]
            for x in gone:
                self.fs.delete(x.getPath(), False)
            n += len(gone)
            if gone and len(gone) == len(shards):
                self.fs.delete(folder.getPath(), True)
        return n


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents arrive in four lots, are appended and compacted, and are read back through the manifest.

    shards_ok: every shard holds as many rows as the manifest says; compacted: no tier has shards left to merge.
    """
    store = Store(spark, common.scratch(spark, "shards"))
    docs = common.table(spark, sf_dir, "documents")
    for k in range(4):
        store.append(docs.where(F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(4)), F.lit(0)) == k))
    version = store.settle()
    shards = store.manifest(version)
    name = lambda c: F.substring_index(c, "/", -2)
    rows = store.read(version)
    real = rows.groupBy(name(F.input_file_name()).alias("file")).agg(F.count("*").alias("there"))
    bad = real.join(shards.select(name(F.col("path")).alias("file"), "rows"), "file", "full").where("not (there <=> rows)").count()
    left = shards.where(F.col("bytes") < store.target // 2).groupBy("tier").count().where(F.col("count") >= store.fan_in).count()
    return rows.select("doc_id", "lang", "source", "n_chars", F.md5(F.col("text").cast("binary")).alias("text_md5"), F.lit(bad == 0).alias("shards_ok"), F.lit(left == 0).alias("compacted"))


SQL = "SELECT doc_id, lang, source, n_chars, md5(text) AS text_md5, TRUE AS shards_ok, TRUE AS compacted FROM documents"
