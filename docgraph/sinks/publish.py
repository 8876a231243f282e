"""Whole runs published at once: what a reader finds is of one run, or of the one before, and never of both.

A run writes each of its outputs to a new path in a folder of its own, and names it. At its end all names, those of the run and those
that it left as they were, are published as one small file of the next version number, which is created exclusively: of two
runs that end at once the second one raises. A run that fails publishes nothing; a file that was cut off while it was written is no version. Readers ask
for the path of a name in the last version. Older runs stay for their readers until vacuum().
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _listed(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


def _version(spark: SparkSession, out: str, name: str) -> dict[str, str] | None:
    try:
        text = spark.read.text(f"{out}/published/{name}", wholetext=True).first()
        return json.loads(text[0])["names"] if text else None
    except ValueError:
        return None


def published(spark: SparkSession, out: str) -> tuple[int, dict[str, str]]:
    """(number, name -> path below out) of the last version; number 0 without any."""
    for name in reversed(_listed(spark, f"{out}/published")):
        if (names := _version(spark, out, name)) is not None:
            return int(name.split(".")[0]), names
    return 0, {}


def path(spark: SparkSession, out: str, name: str) -> str | None:
    """Where the last version has an output of this name."""
    found = published(spark, out)[1].get(name)
    return f"{out}/{found}" if found else None


class Run:
    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out.rstrip("/")
        self.began, self.before = published(spark, out)
        self.folder, self.made = f"runs/{uuid.uuid4().hex}", {}

    def new(self, name: str) -> str:
        """A path to write an output of this name to; a later one takes its place."""
        self.made[name] = f"{self.folder}/{name}" if name not in self.made else f"{self.folder}/{len(self.made)}-{uuid.uuid4().hex[:8]}/{name}"
        return f"{self.out}/{self.made[name]}"

    def find(self, name: str) -> str | None:
        """Where this run, or else the last version when it began, has an output."""
        found = self.made.get(name) or self.before.get(name)
        return f"{self.out}/{found}" if found else None

    def commit(self) -> None:
        """Publishes all names, if no other run was published since this one began."""
        taken = [int(x.split(".")[0]) for x in _listed(self.spark, f"{self.out}/published")]
        if published(self.spark, self.out)[0] != self.began:
            raise RuntimeError("another run was published meanwhile")
        fs, p = _fs(self.spark, f"{self.out}/published/{max([self.began, *taken]) + 1:08}.json")
        stream = fs.create(p, False)  # exclusively
        stream.write(bytearray(json.dumps({"names": self.before | self.made}, indent=1).encode()))
        stream.close()


@contextmanager
def run(spark: SparkSession, out: str | Run) -> Iterator[Run]:
    """A run that is published at the end; within another run, that one."""
    if isinstance(out, Run):
        yield out
        return
    own = Run(spark, out)
    yield own
    own.commit()


def vacuum(spark: SparkSession, out: str, keep: int = 2) -> list[str]:
    """Deletes the folders of runs that none of the last `keep` versions names, and returns them. Runs that have begun and are not
    published yet must not be under way."""
    versions = [n for n in map(lambda x: _version(spark, out, x), reversed(_listed(spark, f"{out}/published"))) if n is not None][:keep]
    used = {"/".join(p.split("/")[:2]) for names in versions for p in names.values()}
    gone = [f"runs/{x}" for x in _listed(spark, f"{out}/runs") if f"runs/{x}" not in used]
    for x in gone:
        fs, p = _fs(spark, f"{out}/{x}")
        fs.delete(p, True)
    return gone
