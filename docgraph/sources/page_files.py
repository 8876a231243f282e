"""Cached pages as a data source of Spark: a folder of page files by host, which filters prune before any file is opened.

    pages.write...            # write_pages(pages, root): root/host=<host>/part-*.json, a JSON document with url and html on each line
    spark.dataSource.register(PageFiles)
    spark.read.format("page_files").option("path", root).load().where("host = 'h'")

A file is one input partition. Filters on the host (equal, one of, prefix) are taken over whole: files of other hosts are not opened. A prefix or
value of the url is taken over too: its host prunes files, and lines are compared as they are read. Everything else is
left to Spark. Malformed lines are rows with a null url, in which `html` is the line; a filter on the url drops them. Empty folders give no rows.

The files must be in a file system that all executors have mounted, such as a shared folder: Python opens them.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Iterator
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, StringStartsWith

SCHEMA = "host string, url string, html string"


def write_pages(pages: DataFrame, root: str) -> None:
    """Writes url and html of pages in a folder for each host."""
    host = F.coalesce(F.try_parse_url("url", F.lit("HOST")), F.lit(""))
    pages.select(host.alias("host"), F.to_json(F.struct("url", "html")).alias("value")).write.mode("overwrite").partitionBy("host").text(root)


class File(InputPartition):
    def __init__(self, path: str, host: str):
        self.path, self.host = path, host


class PageFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "page_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return Reader(self.options["path"])


class Reader(DataSourceReader):
    def __init__(self, path: str):
        self.root = path.removeprefix("file://").removeprefix("file:")
        self.hosts: list[tuple[str, object]] = []  # (how, value) that a host must meet
        self.urls: list[tuple[str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            column = getattr(f, "attribute", None)
            if isinstance(f, (EqualTo, In, StringStartsWith)) and column in (("host",), ("url",)):
                how = "in" if isinstance(f, (EqualTo, In)) else "prefix"
                value = (f.value,) if isinstance(f, EqualTo) else f.value
                (self.hosts if column == ("host",) else self.urls).append((how, value))
            elif isinstance(f, IsNotNull) and column == ("host",):
                pass  # a host is never null
            elif isinstance(f, IsNotNull) and column == ("url",):
                self.urls.append(("prefix", ""))
            else:
                yield f

    def wanted(self, host: str) -> bool:
        """Whether files of a host can have rows."""
        for how, value in self.hosts:
            if not (host in value if how == "in" else host.startswith(value)):
                return False
        for how, value in self.urls:
            if how == "in" and host not in {urlsplit(v).hostname or "" for v in value if v is not None}:
                return False
            if how == "prefix" and "://" in value:
                site = value.partition("://")[2].partition("/")[0]
                own = site.rpartition("@")[2].partition(":")[0].lower()
                if "/" in value.partition("://")[2] and host != own:
                    return False
        return True

    def fits(self, url: str | None) -> bool:
        return all(url is not None and (url in value if how == "in" else url.startswith(value)) for how, value in self.urls)

    def partitions(self) -> list[InputPartition]:
        out = []
        for folder in sorted(os.listdir(self.root)):
            if folder.startswith("host="):
                host = unquote(folder[5:])
                host = "" if host == "__HIVE_DEFAULT_PARTITION__" else host
                if self.wanted(host):
                    out += [File(os.path.join(self.root, folder, name), host) for name in sorted(os.listdir(os.path.join(self.root, folder))) if not name.startswith((".", "_"))]
        return out or [File("", "")]

    def read(self, partition: File) -> Iterator[tuple]:
        if not partition.path:
            return
        with open(partition.path, encoding="utf-8") as lines:
            for line in lines:
                line = line.rstrip("\n")
                try:
                    page = json.loads(line)
                    url, html = page.get("url"), page.get("html")
                except (ValueError, AttributeError):
                    url, html = None, line
                if self.fits(url):
                    yield partition.host, url, html


def load(spark: SparkSession, root: str) -> DataFrame:
    """The pages under root, as a table that takes filters over."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PageFiles)
    return spark.read.format("page_files").option("path", root).load()


__all__ = ["PageFiles", "load", "write_pages"]
