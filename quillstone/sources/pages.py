"""A store of pages: Markdown files with a YAML head, written whole or not at all, retired to an archive, indexed by hash.

Files lie where all executors see them. One writer at a time is taken for granted; readers never see half a page, as a
page is written beside its place and then moved there.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ARCHIVE = "_retired"
HEAD = r"(?s)^---\n(.*?)\n---\n?(.*)$"


class PageStore:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def write(self, name: str, fields: dict[str, str], body: str) -> None:
        """Puts a page in its place, instead of the one there."""
        import yaml

        head = yaml.safe_dump(fields, allow_unicode=True, sort_keys=True)
        beside, place = self._path(f"{self.root}/_{uuid.uuid4().hex}.part"), self._path(f"{self.root}/{name}.md")
        stream = self._files.create(beside)
        stream.write(f"---\n{head}---\n{body}".encode())
        stream.close()
        self._move(beside, place)

    def retire(self, name: str) -> None:
        """Moves a page to the archive, where it keeps its name and gets a number."""
        place, old = self._path(f"{self.root}/{name}.md"), self._path(f"{self.root}/{ARCHIVE}")
        if not self._files.exists(place):
            raise FileNotFoundError(name)
        self._files.mkdirs(old)
        n = sum(1 for f in self._files.listStatus(old) if f.getPath().getName().startswith(f"{name}."))
        self._move(place, self._path(f"{self.root}/{ARCHIVE}/{name}.{n + 1}.md"))

    def _move(self, source, target) -> None:
        if self._files.exists(target):
            self._files.delete(target, False)
        if not self._files.rename(source, target):
            raise OSError(f"can't move {source} to {target}")

    def index(self, retired: bool = False) -> DataFrame:
        """(name, checksum, head, body) of the pages in place, or of those retired: names or hashes find a page."""
        where = f"{self.root}/{ARCHIVE}" if retired else self.root
        schema = "name string, checksum string, head string, body string"
        if not any(f.getPath().getName().endswith(".md") for f in (self._files.listStatus(self._path(where)) if self._files.exists(self._path(where)) else [])):
            return self.spark.createDataFrame([], schema)
        raw = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.md").load(where)
        text = F.decode("content", "UTF-8")
        return raw.select(F.regexp_extract("path", r"([^/]+)\.md$", 1).alias("name"), F.sha2("content", 256).alias("checksum"), F.regexp_extract(text, HEAD, 1).alias("head"), F.regexp_extract(text, HEAD, 2).alias("body"))

    def known(self, checksums: DataFrame) -> DataFrame:
        """Those of checksums (checksum) that a page in place has, with its name."""
        return checksums.join(self.index().select("checksum", "name"), "checksum")
