"""Readers and writers: folders, rosters, evaluation sets, traces and last-wins tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed sets of file name extensions.
ELECTRONIC = ("docx", "pdf", "html", "htm", "txt", "md")
PHOTO = ("jpg", "jpeg", "png", "tif", "tiff")


def dispatch(df: DataFrame, path: str = "path") -> DataFrame:
    """Adds source_kind (electronic or photo) by extension; anything else gets an error, never silence."""
    kind = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    return df.withColumns({"source_kind": F.when(kind.isin(*ELECTRONIC), "electronic").when(kind.isin(*PHOTO), "photo"), "error": F.when(~kind.isin(*ELECTRONIC, *PHOTO), F.concat(F.lit("unsupported: "), kind))})


def scan_folder(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256, source_kind, error) for each file of a folder; its contents aren't kept."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return dispatch(files.select("path", "length", F.sha2("content", 256).alias("sha256")))


def clean_roster(df: DataFrame, texts: list[str], dates: list[str]) -> DataFrame:
    """Trims texts (empty is null) and parses dates, of which only those of 10 characters count."""
    out = df.withColumns({c: F.nullif(F.trim(c), F.lit("")) for c in texts})
    return out.withColumns({c: F.when(F.length(F.trim(c)) == 10, F.trim(c).try_cast("date")) for c in dates})


def read_roster(spark: SparkSession, path: str, dates: list[str]) -> DataFrame:
    """A CSV roster with a header; a byte order mark is dropped and every column cleaned."""
    raw = spark.read.csv(path, header=True, encoding="UTF-8")
    raw = raw.toDF(*[c.lstrip("﻿") for c in raw.columns])
    return clean_roster(raw, [c for c in raw.columns if c not in dates], dates)


def read_tsv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """An evaluation set: tab-separated, lines with # are comments."""
    return spark.read.csv(path, sep="\t", comment="#", schema=T.StructType([T.StructField(c, T.StringType()) for c in columns]), quote="")


def read_trace(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A trace, one JSON object a line; a broken line is left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def append_trace(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def insert_absent(have: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """What is there, and of the new rows those whose keys aren't; of new rows with equal keys one."""
    fresh = new.dropDuplicates(keys).join(have.select(*keys), keys, "left_anti")
    return have.unionByName(fresh.select(have.columns))


def purge(df: DataFrame, today: str, root: str, uri: str = "raw_uri") -> DataFrame:
    """Forgets the originals of expired rows; a path outside root is left as it is."""
    inside = F.startswith(F.col(uri), F.lit(root)) & ~F.contains(F.col(uri), F.lit(".."))
    return df.withColumn(uri, F.when(~((F.col("expires_at") <= F.lit(today).cast("date")) & inside), F.col(uri)))


#: Bytes that a catalog may have.
MOST_CATALOG = 16 << 20


def read_catalog(spark: SparkSession, path: str, entries: str, schema: str) -> DataFrame:
    """The entries of a YAML catalog (a list, or a mapping whose keys become the first column) as rows of a schema.

    Catalogs are small files of rules and words that people write; a file over MOST_CATALOG bytes is refused. Fields that
    an entry lacks are null, and fields that the schema lacks are left out.
    """
    import yaml

    file = spark.read.format("binaryFile").load(path)
    size = file.select("length").first()[0]
    if size > MOST_CATALOG:
        raise ValueError(f"{path} has {size} bytes, more than a catalog may have")
    found = yaml.safe_load(bytes(file.select("content").first()[0]).decode("utf-8-sig")) or {}
    found = found.get(entries) or [] if entries else found
    names = spark.createDataFrame([], schema).columns
    if isinstance(found, dict):
        found = [{names[0]: k, **(x if isinstance(x, dict) else {names[1]: x})} for k, x in found.items()]
    return spark.createDataFrame([tuple(x.get(n) for n in names) for x in found], schema)
