"""Shared pieces of the training-data operators: the written-table cut, word patterns and Arrow helpers."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of characters other than these six ASCII white-space characters.
WHITE = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Only a local session, as in tests, gets one of its own."""
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = tempfile.mkdtemp(prefix="quillstone-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def _place(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def written(df: DataFrame, label: str) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it again.

    This cuts the lineage: a lost executor costs its running tasks only. The files go with discard, or when the
    application ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quillstone/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    where, files = _place(spark, path)
    files.deleteOnExit(where)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Deletes the files of written tables that nothing still to be computed reads."""
    for table in tables:
        path = getattr(table, "_written_at", None)
        if path:
            where, files = _place(table.sparkSession, path)
            files.delete(where, True)


def words_of(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_PATTERN), "")


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that the string column holds about most_bytes a slice (one row at least)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        size = max(batch.column(column).nbytes, 1)
        step = max(1, min(n, n * most_bytes // size))
        for at in range(0, n, step):
            yield batch.slice(at, step)


def release_memory() -> None:
    """Gives freed memory that Arrow and the C library keep for later back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def thrifty(run):
    """The Arrow map, with memory released at its end: a worker lives on, and so would what its task has freed."""

    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return released


def fresh_name(df: DataFrame, name: str) -> str:
    """The name, with as many underscores behind it as no column of df is named so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def packed(df: DataFrame, **columns: str) -> DataFrame:
    """The columns asked for under names of our own, beside the whole row as the struct _row: no name can clash."""
    return df.select(F.struct("*").alias("_row"), *[F.col(c).alias(n) for n, c in columns.items()])


def unpacked(df: DataFrame, names: list[str], **added: Column) -> DataFrame:
    """The columns of the packed row, and columns that are added or replace one of the same name."""
    fresh = {n.lower() for n in added}
    return df.select(*[F.col("_row").getField(n).alias(n) for n in names if n.lower() not in fresh], *[c.alias(n) for n, c in added.items()])


def with_columns(batch: pa.RecordBatch, names: list[str], columns: list[pa.Array]) -> pa.RecordBatch:
    """The batch with columns added, or replaced where the name is there already (in any case of its letters)."""
    fresh = {n.lower() for n in names}
    keep = [(n, batch.column(i)) for i, n in enumerate(batch.schema.names) if n.lower() not in fresh]
    keep += list(zip(names, columns, strict=True))
    return pa.RecordBatch.from_arrays([c for _, c in keep], names=[n for n, _ in keep])
