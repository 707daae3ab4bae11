"""Streams of traces and documents: windowed latency, exact de-duplication and dialogue slots.

Sources are folders of files that arrive; each function takes a streaming DataFrame and returns one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def folder(spark: SparkSession, path: str, schema: str = EVENTS, archive: str | None = None, files: int = 100) -> DataFrame:
    """JSON lines from files as they arrive; done files move to the archive, if named."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.json(path)


def latency(events: DataFrame, width: str = "10 minutes", slide: str = "5 minutes", late: str = "30 minutes") -> DataFrame:
    """Counts, errors, mean and greatest value for each type in sliding windows; events later than `late` are left out."""
    w = events.withWatermark("ts", late).groupBy(F.window("ts", width, slide), "event_type")
    out = w.agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("errors"), F.avg("value").alias("mean"), F.max("value").alias("top"))
    return out.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "event_type", "n", "errors", "mean", "top")


def first_copies(docs: DataFrame, text: str = "text", ts: str = "ts", late: str = "1 day") -> DataFrame:
    """The first of equal texts within the watermark."""
    return docs.withColumn("checksum", F.sha2(text, 256)).withWatermark(ts, late).dropDuplicatesWithinWatermark(["checksum"])


def carried_slots(turns: DataFrame, key: str = "user_id", slot: str = "event_type", ignore: str = "view") -> DataFrame:
    """(key, event_id, carried): the last slot of each dialogue, kept as state; turns of kind `ignore` fill none."""

    def step(k: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        out = []
        for row in pd.concat(list(batches)).sort_values("event_id").itertuples():
            value = getattr(row, slot)
            last = last if value == ignore else value
            out.append((k[0], row.event_id, last))
        if last is not None:
            state.update((last,))
        yield pd.DataFrame(out, columns=[key, "event_id", "carried"])

    return turns.groupBy(key).applyInPandasWithState(step, f"{key} bigint, event_id bigint, carried string", "last string", "append", "NoTimeout")
