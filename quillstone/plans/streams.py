"""Streams over the tables, drained to their end: what they give must equal what a batch query gives."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import guard
from ..sources import views as v
from ..streaming import traces
from .registry import register


def _shared(spark: SparkSession) -> str:
    """A new folder below the one that the driver and all executors share."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{(root or tempfile.mkdtemp(prefix='quillstone-')).rstrip('/')}/stream-{uuid.uuid4().hex}"


def arriving(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table's files as a stream."""
    path = f"{sf_dir}/{name}.parquet"
    return spark.readStream.schema(spark.read.parquet(path).schema).option("recursiveFileLookup", "true").parquet(f"{path}*")


def drained(stream: DataFrame, mode: str) -> DataFrame:
    """What a stream has given once all that is there has been read; of a complete mode the last state."""
    spark, where = stream.sparkSession, _shared(stream.sparkSession)

    def keep(rows: DataFrame, _: int) -> None:
        rows.write.mode("overwrite" if mode == "complete" else "append").parquet(f"{where}/rows")

    query = stream.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", f"{where}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{where}/rows")


@register("st_windowed_latency", "SELECT strftime(w, '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS errors, max(value) AS top FROM (SELECT event_type, value, unnest([time_bucket(INTERVAL 5 MINUTE, ts), time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 5 MINUTE]) AS w FROM events) GROUP BY w, event_type")
def st_latency(spark, sf_dir):
    """Counts, errors and greatest value by type in windows of ten minutes that begin every five."""
    out = drained(traces.latency(arriving(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")), late="60 days"), "complete")
    return out.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n", "errors", "top")


@register("st_first_copies", "SELECT DISTINCT sha256(text) AS checksum FROM documents")
def st_copies(spark, sf_dir):
    """The checksums of documents as they arrive, each once."""
    arrived = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("doc_id") % 3600)
    docs = arriving(spark, sf_dir, "documents").select("text", arrived.alias("ts"))
    return drained(traces.first_copies(docs).select("checksum"), "append")


@register("st_dialogue_slots", "SELECT user_id, event_id, last_value(CASE WHEN event_type <> 'view' THEN event_type END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried FROM events")
def st_slots(spark, sf_dir):
    """The slot that each turn carries, with the last one of each dialogue kept as state."""
    return drained(traces.carried_slots(arriving(spark, sf_dir, "events").select("user_id", "event_id", "event_type")), "append")


# Queries that others may write, and whether they may run.
WRITTEN = (
    ("SELECT count(*) FROM facts_v WHERE status = 'confirmed'", True),
    ("WITH c AS (SELECT * FROM facts_v WHERE status = 'confirmed') SELECT dimension, count(*) FROM c GROUP BY dimension", True),
    ("SELECT name FROM people_v ORDER BY name LIMIT 5", True),
    ("DROP VIEW people_v", False),
    ("INSERT INTO people_v VALUES (1, 'x', 'y', 'z')", False),
    ("SELECT * FROM passwords", False),
    ("SELEC 1", False),
    ("CREATE TABLE t AS SELECT 1", False),
    ("SELECT nobody FROM people_v", False),
)


@register("f39_query_check", "SELECT * FROM (VALUES " + ", ".join(f"('{q.replace(chr(39), chr(39) * 2)}', {str(ok).lower()})" for q, ok in WRITTEN) + ") x(query, allowed)")
def f39(spark, sf_dir):
    """Which queries only read the tables at hand."""
    v.facts(spark, sf_dir).createOrReplaceTempView("facts_v")
    v.people(spark, sf_dir).createOrReplaceTempView("people_v")
    found = [(q, guard.check(spark, q, {"facts_v", "people_v"}) is None) for q, _ in WRITTEN]  # plans are checked, not run
    return spark.createDataFrame(found, "query string, allowed boolean")
