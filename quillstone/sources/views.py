"""The fact model over the driver's tables: each view as a DataFrame, and as SQL for the twin queries.

Orders play facts, customers play objects and people, and source documents are numbers that many facts share. Three of
the five order priorities are states that last; the other two are requisites of the same source document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATES = ("1-URGENT", "2-HIGH", "3-MEDIUM")
NUMBER, PLACE = "4-NOT SPECIFIED", "5-LOW"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """The same rows dealt over four tasks a core by a key: for work of which a small file holds much."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism, key)


#: Rows of a table that one task puts in order at most, about; as a table grows, it is dealt to more tasks.
TASK_ROWS = 1_000_000


def spread_by_size(df: DataFrame, name: str, spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """The same rows dealt by a key to as many tasks as the rows of the table that they come from ask for."""
    rows = table(spark, sf_dir, name).count()  # from the files' footers
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS)), key)


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, object_id, dimension, value, valid_from, valid_to, status, source_doc_id, confidence, info)."""
    o = table(spark, sf_dir, "orders")
    key, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    value = (
        F.when(F.col("o_orderpriority") == NUMBER, F.concat(F.lit("No "), (key % 500).cast("string")))
        .when(F.col("o_orderpriority") == PLACE, F.concat(F.lit("Place "), (key % 40).cast("string")))
        .when(key % 3 == 0, F.lit("Pier's"))
        .when(key % 3 == 1, F.lit("Pier’s"))
        .otherwise(F.col("o_orderpriority"))
    )
    error = F.when(key % 7 == 0, F.lit('"end before start"')).when(key % 7 == 1, F.lit("null")).otherwise(F.lit('""'))
    info = F.concat(F.lit('{"date_range_error": '), error, F.lit(', "co_travelers": "'), F.when(key % 5 == 0, F.concat(F.lit("P"), (key % 11).cast("string"))).otherwise(F.lit(" ")), F.lit('", "method": "m'), (key % 3).cast("string"), F.lit('"}'))
    return o.select(
        key.alias("id"),
        F.col("o_custkey").alias("object_id"),
        F.col("o_orderpriority").alias("dimension"),
        value.alias("value"),
        F.when(key % 97 != 0, day).alias("valid_from"),
        F.when(key % 10 != 0, F.date_add(day, (key % 30).cast("int"))).alias("valid_to"),
        F.when(F.col("o_orderstatus") == "F", "confirmed").when(F.col("o_orderstatus") == "P", "unconfirmed").otherwise("rejected").alias("status"),
        (key % 997).alias("source_doc_id"),
        F.when(key % 13 != 0, (key % 100) / F.lit(100.0)).alias("confidence"),
        info.alias("info"),
    )


FACTS_SQL = """
facts AS (
  SELECT o_orderkey AS id, o_custkey AS object_id, o_orderpriority AS dimension,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'No ' || CAST(o_orderkey % 500 AS VARCHAR)
         WHEN o_orderpriority = '5-LOW' THEN 'Place ' || CAST(o_orderkey % 40 AS VARCHAR)
         WHEN o_orderkey % 3 = 0 THEN 'Pier''s' WHEN o_orderkey % 3 = 1 THEN 'Pier’s' ELSE o_orderpriority END AS value,
    CASE WHEN o_orderkey % 97 <> 0 THEN CAST(o_orderdate AS DATE) END AS valid_from,
    CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INTEGER) END AS valid_to,
    CASE o_orderstatus WHEN 'F' THEN 'confirmed' WHEN 'P' THEN 'unconfirmed' ELSE 'rejected' END AS status,
    o_orderkey % 997 AS source_doc_id,
    CASE WHEN o_orderkey % 13 <> 0 THEN (o_orderkey % 100) / 100.0::DOUBLE END AS confidence,
    '{"date_range_error": ' || CASE o_orderkey % 7 WHEN 0 THEN '"end before start"' WHEN 1 THEN 'null' ELSE '""' END
      || ', "co_travelers": "' || CASE WHEN o_orderkey % 5 = 0 THEN 'P' || CAST(o_orderkey % 11 AS VARCHAR) ELSE ' ' END
      || '", "method": "m' || CAST(o_orderkey % 3 AS VARCHAR) || '"}' AS info
  FROM orders
)"""


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(object_id, name, service_id or null, subdivision)."""
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    service = F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("UNIT-"), F.col("c_custkey").cast("string")))
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(F.col("c_custkey").alias("object_id"), F.col("c_name").alias("name"), service.alias("service_id"), F.col("n_name").alias("subdivision"))


PEOPLE_SQL = """
people AS (
  SELECT c_custkey AS object_id, c_name AS name,
    CASE WHEN c_acctbal >= 0 THEN 'UNIT-' || CAST(c_custkey AS VARCHAR) END AS service_id, n_name AS subdivision
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
)"""


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents: (id, domain or null, type, validity, expires_at, checksum, text, lang)."""
    d = table(spark, sf_dir, "documents")
    i = F.col("doc_id")
    return d.select(
        i.alias("id"),
        F.when(i % 4 == 0, "normative").when(i % 4 == 1, "leave").when(i % 4 == 2, "deployment").alias("domain"),
        F.col("source").alias("type"),
        F.when(i % 9 == 0, "superseded").otherwise("current").alias("validity"),
        F.date_add(F.lit("2024-01-01").cast("date"), (i % 60).cast("int")).alias("expires_at"),
        F.sha2("text", 256).alias("checksum"),
        "text",
        "lang",
    )


REGISTRY_SQL = """
registry AS (
  SELECT doc_id AS id, CASE doc_id % 4 WHEN 0 THEN 'normative' WHEN 1 THEN 'leave' WHEN 2 THEN 'deployment' END AS domain,
    source AS type, CASE WHEN doc_id % 9 = 0 THEN 'superseded' ELSE 'current' END AS validity,
    DATE '2024-01-01' + CAST(doc_id % 60 AS INTEGER) AS expires_at, sha256(text) AS checksum, text, lang
  FROM documents
)"""


def review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(document_id, fact_id, queue_type, resolved), one open or closed task for some facts."""
    f = facts(spark, sf_dir).filter("status <> 'rejected' and id % 4 = 0")
    kind = F.when(F.col("id") % 12 == 0, "new_person").when(F.col("id") % 8 == 0, "date_conflict").otherwise("low_confidence")
    return f.select(F.col("source_doc_id").alias("document_id"), F.col("id").alias("fact_id"), kind.alias("queue_type"), (F.col("id") % 20 == 0).alias("resolved"))


QUEUE_SQL = """
queue AS (
  SELECT source_doc_id AS document_id, id AS fact_id,
    CASE WHEN id % 12 = 0 THEN 'new_person' WHEN id % 8 = 0 THEN 'date_conflict' ELSE 'low_confidence' END AS queue_type,
    id % 20 = 0 AS resolved
  FROM facts WHERE status <> 'rejected' AND id % 4 = 0
)"""


def sql(*views: str, body: str) -> str:
    """A query text over views."""
    return "WITH " + ",".join(views) + "\n" + body
