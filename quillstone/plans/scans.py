"""Sources and sinks as queries: hashing, markup, cleaned rosters, last-wins tables, upserts, retention, traces."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as x
from ..sources import readers
from ..sources import views as v
from .registry import register


@register("s05_dispatch_by_extension", "SELECT page_id, CASE WHEN page_id % 5 = 4 THEN NULL WHEN page_id % 5 = 3 THEN 'photo' ELSE 'electronic' END AS source_kind, CASE WHEN page_id % 5 = 4 THEN 'unsupported: exe' END AS error FROM pages")
def s05(spark, sf_dir):
    names = F.array(*[F.lit(n) for n in ("a.docx", "b.PDF", "c.html", "d.Jpg", "e.exe")])
    p = v.table(spark, sf_dir, "pages").withColumn("path", F.concat(F.lit("/in/"), F.get(names, (F.col("page_id") % 5).cast("int"))))
    return readers.dispatch(p, "path").select("page_id", "source_kind", "error")


@register("s06_exact_dedupe", "SELECT sha256(text) AS checksum, min(doc_id) AS doc_id, count(*) AS copies FROM documents WHERE sha256(text) NOT IN (SELECT sha256(text) FROM benchmark UNION ALL SELECT sha256(text) FROM conversations) GROUP BY 1")
def s06(spark, sf_dir):
    """New documents by checksum, each once, beside those that the store (passages and turns here) has already."""
    sums = lambda name: v.table(spark, sf_dir, name).select(F.sha2("text", 256).alias("checksum"))
    d = v.table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("checksum"))
    return d.join(sums("benchmark").unionByName(sums("conversations")), "checksum", "left_anti").groupBy("checksum").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


HTML = "regexp_replace(regexp_replace(html, '<(script|style)\\b.*?</(script|style)\\s*>', '', 'gis'), '<[^>]*>', chr(10), 'gs')"
for _name, _char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
    HTML = f"replace({HTML}, '{_name}', '{_char}')"


@register("s07_html_to_text", f"SELECT page_id, array_to_string(list_filter(list_transform(string_split({HTML}, chr(10)), lambda s: trim(regexp_replace(s, '[ \\t\\r]+', ' ', 'g'))), lambda s: s <> ''), chr(10)) AS text FROM pages")
def s07(spark, sf_dir):
    return v.table(spark, sf_dir, "pages").select("page_id", x.html_to_lines(F.col("html")).alias("text"))


@register("s09_roster_cleaning", "SELECT c_custkey, nullif(trim(c_mktsegment), '') AS rank, CASE WHEN length(trim(day)) = 10 THEN try_cast(trim(day) AS DATE) END AS enrolled FROM (SELECT *, CASE c_custkey % 3 WHEN 0 THEN ' 2001-02-03 ' WHEN 1 THEN '2001-2-3' ELSE '2001-02-30' END AS day FROM customer)")
def s09(spark, sf_dir):
    day = F.when(F.col("c_custkey") % 3 == 0, " 2001-02-03 ").when(F.col("c_custkey") % 3 == 1, "2001-2-3").otherwise("2001-02-30")
    return readers.clean_roster(v.table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("rank"), day.alias("enrolled")), ["rank"], ["enrolled"])


@register("s10_last_wins", "SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def s10(spark, sf_dir):
    order = Window.partitionBy("user_id", "event_type").orderBy(F.desc("ts"), F.desc("event_id"))
    return v.table(spark, sf_dir, "events").withColumn("rn", F.row_number().over(order)).filter("rn = 1").select("user_id", "event_type", "event_id", "value")


@register("s15_insert_if_absent", "SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_mktsegment = 'BUILDING' UNION ALL SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def s15(spark, sf_dir):
    have = v.table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return readers.insert_absent(have, v.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), ["id"])


@register("s17_retention_purge", v.sql(v.REGISTRY_SQL, body="SELECT id, CASE WHEN expires_at > DATE '2024-02-01' THEN 'raw/' || CAST(id AS VARCHAR) END AS raw_uri FROM registry"))
def s17(spark, sf_dir):
    r = v.registry(spark, sf_dir).withColumn("raw_uri", F.concat(F.lit("raw/"), F.col("id").cast("string")))
    return readers.purge(r, "2024-02-01", "raw/").select("id", "raw_uri")


@register("p18_hash_sample", "SELECT doc_id FROM documents WHERE CAST('0x' || substring(sha256(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 20 = 0")
def p18(spark, sf_dir):
    return v.table(spark, sf_dir, "documents").filter(x.sampled(F.col("doc_id").cast("string"), 20)).select("doc_id")
