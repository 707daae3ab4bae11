"""Upkeep of facts and documents: copies, disagreements, overlaps, supersession, roster rules and duplicate groups."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import similarity
from ..operators import temporal as t
from ..sources import views as v
from .registry import register

KEYS = "object_id % 50, dimension, replace(value, '''', '’'), valid_from"
SURVIVOR = "CASE status WHEN 'confirmed' THEN 0 ELSE 1 END, confidence DESC NULLS LAST, id"
DUPES = f"dupes AS (SELECT *, object_id % 50 AS obj, row_number() OVER (PARTITION BY {KEYS} ORDER BY {SURVIVOR}) AS rn, first_value(id) OVER (PARTITION BY {KEYS} ORDER BY {SURVIVOR}) AS survivor, count(*) OVER (PARTITION BY {KEYS}) AS n FROM facts WHERE status <> 'rejected')"


def duplicates(spark, sf_dir):
    """Facts with the rank, survivor and size of their group of copies."""
    f = v.facts(spark, sf_dir).filter("status <> 'rejected'").withColumn("obj", F.col("object_id") % 50)
    group = Window.partitionBy("obj", "dimension", t.same_text("value"), "valid_from")
    order = group.orderBy(F.when(F.col("status") == "confirmed", 0).otherwise(1), F.col("confidence").desc_nulls_last(), "id")
    return f.withColumns({"rn": F.row_number().over(order), "survivor": F.first("id").over(order), "n": F.count("*").over(group)})


@register("a31_duplicate_facts", v.sql(v.FACTS_SQL, DUPES, body="SELECT obj, dimension, survivor, any_value(n) AS n, string_agg(CAST(id AS VARCHAR), ',' ORDER BY rn) AS ids FROM dupes WHERE n > 1 GROUP BY obj, dimension, survivor"))
def a31(spark, sf_dir):
    ids = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", "id"))), lambda x: x["id"].cast("string")), ",")
    return duplicates(spark, sf_dir).filter("n > 1").groupBy("obj", "dimension", "survivor").agg(F.max("n").alias("n"), ids.alias("ids"))


@register("a32_disagreements", v.sql(v.FACTS_SQL, body="SELECT object_id, dimension, count(DISTINCT source_doc_id) AS n_docs, count(DISTINCT replace(value, '''', '’')) AS n_values, array_to_string(list_sort(list(DISTINCT replace(value, '''', '’'))), '|') AS vals FROM facts WHERE status = 'confirmed' GROUP BY object_id, dimension HAVING count(DISTINCT source_doc_id) > 1 AND count(DISTINCT replace(value, '''', '’')) > 1"))
def a32(spark, sf_dir):
    f = v.facts(spark, sf_dir).filter("status = 'confirmed'").withColumn("v", t.same_text("value"))
    out = f.groupBy("object_id", "dimension").agg(F.count_distinct("source_doc_id").alias("n_docs"), F.array_sort(F.collect_set("v")).alias("all"))
    return out.filter((F.col("n_docs") > 1) & (F.size("all") > 1)).select("object_id", "dimension", "n_docs", F.size("all").cast("long").alias("n_values"), F.array_join("all", "|").alias("vals"))


def overlap_sql(end: str, same: str) -> str:
    return f"spans AS (SELECT *, coalesce(valid_to, {end}) AS stop FROM facts WHERE status = 'confirmed' AND valid_from IS NOT NULL), pairs AS (SELECT a.id AS a_id, b.id AS b_id, a.object_id, a.dimension AS a_dimension, b.dimension AS b_dimension, a.value AS a_value, b.value AS b_value FROM spans a JOIN spans b ON a.object_id = b.object_id AND a.id < b.id {same} AND a.valid_from <= b.stop AND b.valid_from <= a.stop AND a.stop >= a.valid_from AND b.stop >= b.valid_from)"


@register("j06_overlaps_open_infinite", v.sql(v.FACTS_SQL, overlap_sql("DATE '9999-12-31'", "AND a.dimension = b.dimension"), body="SELECT a_id, b_id, object_id FROM pairs"))
def j06(spark, sf_dir):
    return t.overlaps(v.facts(spark, sf_dir).filter("status = 'confirmed'"), "infinite", ["dimension"]).select("a_id", "b_id", "object_id")


@register("j06_overlaps_open_point", v.sql(v.FACTS_SQL, overlap_sql("valid_from", ""), body="SELECT a_id, b_id, object_id FROM pairs"))
def j06_point(spark, sf_dir):
    return t.overlaps(v.facts(spark, sf_dir).filter("status = 'confirmed'"), "point", []).select("a_id", "b_id", "object_id")


@register("a33_overlap_summary", v.sql(v.FACTS_SQL, overlap_sql("valid_from", ""), body="SELECT count(*) AS n, count(*) FILTER (WHERE a_dimension = b_dimension) AS n_same_state, count(*) FILTER (WHERE a_value <> b_value) AS n_other_value FROM pairs"))
def a33(spark, sf_dir):
    pairs = t.overlaps(v.facts(spark, sf_dir).filter("status = 'confirmed'"), "point", [])
    return pairs.agg(F.count("*").alias("n"), F.count_if(F.col("a_dimension") == F.col("b_dimension")).alias("n_same_state"), F.count_if(F.col("a_value") != F.col("b_value")).alias("n_other_value"))


@register("a34_straight_through", v.sql(v.FACTS_SQL, v.QUEUE_SQL, v.REGISTRY_SQL, body="SELECT count(*) AS total, count(*) FILTER (WHERE f.id IS NOT NULL AND q.id IS NULL) AS straight, count(*) FILTER (WHERE q.id IS NOT NULL) AS reviewed, count(*) FILTER (WHERE f.id IS NULL AND q.id IS NULL) AS without_facts FROM registry r LEFT JOIN (SELECT DISTINCT source_doc_id AS id FROM facts WHERE status = 'confirmed') f ON f.id = r.id LEFT JOIN (SELECT DISTINCT document_id AS id FROM queue WHERE NOT resolved AND queue_type = 'date_conflict') q ON q.id = r.id"))
def a34(spark, sf_dir):
    r = v.registry(spark, sf_dir).select("id")
    f = v.facts(spark, sf_dir).filter("status = 'confirmed'").select(F.col("source_doc_id").alias("id")).distinct().withColumn("f", F.lit(1))
    q = v.review_queue(spark, sf_dir).filter("not resolved and queue_type = 'date_conflict'").select(F.col("document_id").alias("id")).distinct().withColumn("q", F.lit(1))
    both = r.join(f, "id", "left").join(q, "id", "left")
    return both.agg(F.count("*").alias("total"), F.count_if(F.col("f").isNotNull() & F.col("q").isNull()).alias("straight"), F.count("q").alias("reviewed"), F.count_if(F.col("f").isNull() & F.col("q").isNull()).alias("without_facts"))


@register("a35_roster_reconcile", v.sql(v.FACTS_SQL, v.PEOPLE_SQL, body="SELECT f.source_doc_id, count(*) FILTER (WHERE status = 'confirmed') AS confirmed, count(*) FILTER (WHERE status = 'unconfirmed') AS unconfirmed, bool_and(service_id IS NOT NULL) AS all_matched FROM facts f JOIN people USING (object_id) WHERE status <> 'rejected' GROUP BY f.source_doc_id"))
def a35(spark, sf_dir):
    f = v.facts(spark, sf_dir).filter("status <> 'rejected'").join(v.people(spark, sf_dir), "object_id")
    return f.groupBy("source_doc_id").agg(F.count_if(F.col("status") == "confirmed").alias("confirmed"), F.count_if(F.col("status") == "unconfirmed").alias("unconfirmed"), F.bool_and(F.col("service_id").isNotNull()).alias("all_matched"))


@register("t01_period_check", v.sql(v.FACTS_SQL, body="SELECT id, CASE WHEN valid_from IS NULL THEN 'unverifiable' WHEN valid_to < valid_from THEN 'contradictory' WHEN valid_to IS NULL THEN 'open' WHEN valid_to - valid_from + 1 > 28 THEN 'long' ELSE 'fine' END AS problem, CAST(valid_to - valid_from + 1 AS BIGINT) AS days FROM facts"))
def t01(spark, sf_dir):
    days = (F.datediff("valid_to", "valid_from") + 1).cast("long")
    problem = F.when(F.col("valid_from").isNull(), "unverifiable").when(F.col("valid_to") < F.col("valid_from"), "contradictory").when(F.col("valid_to").isNull(), "open").when(days > 28, "long").otherwise("fine")
    return v.facts(spark, sf_dir).select("id", problem.alias("problem"), days.alias("days"))


@register("t02_supersede", v.sql(v.FACTS_SQL, "ranked AS (SELECT *, valid_from IS NOT NULL AND row_number() OVER (PARTITION BY object_id, dimension, valid_from ORDER BY id) = 1 AS good FROM facts WHERE status <> 'rejected')", body="SELECT id, CASE WHEN good THEN lead(valid_from) OVER (PARTITION BY object_id, dimension, good ORDER BY valid_from, id) END AS closed_at, CASE WHEN good THEN 'confirmed' ELSE 'unconfirmed' END AS new_status FROM ranked"))
def t02(spark, sf_dir):
    return t.supersede(v.facts(spark, sf_dir).filter("status <> 'rejected'")).select("id", "closed_at", "new_status")


@register("t02_same_value_merge", v.sql(v.FACTS_SQL, "o AS (SELECT *, replace(value, '''', '’') AS said, row_number() OVER (PARTITION BY object_id, dimension ORDER BY valid_from, id) AS rn FROM facts WHERE status <> 'rejected' AND valid_from IS NOT NULL)", "m AS (SELECT a.*, (SELECT max(b.rn) FROM o b WHERE b.object_id = a.object_id AND b.dimension = a.dimension AND b.rn < a.rn AND b.said <> a.said) AS last_other FROM o a)", "g AS (SELECT object_id, dimension, coalesce(last_other, 0) AS island, min(id) FILTER (WHERE rn = coalesce(last_other, 0) + 1) AS id, min(valid_from) AS valid_from, count(*) AS copies, count(DISTINCT source_doc_id) AS sources FROM m GROUP BY ALL)", body="SELECT id, object_id, dimension, valid_from, lead(valid_from) OVER (PARTITION BY object_id, dimension ORDER BY island) AS closed_at, copies, sources FROM g"))
def t02_merge(spark, sf_dir):
    """Values that hold one at a time: a fact that says the same again adds its document to the one that holds, another closes it."""
    return t.merged_values(v.facts(spark, sf_dir).filter("status <> 'rejected'"))


INVERTED = "l_orderkey, l_linenumber, CAST(o_orderdate AS DATE) AS valid_from, CAST(l_shipdate AS DATE) AS valid_to"


@register("t03_inverted_periods", f"SELECT l_orderkey, l_linenumber, valid_from, valid_to, CASE WHEN valid_to < valid_from THEN 'unconfirmed' ELSE 'confirmed' END AS status, CASE WHEN valid_to < valid_from THEN 'end before start' END AS error FROM (SELECT {INVERTED} FROM lineitem JOIN orders ON l_orderkey = o_orderkey)")
def t03(spark, sf_dir):
    o = v.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("valid_from"))
    li = v.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("valid_to"))
    wrong = F.col("valid_to") < F.col("valid_from")
    return li.join(o, "l_orderkey").select("l_orderkey", "l_linenumber", "valid_from", "valid_to", F.when(wrong, "unconfirmed").otherwise("confirmed").alias("status"), F.when(wrong, "end before start").alias("error"))


@register("t04_absent_now", v.sql(v.FACTS_SQL, body="SELECT object_id, count(*) AS n FROM facts WHERE status = 'confirmed' AND dimension IN ('1-URGENT', '2-HIGH') AND valid_from <= DATE '1999-01-01' AND (valid_to IS NULL OR valid_to >= DATE '1999-01-01') AND id % 6 <> 0 GROUP BY object_id"))
def t04(spark, sf_dir):
    returned = F.col("id") % 6 == 0
    return v.facts(spark, sf_dir).filter((F.col("status") == "confirmed") & F.col("dimension").isin("1-URGENT", "2-HIGH") & t.at_date("1999-01-01") & ~returned).groupBy("object_id").agg(F.count("*").alias("n"))


@register("t06_roster_rule", v.sql(v.FACTS_SQL, v.PEOPLE_SQL, body="SELECT id, CASE WHEN status = 'confirmed' AND service_id IS NULL THEN 'unconfirmed' ELSE status END AS status FROM facts LEFT JOIN people USING (object_id)"))
def t06(spark, sf_dir):
    f = v.facts(spark, sf_dir).join(v.people(spark, sf_dir).select("object_id", "service_id"), "object_id", "left")
    return f.select("id", F.when((F.col("status") == "confirmed") & F.col("service_id").isNull(), "unconfirmed").otherwise(F.col("status")).alias("status"))


@register("e01_resolve_objects", "SELECT alias, min(id) AS object_id FROM (SELECT c_custkey AS id, lower(c_mktsegment) || '/' || CAST(c_nationkey AS VARCHAR) AS alias FROM customer) GROUP BY alias UNION ALL SELECT alias, NULL FROM (SELECT DISTINCT 'machinery/' || CAST(s_nationkey + 20 AS VARCHAR) AS alias FROM supplier) s WHERE NOT EXISTS (SELECT 1 FROM customer WHERE lower(c_mktsegment) || '/' || CAST(c_nationkey AS VARCHAR) = s.alias)")
def e01(spark, sf_dir):
    c = v.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.concat_ws("/", F.lower("c_mktsegment"), F.col("c_nationkey").cast("string")).alias("alias"))
    known = c.groupBy("alias").agg(F.min("id").alias("object_id"))
    asked = v.table(spark, sf_dir, "supplier").select(F.concat(F.lit("machinery/"), (F.col("s_nationkey") + 20).cast("string")).alias("alias")).distinct()
    return known.unionByName(asked.join(known, "alias", "left_anti").withColumn("object_id", F.lit(None).cast("long")))


@register("e02_dedupe_facts", v.sql(v.FACTS_SQL, DUPES, body="SELECT survivor AS fact_id, source_doc_id AS document_id, bool_or(rn = 1) AS is_primary FROM dupes GROUP BY survivor, source_doc_id"))
def e02(spark, sf_dir):
    return duplicates(spark, sf_dir).groupBy(F.col("survivor").alias("fact_id"), F.col("source_doc_id").alias("document_id")).agg(F.bool_or(F.col("rn") == 1).alias("is_primary"))


def document_number():
    """The identifier that a text names: a telephone number or a number of 16 digits, the first of each kind."""
    a, b = F.regexp_extract("text", r"\+1 \([0-9]{3}\) 555-[0-9]{4}", 0), F.regexp_extract("text", "[0-9]{16}", 0)
    return F.when(a != "", F.concat(F.lit("phone:"), F.regexp_replace(a, "[^0-9]", ""))).when(b != "", F.concat(F.lit("number:"), b))


@register("e03_duplicate_documents")
def e03(spark, sf_dir):
    """Groups of copies: documents of one identifier, and of alike heads; canonical is one with an identifier, the longest.

    The twin would need the ratio of matching blocks, which SQL lacks; tests hold it against a plain comparison.
    """
    return similarity.duplicate_groups(v.table(spark, sf_dir, "documents").select("doc_id", "text", document_number().alias("identifier")))


@register("e04_identifier_canonical", "SELECT doc_id, CASE WHEN a <> '' THEN 'phone:' || regexp_replace(a, '[^0-9]', '', 'g') WHEN b <> '' THEN 'number:' || b ELSE NULL END AS identifier FROM (SELECT doc_id, regexp_extract(text, '\\+1 \\([0-9]{3}\\) 555-[0-9]{4}') AS a, regexp_extract(text, '[0-9]{16}') AS b FROM documents)")
def e04(spark, sf_dir):
    return v.table(spark, sf_dir, "documents").select("doc_id", document_number().alias("identifier"))


@register("f46_supersede_action", v.sql(v.FACTS_SQL, overlap_sql("valid_from", ""), "losers AS (SELECT DISTINCT a_id AS id FROM pairs)", body="SELECT f.id, CASE WHEN l.id IS NULL THEN f.status ELSE 'rejected' END AS status FROM facts f LEFT JOIN losers l ON l.id = f.id WHERE f.status = 'confirmed'"))
def f46(spark, sf_dir):
    f = v.facts(spark, sf_dir).filter("status = 'confirmed'")
    losers = t.overlaps(f, "point", []).select(F.col("a_id").alias("id")).distinct().withColumn("lost", F.lit(True))
    return f.join(losers, "id", "left").select("id", F.when(F.col("lost"), "rejected").otherwise(F.col("status")).alias("status"))


@register("f37_next_number", v.sql(v.FACTS_SQL, body="SELECT coalesce(max(try_cast(replace(value, 'No ', '') AS BIGINT)), 0) + 1 AS next_number FROM facts WHERE dimension = '4-NOT SPECIFIED'"))
def f37(spark, sf_dir):
    return v.facts(spark, sf_dir).filter(F.col("dimension") == v.NUMBER).agg((F.coalesce(F.max(F.replace("value", F.lit("No "), F.lit("")).try_cast("bigint")), F.lit(0)) + 1).alias("next_number"))


@register("j04_latest_value", v.sql(v.FACTS_SQL, body="SELECT object_id, dimension, value FROM (SELECT *, row_number() OVER (PARTITION BY object_id, dimension ORDER BY valid_from DESC NULLS LAST, id) AS rn FROM facts WHERE status = 'confirmed') WHERE rn = 1"))
def j04(spark, sf_dir):
    return t.latest(v.facts(spark, sf_dir).filter("status = 'confirmed'"), ["object_id", "dimension"])


@register("j08_docs_without_facts", v.sql(v.FACTS_SQL, v.REGISTRY_SQL, body="SELECT id, domain FROM registry r WHERE NOT EXISTS (SELECT 1 FROM facts WHERE source_doc_id = r.id AND status = 'confirmed')"))
def j08(spark, sf_dir):
    f = v.facts(spark, sf_dir).filter("status = 'confirmed'").select(F.col("source_doc_id").alias("id"))
    return v.registry(spark, sf_dir).select("id", "domain").join(f, "id", "left_anti")


@register("j11_unambiguous_names", "SELECT s_suppkey, max(c_custkey) AS c_custkey FROM supplier JOIN customer ON c_nationkey = s_nationkey AND c_mktsegment = 'MACHINERY' AND c_acctbal > 7000 GROUP BY s_suppkey HAVING count(*) = 1")
def j11(spark, sf_dir):
    c = v.table(spark, sf_dir, "customer").filter("c_mktsegment = 'MACHINERY' and c_acctbal > 7000")
    s = v.table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("c_nationkey"))
    lone = c.groupBy("c_nationkey").agg(F.count("*").alias("n"), F.max("c_custkey").alias("c_custkey")).filter("n = 1")
    return s.join(lone, "c_nationkey").select("s_suppkey", "c_custkey")


@register("u01_document_family", v.sql(v.FACTS_SQL, body="SELECT id FROM (SELECT source_doc_id AS id FROM facts WHERE dimension = '1-URGENT' UNION SELECT source_doc_id FROM facts WHERE dimension = '2-HIGH') EXCEPT SELECT source_doc_id FROM facts WHERE status = 'rejected' AND dimension = '3-MEDIUM'"))
def u01(spark, sf_dir):
    f = v.facts(spark, sf_dir)
    docs = lambda where: f.filter(where).select(F.col("source_doc_id").alias("id"))
    return docs("dimension = '1-URGENT'").union(docs("dimension = '2-HIGH'")).distinct().exceptAll(docs("status = 'rejected' and dimension = '3-MEDIUM'").distinct())


@register("f46_supersede_and_recommit", v.sql(v.FACTS_SQL, overlap_sql("valid_from", ""), "losers AS (SELECT DISTINCT source_doc_id AS doc FROM facts WHERE id IN (SELECT a_id FROM pairs WHERE a_id % 50 = 0))", "left_ AS (SELECT * FROM facts WHERE status = 'confirmed' AND source_doc_id NOT IN (SELECT doc FROM losers))", "ranked AS (SELECT *, valid_from IS NOT NULL AND row_number() OVER (PARTITION BY object_id, dimension, valid_from ORDER BY id) = 1 AS good FROM left_)", body="SELECT id, CASE WHEN good THEN lead(valid_from) OVER (PARTITION BY object_id, dimension, good ORDER BY valid_from, id) END AS closed_at, CASE WHEN good THEN 'confirmed' ELSE 'unconfirmed' END AS status FROM ranked UNION ALL SELECT id, NULL, 'rejected' FROM facts WHERE status = 'confirmed' AND source_doc_id IN (SELECT doc FROM losers)"))
def f46_recommit(spark, sf_dir):
    """Documents that a person has ruled out in a conflict lose all their facts; what is left is committed anew.

    Rulings here are the overlaps whose first fact has a round number.
    """
    f = v.facts(spark, sf_dir).filter("status = 'confirmed'")
    ruled = t.overlaps(f, "point", []).filter("a_id % 50 = 0").select(F.col("a_id").alias("id"))
    docs = f.join(ruled, "id", "left_semi").select("source_doc_id").distinct()
    kept = t.supersede(f.join(docs, "source_doc_id", "left_anti")).select("id", "closed_at", F.col("new_status").alias("status"))
    gone = f.join(docs, "source_doc_id", "left_semi").select("id", F.lit(None).cast("date").alias("closed_at"), F.lit("rejected").alias("status"))
    return kept.unionByName(gone)


@register("k05_queue_claims", v.sql(v.FACTS_SQL, v.QUEUE_SQL, body="SELECT (place - 1) % 4 AS worker, fact_id, queue_type FROM (SELECT *, row_number() OVER (ORDER BY CASE queue_type WHEN 'new_person' THEN 0 WHEN 'date_conflict' THEN 1 ELSE 2 END, fact_id) AS place FROM queue WHERE NOT resolved) WHERE place <= 4"))
def k05(spark, sf_dir):
    """The next open task for each of four workers, none twice: by kind, then by age."""
    return t.claims(v.review_queue(spark, sf_dir).filter("not resolved"), [F.when(F.col("queue_type") == "new_person", 0).when(F.col("queue_type") == "date_conflict", 1).otherwise(2), F.col("fact_id")], 4).select("worker", "fact_id", "queue_type")
