"""The closed catalog of questions over facts; confirmed facts and drafts are answered side by side, never mixed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import temporal as t
from ..sources import views as v
from .registry import register

DAY, FIRST, LAST = "1998-06-15", "1998-03-01", "1998-09-30"
ABSENT = ("1-URGENT", "2-HIGH")
#: Both statuses that are ever shown.
SHOWN = ("confirmed", "unconfirmed")

AT = f"valid_from <= DATE '{DAY}' AND (valid_to IS NULL OR valid_to >= DATE '{DAY}')"
IN = f"valid_from <= DATE '{LAST}' AND (valid_to IS NULL OR valid_to >= DATE '{FIRST}')"
DIMS = "dimension IN ('1-URGENT', '2-HIGH')"
OPEN = "status IN ('confirmed', 'unconfirmed')"
SAME = "replace(value, '''', '’')"
DISTINCT = f"row_number() OVER (PARTITION BY object_id, dimension, {SAME}, valid_from, valid_to, status ORDER BY source_doc_id NULLS LAST, id) AS rn"
ATTRS = """
attrs AS (
  SELECT source_doc_id, arg_min(value, id) FILTER (WHERE dimension = '4-NOT SPECIFIED') AS doc_number,
    arg_min(value, id) FILTER (WHERE dimension = '5-LOW') AS place
  FROM facts GROUP BY source_doc_id
)"""


def absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.facts(spark, sf_dir).filter(F.col("dimension").isin(*ABSENT) & F.col("status").isin(*SHOWN))


def doc_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.attributes(v.facts(spark, sf_dir), {v.NUMBER: "doc_number", v.PLACE: "place"})


@register("a01_count_by_state_on_date", v.sql(v.FACTS_SQL, body=f"SELECT status, count(DISTINCT object_id) AS n_objects FROM facts WHERE {AT} AND {DIMS} AND {OPEN} GROUP BY status"))
def a01(spark, sf_dir):
    return absent(spark, sf_dir).filter(t.at_date(DAY)).groupBy("status").agg(F.countDistinct("object_id").alias("n_objects"))


@register("a02_count_by_state_period", v.sql(v.FACTS_SQL, body=f"SELECT status, count(DISTINCT object_id) AS n_objects FROM facts WHERE {IN} AND {DIMS} AND {OPEN} GROUP BY status"))
def a02(spark, sf_dir):
    return absent(spark, sf_dir).filter(t.in_period(FIRST, LAST)).groupBy("status").agg(F.countDistinct("object_id").alias("n_objects"))


LISTED = f"listed AS (SELECT *, {DISTINCT} FROM facts WHERE {AT} AND {DIMS} AND {OPEN})"


@register("a03_list_by_state", v.sql(v.FACTS_SQL, v.PEOPLE_SQL, ATTRS, LISTED, body="SELECT name, dimension, value, valid_from, valid_to, status, l.source_doc_id, doc_number FROM listed l JOIN people USING (object_id) LEFT JOIN attrs a ON a.source_doc_id = l.source_doc_id WHERE rn = 1"))
def a03(spark, sf_dir):
    found = t.distinct_facts(absent(spark, sf_dir).filter(t.at_date(DAY)), "status")
    named = found.join(v.people(spark, sf_dir), "object_id").join(doc_attributes(spark, sf_dir), "source_doc_id", "left")
    return named.select("name", "dimension", "value", "valid_from", "valid_to", "status", "source_doc_id", "doc_number")


@register("a04_person_status", v.sql(v.FACTS_SQL, v.PEOPLE_SQL, f"own AS (SELECT f.*, name, {DISTINCT} FROM facts f JOIN people USING (object_id) WHERE status <> 'rejected' AND regexp_matches(name, '\\bcustomer#0000001[0-9]{{2}}\\b', 'i'))", body="SELECT name, dimension, value, valid_from, valid_to, status FROM own WHERE rn = 1"))
def a04(spark, sf_dir):
    named = v.people(spark, sf_dir).filter(F.col("name").rlike(r"(?iu)\bcustomer#0000001[0-9]{2}\b"))
    found = v.facts(spark, sf_dir).filter("status <> 'rejected'").join(named, "object_id")
    return t.distinct_facts(found, "status").select("name", "dimension", "value", "valid_from", "valid_to", "status")


@register("a05_doc_by_number", v.sql(v.FACTS_SQL, f"own AS (SELECT *, {DISTINCT} FROM facts WHERE status <> 'rejected' AND source_doc_id IN (SELECT source_doc_id FROM facts WHERE dimension = '4-NOT SPECIFIED' AND trim(value) = 'No 77'))", body="SELECT id, object_id, dimension, value, source_doc_id, status FROM own WHERE rn = 1"))
def a05(spark, sf_dir):
    f = v.facts(spark, sf_dir)
    numbered = f.filter((F.col("dimension") == v.NUMBER) & (F.trim("value") == "No 77")).select("source_doc_id")
    found = f.filter("status <> 'rejected'").join(numbered, "source_doc_id", "left_semi")
    return t.distinct_facts(found, "status").select("id", "object_id", "dimension", "value", "source_doc_id", "status")


@register("a06_review_queue_count", v.sql(v.FACTS_SQL, v.QUEUE_SQL, body="SELECT queue_type, count(*) AS n FROM queue WHERE NOT resolved GROUP BY queue_type"))
def a06(spark, sf_dir):
    return v.review_queue(spark, sf_dir).filter("not resolved").groupBy("queue_type").agg(F.count("*").alias("n"))


@register("a07_unconfirmed_count", v.sql(v.FACTS_SQL, body="SELECT count(*) AS n_facts, count(DISTINCT source_doc_id) AS n_docs FROM facts WHERE status = 'unconfirmed'"))
def a07(spark, sf_dir):
    return v.facts(spark, sf_dir).filter("status = 'unconfirmed'").agg(F.count("*").alias("n_facts"), F.countDistinct("source_doc_id").alias("n_docs"))


@register("a08_documents_count", v.sql(v.REGISTRY_SQL, body="SELECT coalesce(domain, '(no domain)') AS domain, count(*) AS n FROM registry GROUP BY registry.domain"))
def a08(spark, sf_dir):
    return v.registry(spark, sf_dir).groupBy("domain").agg(F.count("*").alias("n")).select(F.coalesce("domain", F.lit("(no domain)")).alias("domain"), "n")


@register("a09_count_by_doc_type", v.sql(v.REGISTRY_SQL, body="SELECT coalesce(t.label, '(no type)') AS label, count(*) AS n FROM registry r LEFT JOIN (SELECT DISTINCT type, upper(type) AS label FROM registry WHERE type <> 'src3') t ON r.type = t.type GROUP BY t.label"))
def a09(spark, sf_dir):
    r = v.registry(spark, sf_dir)
    types = r.filter("type <> 'src3'").select("type", F.upper("type").alias("label")).distinct()
    return r.join(types, "type", "left").groupBy("label").agg(F.count("*").alias("n")).select(F.coalesce("label", F.lit("(no type)")).alias("label"), "n")


@register("a10_count_by_reason", v.sql(v.FACTS_SQL, ATTRS, body=f"SELECT status, coalesce(place, '(no reason)') AS reason, count(*) AS n FROM (SELECT DISTINCT status, place, object_id, valid_from, valid_to FROM facts LEFT JOIN attrs USING (source_doc_id) WHERE {IN} AND {DIMS} AND {OPEN}) GROUP BY status, place"))
def a10(spark, sf_dir):
    found = absent(spark, sf_dir).filter(t.in_period(FIRST, LAST)).join(doc_attributes(spark, sf_dir), "source_doc_id", "left")
    periods = F.count_distinct(F.struct("object_id", "valid_from", "valid_to")).alias("n")
    return found.groupBy("status", "place").agg(periods).select("status", F.coalesce("place", F.lit("(no reason)")).alias("reason"), "n")


@register("a11_returning_on_date", v.sql(v.FACTS_SQL, ATTRS, f"own AS (SELECT f.*, CASE WHEN regexp_matches(actual, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN try_cast(actual AS DATE) END AS back, {DISTINCT} FROM (SELECT *, CASE id % 6 WHEN 0 THEN '{DAY}' WHEN 1 THEN '1998-02-30' WHEN 2 THEN 'soon' END AS actual FROM facts) f WHERE {DIMS} AND {OPEN} AND coalesce(CASE WHEN regexp_matches(actual, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN try_cast(actual AS DATE) END, valid_to) = DATE '{DAY}')", body="SELECT id, object_id, status, back, valid_to FROM own WHERE rn = 1"))
def a11(spark, sf_dir):
    actual = F.when(F.col("id") % 6 == 0, DAY).when(F.col("id") % 6 == 1, "1998-02-30").when(F.col("id") % 6 == 2, "soon")
    back = F.when(F.col("actual").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.expr("try_cast(actual as date)"))
    found = absent(spark, sf_dir).withColumn("actual", actual).withColumn("back", back).filter(F.coalesce("back", "valid_to") == F.lit(DAY).cast("date"))
    return t.distinct_facts(found, "status").select("id", "object_id", "status", "back", "valid_to")


@register("a12_absent_breakdown", v.sql(v.FACTS_SQL, body=f"SELECT status, dimension, CAST(grouping(dimension) AS BIGINT) AS is_total, count(DISTINCT object_id) AS n FROM facts WHERE {AT} AND {OPEN} GROUP BY status, ROLLUP(dimension)"))
def a12(spark, sf_dir):
    found = v.facts(spark, sf_dir).filter(F.col("status").isin(*SHOWN) & t.at_date(DAY))
    found.createOrReplaceTempView("_a12")
    return spark.sql("SELECT status, dimension, CAST(grouping(dimension) AS BIGINT) AS is_total, count(DISTINCT object_id) AS n FROM _a12 GROUP BY GROUPING SETS ((status, dimension), (status))")


@register("a13_with_co_travelers", v.sql(v.FACTS_SQL, f"own AS (SELECT *, json_extract_string(info, '$.co_travelers') AS co, {DISTINCT} FROM facts WHERE {IN} AND {DIMS} AND {OPEN} AND trim(json_extract_string(info, '$.co_travelers')) <> '')", body="SELECT id, object_id, status, co FROM own WHERE rn = 1"))
def a13(spark, sf_dir):
    found = absent(spark, sf_dir).filter(t.in_period(FIRST, LAST)).withColumn("co", F.get_json_object("info", "$.co_travelers")).filter(F.trim("co") != "")
    return t.distinct_facts(found, "status").select("id", "object_id", "status", "co")


@register("a14_with_travel_document", v.sql(v.FACTS_SQL, f"""
periods AS (SELECT source_doc_id, object_id, arg_min(valid_from, id) AS p_from, arg_min(valid_to, id) AS p_to, min(id) AS pid FROM facts WHERE {DIMS} AND status = 'confirmed' GROUP BY 1, 2),
period AS (SELECT p.source_doc_id, p.object_id, f.valid_from AS p_from, f.valid_to AS p_to FROM periods p JOIN facts f ON f.id = p.pid)""", body=f"SELECT f.id, f.object_id, f.value, p_from, p_to FROM facts f LEFT JOIN period USING (source_doc_id, object_id) WHERE f.dimension = '4-NOT SPECIFIED' AND f.status = 'confirmed' AND (p_from IS NULL OR (p_from <= DATE '{LAST}' AND (p_to IS NULL OR p_to >= DATE '{FIRST}')))"))
def a14(spark, sf_dir):
    f = v.facts(spark, sf_dir).filter("status = 'confirmed'")
    first = F.min_by(F.struct("valid_from", "valid_to"), "id").alias("p")
    period = f.filter(F.col("dimension").isin(*ABSENT)).groupBy("source_doc_id", "object_id").agg(first).select("source_doc_id", "object_id", F.col("p.valid_from").alias("p_from"), F.col("p.valid_to").alias("p_to"))
    found = f.filter(F.col("dimension") == v.NUMBER).join(period, ["source_doc_id", "object_id"], "left")
    inside = (F.col("p_from") <= F.lit(LAST).cast("date")) & (F.col("p_to").isNull() | (F.col("p_to") >= F.lit(FIRST).cast("date")))
    return found.filter(F.col("p_from").isNull() | inside).select("id", "object_id", "value", "p_from", "p_to")


@register("a15_drafts_list", v.sql(v.FACTS_SQL, v.QUEUE_SQL, f"own AS (SELECT f.*, q.queue_type, {DISTINCT} FROM facts f LEFT JOIN queue q ON q.fact_id = f.id AND q.document_id = f.source_doc_id AND NOT q.resolved WHERE {DIMS} AND status = 'unconfirmed')", body="SELECT id, object_id, dimension, value, queue_type FROM own WHERE rn = 1"))
def a15(spark, sf_dir):
    tasks = v.review_queue(spark, sf_dir).filter("not resolved").select(F.col("fact_id").alias("id"), F.col("document_id").alias("source_doc_id"), "queue_type")
    found = absent(spark, sf_dir).filter("status = 'unconfirmed'").join(tasks, ["id", "source_doc_id"], "left")
    return t.distinct_facts(found, "status").select("id", "object_id", "dimension", "value", "queue_type")


@register("a16_date_conflict_docs", v.sql(v.FACTS_SQL, ATTRS, body="SELECT source_doc_id, any_value(doc_number) AS doc_number, any_value(place) AS place, count(*) AS n FROM facts LEFT JOIN attrs USING (source_doc_id) WHERE json_extract_string(info, '$.date_range_error') <> '' GROUP BY source_doc_id"))
def a16(spark, sf_dir):
    broken = v.facts(spark, sf_dir).filter(F.get_json_object("info", "$.date_range_error") != "").groupBy("source_doc_id").agg(F.count("*").alias("n"))
    return broken.join(doc_attributes(spark, sf_dir), "source_doc_id", "left").select("source_doc_id", "doc_number", "place", "n")


@register("a17_fact_provenance", v.sql(v.FACTS_SQL, v.PEOPLE_SQL, "linked AS (SELECT id AS fact_id, source_doc_id AS document_id, true AS is_primary FROM facts UNION ALL SELECT id, (id * 7) % 997, false FROM facts WHERE id % 2 = 0)", body="SELECT f.id, json_extract_string(any_value(info), '$.method') AS method, any_value(confidence) AS score, string_agg(CAST(document_id AS VARCHAR), ', ' ORDER BY is_primary DESC, document_id) AS documents FROM facts f JOIN people USING (object_id) JOIN linked ON fact_id = f.id WHERE name LIKE 'Customer#0000000%' GROUP BY f.id"))
def a17(spark, sf_dir):
    f = v.facts(spark, sf_dir).join(v.people(spark, sf_dir).filter("name like 'Customer#0000000%'"), "object_id", "left_semi")
    linked = f.select("id", F.col("source_doc_id").alias("document_id"), F.lit(0).alias("rank")).unionAll(f.filter("id % 2 = 0").select("id", ((F.col("id") * 7) % 997).alias("document_id"), F.lit(1).alias("rank")))
    documents = linked.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "document_id"))), lambda x: x["document_id"].cast("string")), ", ").alias("documents"))
    return f.select("id", F.get_json_object("info", "$.method").alias("method"), F.col("confidence").alias("score")).join(documents, "id")


TOPICS = {"thand": "the and", "queer": "que la", "geein": "die und", "losdel": "de los"}
TOPIC_VALUES = ", ".join(f"('{k}', '{w}')" for k, w in TOPICS.items())


@register("a18_normative_list", v.sql(v.REGISTRY_SQL, body=f"SELECT topic, count(*) AS n FROM (SELECT coalesce(topic, '(other)') AS topic FROM (SELECT id, substring(text, 1, 1200) AS head FROM registry WHERE domain = 'normative') h LEFT JOIN (VALUES {TOPIC_VALUES}) x(topic, phrase) ON contains(lower(head), phrase)) GROUP BY topic"))
def a18(spark, sf_dir):
    head = F.lower(F.substring("text", 1, 1200))
    hits = F.filter(F.array(*[F.when(head.contains(w), k) for k, w in TOPICS.items()]), lambda x: x.isNotNull())
    topics = F.when(F.size(hits) > 0, hits).otherwise(F.array(F.lit("(other)")))
    return v.registry(spark, sf_dir).filter("domain = 'normative'").select(F.explode(topics).alias("topic")).groupBy("topic").agg(F.count("*").alias("n"))


@register("a20_failed_docs_count", v.sql(v.FACTS_SQL, v.REGISTRY_SQL, body="SELECT (SELECT count(*) FROM registry WHERE domain IS NULL) AS no_domain, (SELECT count(*) FROM registry r WHERE NOT EXISTS (SELECT 1 FROM facts f WHERE f.source_doc_id = r.id)) AS no_facts, (SELECT count(*) FROM registry) AS total"))
def a20(spark, sf_dir):
    r = v.registry(spark, sf_dir).select("id", "domain")
    known = v.facts(spark, sf_dir).select(F.col("source_doc_id").alias("id")).distinct().withColumn("known", F.lit(True))
    return r.join(known, "id", "left").agg(F.count_if(F.col("domain").isNull()).alias("no_domain"), F.count_if(F.col("known").isNull()).alias("no_facts"), F.count("*").alias("total"))


@register("a21_count_in_subdivision", v.sql(v.FACTS_SQL, v.PEOPLE_SQL, body=f"SELECT status, count(DISTINCT object_id) AS n FROM facts WHERE {AT} AND {DIMS} AND {OPEN} AND object_id IN (SELECT object_id FROM people WHERE subdivision ILIKE '%nation_1%') GROUP BY status"))
def a21(spark, sf_dir):
    unit = v.people(spark, sf_dir).filter(F.col("subdivision").ilike("%nation_1%"))
    return absent(spark, sf_dir).filter(t.at_date(DAY)).join(unit, "object_id", "left_semi").groupBy("status").agg(F.countDistinct("object_id").alias("n"))


@register("a22_count_not_in_state", v.sql(v.FACTS_SQL, v.PEOPLE_SQL, body=f"SELECT (SELECT count(*) FROM people) AS total, count(DISTINCT object_id) FILTER (WHERE status = 'confirmed') AS confirmed, count(DISTINCT object_id) FILTER (WHERE status = 'unconfirmed') AS unconfirmed FROM facts WHERE {AT} AND {DIMS} AND {OPEN}"))
def a22(spark, sf_dir):
    found = absent(spark, sf_dir).filter(t.at_date(DAY))
    counts = found.agg(*[F.count_distinct(F.when(F.col("status") == s, F.col("object_id"))).alias(s) for s in SHOWN])
    return v.people(spark, sf_dir).agg(F.count("*").alias("total")).crossJoin(F.broadcast(counts))  # one row each


@register("a23_list_in_subdivision", v.sql(v.FACTS_SQL, v.PEOPLE_SQL, ATTRS, body=f"SELECT f.id, name, dimension, valid_from, valid_to, status, doc_number FROM facts f JOIN people p USING (object_id) LEFT JOIN attrs USING (source_doc_id) WHERE {AT} AND {DIMS} AND {OPEN} AND subdivision ILIKE '%nation_1%'"))
def a23(spark, sf_dir):
    unit = v.people(spark, sf_dir).filter(F.col("subdivision").ilike("%nation_1%"))
    found = absent(spark, sf_dir).filter(t.at_date(DAY)).join(unit, "object_id").join(doc_attributes(spark, sf_dir), "source_doc_id", "left")
    return found.select("id", "name", "dimension", "valid_from", "valid_to", "status", "doc_number")


@register("a24_subdivision_breakdown", v.sql(v.FACTS_SQL, v.PEOPLE_SQL, body=f"SELECT subdivision, count(DISTINCT object_id) AS n FROM facts JOIN people USING (object_id) WHERE {AT} AND {DIMS} AND status = 'confirmed' GROUP BY subdivision"))
def a24(spark, sf_dir):
    found = absent(spark, sf_dir).filter(t.at_date(DAY) & (F.col("status") == "confirmed"))
    return found.join(v.people(spark, sf_dir), "object_id").groupBy("subdivision").agg(F.countDistinct("object_id").alias("n"))


@register("a25_roster_total", v.sql(v.PEOPLE_SQL, body="SELECT count(*) AS total, count(service_id) AS in_roster FROM people"))
def a25(spark, sf_dir):
    return v.people(spark, sf_dir).agg(F.count("*").alias("total"), F.count("service_id").alias("in_roster"))


def by_place(spark: SparkSession, sf_dir: str, place: str) -> DataFrame:
    """Absences whose document names a place; a draft place still asks for a confirmed absence."""
    f = v.facts(spark, sf_dir)
    places = f.filter((F.col("dimension") == v.PLACE) & F.col("value").ilike(f"%{place}%") & F.col("status").isin(*SHOWN)).select("source_doc_id", F.col("status").alias("place_status"), F.col("value").alias("place"))
    states = f.filter(F.col("dimension").isin(*ABSENT) & (F.col("status") == "confirmed"))
    return places.join(states, "source_doc_id").select("object_id", "dimension", "valid_from", "valid_to", "place", "place_status").distinct()


PLACES = f"places AS (SELECT DISTINCT a.object_id, a.dimension, a.valid_from, a.valid_to, p.value AS place, p.status AS place_status FROM facts p JOIN facts a USING (source_doc_id) WHERE p.dimension = '5-LOW' AND p.value ILIKE '%place 1%' AND p.status IN ('confirmed', 'unconfirmed') AND a.{DIMS} AND a.status = 'confirmed')"


@register("a26_list_by_place", v.sql(v.FACTS_SQL, PLACES, body="SELECT * FROM places"))
def a26(spark, sf_dir):
    return by_place(spark, sf_dir, "place 1")


@register("a27_place_within_state", v.sql(v.FACTS_SQL, PLACES, body=f"SELECT * FROM places WHERE {AT} AND dimension = '1-URGENT'"))
def a27(spark, sf_dir):
    return by_place(spark, sf_dir, "place 1").filter(t.at_date(DAY) & (F.col("dimension") == "1-URGENT"))


REFUSALS = {"date_invalid": "The date doesn't exist.", "subdivision_unknown": "No such subdivision.", "absent_without_docs": "Absence without documents isn't recorded.", "place_unknown": "No such place.", "smalltalk": "Ask about documents."}


@register("a28_blocked_templates", "SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{m.replace(chr(39), chr(39) * 2)}', true)" for k, m in REFUSALS.items()) + ") x(template, message, blocked)")
def blocked(spark, sf_dir):
    return spark.createDataFrame([(k, m, True) for k, m in REFUSALS.items()], "template string, message string, blocked boolean")


@register("a29_subdivision_table", v.sql(v.FACTS_SQL, v.PEOPLE_SQL, f"away AS (SELECT DISTINCT object_id FROM facts WHERE {AT} AND {DIMS} AND status = 'confirmed')", body="SELECT subdivision, count(*) AS total, count(a.object_id) AS absent FROM people p LEFT JOIN away a ON a.object_id = p.object_id GROUP BY subdivision"))
def a29(spark, sf_dir):
    away = absent(spark, sf_dir).filter(t.at_date(DAY) & (F.col("status") == "confirmed")).select("object_id").distinct().withColumn("away", F.lit(1))
    return v.people(spark, sf_dir).join(away, "object_id", "left").groupBy("subdivision").agg(F.count("*").alias("total"), F.count("away").alias("absent"))


@register("a30_coverage", v.sql(v.FACTS_SQL, body="SELECT dimension, min(valid_from) AS first_day, max(valid_to) AS last_day, count(*) AS n FROM facts WHERE status = 'confirmed' GROUP BY dimension"))
def a30(spark, sf_dir):
    return v.facts(spark, sf_dir).filter("status = 'confirmed'").groupBy("dimension").agg(F.min("valid_from").alias("first_day"), F.max("valid_to").alias("last_day"), F.count("*").alias("n"))


@register("a40_source_envelope", v.sql(v.FACTS_SQL, ATTRS, body=f"SELECT source_doc_id, any_value(doc_number) AS doc_number, count(DISTINCT f.id) AS n_facts, max(valid_from) AS newest FROM facts f LEFT JOIN attrs USING (source_doc_id) WHERE {IN} AND {DIMS} AND status = 'confirmed' GROUP BY source_doc_id"))
def a40(spark, sf_dir):
    found = absent(spark, sf_dir).filter(t.in_period(FIRST, LAST) & (F.col("status") == "confirmed")).groupBy("source_doc_id").agg(F.countDistinct("id").alias("n_facts"), F.max("valid_from").alias("newest"))
    return found.join(doc_attributes(spark, sf_dir), "source_doc_id", "left").select("source_doc_id", "doc_number", "n_facts", "newest")


@register("d14_answer_envelope", v.sql(v.FACTS_SQL, v.PEOPLE_SQL, body=f"SELECT DATE '{DAY}' AS slice_date, (SELECT count(*) FROM people) AS denominator, count(DISTINCT object_id) FILTER (WHERE {AT} AND status = 'confirmed') AS confirmed, count(DISTINCT object_id) FILTER (WHERE {AT} AND status = 'unconfirmed') AS drafts, coalesce(min(valid_from) FILTER (WHERE status = 'confirmed') <= DATE '{DAY}', false) AS covered FROM facts WHERE {DIMS}"))
def d14(spark, sf_dir):
    f = v.facts(spark, sf_dir).filter(F.col("dimension").isin(*ABSENT))
    now = [F.count_distinct(F.when(t.at_date(DAY) & (F.col("status") == s), F.col("object_id"))).alias(n) for s, n in (("confirmed", "confirmed"), ("unconfirmed", "drafts"))]
    covered = F.coalesce(F.min(F.when(F.col("status") == "confirmed", F.col("valid_from"))) <= F.lit(DAY).cast("date"), F.lit(False)).alias("covered")
    total = v.people(spark, sf_dir).agg(F.count("*").alias("denominator"))
    return f.agg(*now, covered).crossJoin(F.broadcast(total)).select(F.lit(DAY).cast("date").alias("slice_date"), "denominator", "confirmed", "drafts", "covered")  # one row each
